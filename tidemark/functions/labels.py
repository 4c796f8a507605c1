"""Text and label expressions: category bands, surrogate keys, checksums, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col


def band(
    value: str | Column,
    cuts: Sequence[tuple[float, str]],
    top_label: str,
    null_label: str | None = None,
) -> Column:
    """First label whose upper bound (inclusive) holds the value, else ``top_label``.

    A null value compares as unknown and so ends in the top band, as it does in a
    SQL CASE; ``null_label`` overrides that.
    """
    c = as_col(value)
    first, *rest = [(c <= F.lit(float(upper)), label) for upper, label in cuts]
    expr = F.when(first[0], first[1])
    for condition, label in rest:
        expr = expr.when(condition, label)
    if null_label is not None:
        return F.when(c.isNull(), null_label).otherwise(expr.otherwise(top_label))
    return expr.otherwise(top_label)


def surrogate_key(*columns: str | Column, separator: str = "_") -> Column:
    """md5 over the joined parts; null when any part is null."""
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(separator))
        parts.append(as_col(c).cast("string"))
    return F.md5(F.concat(*parts))


def payload_checksum(payload: str | Column) -> Column:
    return F.sha2(as_col(payload).cast("string"), 256)


def threshold_text(value: str | Column, limit: float, above: str, otherwise: str) -> Column:
    return F.when(as_col(value) > F.lit(float(limit)), above).otherwise(otherwise)


def month_day(date: str | Column) -> Column:
    return F.date_format(as_col(date), "MM-dd")


def iso_date(date: str | Column) -> Column:
    return F.date_format(as_col(date), "yyyy-MM-dd")
