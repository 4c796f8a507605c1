"""Cleaning: typed columns, bounds, quarantine, latest-wins deduplication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import any_of, as_col

MINUTE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"


def parse_minute_time(time: str | Column) -> Column:
    """``YYYY-MM-DDTHH:MM`` to a zone-free timestamp; anything else is null.

    The cast goes straight to TIMESTAMP_NTZ, so no session zone can shift a day.
    """
    c = as_col(time)
    return F.when(c.rlike(MINUTE_TIME), c.try_cast("timestamp_ntz"))


def derive_time_keys(df: DataFrame, time: str = "time", observed_at: str = "datetime_utc") -> DataFrame:
    with_time = df.withColumn(observed_at, parse_minute_time(time))
    return with_time.withColumns(
        {"date": F.to_date(F.col(observed_at)), "hour": F.hour(F.col(observed_at)).cast("int")}
    )


def cast_measures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast in place; a value that does not convert becomes null and meets the bounds check."""
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in types.items()})


def select_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def bounds_mask(rules: Mapping[str, tuple[float, float]], required: Sequence[str] = ()) -> Column:
    """True where any column leaves its closed range or a required column is null.

    Three-valued: unknown when a ruled column is null and nothing else is wrong.
    """
    outside = [
        (F.col(name) < F.lit(float(low))) | (F.col(name) > F.lit(float(high)))
        for name, (low, high) in rules.items()
    ]
    return any_of(outside + [F.col(name).isNull() for name in required])


def split_clean_reject(df: DataFrame, mask: Column, on_null: str = "drop") -> tuple[DataFrame, DataFrame]:
    """(clean, rejected). Rows with an unknown mask are dropped, kept or rejected."""
    if on_null == "drop":
        return df.filter(~mask), df.filter(mask)
    if on_null == "keep":
        known = F.coalesce(mask, F.lit(False))
    elif on_null == "reject":
        known = F.coalesce(mask, F.lit(True))
    else:
        raise ValueError(f"on_null must be drop, keep or reject, not {on_null!r}")
    return df.filter(~known), df.filter(known)


def quarantine(rejected: DataFrame, reason: str, source_type: str, at: dt.datetime | str) -> DataFrame:
    return rejected.withColumns(
        {
            "quarantine_reason": F.lit(reason),
            "source_type": F.lit(source_type),
            "quarantined_at": F.to_timestamp(F.lit(str(at))).cast("timestamp_ntz"),
        }
    )


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key, taken whole (nulls included).

    ``row_number() = 1`` lets Spark keep one row per key in every input partition
    before the shuffle, so a key holding much of the table does not gather in one
    task. Name enough tie-break columns to make the order total.
    """
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *tie_break]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def filter_key(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    return df.dropna(subset=[label])


def select_exclude(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def staging_projection(df: DataFrame, columns: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """``{output: (input, type)}``: rename and cast in one projection; type None keeps the input's."""
    return df.selectExpr(
        *[
            f"`{source}` AS `{name}`" if dtype is None else f"CAST(`{source}` AS {dtype}) AS `{name}`"
            for name, (source, dtype) in columns.items()
        ]
    )
