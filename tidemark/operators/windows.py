"""Per-series windows.

They run on daily rollups, where (key, date) is unique: a series holds at most one
row per calendar day however many raw rows its key has, so partitioning by key is
safe even when one key owns much of the raw data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away


def series_window(key: str, date: str):
    return Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())


def lag_features(key: str, date: str, value: str, steps: Sequence[int], name: str) -> dict[str, Column]:
    """Row-based lags: after a gap in the dates, lag 1 is the previous row and not the previous day."""
    w = series_window(key, date)
    return {name.format(step=n): F.lag(value, n).over(w) for n in steps}


def rolling_mean(key: str, date: str, value: str, rows: int = 7, digits: int = 1) -> Column:
    """Mean over the current row and the ``rows - 1`` before it; partial at the start."""
    w = series_window(key, date).rowsBetween(-(rows - 1), 0)
    return round_half_away(F.avg(value).over(w), digits)


def reachable_rows(series: DataFrame, changed: DataFrame, key: str, date: str, rows: int) -> DataFrame:
    """Which rows of a windowed table can move, and which are needed to work them out again.

    ``series`` holds the (key, date) of every row, ``changed`` those that are new or different. By row position a
    change reaches its own row and the ``rows`` - 1 after it, and each of these looks at the ``rows`` - 1 before it.
    Returns (key, date, ``moves``); rows that are neither are left out. Only keys are read and sorted.
    """
    w = series_window(key, date)
    marked = series.select(key, date).join(changed.select(key, date).distinct().withColumn("_new", F.lit(True)), [key, date], "left")
    moved = marked.withColumn("moves", F.coalesce(F.max("_new").over(w.rowsBetween(-(rows - 1), 0)), F.lit(False))).drop("_new")
    return moved.withColumn("_needed", F.max("moves").over(w.rowsBetween(0, rows - 1))).filter("_needed").drop("_needed")


def lead_target(key: str, date: str, value: str) -> Column:
    return F.lead(value, 1).over(series_window(key, date))


def next_day_lookup(key: str, date: str, value: str) -> Column:
    """Value on the next calendar day, null when that day is missing.

    Dates are unique per key, so the next row either is that day or no row is;
    one window does it without a self-join.
    """
    w = series_window(key, date)
    return F.when(F.lead(date, 1).over(w) == F.date_add(F.col(date), 1), F.lead(value, 1).over(w))


def labelled_rows(key: str, label: str) -> Column:
    """Rows of the series that have a label."""
    return F.count(F.col(label)).over(Window.partitionBy(key))


def chronological_split(
    key: str, date: str, label: str, test: int = 12, val: int = 8, min_train: int = 5
) -> Column:
    """``train`` / ``val`` / ``test`` by position among the labelled rows, newest last.

    A series with fewer than ``test + val + min_train`` labelled rows is ``short``;
    rows without a label are ``unlabelled``.
    """
    unlabelled = F.col(label).isNull()
    newest_first = Window.partitionBy(key).orderBy(unlabelled, F.col(date).desc_nulls_first())
    position = F.row_number().over(newest_first)
    return (
        F.when(unlabelled, "unlabelled")
        .when(labelled_rows(key, label) < test + val + min_train, "short")
        .when(position <= test, "test")
        .when(position <= test + val, "val")
        .otherwise("train")
    )
