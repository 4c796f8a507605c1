"""Joins, set operations and reshaping between streams, dimensions and forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col


def join_streams_daily(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two rollups already hash-partitioned on ``keys``; a day in one stream only vanishes."""
    return left.join(right, list(keys), "inner")


def join_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join; Spark broadcasts the dimension when its measured size allows it."""
    return fact.join(dim, key, "inner")


def join_prediction_default(
    summary: DataFrame, predictions: DataFrame, key: str, actual: str, predicted: str
) -> DataFrame:
    """Left join; a key without a prediction carries its current value. ``delta = predicted - actual``."""
    joined = summary.join(predictions.select(key, predicted), key, "left")
    value = F.coalesce(F.col(predicted), F.col(actual))
    return joined.withColumn(predicted, value).withColumn("delta", F.col(predicted) - F.col(actual))


def missing_dates(
    landed: DataFrame, key: str, date: str, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(key, date) pairs of the calendar ``start``..``end`` that have not landed.

    Days are cut to the calendar and made distinct per key before anything is
    gathered, so a key's set is at most the calendar long; the difference is
    taken inside the row. A key with no day inside the calendar misses all of it.
    """
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    inside = F.when(F.col(date).between(first, last), F.col(date)).alias(date)
    days = landed.select(key, inside).distinct()
    per_key = days.groupBy(key).agg(F.collect_list(date).alias("landed"))
    missing = F.array_except(F.sequence(first, last), F.col("landed"))
    return per_key.select(key, F.explode(missing).alias(date))


def route_by_age(date: str | Column, today: dt.date | str, archive_after: int = 5) -> Column:
    """``archive`` for dates at least ``archive_after`` days old, else ``forecast``."""
    age = F.datediff(F.lit(str(today)).cast("date"), as_col(date))
    return F.when(age >= archive_after, "archive").otherwise("forecast")


def append_forecast_point(series: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Series rows plus forecast rows, whose actual columns are null."""
    return series.unionByName(forecasts, allowMissingColumns=True)


def unpivot_measures(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``{column: shown name}`` to (name, value) rows; reads the row once."""
    renamed = df.select(*ids, *[F.col(c).cast("double").alias(shown) for c, shown in columns.items()])
    shown = [F.col(f"`{name}`") for name in columns.values()]
    return renamed.unpivot(list(ids), shown, "name", "value")
