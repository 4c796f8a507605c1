"""Grouped aggregates. All combine partially before their shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col, improvement_pct, round_half_away, round_half_away_sql
from tidemark.operators.clean import dedupe_latest

_FUNCTIONS = ("avg", "min", "max", "sum")

# {output: (function, input column, digits)}
Measures = Mapping[str, tuple[str, str, int]]


def daily_rollup(df: DataFrame, keys: Sequence[str], measures: Measures, count_as: str) -> DataFrame:
    """Rounded aggregates and a row count per key and day."""
    aggregates = []
    for name, (function, source, digits) in measures.items():
        if function not in _FUNCTIONS:
            raise ValueError(f"unknown aggregate {function!r}")
        rounded = round_half_away_sql(f"{function}(`{source}`)", digits)
        aggregates.append(F.expr(f"{rounded} AS `{name}`"))
    return df.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias(count_as))


def latest_per_key(df: DataFrame, key: str, order_by: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Whole newest row per key; one row per key and input partition reaches the shuffle."""
    return dedupe_latest(df, [key], [order_by], tie_break)


def last_row_per_key(df: DataFrame, key: str, order_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest row of each series through one aggregate over a struct, no sort of the series."""
    newest = F.max_by(F.struct(*columns), F.struct(*order_by)).alias("_newest")
    return df.groupBy(key).agg(newest).select(key, *[F.col("_newest")[c].alias(c) for c in columns])


def latest_non_null_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Per column, its newest value that is not null."""
    order = F.struct(*order_by)
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def dataset_window(df: DataFrame, key: str, date: str, label: str) -> DataFrame:
    """Days, labelled days and date range of each series."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count(label).alias("labeled_days"),
        F.min(date).alias("start_date"),
        F.max(date).alias("end_date"),
    )


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table; each count is a metadata-light scan with no columns read."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def monotone_counts(live: DataFrame, prior: DataFrame, key: str = "layer", count: str = "row_count") -> DataFrame:
    """Live counts that never fall below the prior ones; layers only the prior knows are kept."""
    before = prior.select(key, F.col(count).alias("prior_count"))
    joined = live.select(key, F.col(count).alias("live_count")).join(before, key, "full_outer")
    return joined.select(
        key,
        F.greatest(F.coalesce("live_count", F.lit(0)), F.coalesce("prior_count", F.lit(0))).alias(count),
    )


def mean_absolute_error(actual: str | Column, predicted: str | Column) -> Column:
    return F.avg(F.abs(as_col(actual) - as_col(predicted)))


def aggregate_scores(scores: DataFrame) -> DataFrame:
    """Mean validation, test and baseline error over keys, overall gain, keys that beat the baseline."""
    means = scores.agg(
        F.avg("val_mae").alias("val"),
        F.avg("test_mae").alias("test"),
        F.avg("naive_baseline_mae").alias("base"),
        F.count_if(F.col("beats_baseline")).alias("keys_beating_baseline"),
        F.count(F.lit(1)).alias("total_keys"),
    )
    return means.select(
        round_half_away("val", 2).alias("val_mae"),
        round_half_away("test", 2).alias("test_mae"),
        round_half_away("base", 2).alias("base_mae"),
        improvement_pct("base", "test").alias("overall_delta_pct"),
        "keys_beating_baseline",
        "total_keys",
    )


def argmin_config(scores: DataFrame, config: str, score: str) -> DataFrame:
    """Configurations ranked by mean score to nine digits; the first row wins, names break ties."""
    mean = scores.groupBy(config).agg(F.round(F.avg(score), 9).alias("mean_score"))
    return mean.orderBy(F.col("mean_score").asc_nulls_last(), config)
