"""Gold: city dimension, daily fact, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import band, surrogate_key
from tidemark.operators.clean import staging_projection
from tidemark.operators.joins import join_dimension, join_streams_daily
from tidemark.operators.rollup import daily_rollup, latest_per_key
from tidemark.operators.windows import lag_features, rolling_mean
from tidemark.plans import defaults as D
from tidemark.sources.tables import literal_relation


def dim_build(members: DataFrame, key: str = "city", key_name: str = "city_id", created_at: str | None = None) -> DataFrame:
    """Dimension rows with an md5 key and a creation time (now, unless given)."""
    stamp = F.current_timestamp() if created_at is None else F.to_timestamp(F.lit(created_at))
    return members.select(surrogate_key(key).alias(key_name), *members.columns, stamp.alias("created_at"))


def city_dimension(spark: SparkSession, created_at: str | None = None) -> DataFrame:
    return dim_build(literal_relation(spark, D.CITIES, D.CITY_SCHEMA), created_at=created_at)


def stage_weather(silver: DataFrame) -> DataFrame:
    return staging_projection(silver, D.STAGING_WEATHER)


def stage_air_quality(silver: DataFrame) -> DataFrame:
    return staging_projection(silver, D.STAGING_AIR_QUALITY)


def weather_days(staged: DataFrame) -> DataFrame:
    return daily_rollup(staged, D.DAILY_KEYS, D.WEATHER_ROLLUP, "hourly_weather_records")


def air_quality_days(staged: DataFrame) -> DataFrame:
    return daily_rollup(staged, D.DAILY_KEYS, D.AIR_QUALITY_ROLLUP, "hourly_aq_records")


def fct_from_days(weather: DataFrame, air_quality: DataFrame) -> DataFrame:
    """Daily rollups of both streams to the fact; lags and rolling mean share one sort."""
    city, day = D.DAILY_KEYS
    joined = join_streams_daily(weather, air_quality, [city, day]).select(
        surrogate_key(city, day).alias("daily_metric_id"),
        city,
        day,
        *D.WEATHER_ROLLUP,
        *D.AIR_QUALITY_ROLLUP,
        band("avg_us_aqi", D.AQI_CUTS, D.AQI_TOP).alias("aqi_category"),
        "hourly_weather_records",
        "hourly_aq_records",
    )
    return joined.withColumns(
        {
            **lag_features(city, day, "avg_us_aqi", D.FACT_LAGS, "lag_{step}d_aqi"),
            "rolling_7d_avg_aqi": rolling_mean(city, day, "avg_us_aqi", D.FACT_ROLLING, 1),
        }
    )


def fct_daily(weather: DataFrame, air_quality: DataFrame) -> DataFrame:
    """Two staged streams to one fact row per (city, day); both are reduced to days before they meet."""
    return fct_from_days(weather_days(weather), air_quality_days(air_quality))


def latest_city_summary(fact: DataFrame, dim: DataFrame, dim_columns: Sequence[str] | None = None) -> DataFrame:
    """Newest fact row of each city with its dimension columns, worst air first.

    Only the newest rows meet the dimension.
    """
    columns = dim_columns or ["city_name", "state", "latitude", "longitude", "population_tier"]
    newest = latest_per_key(fact, "city", "metric_date")
    joined = join_dimension(newest, dim.select("city", *columns), "city")
    return joined.orderBy(F.col("avg_us_aqi").desc_nulls_last(), "city")


def daily_metrics_snapshot(fact: DataFrame) -> DataFrame:
    ordered = fact.select(*D.SNAPSHOT_COLUMNS)
    return ordered.orderBy(F.col("metric_date").asc_nulls_last(), F.col("city").asc_nulls_last())
