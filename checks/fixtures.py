"""Driver tables in the shapes the operators expect. Every fixture reads its whole table, and its rows grow with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import gold
from tidemark.session import scratch_path
from tidemark.sources import raw

RUN_TS = "2024-02-01 03:00:00"
PROPS = T.StructType([T.StructField("k", T.IntegerType())])
DOC_MEASURES = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "weather_code"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = raw.parse_json_column(table(spark, sf_dir, "events"), "props", PROPS, "parsed")
    return parsed.selectExpr("* EXCEPT (parsed)", "parsed.k AS k")


# Stream measures out of an event's value and k; a few temperatures are missing.
WEATHER = {
    "temperature_2m": "CASE WHEN k != 0 THEN value END",
    "relative_humidity_2m": "CAST(k AS DOUBLE)",
    "precipitation": "greatest(value - k, 0D)",
    "wind_speed_10m": "abs(value - k)",
    "weather_code": "k",
}
AIR_QUALITY = {
    "pm10": "value + k",
    "pm2_5": "CAST(k AS DOUBLE)",
    "carbon_monoxide": "value * 2",
    "nitrogen_dioxide": "k * 0.5D",
    "sulphur_dioxide": "value * 0.5D",
    "ozone": "CAST(100 - k AS DOUBLE)",
    "european_aqi": "CAST(k AS DOUBLE)",
    "us_aqi": "value",
}


def _observations(spark: SparkSession, sf_dir: str, measures: dict[str, str]) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "event_type AS city",
        "to_date(ts) AS date",
        "hour(ts) AS hour",
        "ts AS datetime_utc",
        *[f"{expression} AS {name}" for name, expression in measures.items()],
        "concat('events/', event_type) AS source_file",
        f"TIMESTAMP_NTZ '{RUN_TS}' AS silver_processed_at",
    )


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observations(spark, sf_dir, WEATHER)


def silver_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observations(spark, sf_dir, AIR_QUALITY)


def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stage_weather(silver_weather(spark, sf_dir))


def staged_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stage_air_quality(silver_air_quality(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_daily(staged_weather(spark, sf_dir), staged_air_quality(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str, measures: dict[str, str]) -> DataFrame:
    """Observations stamped with their hour: many ingestions of one (city, time), the newest event wins."""
    return events(spark, sf_dir).selectExpr(
        "event_type AS city",
        "date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm\") AS time",
        *[f"CAST({expression} AS DOUBLE) AS {name}" for name, expression in measures.items()],
        "concat('events/', event_type) AS source_file",
        "sha2(props, 256) AS payload_hash",
        "ts AS ingestion_timestamp",
    )


# Raw documents: every event is one item of its user's document; ``precipitation`` carries the event's id.
ITEM = {
    "temperature_2m": "value",
    "relative_humidity_2m": "CAST(k AS DOUBLE)",
    "precipitation": "CAST(event_id AS DOUBLE)",
    "wind_speed_10m": "abs(value - k)",
    "weather_code": "CAST(k AS DOUBLE)",
}
AIR_ITEM = {"pm10": "abs(value - k)", "pm2_5": "CAST(k AS DOUBLE)", "us_aqi": "least(value, 500D)"}


def items(spark: SparkSession, sf_dir: str, measures: dict[str, str] = ITEM) -> DataFrame:
    """One row per event: its user as city, its day, hour and minute, and the stream's measures."""
    return events(spark, sf_dir).selectExpr(
        "concat('user-', user_id) AS city",
        "to_date(ts) AS date",
        "hour(ts) AS hour",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm\") AS time",
        *[f"{expression} AS {name}" for name, expression in measures.items()],
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event with the highest number of every (city, day, hour)."""
    newest = F.max_by(F.struct("time", *DOC_MEASURES), "precipitation").alias("newest")
    return items(spark, sf_dir).groupBy("city", "date", "hour").agg(newest).select("city", "date", "hour", "newest.*")


def packed(spark: SparkSession, sf_dir: str, keys: list[str], measures: dict[str, str] = ITEM) -> DataFrame:
    """Events packed into parallel arrays; a group is a user's day or series."""
    item = F.struct("time", *measures)
    grouped = items(spark, sf_dir, measures).groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    arrays = [F.col("items")[c].alias(c) for c in ("time", *measures)]
    return grouped.select(*keys, F.struct(*arrays).alias("hourly"))


def documents(spark: SparkSession, sf_dir: str, measures: dict[str, str] = ITEM, pretty: bool = False) -> DataFrame:
    """(city, target_date, payload): one JSON document per city and day."""
    meta = F.struct("city", F.col("date").cast("string").alias("target_date"))
    return packed(spark, sf_dir, ["city", "date"], measures).select(
        "city",
        F.col("date").cast("string").alias("target_date"),
        F.to_json(F.struct("hourly", meta.alias("_metadata")), {"pretty": str(pretty).lower()}).alias("payload"),
    )


def city_documents(spark: SparkSession, sf_dir: str, measures: dict[str, str] = ITEM) -> DataFrame:
    """(city, payload): one JSON document per city with all of its days."""
    payload = F.to_json(F.struct("hourly", F.struct("city").alias("_metadata")), {"pretty": "true"})
    return packed(spark, sf_dir, ["city"], measures).select("city", payload.alias("payload"))


def write_packed(docs: DataFrame, path: str) -> str:
    """One file per document in a folder per city below the stream's folder, packed as lines of a few files."""
    city = F.when(F.col("city") != "", F.replace(F.url_encode("city"), F.lit("+"), F.lit("%20")))
    folder = F.concat(F.lit(f"{path.rsplit('/', 1)[1]}/city="), F.coalesce(city, F.lit("__HIVE_DEFAULT_PARTITION__")))
    name = F.concat(F.lit("/part-"), F.hex(F.xxhash64("payload")), F.lit(".txt"))
    files = docs.select(F.concat(folder, name).alias("path"), F.concat("payload", F.lit("\n")).alias("payload"))
    files.select(raw.packed().alias("value")).write.mode("append").text(path)
    return path


def write_lines(docs: DataFrame, path: str) -> str:
    """Documents as lines of as many files as their aggregation has partitions."""
    docs.select("payload").write.mode("append").text(path)
    return path


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_name", "r_name")
    )
