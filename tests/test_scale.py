"""Plans that must hold on large data: partial aggregates, pruned scans, no forced broadcast, hot keys."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import fixtures as fx
from tidemark.operators.joins import join_dimension, missing_dates
from tidemark.operators.rollup import latest_non_null_per_key
from tidemark.operators.upsert import key_uniqueness_profile, keyed_upsert
from tidemark.plans import gold
from tidemark.session import scratch_path, sizing

PLANS = entry.queries()
SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(keys[0])
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    spark.conf.set(keys[0], before)
    spark.conf.unset(keys[1])


# Queries whose plan is built without running the whole lake.
PLANNED = [
    "fct_daily", "latest_city_summary", "daily_metrics_snapshot", "dedupe_latest", "latest_per_key", "keyed_upsert",
    "join_dimension", "join_streams_daily", "missing_dates", "next_day_lookup", "feature_frame", "chronological_split",
    "dq_report", "monotone_counts", "literal_relation", "dim_build",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_forced_broadcast(spark, no_broadcast, name):
    """With broadcasts switched off every join falls back to a shuffle: no hint insists on one."""
    text = plan_of(PLANS[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "EvalPython"):
        assert operator not in text


def test_flagship_reduces_before_it_shuffles(spark, no_broadcast):
    text = plan_of(fx.fact(spark, SF))
    assert text.count("Exchange hashpartitioning") == 3
    assert "partial_avg" in text and text.count("Sort [city") <= 3
    # One window operator serves three lags and the rolling mean.
    assert len(re.findall(r"- Window \[", text)) == 1
    assert "event_id" not in re.search(r"FileScan parquet \[(.*?)\]", text).group(1)


def test_key_filter_reaches_the_scan(spark):
    assert "EqualTo(event_type,purchase)" in plan_of(PLANS["filter_key"](spark, SF))


def test_two_column_projection_reads_two_columns(spark):
    text = plan_of(PLANS["payload_checksum"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in text


def hot(spark, n=30_000):
    """A third of all rows belongs to one key."""
    return spark.range(n).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k"), F.expr("id AS v"), F.expr("CASE WHEN id % 2 = 0 THEN id END AS w")
    )


def test_hot_key_join_is_split_and_whole(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = hot(spark).repartition(8)
        dim = spark.range(30_000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")).repartition(4)
        joined = join_dimension(facts, dim, "k")
        assert joined.count() == 30_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 30_000 and all(r.name == f"n{r.k}" for r in rows)
        assert "skew=true" in plan_of(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_aggregates_are_exact(spark):
    rows = hot(spark)
    newest = {r.k: (r.v, r.w) for r in latest_non_null_per_key(rows, ["k"], ["v"], ["v", "w"]).collect()}
    assert newest[0] == (29_997, 29_994)
    counts = key_uniqueness_profile(rows, ["k"]).collect()
    assert [(r.k, r.n_rows) for r in counts] == [(0, 10_000)]


def test_hot_day_is_upserted_into_several_files(spark):
    """Rebalancing splits a day that outgrows one task; rows stay whole."""
    from tidemark.functions.schemas import struct_of
    from tidemark.sources.snapshots import VersionedTable

    schema = struct_of({"k": "bigint", "day": "date", "x": "string"})
    table = VersionedTable(spark, scratch_path(spark, "hot"), schema, ["k", "day"], "day")
    rows = spark.range(20_000).select(
        F.col("id").alias("k"), F.lit("2026-01-01").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    ).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        table.upsert(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = table.read().select(F.input_file_name()).distinct().count()
    assert files > 1 and table.read().count() == 20_000


def test_null_keys_of_a_third_of_the_target_survive(spark):
    target = hot(spark, 3000).select(F.expr("nullif(k, 0) AS k"), "v")
    source = target.filter("k % 10 = 1").withColumn("v", F.lit(-1).cast("bigint"))
    merged = keyed_upsert(target, source, ["k"])
    assert merged.count() == 3000
    assert merged.filter("k IS NULL").count() == 1000


def test_missing_dates_keeps_keys_outside_the_calendar(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', DATE '2026-01-02'), ('b', DATE '2020-05-05'), ('c', NULL) AS t(k, d)")
    got = sorted((r.k, str(r.d)) for r in missing_dates(rows, "k", "d", "2026-01-01", "2026-01-02").collect())
    assert got == [("a", "2026-01-01"), ("b", "2026-01-01"), ("b", "2026-01-02"), ("c", "2026-01-01"), ("c", "2026-01-02")]


def test_gold_reads_daily_rollups_not_raw(spark):
    """The fact can be rebuilt from stored days alone and equals the direct plan."""
    weather, air = fx.staged_weather(spark, SF), fx.staged_air_quality(spark, SF)
    path = scratch_path(spark, "days")
    gold.weather_days(weather).write.parquet(f"{path}/w")
    gold.air_quality_days(air).write.parquet(f"{path}/a")
    stored = gold.fct_from_days(spark.read.parquet(f"{path}/w"), spark.read.parquet(f"{path}/a"))
    direct = gold.fct_daily(weather, air)
    assert sorted(map(str, stored.collect())) == sorted(map(str, direct.collect()))


def test_sizing_follows_the_volume():
    small, large = sizing(10 * 1024**3, 32), sizing(100 * 1024**4, 4000)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert int(large["spark.sql.shuffle.partitions"]) == 524288


def test_cluster_must_name_a_shared_folder(spark, monkeypatch):
    from tidemark import session

    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}

    with pytest.raises(RuntimeError):
        session.shared_root(Fake())
