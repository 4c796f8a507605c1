"""Cleaning, deduplication, upsert and versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.clean import bounds_mask, dedupe_latest, derive_time_keys, split_clean_reject
from tidemark.operators.upsert import DuplicateKeyError, key_uniqueness_profile, keyed_upsert
from tidemark.plans import defaults as D
from tidemark.plans.silver import AIR_QUALITY, WEATHER, build_silver
from tidemark.session import scratch_path
from tidemark.sources.snapshots import VersionedTable

RUN = "2026-09-23 03:00:00"


def bronze(spark, rows):
    """rows of (city, time, temperature, humidity, wind, ingested)."""
    full = [
        (c, t, temp, hum, 0.0, wind, 1.0, "weather/f.json", "h", dt.datetime.fromisoformat(at))
        for c, t, temp, hum, wind, at in rows
    ]
    return spark.createDataFrame(full, WEATHER.bronze_schema)


def hours(spark, base, city="delhi", n=24):
    day = dt.date(2026, 9, 22)
    rows = [
        (city, day, h, dt.datetime(2026, 9, 22, h), base + h * 0.2, 55.0, 0.0, 12.5, 1, "f.json", dt.datetime(2026, 9, 22, 10))
        for h in range(n)
    ]
    return spark.createDataFrame(rows, WEATHER.silver_schema)


@pytest.fixture
def table(spark, lake_root):
    return VersionedTable(spark, f"{lake_root}/silver", WEATHER.silver_schema, D.SILVER_KEYS, "date")


def test_upsert_twice_leaves_no_duplicates(spark, table):
    table.upsert(hours(spark, 30.0))
    assert table.read().count() == 24
    table.upsert(hours(spark, 31.0))
    result = table.read()
    assert result.count() == 24
    assert result.filter("hour = 0").first().temperature_2m == 31.0
    assert key_uniqueness_profile(result, D.SILVER_KEYS).isEmpty()


def test_versions_count_up_and_stay_readable(spark, table):
    assert table.current_version() is None and table.read().isEmpty()
    assert table.upsert(hours(spark, 29.5, "mumbai", 1)) == 0
    assert table.upsert(hours(spark, 30.5, "mumbai", 1)) == 1
    assert table.versions() == [0, 1]
    assert table.read(0).first().temperature_2m == 29.5
    assert table.read().first().temperature_2m == 30.5
    with pytest.raises(ValueError):
        table.read(7)


def test_upsert_only_rewrites_touched_days(spark, table):
    first = hours(spark, 20.0).unionByName(hours(spark, 20.0).withColumn("date", F.date_sub("date", 1)))
    table.upsert(first)
    table.upsert(hours(spark, 40.0, n=1))
    assert [f.rsplit("/", 1)[1] for f in table.changed_partitions(0)] == ["date=2026-09-22"]
    assert table.read().count() == 48
    assert table.read_changed(0).count() == 24
    assert table.read().filter("temperature_2m = 40").count() == 1


def test_an_unfinished_version_is_not_read(spark, table):
    table.upsert(hours(spark, 20.0))
    hours(spark, 99.0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("date").parquet(
        f"{table.path}/v=1"
    )
    assert table.versions() == [0]
    assert table.read().agg(F.max("temperature_2m")).first()[0] < 99
    assert table.upsert(hours(spark, 21.0)) == 1
    assert table.read().filter("hour = 0").first().temperature_2m == 21.0


def test_duplicate_source_keys_are_refused(spark, table):
    twice = hours(spark, 20.0, n=1).unionByName(hours(spark, 21.0, n=1))
    with pytest.raises(DuplicateKeyError):
        table.upsert(twice)
    assert table.versions() == []


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    source = spark.createDataFrame([(None, 2), ("a", 2)], "k string, v int")
    got = sorted(keyed_upsert(target, source, ["k"]).collect(), key=str)
    assert [(r.k, r.v) for r in got] == [("a", 2), (None, 1), (None, 2)]


def test_upsert_is_a_fixpoint(spark):
    target, source = hours(spark, 20.0), hours(spark, 25.0, n=12)
    once = keyed_upsert(target, source, D.SILVER_KEYS)
    again = keyed_upsert(once, source, D.SILVER_KEYS)
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_newest_ingestion_wins_whole(spark):
    """The newest row is taken with its nulls, not patched from older ones."""
    rows = bronze(spark, [
        ("delhi", "2026-09-22T00:00", 20.0, 50.0, 5.0, "2026-09-22T01:00:00.500000"),
        ("delhi", "2026-09-22T00:00", None, 51.0, 6.0, "2026-09-22T01:00:01"),
        ("delhi", "2026-09-22T00:00", 18.0, 52.0, 7.0, "2026-09-22T01:00:00"),
    ])
    got = dedupe_latest(rows, ["city", "time"], ["ingestion_timestamp"]).collect()
    assert len(got) == 1 and got[0].temperature_2m is None and got[0].relative_humidity_2m == 51.0


@pytest.mark.parametrize("column,low,high", [(c, lo, hi) for s in (WEATHER, AIR_QUALITY) for c, (lo, hi) in s.bounds.items()])
def test_bounds_are_inclusive(spark, column, low, high):
    rows = spark.createDataFrame([(low,), (high,), (low - 0.1,), (high + 0.1,)], f"`{column}` double")
    got = [r[0] for r in rows.select(bounds_mask({column: (low, high)})).collect()]
    assert got == [False, False, True, True]


def test_sides_and_lost_rows_add_up(spark):
    rows = bronze(spark, [
        ("delhi", "2026-09-22T00:00", 20.0, 50.0, 5.0, RUN),
        ("delhi", "2026-09-22T01:00", 99.0, 50.0, 5.0, RUN),
        ("delhi", "2026-09-22T02:00", None, 50.0, 5.0, RUN),
        ("delhi", "2026-09-22T03:00", None, 150.0, 5.0, RUN),
        (None, "2026-09-22T04:00", 20.0, 50.0, 5.0, RUN),
        ("delhi", "22.09.2026 05:00", 20.0, 50.0, 5.0, RUN),
        ("delhi", None, 20.0, 50.0, 5.0, RUN),
    ])
    with build_silver(rows, WEATHER, RUN) as (clean, rejected):
        assert [r.hour for r in clean.collect()] == [0]
        # A null measure beside a real violation is rejected; alone it is dropped.
        assert rejected.count() == 5
        assert {r.quarantine_reason for r in rejected.collect()} == {D.REJECT_REASONS["weather"]}
    with build_silver(rows, WEATHER, RUN, on_null="keep") as (kept, _):
        assert sorted(r.hour for r in kept.collect()) == [0, 2]
    with build_silver(rows, WEATHER, RUN, on_null="reject") as (_, rejected):
        assert rejected.count() == 6
    with pytest.raises(ValueError):
        split_clean_reject(rows, bounds_mask({"temperature_2m": (0, 1)}), "other")


def test_local_times_do_not_shift_with_the_session_zone(spark):
    """Times inside a daylight-saving gap of the session zone stay as written."""
    rows = spark.createDataFrame([("2026-03-29T02:30",), ("2026-01-01T00:00",)], "time string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = derive_time_keys(rows).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(str(r.date), r.hour) for r in got] == [("2026-03-29", 2), ("2026-01-01", 0)]


def test_a_hot_key_sends_one_row_per_partition(spark):
    """The plan keeps one row per key before the shuffle."""
    rows = spark.range(1000).select(F.expr("id div 1000 AS k"), F.col("id").alias("v")).repartition(4)
    latest = dedupe_latest(rows, ["k"], ["v"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r.v for r in latest.collect()] == [999]


def test_same_result_for_any_partitioning(spark):
    from checks import fixtures as fx

    results = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(str, fx.fact(spark, "/root/testdata/sf0.001").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_bronze_batches_with_other_columns_merge_on_read(spark):
    from tidemark.sources.tables import append_sink, scan_merged

    path = scratch_path(spark, "merge")
    append_sink(spark.createDataFrame([(1, 2.0)], "a int, b double"), path)
    append_sink(spark.createDataFrame([(3, "x")], "a int, c string"), path)
    got = sorted((r.a, r.b, r.c) for r in scan_merged(spark, path).collect())
    assert got == [(1, 2.0, None), (3, None, "x")]


def test_snapshot_files_are_in_order_with_nulls_and_no_nan(spark):
    import json
    from pathlib import Path

    from tidemark.sources.tables import export_snapshot_json

    path = scratch_path(spark, "order")
    rows = spark.range(1000).selectExpr(
        "1000 - id AS n", "date_add(DATE '2026-01-01', CAST(1000 - id AS INT)) AS d",
        "IF(id = 3, CAST('NaN' AS DOUBLE), IF(id = 4, CAST('Infinity' AS DOUBLE), 1.5D)) AS x",
    ).repartition(8)
    export_snapshot_json(rows, path, ["n"])
    lines = [json.loads(x) for f in sorted(Path(path).glob("part-*")) for x in f.read_text().splitlines()]
    assert [r["n"] for r in lines] == list(range(1, 1001))
    assert lines[0]["d"] == "2026-01-02" and sum(r["x"] is None for r in lines) == 2


def test_upsert_of_an_empty_batch_keeps_the_rows(spark, table):
    table.upsert(hours(spark, 20.0))
    assert table.upsert(hours(spark, 20.0).limit(0)) == 1
    assert table.read().count() == 24 and table.read_changed(0).isEmpty()


def test_two_hundred_versions_are_read_with_one_listing(spark, lake_root, monkeypatch):
    from tidemark.functions.schemas import struct_of
    from tidemark.sources import snapshots

    schema = struct_of({"k": "int", "day": "date", "x": "int"})
    table = VersionedTable(spark, f"{lake_root}/many", schema, ["k", "day"], "day")
    days = [f"2026-01-{d:02d}" for d in range(1, 11)]
    listed = []
    whole = snapshots.glob_paths
    monkeypatch.setattr(snapshots, "glob_paths", lambda spark, pattern: listed.append(pattern) or whole(spark, pattern))
    for i in range(200):
        if i % 20:  # most versions only need an index to be there
            table._commit(i, table._index(i - 1)[0], {"i": i})
        else:
            table.upsert(spark.sql(f"SELECT {i % 3} AS k, DATE '{days[i // 20]}' AS day, {i} AS x"), note={"i": i})
    listed.clear()
    fresh = VersionedTable(spark, f"{lake_root}/many", schema, ["k", "day"], "day")
    before = sorted(map(str, fresh.read().collect()))
    assert len(listed) == 1 and len(fresh.versions()) == 200
    assert fresh.row_count() == len(before)
    old = sorted(map(str, fresh.read(45).collect()))
    base = fresh.compact()
    assert base == 200 and {p.version for p in fresh._index(base)[0]} == {200}
    assert sorted(map(str, fresh.read().collect())) == before and fresh.read_changed(199).isEmpty()
    assert sorted(map(str, fresh.read(45).collect())) == old and fresh.note() == {"i": 199}
    fresh.vacuum(keep=1)
    assert fresh.versions() == [200] and sorted(map(str, fresh.read().collect())) == before
    assert fresh.upsert(spark.sql("SELECT 9 AS k, DATE '2026-02-01' AS day, 1 AS x")) == 201


def test_odd_partition_values_keep_their_rows(spark, lake_root):
    from tidemark.functions.schemas import struct_of

    table = VersionedTable(spark, f"{lake_root}/odd", struct_of({"k": "int", "p": "string", "x": "int"}), ["k", "p"], "p")
    rows = [(1, "a b", 1), (1, "a/b:c", 2), (1, "50%", 3), (1, "x+y=z", 4), (1, None, 5), (1, "é", 6)]
    table.upsert(spark.createDataFrame(rows, "k int, p string, x int"))
    assert table.row_count() == 6
    table.upsert(spark.createDataFrame([(k, p, v + 10) for k, p, v in rows if p], "k int, p string, x int"))
    got = sorted((r.x, r.p) for r in table.read().collect() if r.p)
    assert got == sorted((v + 10, p) for _, p, v in rows if p)
    assert table.row_count() == table.read().count() == 6
    table.compact()
    assert table.read_partitions(["a/b:c", "50%"]).count() == 2


def test_a_column_may_not_be_named_like_the_version_folders(spark, lake_root):
    from tidemark.functions.schemas import struct_of

    with pytest.raises(ValueError, match="named v"):
        VersionedTable(spark, lake_root, struct_of({"k": "int", "day": "date", "v": "int"}), ["k", "day"], "day")


def test_an_evolving_table_grows_and_refuses_other_types(spark):
    from tidemark.sources.tables import EvolvingTable, SchemaConflictError

    table = EvolvingTable(spark, scratch_path(spark, "evolving"))
    assert table.read().isEmpty()
    table.append(spark.createDataFrame([(1, 2.0)], "a int, b double"), "x-0")
    table.append(spark.createDataFrame([(3, "s")], "a int, c string"), "y-0")
    table.append(spark.createDataFrame([(4, "t")], "a int, c string"), "y-0")  # a replay replaces itself
    got = sorted((r.a, r.b, r.c, r.batch) for r in table.read().collect())
    assert got == [(1, 2.0, None, "x-0"), (4, None, "t", "y-0")]
    with pytest.raises(SchemaConflictError, match="b is double, not string"):
        table.append(spark.createDataFrame([("no",)], "b string"), "z-0")
    assert len(table.read().collect()) == 2 and table.schema().fieldNames() == ["a", "b", "c"]


def test_rows_of_new_days_are_not_ranked_again(spark, lake_root, monkeypatch):
    from tidemark.sources import snapshots

    merges = []
    monkeypatch.setattr(snapshots, "keyed_upsert", lambda *a: merges.append(1) or keyed_upsert(*a))
    order = ("datetime_utc", "source_file")
    table = VersionedTable(spark, f"{lake_root}/silver", WEATHER.silver_schema, D.SILVER_KEYS, "date", order)
    table.upsert(hours(spark, 30.0), is_unique=True)
    later = hours(spark, 20.0).withColumn("date", F.date_add("date", 1))
    table.upsert(later, is_unique=True)
    assert not merges and table.read().count() == 48
    table.upsert(later.withColumn("source_file", F.lit("g.json")), is_unique=True)
    assert merges and table.read().count() == 48
    assert table.read().filter("source_file = 'g.json'").count() == 24
    table.upsert(hours(spark, 1.0, "pune", 1).withColumn("date", F.date_add("date", 9)).union(hours(spark, 1.0, "pune", 1).withColumn("date", F.date_add("date", 9))))
    assert table.read().filter("city = 'pune'").count() == 1  # rows not said to be unique are ranked
