"""Raw documents, landing and slicing on hand-written files."""

import datetime as dt
import hashlib
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.plans.bronze import bronze_table, build_bronze, rejected_files, write_bronze
from tidemark.plans.refresh import Lake, land_documents, wanted_files
from tidemark.plans.silver import WEATHER
from tidemark.session import scratch_path, shared_root
from tidemark.sources import raw
from tidemark.sources.landing import LandedKeys, landing_first_write_wins, slice_range_payload
from tidemark.sources.tables import staged
from tidemark.streaming.incremental import StreamPaths, incremental_refresh, land_ranges, quarantine_table, range_documents

RUN = "2026-09-23 03:00:00"
M = list(WEATHER.measures)


def write(root: str, city: str, name: str, content) -> str:
    folder = Path(root) / "weather" / city
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    (folder / name).write_text(text, encoding="utf-8")
    return text


def document(times, city="delhi", **measures):
    doc = {"latitude": 1.0, "longitude": 2.0, "timezone": "Asia/Kolkata", "hourly": {"time": times, **measures}}
    if city:
        doc["_metadata"] = {"city": city, "target_date": "2026-09-22"}
    return doc


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test-raw")


def bronze(spark, root):
    stored = f"{root}/bronze"
    write_bronze(build_bronze(spark, f"{root}/weather", WEATHER, RUN), stored)
    rows = bronze_table(spark, stored, WEATHER).orderBy("city", "time")
    return rows.collect(), rejected_files(spark, stored, WEATHER).collect()


def test_measures_align_with_time(spark, root):
    """A short array pads with nulls, a long one is cut, a missing one is all null."""
    times = [f"2026-09-22T{h:02d}:00" for h in range(3)]
    text = write(root, "delhi", "2026-09-22.json", document(
        times, temperature_2m=[1, 2.5], relative_humidity_2m=[1.0, 2.0, 3.0, 4.0], precipitation=[None, 0, 1]))
    rows, rejects = bronze(spark, root)
    assert not rejects
    assert [r.temperature_2m for r in rows] == [1.0, 2.5, None]
    assert [r.relative_humidity_2m for r in rows] == [1.0, 2.0, 3.0]
    assert [r.precipitation for r in rows] == [None, 0.0, 1.0]
    assert [r.wind_speed_10m for r in rows] == [None] * 3
    assert {r.source_file for r in rows} == {"weather/delhi/2026-09-22.json"}
    assert {r.payload_hash for r in rows} == {hashlib.sha256(text.encode()).hexdigest()}
    assert {r.ingestion_timestamp for r in rows} == {dt.datetime(2026, 9, 23, 3)}


def test_bad_files_do_not_stop_the_batch(spark, root):
    good = document(["2026-09-22T00:00"], temperature_2m=[20.0])
    write(root, "delhi", "good.json", good)
    write(root, "delhi", "cut.json", json.dumps(good)[:-3])
    write(root, "delhi", "text.json", "no json at all")
    write(root, "delhi", "list.json", "[1, 2]")
    write(root, "delhi", "type.json", document(["2026-09-22T01:00"], temperature_2m=["warm"]))
    rows, rejects = bronze(spark, root)
    assert len(rows) == 1
    assert sorted(Path(r.source_file).name for r in rejects) == ["cut.json", "list.json", "text.json", "type.json"]


def test_documents_without_hours_give_no_rows(spark, root):
    write(root, "delhi", "a.json", {"latitude": 1.0})
    write(root, "delhi", "b.json", {"hourly": {}})
    write(root, "delhi", "c.json", document([]))
    write(root, "pune", "d.json", document(["2026-09-22T00:00"], city="pune"))
    rows, rejects = bronze(spark, root)
    assert [r.city for r in rows] == ["pune"] and not rejects


def test_city_comes_from_the_folder_without_metadata(spark, root):
    write(root, "navi mumbai+x", "a.json", document(["2026-09-22T00:00"], city=None))
    write(root, "city=pune", "b.json", document(["2026-09-22T00:00"], city=None))
    rows, _ = bronze(spark, root)
    assert [r.city for r in rows] == ["navi mumbai+x", "pune"]


def test_landed_layout_names_its_city_too(spark, root):
    folder = Path(root) / "weather" / "city=pune" / "target_date=2026-09-22"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(json.dumps(document(["2026-09-22T00:00"], city=None)))
    rows, _ = bronze(spark, root)
    assert [(r.city, r.source_file) for r in rows] == [("pune", "weather/city=pune/target_date=2026-09-22/part-0.json")]


def test_other_file_types_are_left_alone(spark, root):
    write(root, "delhi", "a.json", document(["2026-09-22T00:00"]))
    write(root, "delhi", ".b.json", document(["2026-09-22T01:00"]))
    write(root, "delhi", "c.tmp", document(["2026-09-22T02:00"]))
    rows, _ = bronze(spark, root)
    assert [r.time for r in rows] == ["2026-09-22T00:00"]


def test_slicing_keeps_order_and_drops_values_past_the_end(spark):
    times = ["2026-09-21T22:00", "2026-09-21T23:00", "2026-09-22T00:00", "2026-09-22T01:00"]
    payload = json.dumps({"hourly": {"time": times, "temperature_2m": [4.0, 3.0, 2.0], "weather_code": [1, None, 3, 4]}})
    docs = raw.parse_documents(spark.createDataFrame([("p", payload)], "path string, payload string"), raw.document_schema(M))
    days = slice_range_payload(docs.select("path", "doc.hourly"), ["path"], "hourly", M).orderBy("target_date").collect()
    assert [d.target_date for d in days] == ["2026-09-21", "2026-09-22"]
    assert days[0].hourly.time == times[:2] and days[1].hourly.time == times[2:]
    assert days[0].hourly.temperature_2m == [4.0, 3.0] and days[1].hourly.temperature_2m == [2.0]
    assert days[0].hourly.weather_code == [1.0, None] and days[1].hourly.weather_code == [3.0, 4.0]
    assert days[0].hourly.precipitation == []


def test_first_landed_document_stays(spark, root):
    lake = Lake(root)
    first = spark.createDataFrame([("delhi", "2026-09-21", "{}"), ("pune", "2026-09-21", "{}")], "city string, target_date string, payload string")
    again = spark.createDataFrame([("delhi", "2026-09-21", '{"x": 1}'), ("delhi", "2026-09-22", "{}")], first.schema)
    land_documents(first, lake, WEATHER)
    land_documents(again, lake, WEATHER)
    paths = lake.stream("weather")
    keys = sorted((r.city, str(r.target_date)) for r in LandedKeys(spark, paths.landed_keys).read().collect())
    assert keys == [("delhi", "2026-09-21"), ("delhi", "2026-09-22"), ("pune", "2026-09-21")]
    lines = raw.document_lines(spark.read, paths.landed, "part-*").collect()
    assert sorted((r.city, str(r.target_date)) for r in lines) == keys and {r.payload for r in lines} == {"{}"}


def test_wanted_files_of_a_backfill(spark, root):
    lake = Lake(root)
    landed = spark.createDataFrame([("delhi", "2026-09-20", "{}")], "city string, target_date string, payload string")
    land_documents(landed, lake, WEATHER)
    wanted = wanted_files(spark, lake, WEATHER, dt.date(2026, 9, 23), backfill_days=6).collect()
    assert len(wanted) == 8 * 6 - 1
    routes = {(str(r.target_date), r.route) for r in wanted}
    assert ("2026-09-18", "archive") in routes and ("2026-09-19", "forecast") in routes
    one = wanted_files(spark, lake, WEATHER, dt.date(2026, 9, 23), 0, dt.date(2026, 9, 20)).filter(F.col("city") == "delhi")
    assert one.isEmpty()


@pytest.mark.parametrize("tail", ["{}", " junk", "} junk", "] junk", ', {"a": 1}', "\n[]"])
def test_text_after_the_document_rejects_the_file(spark, root, tail):
    good = document(["2026-09-22T00:00"], temperature_2m=[1.0])
    write(root, "delhi", "good.json", json.dumps(good) + "\n")
    write(root, "delhi", "bad.json", json.dumps(good) + tail)
    docs = raw.scan_raw_json(spark, f"{root}/weather", raw.document_schema(M))
    assert {r.path.rsplit("/", 1)[1]: r.is_malformed for r in docs.collect()} == {"good.json": False, "bad.json": True}


def test_lines_and_files_give_equal_rows(spark, root):
    """A document per line, plain or in an envelope, reads like one per file; blank and broken lines are told apart."""
    docs = {c: document([f"2026-09-22T{h:02d}:00" for h in range(4)], city=c, temperature_2m=[1.0, 2.0]) for c in ("delhi", "pune")}
    for city, doc in docs.items():
        write(root, city, "a.json", doc)
    lines = Path(root) / "lines" / "weather" / "x"
    lines.mkdir(parents=True)
    envelope = json.dumps({"city": "ignored", "target_date": "2026-09-22", "payload": json.dumps(docs["pune"], indent=2)})
    (lines / "a.jsonl").write_text("\n".join([json.dumps(docs["delhi"]), "", "  ", envelope, "broken {"]) + "\n")
    found = {}
    for layout, path, glob in (("files", f"{root}/weather", "*.json"), ("lines", f"{root}/lines/weather", "*.jsonl")):
        batch = build_bronze(spark, path, WEATHER, RUN, glob, layout)
        found[layout] = sorted(map(str, batch.filter("kind = 'row'").drop("source_file", "payload_hash").collect()))
        assert batch.filter("kind = 'reject'").count() == (layout == "lines")
    assert found["files"] == found["lines"] and len(found["files"]) == 8


def test_an_envelope_names_the_city_of_a_document_that_does_not(spark, root):
    folder = Path(root) / "weather" / "target_date=2026-09-22"
    folder.mkdir(parents=True)
    payload = json.dumps(document(["2026-09-22T00:00"], city=None))
    (folder / "part-0.txt").write_text(json.dumps({"city": "pune", "target_date": "2026-09-22", "payload": payload}) + "\n" + payload + "\n")
    rows = build_bronze(spark, f"{root}/weather", WEATHER, RUN, "part-*", "lines").collect()
    assert sorted((r.city or "", r.source_file) for r in rows) == [
        ("", "weather/target_date=2026-09-22/part-0.txt"), ("pune", "weather/target_date=2026-09-22/part-0.txt")
    ]


def test_a_hundred_thousand_documents_in_few_files(spark, root):
    """Tasks split lines by bytes: far fewer tasks than documents, and no document is lost at a split."""
    text = F.format_string('{"hourly": {"time": ["2026-09-%02dT00:00"], "temperature_2m": [%d.0]}, "_metadata": {"city": "c%d"}}',
                           F.expr("1 + id % 28"), "id", F.expr("id % 1000"))
    spark.range(0, 100_000, 1, 8).select(text.alias("value")).write.text(f"{root}/weather/all")
    assert len(list(Path(root, "weather", "all").glob("part-*"))) < 100
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
    try:
        docs = raw.scan_raw_json(spark, f"{root}/weather", raw.document_schema(M), "*.txt", layout="lines")
        assert 8 < docs.rdd.getNumPartitions() < 200
        got = docs.filter("NOT is_malformed").agg(F.count(F.lit(1)), F.sum(F.col("doc.hourly.temperature_2m")[0])).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (100_000, sum(range(100_000)))


def scan_metrics(df):
    """(files read, partition filters) of the scans of a plan that has run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\]", text)


def test_looking_up_a_window_lists_its_days_only(spark, root):
    keys = LandedKeys(spark, f"{root}/keys")
    keys.add(spark.sql("SELECT concat('c', id) AS city, explode(sequence(DATE '2026-01-01', DATE '2026-06-30')) AS target_date FROM range(20)"))
    window = keys.read(dt.date(2026, 3, 1), dt.date(2026, 3, 5))
    assert window.count() == 100
    assert any("target_date" in f and "2026-03-01" in f for f in scan_metrics(window))
    assert {p.split("target_date=")[1][:10] for p in window.inputFiles()} >= {"2026-03-01"}
    read = window.select(F.input_file_name()).distinct().count()
    assert read <= 5 * 8
    again = spark.sql("SELECT 'c3' AS city, DATE '2026-03-02' AS target_date UNION ALL SELECT 'new', DATE '2026-03-03'")
    fresh = keys.unknown(again.checkpoint())
    assert [r.city for r in fresh.collect()] == ["new"]
    assert any("2026-03-02" in f and "2026-03-03" in f for f in scan_metrics(fresh))


def test_landed_keys_are_pruned_by_a_bloom_filter_of_the_new_ones(spark, root):
    landed = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    landed.write.parquet(f"{root}/landed")
    spark.range(3).select(F.col("id").alias("k")).write.parquet(f"{root}/new")
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        new = spark.read.parquet(f"{root}/new").filter("k > 0")
        fresh = landing_first_write_wins(new, spark.read.parquet(f"{root}/landed"), ["k"])
        assert "might_contain" in fresh._jdf.queryExecution().optimizedPlan().toString()
        assert fresh.count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_key_with_a_null_lands(spark):
    new = spark.createDataFrame([("a", None), ("a", 1), ("b", 1)], "c string, d int")
    landed = spark.createDataFrame([("a", None), ("a", 1), ("a", 1)], "c string, d int")
    assert sorted(map(str, landing_first_write_wins(new, landed, ["c", "d"]).collect())) == ["Row(c='a', d=None)", "Row(c='b', d=1)"]


def range_payload(root, stream, city, first, days, value):
    times = [f"{first + dt.timedelta(days=d)}T{h:02d}:00" for d in range(days) for h in range(24)]
    doc = {"hourly": {"time": times, **{m: [value] * len(times) for m in WEATHER.measures}}, "_metadata": {"city": city}}
    folder = Path(root.removeprefix("file:")) / "ranges" / stream / city
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{first}-{days}-{value}.json").write_text(json.dumps(doc))


def test_range_payloads_land_day_by_day_once(spark, lake_root):
    paths, day = StreamPaths.below(lake_root, "weather"), dt.date(2026, 9, 1)
    range_payload(lake_root, "weather", "delhi", day, 3, 20.0)
    range_payload(lake_root, "weather", "pune", day, 2, 21.0)
    (Path(lake_root.removeprefix("file:")) / "ranges" / "weather" / "pune" / "bad.json").write_text("{")
    assert land_ranges(spark, paths, WEATHER, "2026-09-06") == 1
    incremental_refresh(spark, paths, WEATHER, RUN)
    bronze = bronze_table(spark, paths.bronze, WEATHER)
    assert bronze.count() == 5 * 24
    lines = raw.document_lines(spark.read, paths.landed, "part-*")
    docs = raw.parse_documents(lines, raw.document_schema(M)).select("city", "target_date", "doc._metadata.source").collect()
    assert {(r.city, r.target_date.day, r.source) for r in docs} == {
        ("delhi", 1, "archive"), ("delhi", 2, "forecast"), ("delhi", 3, "forecast"), ("pune", 1, "archive"), ("pune", 2, "forecast")
    }
    # dropped again, overlapping and longer: only the day not seen before lands, with its own values
    range_payload(lake_root, "weather", "delhi", day, 4, 30.0)
    range_payload(lake_root, "weather", "pune", day, 2, 31.0)
    assert land_ranges(spark, paths, WEATHER, "2026-09-06") == 1
    incremental_refresh(spark, paths, WEATHER, "2026-09-24 03:00:00")
    assert bronze_table(spark, paths.bronze, WEATHER).filter("temperature_2m >= 30").count() == 24
    assert land_ranges(spark, paths, WEATHER, "2026-09-06") == 0
    refused = quarantine_table(spark, paths).read().collect()
    assert [(r.quarantine_reason, r.source_file.rsplit("/", 1)[1]) for r in refused if r.quarantine_reason == "no document"] == [("no document", "bad.json")]


def test_times_without_a_day_are_refused_and_the_rest_lands(spark):
    doc = {"hourly": {"time": ["2026-09-01T00:00", "soon", None], "temperature_2m": [1.0, 2.0, 3.0]}, "_metadata": {"city": "delhi"}}
    payloads = spark.createDataFrame([("p", json.dumps(doc), None), ("q", json.dumps({**doc, "_metadata": {}}), None)], "path string, payload string, city string")
    cut, bad = range_documents(payloads, WEATHER, "2026-09-02")
    assert [(r.city, str(r.target_date)) for r in cut.collect()] == [("delhi", "2026-09-01")]
    assert {(r.path, r.reason) for r in bad.collect()} == {("p", "times without a day or city"), ("q", "times without a day or city")}


def test_packed_files_read_like_files_apart(spark, root):
    """Name, exact bytes and folder of a packed file are those of the file; a bare line is a document by itself."""
    texts = {city: write(root, city, "a.json", document(["2026-09-22T00:00"], city=None, temperature_2m=[1.0])) for city in ("city=são paulo+", "delhi")}
    names = {"city=são paulo+": "weather/city=s%C3%A3o%20paulo+/a.json", "delhi": "weather/delhi/a.json"}
    folder = Path(root) / "packed" / "weather"
    folder.mkdir(parents=True)
    bare = json.dumps(document(["2026-09-22T01:00"], city="pune"))
    (folder / "a.jsonl").write_text("\n".join([*[json.dumps({"path": names[c], "payload": t}) for c, t in texts.items()], "", bare]) + "\n")

    def rows(path, glob, layout):
        stamped = raw.stamp_lineage(raw.scan_raw_json(spark, path, raw.document_schema(M), glob, layout), RUN)
        return sorted(map(tuple, stamped.select("city", "source_file", "payload_hash", "payload", "is_malformed").collect()))

    apart = rows(f"{root}/weather", "*.json", "files")
    together = rows(str(folder), "*.jsonl", "packed")
    assert [r for r in together if r[0] != "pune"] == apart and len(apart) == 2
    assert [r[3] for r in together if r[0] == "pune"] == [bare]


@pytest.mark.parametrize("name", ["build_bronze", "stamp_lineage", "default_key_from_path"])
def test_documents_of_many_users_lie_in_few_files(spark, root, name):
    """The number of files that a query leaves does not follow the number of users."""
    rows = spark.range(600).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts", "id % 300 AS user_id",
        "'view' AS event_type", "CAST(id AS DOUBLE) AS value", "format_string('{\"k\": %d}', id % 100) AS props",
    )
    rows.write.parquet(f"{root}/events.parquet")
    raw_folders = lambda: set(Path(shared_root(spark).removeprefix("file:")).glob("raw-*"))
    before = raw_folders()
    got = entry.queries()[name](spark, root).count()
    assert got == {"build_bronze": 1200}.get(name, 300)
    assert 0 < sum(1 for folder in raw_folders() - before for f in folder.rglob("*.txt")) < 60


def test_a_document_is_parsed_once(spark, root):
    """A filter on the outcome is not pushed below the parser, where it would parse again."""
    write(root, "delhi", "a.json", document(["2026-09-22T00:00"]))
    lines = raw.document_lines(spark.read, f"{root}/weather", "*.json")
    good, rejects = raw.tolerate_malformed(raw.parse_documents(lines, raw.document_schema(M)))
    for part in (good, rejects):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "is_malformed" in plan and plan.count("from_json(") == 2  # the envelope and the document


def test_rejects_keep_the_city_they_landed_with(spark, root):
    folder = Path(root) / "weather"
    folder.mkdir(parents=True)
    lines = [json.dumps({"city": c, "target_date": "2026-09-22", "payload": "broken {"}) for c in ("delhi", "pune")]
    (folder / "part-0.txt").write_text("\n".join(lines) + "\n")
    found = raw.document_lines(spark.read, str(folder), "part-*")
    _, rejects = raw.tolerate_malformed(raw.parse_documents(found, raw.document_schema(M)))
    assert sorted((r.city, r.payload_hash) for r in rejects.collect()) == [(c, hashlib.sha256(b"broken {").hexdigest()) for c in ("delhi", "pune")]


def test_new_documents_are_stored_once_on_their_way(spark, root, monkeypatch):
    from tidemark.streaming import incremental

    names = []
    monkeypatch.setattr(incremental, "staged", lambda df, name: names.append(name) or staged(df, name))
    paths = Lake(root).stream("weather")
    new = [(c, "2026-09-22", json.dumps(document(["2026-09-22T00:00"], c, temperature_2m=[1.0]))) for c in ("delhi", "pune")]
    docs = spark.createDataFrame([*new, new[0], ("goa", "2026-09-22", "broken")], "city string, target_date string, payload string")
    incremental.land(docs, paths)
    incremental_refresh(spark, paths, WEATHER, RUN, "part-*")
    assert names == ["landing"]
    assert bronze_table(spark, paths.bronze, WEATHER).count() == 2 and rejected_files(spark, paths.bronze, WEATHER).count() == 1
    incremental.land(docs, paths)  # known ones of the same day land nothing
    assert names == ["landing", "landing", "fresh"]
    assert incremental_refresh(spark, paths, WEATHER, RUN, "part-*") == 0
    assert LandedKeys(spark, paths.landed_keys).read().count() == 3
