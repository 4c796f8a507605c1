"""End-to-end refresh: land, Bronze, Silver, gate, Gold, gate, forecast, publish.

Every stage works on what has changed since it last ran: new documents, their days in Silver, the days whose rollup
differs, and the rows of the fact that a changed day can reach. A run that finds nothing new writes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schemas import struct_of
from tidemark.operators.joins import missing_dates, route_by_age
from tidemark.operators.quality import (
    QualityGateError,
    dq_report,
    gate_audit,
    quality_gate,
    stage_failure_audit,
)
from tidemark.operators.rollup import monotone_counts
from tidemark.operators.windows import reachable_rows
from tidemark.plans import defaults as D
from tidemark.plans import display, gold
from tidemark.plans.forecasting import ForecastResult, locked_summary, prepare, run_forecast
from tidemark.plans.publish import Outputs, Publication, current, publish, together
from tidemark.plans.silver import AIR_QUALITY, WEATHER, Stream
from tidemark.sources.files import glob_paths, place_small
from tidemark.sources.landing import LandedKeys
from tidemark.sources.snapshots import VersionedTable
from tidemark.sources.tables import literal_relation, read_prior_snapshot, staged
from tidemark.streaming.incremental import (
    StreamPaths,
    incremental_refresh,
    land,
    land_ranges,
    ledger,
    quarantine_table,
    range_documents,
    silver_table,
)

GATE = "data_quality_hard_gate"
STREAMS = (WEATHER, AIR_QUALITY)
LAYER = {"layer": "string", "row_count": "bigint", "live_count": "bigint"}
META_SCHEMA = struct_of(
    {
        "last_refresh_timestamp": "string",
        "status": "string",
        "quality_gate_passed": "boolean",
        "layers": T.ArrayType(struct_of(LAYER)),
        "totals": struct_of({n: "bigint" for n in ("bronze", "silver", "gold", "rejected_files", "rejected_rows", "unknown_rows")}),
        "split": struct_of({"train": "bigint", "val": "bigint", "test": "bigint"}),
        "winning_config": "string",
        "winning_params": struct_of({"min_samples_leaf": "int", "learning_rate": "double", "max_depth": "int", "max_iter": "int"}),
        "cities": T.ArrayType(T.StringType()),
        "cities_modelled": "bigint",
    }
)


@dataclass(frozen=True)
class Lake:
    root: str

    def stream(self, name: str) -> StreamPaths:
        return StreamPaths.below(self.root, name)

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def published(self) -> str:
        return f"{self.root}/published"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"


def _rollup_schema(measures, count: str) -> T.StructType:
    return struct_of(
        {
            "city": "string",
            "metric_date": "date",
            **{m: "double" for m in measures},
            count: "bigint",
            "silver_version": "int",
        }
    )


def days_table(spark: SparkSession, lake: Lake, stream: Stream) -> VersionedTable:
    """Daily rollups of one stream; ``silver_version`` tells when a day's values last changed."""
    if stream.name == WEATHER.name:
        schema = _rollup_schema(D.WEATHER_ROLLUP, "hourly_weather_records")
    else:
        schema = _rollup_schema(D.AIR_QUALITY_ROLLUP, "hourly_aq_records")
    return VersionedTable(spark, lake.gold(f"days_{stream.name}"), schema, D.DAILY_KEYS, "metric_date")


def fact_table(spark: SparkSession, lake: Lake) -> VersionedTable:
    """The daily fact, maintained row by row; its note holds the Silver versions it has seen."""
    empty = [spark.createDataFrame([], days_table(spark, lake, s).schema).drop("silver_version") for s in STREAMS]
    return VersionedTable(spark, lake.gold("fct_daily"), gold.fct_from_days(*empty).schema, D.DAILY_KEYS, "metric_date")


def published(spark: SparkSession, root: str) -> Publication | None:
    """What the lake shows its readers."""
    return current(spark, Lake(root.rstrip("/")).published)


def published_fact(spark: SparkSession, root: str) -> DataFrame:
    """The fact as published, whatever versions have been written since."""
    lake = Lake(root.rstrip("/"))
    return fact_table(spark, lake).read(published(spark, root).note["fact_version"])


def wanted_files(
    spark: SparkSession, lake: Lake, stream: Stream, today: dt.date, backfill_days: int, target_date: dt.date | None = None
) -> DataFrame:
    """(city, target_date, route) documents still to be fetched for the asked-for window."""
    end = target_date or today - dt.timedelta(days=1)
    start = target_date or today - dt.timedelta(days=max(backfill_days, 1))
    landed = LandedKeys(spark, lake.stream(stream.name).landed_keys).read(start, end)
    # Configured cities take part even when nothing of theirs has landed.
    cities = gold.city_dimension(spark).select("city", F.lit(None).cast("date").alias("target_date"))
    gaps = missing_dates(landed.unionByName(cities), "city", "target_date", start, end)
    return gaps.withColumn("route", route_by_age("target_date", today))


def land_documents(docs: DataFrame, lake: Lake, stream: Stream, today: dt.date | str | None = None) -> None:
    """Land fetched documents: ``(city, target_date, payload)``, or ``(city, payload)`` that hold ranges of days."""
    if "target_date" not in docs.columns:
        payloads = docs.select(F.lit("fetched").alias("path"), "payload", "city")
        docs, _ = range_documents(payloads, stream, today)
    land(docs, lake.stream(stream.name))


# Documents ``(city, target_date, payload)``, or range payloads ``(city, payload)``, for a stream's wanted
# ``(city, target_date, route)``.
Fetch = Callable[[Stream, DataFrame], DataFrame]


def _gate(spark: SparkSession, lake: Lake, report: DataFrame, run_ts: str) -> None:
    with staged(report, "gate") as stored:
        try:
            quality_gate(stored)
        except QualityGateError:
            gate_audit(stored, run_ts, GATE, GATE).write.mode("append").json(lake.audit)
            raise


def update_days(spark: SparkSession, lake: Lake, run_ts: str) -> None:
    """Check the days that Silver has changed, roll them up and store those whose values differ."""
    staged_with = {WEATHER.name: gold.stage_weather, AIR_QUALITY.name: gold.stage_air_quality}
    rolled_with = {WEATHER.name: gold.weather_days, AIR_QUALITY.name: gold.air_quality_days}
    checks = {WEATHER.name: D.staging_weather_checks(), AIR_QUALITY.name: D.staging_air_quality_checks()}
    changed = {}
    for s in STREAMS:
        silver, days = silver_table(spark, lake.stream(s.name), s), days_table(spark, lake, s)
        version, seen = silver.current_version(), days.note().get("silver_version")
        if version is not None and version != seen:
            changed[s.name] = (days, version, staged_with[s.name](silver.read_changed(_since(version, seen))))
    if not changed:
        return
    _gate(spark, lake, dq_report({f"stg_{n}": (df, checks[n]) for n, (_, _, df) in changed.items()}), run_ts)
    for name, (days, version, df) in changed.items():
        with staged(rolled_with[name](df), "days") as rolled:
            dates = [r[0] for r in rolled.select("metric_date").distinct().collect()]  # bounded by the calendar
            before = days.read_partitions(dates)
            fresh = rolled.subtract(before.select(rolled.columns)) if days.has_partitions(dates) else rolled
            stamped = fresh.withColumn("silver_version", F.lit(version).cast("int"))
            days.upsert(stamped, is_staged=fresh is rolled, note={"silver_version": version}, is_unique=True)


@contextmanager
def moved_facts(spark: SparkSession, lake: Lake, seen: Mapping[str, int]) -> Iterator[DataFrame]:
    """The rows of the fact that can differ from those last worked out, from the days that changed since, stored.

    Of all days only the keys are looked at; measures are read from the partitions of the rows that can move and of
    the few rows before them that their lags and mean look at.
    """
    keys, changed = [], []
    for s in STREAMS:
        days = days_table(spark, lake, s).read().select(*D.DAILY_KEYS, "silver_version")
        keys.append(days.drop("silver_version"))
        changed.append(days.filter(F.col("silver_version") > seen[s.name]).drop("silver_version"))
    series = keys[0].join(keys[1], list(D.DAILY_KEYS))
    with staged(reachable_rows(series, changed[0].union(changed[1]), *D.DAILY_KEYS, D.FACT_REACH), "reach") as rows:
        dates = [r[0] for r in rows.select("metric_date").distinct().collect()]  # bounded by the calendar
        needed, moving = rows.select(*D.DAILY_KEYS), rows.filter("moves").select(*D.DAILY_KEYS)
        sides = [
            days_table(spark, lake, s).read_partitions(dates).drop("silver_version").join(needed, list(D.DAILY_KEYS), "left_semi")
            for s in STREAMS
        ]
        with staged(gold.fct_from_days(*sides).join(moving, list(D.DAILY_KEYS), "left_semi"), "facts") as facts:
            yield facts


def _since(version: int, seen: int | None) -> int:
    """Version after which rows are new; a table that began anew is new as a whole."""
    return -1 if seen is None or version < seen else seen


def update_fact(spark: SparkSession, lake: Lake, run_ts: str) -> None:
    """Work out and store the moved rows; the fact stays as it is when they do not pass the gate."""
    versions = {s.name: days_table(spark, lake, s).note().get("silver_version", -1) for s in STREAMS}
    fact = fact_table(spark, lake)
    note = fact.note()
    if all(versions[name] == note.get(name, -1) for name in versions):
        return
    with moved_facts(spark, lake, {name: _since(v, note.get(name)) for name, v in versions.items()}) as moved:
        dim = gold.city_dimension(spark)
        _gate(spark, lake, dq_report({"dim_city": (dim, D.dim_city_checks()), "fct_daily": (moved, D.fact_checks())}), run_ts)
        fact.upsert(moved, is_staged=True, note=versions)


def live_counts(spark: SparkSession, lake: Lake) -> tuple[dict[str, int], dict[str, int]]:
    """(rows per layer, further totals), from what was counted while writing; no layer is read again."""
    layers, totals = {}, {"rejected_files": 0, "rejected_rows": 0, "unknown_rows": 0}
    for s in STREAMS:
        paths = lake.stream(s.name)
        seen = ledger(spark, paths).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "rejected_files", "rejected", "unknown")]).first()
        layers[f"bronze_{s.name}"] = seen["rows"]
        layers[f"silver_{s.name}"] = silver_table(spark, paths, s).row_count()
        totals["rejected_files"] += seen["rejected_files"]
        totals["rejected_rows"] += seen["rejected"]
        totals["unknown_rows"] += seen["unknown"]
    layers["gold_fct_daily"] = fact_table(spark, lake).row_count()
    for name in ("bronze", "silver", "gold"):
        totals[name] = sum(n for layer, n in layers.items() if layer.startswith(name))
    return layers, totals


def last_report(spark: SparkSession, lake: Lake) -> dict:
    """The newest run report, empty before the first."""
    files = sorted(glob_paths(spark, f"{lake.reports}/report-*.json"), reverse=True)
    rows = read_prior_snapshot(spark, files[:5], META_SCHEMA, "layers").limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else {}


def run_report(spark: SparkSession, lake: Lake, run_ts: str, gate_passed: bool, result: ForecastResult | None = None, split: DataFrame | None = None) -> dict:
    """Computed status, layer counts, split sizes and chosen configuration of a run.

    ``row_count`` never falls; where ``live_count`` is below it, or a layer is empty, or the gate refused, the lake is
    DEGRADED. A run without a forecast repeats the last one's.
    """
    prior = last_report(spark, lake)
    live, totals = live_counts(spark, lake)
    counts = literal_relation(spark, list(live.items()), struct_of({"layer": "string", "row_count": "bigint"}))
    before = [(x["layer"], x["row_count"]) for x in prior.get("layers", [])]
    after = monotone_counts(counts, literal_relation(spark, before, counts.schema)).collect()
    layers = [{"layer": r.layer, "row_count": r.row_count, "live_count": live.get(r.layer, 0)} for r in sorted(after)]
    report = {
        **{c: prior.get(c) for c in ("split", "winning_config", "winning_params", "cities_modelled")},
        "last_refresh_timestamp": run_ts,
        "status": "HEALTHY" if gate_passed and all(x["live_count"] >= x["row_count"] > 0 for x in layers) else "DEGRADED",
        "quality_gate_passed": gate_passed,
        "layers": layers,
        "totals": totals,
        "cities": [row[1] for row in D.CITIES],
    }
    if result is not None:
        sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
        report["split"] = {name: sizes.get(name, 0) for name in ("train", "val", "test")}
        report["winning_config"] = result.winner
        report["winning_params"] = asdict(D.FORECAST.configs[result.winner]) if result.winner in D.FORECAST.configs else None
        report["cities_modelled"] = result.forecasts.filter("predicted_aqi IS NOT NULL").count()
    return report


def _file_report(spark: SparkSession, lake: Lake, report: dict) -> None:
    number = len(glob_paths(spark, f"{lake.reports}/report-*.json"))
    place_small(spark, f"{lake.reports}/report-{number:09d}.json", json.dumps(report))


def _outputs(spark: SparkSession, lake: Lake, fact: DataFrame, result: ForecastResult | None, split: DataFrame | None) -> Outputs:
    dim = gold.city_dimension(spark)
    summary = gold.latest_city_summary(fact, dim)
    worst_first = [F.col("avg_us_aqi").desc_nulls_last(), "city"]
    rejects = quarantine_table(spark, lake.stream(WEATHER.name)).read()
    if "quarantine_reason" in rejects.columns:
        rejects = rejects.groupBy("source_type", "quarantine_reason").agg(F.count(F.lit(1)).alias("n_rows"))
    else:
        rejects = spark.createDataFrame([], "source_type string, quarantine_reason string, n_rows bigint")
    out = Outputs(
        {"dim_city": dim},
        {
            "cities": (dim, ["city"]),
            "metrics": (gold.daily_metrics_snapshot(fact), ["metric_date", "city"]),
            "summary": (summary, worst_first),
            "rejects": (rejects, ["source_type", "quarantine_reason"]),
        },
    )
    out.snapshots["pollutants"] = (display.pollutant_rows(summary), ["city", "name"])
    if result is not None:
        out.tables |= {
            "predictions": result.forecasts,
            "model_scores": result.scores,
            "config_ranking": result.ranking,
            "backtest": result.backtest,
        }
        out.snapshots |= {
            "predictions": (result.forecasts, ["city"]),
            "locked_summary": (locked_summary(split, result.scores), ["kind", "name"]),
            "cards": (display.city_cards(summary, result.forecasts), ["city"]),
            "series": (display.city_series(fact, result.forecasts), ["city", "metric_date"]),
        }
    return out


def refresh_lake(
    spark: SparkSession,
    root: str,
    run_ts: str,
    max_files_per_batch: int | None = None,
    forecast: bool = True,
    file_glob: str = "*",
    backfill_days: int = 0,
    target_date: dt.date | None = None,
    fetch: Fetch | None = None,
    mirrors: Sequence[str] = (),
) -> dict[str, int]:
    """Bring every layer up to date with the landed documents.

    With ``fetch`` the documents missing on ``target_date``, or else in the last ``backfill_days`` days, are asked
    for and landed first; what others have dropped is taken in before that, so it is not asked for again.

    Only new documents are parsed, only their days are merged, checked and rolled up again, and only the rows of the
    fact that these days reach are rewritten. Nothing is published when a gate fails, and the days it refused are
    tried again by the next run. A run that finds nothing new fits and writes nothing, unless rows have been lost:
    that is reported. ``mirrors`` are further folders that show the same outputs, each by a pointer of its own; the
    lake's own pointer is switched last. Returns the batches taken per stream.
    """
    from tidemark.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    lake = Lake(root.rstrip("/"))
    today = dt.datetime.fromisoformat(run_ts).date()
    batches = {s.name: 0 for s in STREAMS}

    def ingest(s: Stream) -> None:
        paths = lake.stream(s.name)
        land_ranges(spark, paths, s, today, file_glob, max_files_per_batch)
        batches[s.name] += incremental_refresh(spark, paths, s, run_ts, file_glob, max_files_per_batch)

    stage = "ingest"
    try:
        together(*[partial(ingest, s) for s in STREAMS])
        if fetch is not None:
            stage = "fetch"
            for s in STREAMS:
                wanted = wanted_files(spark, lake, s, today, 0 if target_date else backfill_days, target_date)
                land_documents(fetch(s, wanted), lake, s, today)
            stage = "ingest"
            together(*[partial(ingest, s) for s in STREAMS])
        stage = "gold"
        update_days(spark, lake, run_ts)
        update_fact(spark, lake, run_ts)

        table, shown = fact_table(spark, lake), published(spark, lake.root)
        version = table.current_version()
        forecast_of = shown.note["forecast_of"] if shown is not None else None
        due = forecast and (shown is None or forecast_of != version)
        if shown is not None and shown.note["fact_version"] == version and not due and not any(batches.values()):
            report = run_report(spark, lake, run_ts, True)
            if report["layers"] != last_report(spark, lake).get("layers"):
                _file_report(spark, lake, report)
            return batches
        fact = table.read(version)
        result, split = None, None
        if due:
            forecast_of = version
            if table.row_count() > 0:
                stage = "forecast"
                result = run_forecast(fact, run_ts=run_ts)
                split = prepare(fact).checkpoint()
        stage = "publish"
        report = run_report(spark, lake, run_ts, True, result, split)
        outputs = _outputs(spark, lake, fact, result, split)
        outputs.snapshots["run_meta"] = (spark.createDataFrame([report], META_SCHEMA), ["last_refresh_timestamp"])
        for place in (*mirrors, lake.published):
            publish(spark, place, outputs, {"fact_version": version, "forecast_of": forecast_of, "run_ts": run_ts})
        _file_report(spark, lake, report)
        return batches
    except QualityGateError:
        _file_report(spark, lake, run_report(spark, lake, run_ts, False))
        raise
    except Exception as error:
        stage_failure_audit(spark, error, run_ts, stage, GATE).write.mode("append").json(lake.audit)
        raise


def maintain_lake(spark: SparkSession, root: str, keep: int = 10) -> None:
    """Gather each versioned table into one base version and drop versions before the newest ``keep``."""
    lake = Lake(root.rstrip("/"))
    tables = [fact_table(spark, lake)]
    for s in STREAMS:
        tables += [silver_table(spark, lake.stream(s.name), s), days_table(spark, lake, s)]
    for table in tables:
        table.compact()
        table.vacuum(keep)
