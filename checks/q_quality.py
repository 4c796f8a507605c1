"""Data-quality checks, report, gate, audit."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from checks.sql import s, with_ctes
from tidemark.operators import quality as Q
from tidemark.plans import defaults as D
from tidemark.session import ensure_checkpoint_dir

LAB = "CASE WHEN k = 0 THEN NULL ELSE value END"


def _holed(spark, sf):
    return fx.events(spark, sf).selectExpr("event_id", "event_type", "hour(ts) AS hour", "k", f"{LAB} AS value")


@check("dq_not_null", with_ctes("SELECT event_id, event_type, k FROM ev WHERE k = 0", "ev"))
def dq_not_null(spark, sf):
    return Q.not_null("value").rows(_holed(spark, sf)).select("event_id", "event_type", "k")


@check("dq_unique", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf):
    return Q.unique("l_orderkey").rows(fx.table(spark, sf, "lineitem").select("l_orderkey"))


@check(
    "dq_accepted_values",
    f"SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'signup')",
)
def dq_accepted_values(spark, sf):
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    return Q.accepted_values("event_type", ["click", "view", "signup"]).rows(rows)


@check(
    "dq_accepted_range",
    with_ctes(f"SELECT event_id, value FROM (SELECT event_id, {LAB} AS value FROM ev) WHERE value NOT BETWEEN 1 AND 200", "ev"),
)
def dq_accepted_range(spark, sf):
    return Q.accepted_range("value", 1.0, 200.0).rows(_holed(spark, sf)).select("event_id", "value")


@check(
    "dq_custom_rows",
    with_ctes(
        f"""SELECT daily_metric_id, city, {s('metric_date')} AS metric_date, avg_us_aqi, max_us_aqi
        FROM (SELECT * REPLACE (CASE WHEN day(metric_date) % 5 = 1 THEN avg_us_aqi + 500 ELSE avg_us_aqi END AS avg_us_aqi,
            CASE WHEN day(metric_date) % 5 = 2 THEN max_us_aqi - 400 ELSE max_us_aqi END AS max_us_aqi) FROM fct)
        WHERE avg_us_aqi NOT BETWEEN 0 AND 500 OR max_us_aqi NOT BETWEEN 0 AND 500 OR max_us_aqi < avg_us_aqi""",
        "fct",
    ),
)
def dq_custom_rows(spark, sf):
    day = F.dayofmonth("metric_date") % 5
    planted = fx.fact(spark, sf).withColumns(
        {
            "avg_us_aqi": F.when(day == 1, F.col("avg_us_aqi") + 500).otherwise(F.col("avg_us_aqi")),
            "max_us_aqi": F.when(day == 2, F.col("max_us_aqi") - 400).otherwise(F.col("max_us_aqi")),
        }
    )
    rows = D.aqi_sanity().rows(planted)
    return rows.select("daily_metric_id", "city", "metric_date", "avg_us_aqi", "max_us_aqi")


def _staging_and_fact(spark, sf):
    """All checks but the dimension's, over streams with planted holes; lines stand in for a dimension."""
    ensure_checkpoint_dir(spark)
    fact = fx.fact(spark, sf).checkpoint()  # read by its row checks and by its uniqueness check
    lines = fx.table(spark, sf, "lineitem").selectExpr("l_orderkey AS city_id", "l_returnflag AS city")
    return Q.dq_report(
        {
            "stg_weather": (fx.staged_weather(spark, sf), D.staging_weather_checks()),
            "stg_air_quality": (fx.staged_air_quality(spark, sf), D.staging_air_quality_checks()),
            "dim_city": (lines, D.dim_city_checks()),
            "fct_daily": (fact, D.fact_checks()),
        }
    )


def _line(table, name, column, violations):
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{column}' AS column_name, {violations} AS violations"


def _nulls(view, table, column, physical=None):
    return _line(table, f"not_null_{column}", column, f"(SELECT count(*) FROM {view} WHERE {physical or column} IS NULL)")


def _duplicates(view, table, column, physical=None):
    c = physical or column
    inner = f"SELECT {c} FROM {view} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    return _line(table, f"unique_{column}", column, f"(SELECT count(*) FROM ({inner}))")


REPORT_LINES = " UNION ALL ".join(
    [
        _nulls("w", "stg_weather", "city"),
        _nulls("w", "stg_weather", "metric_date", "date"),
        _nulls("w", "stg_weather", "metric_hour", "hour"),
        _line("stg_weather", "accepted_values_metric_hour", "metric_hour", "(SELECT count(*) FROM w WHERE hour NOT BETWEEN 0 AND 23)"),
        _nulls("w", "stg_weather", "temperature_c", "temperature_2m"),
        _nulls("a", "stg_air_quality", "city"),
        _nulls("a", "stg_air_quality", "metric_date", "date"),
        _nulls("a", "stg_air_quality", "metric_hour", "hour"),
        _nulls("a", "stg_air_quality", "us_aqi"),
        _duplicates("lineitem", "dim_city", "city_id", "l_orderkey"),
        _nulls("lineitem", "dim_city", "city_id", "l_orderkey"),
        _duplicates("lineitem", "dim_city", "city", "l_returnflag"),
        _nulls("lineitem", "dim_city", "city", "l_returnflag"),
        _duplicates("fct", "fct_daily", "daily_metric_id"),
        _nulls("fct", "fct_daily", "daily_metric_id"),
        _nulls("fct", "fct_daily", "city"),
        _nulls("fct", "fct_daily", "metric_date"),
        _nulls("fct", "fct_daily", "avg_us_aqi"),
        _nulls("fct", "fct_daily", "aqi_category"),
        _line(
            "fct_daily", "accepted_values_aqi_category", "aqi_category",
            "(SELECT count(*) FROM fct WHERE aqi_category NOT IN "
            "('Good', 'Moderate', 'Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous'))",
        ),
        _line(
            "fct_daily", "aqi_sanity", "avg_us_aqi",
            "(SELECT count(*) FROM fct WHERE avg_us_aqi NOT BETWEEN 0 AND 500 OR max_us_aqi NOT BETWEEN 0 AND 500 OR max_us_aqi < avg_us_aqi)",
        ),
    ]
)


@check("dq_report", with_ctes(f", lines AS ({REPORT_LINES}) SELECT *, violations = 0 AS passed FROM lines", "w", "a", "fct"))
def dq_report(spark, sf):
    return _staging_and_fact(spark, sf)


FAILED = with_ctes(
    f", lines AS ({REPORT_LINES}), failed AS (SELECT * FROM lines WHERE violations > 0) "
    "SELECT table_name || '.' || check_name || ': ' || violations || ' violations' AS failure FROM failed",
    "w",
    "a",
    "fct",
)


@check("quality_gate", FAILED)
def quality_gate(spark, sf):
    """The gate must stop on this data; its error lists exactly the failed checks."""
    try:
        Q.quality_gate(_staging_and_fact(spark, sf))
    except Q.QualityGateError as stopped:
        return spark.createDataFrame([(f,) for f in stopped.failures], "failure string")
    return spark.createDataFrame([], "failure string")


@check(
    "gate_audit",
    with_ctes(
        f""", lines AS ({REPORT_LINES}) SELECT 'TASK_FAILURE' AS event, '{fx.RUN_TS}' AS timestamp, 'gate' AS task_id,
        left(table_name || '.' || check_name || ': ' || violations || ' violations', 500) AS error, 'CRITICAL' AS severity
        FROM lines WHERE violations > 0""",
        "w",
        "a",
        "fct",
    ),
)
def gate_audit(spark, sf):
    return Q.gate_audit(_staging_and_fact(spark, sf), fx.RUN_TS, "gate", "gate")
