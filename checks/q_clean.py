"""Projections, filters, predicates, scalar functions."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from checks.sql import aqi_label, improvement, r, s, with_ctes
from tidemark.functions.labels import band, iso_date, month_day, payload_checksum, surrogate_key, threshold_text
from tidemark.functions.numbers import clamp, clamp_round, improvement_pct, null_if_not_finite, round_half_away
from tidemark.operators import clean
from tidemark.operators.forecast import performance_summary
from tidemark.plans import defaults as D

F1_BOUNDS = {"value": (1.0, 200.0)}
# A null measure for part of the rows: the mask becomes unknown there.
HOLED_SQL = "CASE WHEN k = 0 THEN NULL ELSE value END"
MASK_SQL = "(v < 1 OR v > 200 OR event_type IS NULL)"


@check(
    "staging_projection",
    with_ctes(
        f"""SELECT city, {s('date')} AS metric_date, hour AS metric_hour, {s('datetime_utc')} AS measured_at,
        temperature_2m AS temperature_c, relative_humidity_2m AS relative_humidity_pct,
        precipitation AS precipitation_mm, wind_speed_10m AS wind_speed_kmh, weather_code, source_file,
        '{fx.RUN_TS}' AS silver_processed_at FROM w""",
        "w",
    ),
)
def staging_projection(spark, sf):
    return clean.staging_projection(fx.silver_weather(spark, sf), D.STAGING_WEATHER)


@check(
    "cast_measures",
    """SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_text,
    TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INTEGER) AS k_text,
    TRY_CAST(event_type AS DOUBLE) AS event_type FROM events""",
)
def cast_measures(spark, sf):
    text = fx.table(spark, sf, "events").select(
        "event_id",
        F.col("value").cast("string").alias("value_text"),
        F.regexp_replace("props", "[^0-9]", "").alias("k_text"),
        "event_type",
    )
    return clean.cast_measures(text, {"value_text": "double", "k_text": "int", "event_type": "double"})


@check(
    "derive_time_keys",
    f"""WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
        ELSE date_trunc('minute', ts) END AS m, ts FROM events)
    SELECT event_id, CASE WHEN m IS NULL THEN strftime(ts, '%Y/%m/%d %H:%M') ELSE strftime(m, '%Y-%m-%dT%H:%M') END AS time,
    {s('m')} AS datetime_utc, {s('CAST(m AS DATE)')} AS date, CAST(hour(m) AS INTEGER) AS hour FROM t""",
)
def derive_time_keys(spark, sf):
    """One event type writes its time in another format: null keys, not a failed batch."""
    time = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    )
    return clean.derive_time_keys(fx.table(spark, sf, "events").select("event_id", time.alias("time")))


@check(
    "select_ordered",
    with_ctes(
        f"""SELECT city, {s('date')} AS date, hour, {s('datetime_utc')} AS datetime_utc, temperature_2m,
        relative_humidity_2m, precipitation, wind_speed_10m, weather_code, source_file FROM w""",
        "w",
    ),
)
def select_ordered(spark, sf):
    columns = [*D.SILVER_KEYS, "datetime_utc", *D.WEATHER_MEASURES, "source_file"]
    return clean.select_ordered(fx.silver_weather(spark, sf), columns)


def _holed(spark, sf):
    return fx.events(spark, sf).select("event_id", "event_type", F.when(F.col("k") != 0, F.col("value")).alias("value"))


@check(
    "bounds_mask",
    with_ctes(
        f"""SELECT event_id, CASE WHEN {MASK_SQL} THEN 'malformed' WHEN NOT {MASK_SQL} THEN 'clean' ELSE 'unknown' END AS state
        FROM (SELECT *, {HOLED_SQL} AS v FROM ev)""",
        "ev",
    ),
)
def bounds_mask(spark, sf):
    mask = clean.bounds_mask(F1_BOUNDS, required=["event_type"])
    state = F.when(mask, "malformed").when(~mask, "clean").otherwise("unknown")
    return _holed(spark, sf).select("event_id", state.alias("state"))


@check(
    "split_clean_reject",
    with_ctes(
        f""", m AS (SELECT event_id, {MASK_SQL} AS bad FROM (SELECT *, {HOLED_SQL} AS v FROM ev))
        SELECT event_id, 'drop' AS on_null, CASE WHEN bad THEN 'rejected' ELSE 'clean' END AS side
        FROM m WHERE bad IS NOT NULL
        UNION ALL SELECT event_id, 'keep', CASE WHEN coalesce(bad, false) THEN 'rejected' ELSE 'clean' END FROM m
        UNION ALL SELECT event_id, 'reject', CASE WHEN coalesce(bad, true) THEN 'rejected' ELSE 'clean' END FROM m""",
        "ev",
    ),
)
def split_clean_reject(spark, sf):
    rows, mask = _holed(spark, sf), clean.bounds_mask(F1_BOUNDS, required=["event_type"])
    result = None
    for mode in ("drop", "keep", "reject"):
        kept, rejected = clean.split_clean_reject(rows, mask, mode)
        for side, df in (("clean", kept), ("rejected", rejected)):
            part = df.select("event_id", F.lit(mode).alias("on_null"), F.lit(side).alias("side"))
            result = part if result is None else result.unionByName(part)
    return result


@check(
    "quarantine",
    with_ctes(
        f"""SELECT event_id, event_type, value, 'value out of bounds' AS quarantine_reason, 'events' AS source_type,
        '{fx.RUN_TS}' AS quarantined_at FROM ev WHERE value < 1 OR value > 200""",
        "ev",
    ),
)
def quarantine(spark, sf):
    rows = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    _, rejected = clean.split_clean_reject(rows, clean.bounds_mask(F1_BOUNDS))
    return clean.quarantine(rejected, "value out of bounds", "events", fx.RUN_TS)


@check(
    "filter_key",
    with_ctes(f"SELECT city, {s('metric_date')} AS metric_date, avg_us_aqi FROM ad WHERE city = 'purchase'", "ad"),
)
def filter_key(spark, sf):
    from tidemark.plans import gold

    staged = clean.filter_key(fx.staged_air_quality(spark, sf), "city", "purchase")
    return gold.air_quality_days(staged).select("city", "metric_date", "avg_us_aqi")


@check(
    "drop_null_label",
    with_ctes(f"SELECT event_id, {HOLED_SQL} AS value FROM ev WHERE ({HOLED_SQL}) IS NOT NULL", "ev"),
)
def drop_null_label(spark, sf):
    return clean.drop_null_label(_holed(spark, sf), "value").select("event_id", "value")


@check("select_exclude", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_exclude(spark, sf):
    return clean.select_exclude(fx.table(spark, sf, "orders"), "o_orderstatus", "o_orderdate", "o_orderpriority")


@check(
    "bucket_category",
    with_ctes(
        f"""SELECT event_id, {aqi_label('v')} AS category,
        CASE WHEN v IS NULL THEN 'Unknown' ELSE {aqi_label('v')} END AS category_or_unknown
        FROM (SELECT *, {HOLED_SQL} AS v FROM ev)""",
        "ev",
    ),
)
def bucket_category(spark, sf):
    return _holed(spark, sf).select(
        "event_id",
        band("value", D.AQI_CUTS, D.AQI_TOP).alias("category"),
        band("value", D.AQI_CUTS, D.AQI_TOP, null_label="Unknown").alias("category_or_unknown"),
    )


@check(
    "bucket_display_band",
    """SELECT event_id, CASE WHEN value <= 50 THEN 'Good' WHEN value <= 100 THEN 'Moderate'
    WHEN value <= 150 THEN 'Moderate / USG' WHEN value > 200 THEN 'Critical' ELSE 'Unhealthy' END AS display_band
    FROM events""",
)
def bucket_display_band(spark, sf):
    rows = fx.table(spark, sf, "events")
    return rows.select("event_id", band("value", D.DISPLAY_CUTS, D.DISPLAY_TOP).alias("display_band"))


@check(
    "threshold_advisory",
    with_ctes(
        f"""SELECT city, {s('metric_date')} AS metric_date, CASE WHEN avg_us_aqi > 150 THEN '{D.ADVISORY_ABOVE}'
        ELSE '{D.ADVISORY_BELOW}' END AS advisory FROM ad""",
        "ad",
    ),
)
def threshold_advisory(spark, sf):
    from tidemark.plans import gold

    days = gold.air_quality_days(fx.staged_air_quality(spark, sf))
    text = threshold_text("avg_us_aqi", D.ADVISORY_LIMIT, D.ADVISORY_ABOVE, D.ADVISORY_BELOW)
    return days.select("city", "metric_date", text.alias("advisory"))


@check(
    "clamp_round",
    with_ctes(
        f"""SELECT event_id, CASE WHEN v IS NULL THEN NULL ELSE {r('greatest(0, least(500, v))', 1)} END AS clamped
        FROM (SELECT event_id, CASE WHEN k = 0 THEN NULL ELSE value * 3 - 40 END AS v FROM ev)""",
        "ev",
    ),
)
def clamp_round_query(spark, sf):
    shifted = fx.events(spark, sf).select("event_id", F.when(F.col("k") != 0, F.col("value") * 3 - 40).alias("v"))
    return shifted.select("event_id", clamp_round("v", 0.0, 500.0, 1).alias("clamped"))


@check(
    "scalar_functions",
    with_ctes(
        f"""SELECT event_id, md5(event_type) AS key_md5, md5(event_type || '_' || {s('CAST(ts AS DATE)')}) AS day_md5,
        sha256(props) AS props_sha256, {r('value / 7', 2)} AS rounded,
        CAST(floor(value + 0.5) AS INTEGER) AS nearest_int,
        split_part(strftime(ts, '%Y-%m-%dT%H:%M'), 'T', 1) AS date_part,
        list_extract(string_split('lake/' || event_type || '/day.json', '/'), -2) AS folder,
        {s('CAST(ts AS DATE)')} AS day, CAST(hour(ts) AS INTEGER) AS hour,
        CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(month(ts) AS INTEGER) AS month,
        {s('CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE)')} AS next_day,
        CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS age_days,
        strftime(ts, '%m-%d') AS month_day, abs(value - k) AS distance,
        greatest(0.0::DOUBLE, least(100.0::DOUBLE, value)) AS clamped, CASE WHEN k = 0 THEN NULL ELSE value / k END AS finite_ratio,
        {improvement('value', 'CAST(k AS DOUBLE)')} AS delta_pct, k < value AS beats,
        CASE WHEN k < value THEN 'Beats persistence baseline by ' || printf('%.1f', {improvement('value', 'CAST(k AS DOUBLE)')}) || '%'
        ELSE 'Underperforms persistence baseline by ' || printf('%.1f', abs({improvement('value', 'CAST(k AS DOUBLE)')}))
          || '% (low atmospheric volatility / small sample)' END AS summary
        FROM ev""",
        "ev",
    ),
)
def scalar_functions(spark, sf):
    value, k, ts = F.col("value"), F.col("k"), F.col("ts")
    scored = fx.events(spark, sf).withColumns(
        {"delta_pct": improvement_pct(value, k.cast("double")), "beats": k < value}
    )
    # Division by zero gives infinity for doubles outside ANSI; build it explicitly.
    ratio = F.when(k == 0, F.lit(float("inf"))).otherwise(F.try_divide(value, k.cast("double")))
    return scored.select(
        "event_id",
        surrogate_key("event_type").alias("key_md5"),
        surrogate_key("event_type", F.to_date(ts)).alias("day_md5"),
        payload_checksum("props").alias("props_sha256"),
        round_half_away(value / 7, 2).alias("rounded"),
        F.floor(value + 0.5).cast("int").alias("nearest_int"),
        F.element_at(F.split(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), "T"), 1).alias("date_part"),
        F.element_at(F.split(F.concat(F.lit("lake/"), "event_type", F.lit("/day.json")), "/"), -2).alias("folder"),
        iso_date(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
        F.month(ts).alias("month"),
        F.date_add(F.to_date(ts), 1).alias("next_day"),
        F.datediff(F.lit("2024-02-01").cast("date"), F.to_date(ts)).alias("age_days"),
        month_day(ts).alias("month_day"),
        F.abs(value - k).alias("distance"),
        clamp(value, 0.0, 100.0).alias("clamped"),
        null_if_not_finite(ratio).alias("finite_ratio"),
        "delta_pct",
        "beats",
        performance_summary("delta_pct", "beats").alias("summary"),
    )
