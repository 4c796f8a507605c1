"""Rollups, joins, windows, sorting, set operations and the gold flows."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from checks.registry import check
from checks.sql import improvement, r, s, with_ctes
from tidemark.functions.numbers import round_half_away
from tidemark.operators import clean, joins, rollup, windows
from tidemark.operators.upsert import key_uniqueness_profile, keyed_upsert
from tidemark.plans import defaults as D
from tidemark.plans import gold
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import append_merge_schema, literal_relation

FACT_COLUMNS_SQL = f"daily_metric_id, city, {s('metric_date')} AS metric_date, " + ", ".join(
    [
        *D.WEATHER_ROLLUP,
        *D.AIR_QUALITY_ROLLUP,
        "aqi_category",
        "hourly_weather_records",
        "hourly_aq_records",
        "lag_1d_aqi",
        "lag_2d_aqi",
        "lag_3d_aqi",
        "rolling_7d_avg_aqi",
    ]
)
SNAPSHOT_SQL = ", ".join(f"{s(c)} AS {c}" if c == "metric_date" else c for c in D.SNAPSHOT_COLUMNS)
DAY_SQL = f"city, {s('metric_date')} AS metric_date"


# --- aggregates --------------------------------------------------------------


@check(
    "daily_rollup_weather",
    with_ctes(f"SELECT {DAY_SQL}, {', '.join(D.WEATHER_ROLLUP)}, hourly_weather_records FROM wd", "wd"),
)
def daily_rollup_weather(spark, sf):
    return gold.weather_days(fx.staged_weather(spark, sf))


@check(
    "daily_rollup_aq",
    with_ctes(f"SELECT {DAY_SQL}, {', '.join(D.AIR_QUALITY_ROLLUP)}, hourly_aq_records FROM ad", "ad"),
)
def daily_rollup_aq(spark, sf):
    return gold.air_quality_days(fx.staged_air_quality(spark, sf))


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_COLUMNS_SQL = ", ".join([*LINE_KEYS, *LINE_REST, f"{s('l_shipdate')} AS l_shipdate"])
LINE_ORDER_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in ["l_shipdate", *LINE_REST])


@check(
    "dedupe_latest",
    f"""SELECT {LINE_COLUMNS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    return clean.dedupe_latest(fx.table(spark, sf, "lineitem"), LINE_KEYS, ["l_shipdate"], LINE_REST)


@check(
    "latest_non_null_per_key",
    with_ctes(
        """SELECT user_id, max_by(v, event_id) FILTER (WHERE v IS NOT NULL) AS value,
        max_by(event_type, event_id) AS event_type, max_by(k, event_id) AS k
        FROM (SELECT *, CASE WHEN k >= 50 THEN value END AS v FROM ev) GROUP BY user_id""",
        "ev",
    ),
)
def latest_non_null_per_key(spark, sf):
    rows = fx.events(spark, sf).withColumn("value", F.when(F.col("k") >= 50, F.col("value")))
    return rollup.latest_non_null_per_key(rows, ["user_id"], ["event_id"], ["value", "event_type", "k"])


@check(
    "dataset_window",
    with_ctes(
        f"""SELECT city, count(*) AS total_days, count(target_next_day_aqi) AS labeled_days,
        {s('min(metric_date)')} AS start_date, {s('max(metric_date)')} AS end_date FROM lab GROUP BY city""",
        "lab",
    ),
)
def dataset_window(spark, sf):
    labelled = fx.fact(spark, sf).withColumn("target", windows.lead_target("city", "metric_date", "avg_us_aqi"))
    return rollup.dataset_window(labelled, "city", "metric_date", "target")


COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@check(
    "layer_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS layer, count(*) AS row_count FROM {t}" for t in COUNTED),
)
def layer_row_counts(spark, sf):
    return rollup.layer_row_counts({t: fx.table(spark, sf, t) for t in COUNTED})


@check(
    "monotone_counts",
    """WITH live AS (SELECT o_orderstatus AS layer, count(*) AS n FROM orders WHERE o_orderdate < DATE '1995-06-01'
        GROUP BY 1),
    prior AS (SELECT o_orderstatus AS layer, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1995-06-01'
        GROUP BY 1)
    SELECT coalesce(live.layer, prior.layer) AS layer, greatest(coalesce(live.n, 0), coalesce(prior.n, 0)) AS row_count
    FROM live FULL OUTER JOIN prior ON live.layer = prior.layer""",
)
def monotone_counts(spark, sf):
    orders = fx.table(spark, sf, "orders")

    def counts(df):
        return df.groupBy(F.col("o_orderstatus").alias("layer")).agg(F.count(F.lit(1)).alias("row_count"))

    live = orders.filter("o_orderdate < DATE '1995-06-01'")
    prior = orders.filter("o_orderdate >= DATE '1995-06-01'")
    return rollup.monotone_counts(counts(live), counts(prior))


@check(
    "mae",
    with_ctes(
        f"""SELECT city, {r('avg(abs(target_next_day_aqi - avg_us_aqi))', 2)} AS mae FROM lab
        WHERE target_next_day_aqi IS NOT NULL GROUP BY city""",
        "lab",
    ),
)
def mae(spark, sf):
    labelled = fx.fact(spark, sf).withColumn("target", windows.lead_target("city", "metric_date", "avg_us_aqi"))
    error = rollup.mean_absolute_error("target", "avg_us_aqi")
    return labelled.groupBy("city").agg(round_half_away(error, 2).alias("mae"))


def _split(spark, sf):
    labelled = fx.fact(spark, sf).withColumn(
        "target_next_day_aqi", windows.lead_target("city", "metric_date", "avg_us_aqi")
    )
    split = windows.chronological_split("city", "metric_date", "target_next_day_aqi")
    return labelled.withColumn("split", split)


@check(
    "aggregate_scores",
    with_ctes(
        f""", per_key AS (SELECT city,
          {r("avg(abs(target_next_day_aqi - rolling_7d_avg_aqi)) FILTER (WHERE split = 'val')", 2)} AS val,
          {r("avg(abs(target_next_day_aqi - rolling_7d_avg_aqi)) FILTER (WHERE split = 'test')", 2)} AS test,
          {r("avg(abs(target_next_day_aqi - avg_us_aqi)) FILTER (WHERE split = 'test')", 2)} AS base
          FROM split GROUP BY city),
        m AS (SELECT avg(val) AS v, avg(test) AS t, avg(base) AS b, count(*) FILTER (WHERE test < base) AS beat,
          count(*) AS n FROM per_key)
        SELECT {r('v', 2)} AS val_mae, {r('t', 2)} AS test_mae, {r('b', 2)} AS base_mae,
        {improvement('b', 't')} AS overall_delta_pct, beat AS keys_beating_baseline, n AS total_keys FROM m""",
        "split",
    ),
)
def aggregate_scores(spark, sf):
    """Scores of the 7-day mean as predictor, so every value has a SQL counterpart."""
    rows = _split(spark, sf)

    def error(part, predicted):
        inside = F.when(F.col("split") == part, F.abs(F.col("target_next_day_aqi") - F.col(predicted)))
        return round_half_away(F.avg(inside), 2)

    per_key = rows.groupBy("city").agg(
        error("val", "rolling_7d_avg_aqi").alias("val_mae"),
        error("test", "rolling_7d_avg_aqi").alias("test_mae"),
        error("test", "avg_us_aqi").alias("naive_baseline_mae"),
    )
    return rollup.aggregate_scores(per_key.withColumn("beats_baseline", F.col("test_mae") < F.col("naive_baseline_mae")))


@check(
    "key_uniqueness_profile",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def key_uniqueness(spark, sf):
    return key_uniqueness_profile(fx.table(spark, sf, "lineitem"), LINE_KEYS)


# --- windows -----------------------------------------------------------------


@check(
    "lag_features",
    with_ctes(f"SELECT {DAY_SQL}, avg_us_aqi, lag_1d_aqi, lag_2d_aqi, lag_3d_aqi FROM fct", "fct"),
)
def lag_features(spark, sf):
    days = gold.air_quality_days(fx.staged_air_quality(spark, sf)).select("city", "metric_date", "avg_us_aqi")
    return days.withColumns(windows.lag_features("city", "metric_date", "avg_us_aqi", (1, 2, 3), "lag_{step}d_aqi"))


@check("rolling_mean_7", with_ctes(f"SELECT {DAY_SQL}, rolling_7d_avg_aqi FROM fct", "fct"))
def rolling_mean_7(spark, sf):
    days = gold.air_quality_days(fx.staged_air_quality(spark, sf))
    mean = windows.rolling_mean("city", "metric_date", "avg_us_aqi", 7, 1)
    return days.select("city", "metric_date", mean.alias("rolling_7d_avg_aqi"))


@check("lead_target", with_ctes(f"SELECT {DAY_SQL}, avg_us_aqi, target_next_day_aqi FROM lab", "lab"))
def lead_target(spark, sf):
    days = gold.air_quality_days(fx.staged_air_quality(spark, sf)).select("city", "metric_date", "avg_us_aqi")
    return days.withColumn("target_next_day_aqi", windows.lead_target("city", "metric_date", "avg_us_aqi"))


@check(
    "latest_per_key",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {s('o_orderdate')} AS o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    return rollup.latest_per_key(fx.table(spark, sf, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"])


@check(
    "chronological_split",
    with_ctes(f"SELECT {DAY_SQL}, split FROM split", "split"),
)
def chronological_split(spark, sf):
    return clean.drop_null_label(_split(spark, sf), "target_next_day_aqi").select("city", "metric_date", "split")


# --- joins -------------------------------------------------------------------


@check(
    "join_streams_daily",
    with_ctes(f"SELECT {DAY_SQL}, avg_temperature_c, avg_us_aqi FROM wd JOIN ad USING (city, metric_date)", "wd", "ad"),
)
def join_streams_daily(spark, sf):
    weather = gold.weather_days(fx.staged_weather(spark, sf)).select(*D.DAILY_KEYS, "avg_temperature_c")
    air = gold.air_quality_days(fx.staged_air_quality(spark, sf)).select(*D.DAILY_KEYS, "avg_us_aqi")
    return joins.join_streams_daily(weather, air, D.DAILY_KEYS)


@check(
    "join_dimension",
    with_ctes("SELECT o_orderkey, o_custkey, o_totalprice, c_name, n_name, r_name FROM orders JOIN dims ON o_custkey = c_custkey", "dims"),
)
def join_dimension(spark, sf):
    fact = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dim = fx.customer_dimension(spark, sf).withColumnRenamed("c_custkey", "o_custkey")
    return joins.join_dimension(fact, dim.select("o_custkey", "c_name", "n_name", "r_name"), "o_custkey")


@check(
    "keyed_upsert",
    f"""WITH source AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders WHERE o_orderdate >= DATE '1999-01-01'),
    target AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-06-01'),
    merged AS (SELECT * FROM source UNION ALL
      SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey))
    SELECT * REPLACE ({s('o_orderdate')} AS o_orderdate) FROM merged""",
)
def keyed_upsert_query(spark, sf):
    """Re-priced and later orders merged into the orders known before."""
    orders = fx.table(spark, sf, "orders")
    target = orders.filter("o_orderdate < DATE '2000-06-01'")
    source = orders.filter("o_orderdate >= DATE '1999-01-01'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return keyed_upsert(target, source, ["o_orderkey"])


@check(
    "next_day_lookup",
    f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS top FROM events GROUP BY 1, 2)
    SELECT a.user_id, {s('a.day')} AS day, a.top, b.top AS next_day_top
    FROM d a LEFT JOIN d b ON a.user_id = b.user_id AND b.day = a.day + 1""",
)
def next_day_lookup(spark, sf):
    """Users skip days, so the next row often is not the next day."""
    days = fx.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("top"))
    return days.withColumn("next_day_top", windows.next_day_lookup("user_id", "day", "top"))


@check(
    "join_prediction_default",
    with_ctes(
        f""", newest AS (SELECT city, max_by(avg_us_aqi, metric_date) AS avg_us_aqi,
          max_by(rolling_7d_avg_aqi, metric_date) AS rolled FROM fct GROUP BY city),
        pred AS (SELECT city, rolled AS predicted_aqi FROM newest WHERE city <> 'view')
        SELECT city, avg_us_aqi, coalesce(predicted_aqi, avg_us_aqi) AS predicted_aqi,
        {r('coalesce(predicted_aqi, avg_us_aqi) - avg_us_aqi', 1)} AS delta FROM newest LEFT JOIN pred USING (city)""",
        "fct",
    ),
)
def join_prediction_default(spark, sf):
    ensure_checkpoint_dir(spark)
    newest = rollup.last_row_per_key(
        fx.fact(spark, sf), "city", ["metric_date"], ["avg_us_aqi", "rolling_7d_avg_aqi"]
    ).checkpoint()  # used on both sides of the join
    predictions = newest.filter("city <> 'view'").select("city", F.col("rolling_7d_avg_aqi").alias("predicted_aqi"))
    summary = newest.select("city", "avg_us_aqi")
    joined = joins.join_prediction_default(summary, predictions, "city", "avg_us_aqi", "predicted_aqi")
    return joined.withColumn("delta", round_half_away("delta", 1))


CALENDAR = ("2023-12-28", "2024-02-02")


@check(
    "missing_dates",
    f"""WITH cal AS (SELECT CAST(unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY)) AS DATE) AS day),
    users AS (SELECT DISTINCT user_id FROM events), landed AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)
    SELECT user_id, {s('day')} AS day FROM (SELECT user_id, day FROM users CROSS JOIN cal EXCEPT SELECT user_id, day FROM landed)""",
)
def missing_dates(spark, sf):
    landed = fx.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    return joins.missing_dates(landed, "user_id", "day", *CALENDAR)


@check(
    "route_by_age",
    f"""SELECT event_id, {s('CAST(ts AS DATE)')} AS day,
    CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') >= 5 THEN 'archive' ELSE 'forecast' END AS route
    FROM events""",
)
def route_by_age(spark, sf):
    rows = fx.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    return rows.withColumn("route", joins.route_by_age("day", "2024-02-01", 5))


# --- sort, top-k -------------------------------------------------------------


@check("order_snapshot", with_ctes(f"SELECT {DAY_SQL}, avg_us_aqi, aqi_category FROM fct", "fct"))
def order_snapshot(spark, sf):
    rows = fx.fact(spark, sf).select("city", "metric_date", "avg_us_aqi", "aqi_category")
    return rows.orderBy(F.col("metric_date").asc_nulls_last(), F.col("city").asc_nulls_last())


@check(
    "last_row_per_key",
    f"""SELECT o_custkey, {s('max(o_orderdate)')} AS o_orderdate, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
    max_by(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM orders GROUP BY o_custkey""",
)
def last_row_per_key(spark, sf):
    return rollup.last_row_per_key(
        fx.table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"],
        ["o_orderdate", "o_orderkey", "o_totalprice"],
    )


PREDICTORS = {"persistence": "avg_us_aqi", "lag_1": "lag_1d_aqi", "lag_2": "lag_2d_aqi", "mean_7": "rolling_7d_avg_aqi"}


@check(
    "argmin_config",
    with_ctes(
        ", cells AS ("
        + " UNION ALL ".join(
            f"SELECT city, '{name}' AS config, avg(abs(target_next_day_aqi - {column})) AS mae FROM split "
            f"WHERE split = 'val' GROUP BY city"
            for name, column in PREDICTORS.items()
        )
        + f") SELECT config, {r('avg(mae)', 4)} AS mean_score, "
        "CAST(row_number() OVER (ORDER BY round(avg(mae), 9) NULLS LAST, config) AS INTEGER) AS place FROM cells GROUP BY config",
        "split",
    ),
)
def argmin_config(spark, sf):
    """Naive predictors ranked by validation error, all scored in one pass over the split."""
    val = _split(spark, sf).filter("split = 'val'")
    cells = val.select("city", "target_next_day_aqi", *[F.col(c).alias(n) for n, c in PREDICTORS.items()])
    long = cells.unpivot(["city", "target_next_day_aqi"], list(PREDICTORS), "config", "predicted")
    scores = long.groupBy("city", "config").agg(
        rollup.mean_absolute_error("target_next_day_aqi", "predicted").alias("mae")
    )
    ranked = rollup.argmin_config(scores, "config", "mae")
    order = Window.orderBy(F.col("mean_score").asc_nulls_last(), "config")  # a row per predictor
    return ranked.withColumn("place", F.row_number().over(order)).withColumn("mean_score", round_half_away("mean_score", 4))


# --- set operations ----------------------------------------------------------


@check(
    "union_all",
    """SELECT 'customer' AS party, c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_all(spark, sf):
    customers = fx.table(spark, sf, "customer").select(
        F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"), F.col("c_acctbal").alias("balance"),
    )
    suppliers = fx.table(spark, sf, "supplier").select(
        F.lit("supplier").alias("party"), F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("party_name"), F.col("s_acctbal").alias("balance"),
    )
    return customers.unionByName(suppliers)


@check(
    "append_forecast_point",
    with_ctes(
        f"""SELECT city, {s('metric_date')} AS metric_date, avg_us_aqi, rolling_7d_avg_aqi, CAST(NULL AS DOUBLE) AS predicted_aqi FROM fct
        UNION ALL SELECT city, {s('max(metric_date) + 1')}, NULL, NULL, max_by(rolling_7d_avg_aqi, metric_date) FROM fct GROUP BY city""",
        "fct",
    ),
)
def append_forecast_point(spark, sf):
    ensure_checkpoint_dir(spark)
    series = fx.fact(spark, sf).select("city", "metric_date", "avg_us_aqi", "rolling_7d_avg_aqi").checkpoint()
    newest = rollup.last_row_per_key(series, "city", ["metric_date"], ["metric_date", "rolling_7d_avg_aqi"])
    points = newest.select(
        "city", F.date_add("metric_date", 1).alias("metric_date"), F.col("rolling_7d_avg_aqi").alias("predicted_aqi")
    )
    return joins.append_forecast_point(series, points)


@check(
    "unpivot_pollutants",
    with_ctes(
        " UNION ALL ".join(f"SELECT {DAY_SQL}, '{shown}' AS name, {c} AS value FROM ad" for c, shown in D.POLLUTANTS.items()),
        "ad",
    ),
)
def unpivot_pollutants(spark, sf):
    days = gold.air_quality_days(fx.staged_air_quality(spark, sf))
    return joins.unpivot_measures(days, D.DAILY_KEYS, D.POLLUTANTS)


# --- flows -------------------------------------------------------------------


@check("fct_daily", with_ctes(f"SELECT {FACT_COLUMNS_SQL} FROM fct", "fct"))
def fct_daily(spark, sf):
    return fx.fact(spark, sf)


@check("daily_metrics_snapshot", with_ctes(f"SELECT {SNAPSHOT_SQL} FROM fct", "fct"))
def daily_metrics_snapshot(spark, sf):
    return gold.daily_metrics_snapshot(fx.fact(spark, sf))


@check(
    "dim_build",
    with_ctes(
        "SELECT md5(c_name) AS customer_id, c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name FROM dims", "dims"
    ),
)
def dim_build(spark, sf):
    return gold.dim_build(fx.customer_dimension(spark, sf), "c_name", "customer_id").drop("created_at")


KIND_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType()), T.StructField("city_name", T.StringType()), T.StructField("tier", T.IntegerType())]
)
KINDS = (("click", "Click", 2), ("error", "Error", 3), ("purchase", "Purchase", 1), ("signup", "Sign-up", 1), ("view", "View", 2))
KINDS_SQL = "kinds(city, city_name, tier) AS (VALUES " + ", ".join(str(k) for k in KINDS) + ")"


@check(
    "literal_relation",
    f"""WITH {KINDS_SQL} SELECT city, city_name, tier, count(*) AS n_events FROM kinds JOIN events ON event_type = city
    GROUP BY ALL""",
)
def literal_relation_query(spark, sf):
    """Literal rows joined to every event; the counts combine before the join."""
    kinds = literal_relation(spark, KINDS, KIND_SCHEMA)
    counts = fx.table(spark, sf, "events").groupBy(F.col("event_type").alias("city")).agg(F.count(F.lit(1)).alias("n_events"))
    return kinds.join(counts, "city")


@check(
    "latest_city_summary",
    with_ctes(
        f""", {KINDS_SQL} SELECT {FACT_COLUMNS_SQL}, city_name, tier FROM
        (SELECT *, row_number() OVER (PARTITION BY city ORDER BY metric_date DESC) AS rn FROM fct) JOIN kinds USING (city)
        WHERE rn = 1""",
        "fct",
    ),
)
def latest_city_summary(spark, sf):
    kinds = literal_relation(spark, KINDS, KIND_SCHEMA)
    return gold.latest_city_summary(fx.fact(spark, sf), kinds, ["city_name", "tier"])


@check(
    "union_merge_schema",
    with_ctes(
        f"""SELECT event_id, city, 'weather' AS source_type, temperature_2m, wind_speed_10m, CAST(NULL AS DOUBLE) AS pm10,
        CAST(NULL AS DOUBLE) AS us_aqi FROM w WHERE temperature_2m < -50 OR temperature_2m > 65 OR wind_speed_10m > 180
        UNION ALL SELECT event_id, city, 'air_quality', NULL, NULL, pm10, us_aqi FROM a WHERE pm10 > 300 OR us_aqi < 1""",
        "w",
        "a",
    ),
)
def union_merge_schema(spark, sf):
    """Rejects of two streams with different columns in one quarantine frame."""
    weather_mask = clean.bounds_mask({"temperature_2m": (-50, 65), "wind_speed_10m": (0, 180)})
    air_mask = clean.bounds_mask({"pm10": (0, 300), "us_aqi": (1, 1000)})
    weather = fx.silver_weather(spark, sf).filter(weather_mask).select(
        "event_id", "city", F.lit("weather").alias("source_type"), "temperature_2m", "wind_speed_10m"
    )
    air = fx.silver_air_quality(spark, sf).filter(air_mask).select(
        "event_id", "city", F.lit("air_quality").alias("source_type"), "pm10", "us_aqi"
    )
    return append_merge_schema(weather, air)
