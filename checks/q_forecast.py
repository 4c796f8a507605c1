"""Forecast operators. Learned values have no SQL side; their properties are tested in tests/."""

import dataclasses

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from checks.sql import aqi_label, improvement, r, s, with_ctes
from tidemark.functions.numbers import round_half_away
from tidemark.operators import forecast as FC
from tidemark.plans import defaults as D
from tidemark.plans import forecasting
from tidemark.session import ensure_checkpoint_dir

SPEC = D.FORECAST
WINNER = next(iter(SPEC.configs))


@check(
    "feature_frame",
    with_ctes(
        f"""SELECT city, {s('metric_date')} AS metric_date, avg_us_aqi, lag_1d_aqi, lag_2d_aqi, lag_3d_aqi, avg_temperature_c,
        avg_humidity_pct, avg_wind_speed_kmh, avg_pm2_5, avg_pm10, CAST(isodow(metric_date) - 1 AS INTEGER) AS day_of_week,
        CAST(month(metric_date) AS INTEGER) AS month, target_next_day_aqi FROM lab""",
        "lab",
    ),
)
def feature_frame(spark, sf):
    return FC.feature_frame(fx.fact(spark, sf), SPEC)


@check(
    "persistence_baseline",
    with_ctes(
        f"""SELECT city, {r('avg(abs(target_next_day_aqi - avg_us_aqi))', 2)} AS naive_baseline_mae FROM split
        WHERE split = 'test' GROUP BY city""",
        "split",
    ),
)
def persistence_baseline(spark, sf):
    return FC.persistence_baseline(forecasting.prepare(fx.fact(spark, sf)), SPEC)


def _split(spark, sf):
    """Each use below reads the split several times, so it is cut off from its inputs once."""
    ensure_checkpoint_dir(spark)
    return forecasting.prepare(fx.fact(spark, sf)).checkpoint()


# The learned queries come twice: with one-stump configurations, which SQL repeats by trying every cut, and with
# the shipped grid of boosted trees (``*_boosted``), which has no SQL side.
STUMPS = {
    "stump_3": FC.TreeConfig(3, 1.0, 1, 1),
    "stump_5_half": FC.TreeConfig(5, 0.5, 1, 1),
    "stump_8": FC.TreeConfig(8, 1.0, 1, 1),
}
STUMP_SPEC = dataclasses.replace(SPEC, configs=STUMPS, fallback=STUMPS["stump_3"])
STUMP = "stump_5_half"

_DERIVED = {"day_of_week": "isodow(metric_date) - 1", "month": "month(metric_date)"}
FEATURE_SQL = ", ".join(f"({_DERIVED.get(c, c)})::DOUBLE" for c in SPEC.features)
# Every day of a series, split or unlabelled, with its target.
DAYS_SQL = """, s0 AS (SELECT *, target_next_day_aqi AS y, 'unlabelled' AS split FROM lab WHERE target_next_day_aqi IS NULL
      UNION ALL BY NAME SELECT * EXCLUDE (newest_first, n), target_next_day_aqi AS y FROM split)"""


def tried_sql(cell: str) -> str:
    """Every cut of every feature of a cell, either side for missing values; ``longer`` holds (cell, leaf, f, v, y)."""
    return f"""cuts AS (SELECT *, (v + lead(v) OVER (PARTITION BY {cell}, f ORDER BY v)) / 2 AS cut FROM (
        SELECT DISTINCT {cell}, leaf, f, v FROM longer WHERE v IS NOT NULL)),
      tried AS (SELECT {cell}, c.leaf, f, c.cut, m.missing_left, count(*) AS n, sum(l.y) AS total,
        count(*) FILTER (WHERE coalesce(l.v <= c.cut, m.missing_left)) AS left_n,
        coalesce(sum(l.y) FILTER (WHERE coalesce(l.v <= c.cut, m.missing_left)), 0) AS left_s, count(*) FILTER (WHERE l.v IS NULL) AS missing_n
        FROM cuts c JOIN longer l USING ({cell}, f), (VALUES (false), (true)) AS m(missing_left) WHERE cut IS NOT NULL GROUP BY ALL),
      gains AS (SELECT *, n - left_n AS right_n, total - left_s AS right_s FROM tried
        WHERE left_n >= leaf AND n - left_n >= leaf AND (missing_n > 0 OR NOT missing_left)),
      best AS (SELECT * FROM (SELECT *, round(left_s * left_s / left_n + right_s * right_s / right_n - total * total / n, 6) AS gain FROM gains)
        WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY {cell} ORDER BY gain DESC, missing_left, f, cut) = 1)"""


LEAF_SQL = """CASE WHEN coalesce(s.x[b.f] <= b.cut, CASE WHEN b.missing_n > 0 THEN b.missing_left ELSE b.left_n > b.right_n END)
      THEN b.left_s / b.left_n ELSE b.right_s / b.right_n END"""
GRID_SQL = ", ".join(f"('{n}', {c.min_samples_leaf}, {c.learning_rate}::DOUBLE)" for n, c in STUMPS.items())
STUMP_SQL = f"""{DAYS_SQL}, s1 AS (SELECT city, metric_date, avg_us_aqi, y, split, [{FEATURE_SQL}] AS x FROM s0),
    grid AS (SELECT * FROM (VALUES {GRID_SQL}) AS t(config, leaf, rate)),
    folds AS (SELECT * FROM (VALUES ('val', ['train'], ['val']), ('eval', ['train', 'val'], ['train', 'val', 'test']),
      ('prod', ['train', 'val', 'test'], ['train', 'val', 'test', 'unlabelled'])) AS t(fold, learns, scores)),
    learned AS (SELECT city, config, fold, leaf, rate, x, y FROM s1, grid, folds WHERE list_contains(learns, split)),
    totals AS (SELECT city, config, fold, rate, count(*) AS n, sum(y) AS total FROM learned GROUP BY ALL),
    longer AS (SELECT city, config, fold, leaf, y, unnest(range(1, len(x) + 1)) AS f, unnest(x) AS v FROM learned),
    {tried_sql('city, config, fold')},
    guessed AS (SELECT s.city, s.metric_date, s.avg_us_aqi, s.y, s.split, t.config, t.fold,
      t.total / t.n + t.rate * (coalesce({LEAF_SQL}, t.total / t.n) - t.total / t.n) AS prediction
      FROM s1 s JOIN totals t USING (city) JOIN folds USING (fold) LEFT JOIN best b USING (city, config, fold) WHERE list_contains(scores, s.split)),
    series AS (SELECT city, metric_date, avg_us_aqi, {r('least(500, greatest(0, prediction))', 1)} AS predicted
      FROM guessed WHERE config = '{STUMP}' AND fold = 'prod')"""


def _grid(spark, sf, spec):
    ranking = FC.grid_search_validation(_split(spark, sf), spec)
    return ranking.withColumn("mean_val_mae", round_half_away("mean_val_mae", 2))


def _evaluated(spark, sf, spec, config):
    split = _split(spark, sf)
    predictions = FC.fit_cells(split, spec, ["val", "eval"], [config])
    return FC.fit_eval_per_key(split, predictions, spec)


def _series(spark, sf, spec=SPEC, config=WINNER):
    split = _split(spark, sf)
    return FC.production_series(split, FC.fit_cells(split, spec, ["prod"], [config]), spec)


@check(
    "grid_search_validation",
    with_ctes(
        f"""{STUMP_SQL}, k AS (SELECT config, city, avg(abs(y - prediction)) AS val_mae FROM guessed WHERE fold = 'val' AND split = 'val' GROUP BY 1, 2)
        SELECT config, {r('avg(val_mae)', 2)} AS mean_val_mae, count(*) AS n_keys FROM k GROUP BY config""",
        "lab",
        "split",
    ),
)
def grid_search_validation(spark, sf):
    return _grid(spark, sf, STUMP_SPEC)


@check("grid_search_boosted")
def grid_search_boosted(spark, sf):
    return _grid(spark, sf, SPEC)


@check(
    "fit_eval_per_key",
    with_ctes(
        f"""{STUMP_SQL} SELECT city, count(DISTINCT metric_date) AS total_samples,
          count(DISTINCT metric_date) FILTER (WHERE split = 'train') AS train_samples, count(DISTINCT metric_date) FILTER (WHERE split = 'val') AS val_samples,
          count(DISTINCT metric_date) FILTER (WHERE split = 'test') AS test_samples,
          {r("avg(abs(y - prediction)) FILTER (WHERE fold = 'val')", 2)} AS val_mae,
          {r("avg(abs(y - prediction)) FILTER (WHERE fold = 'eval' AND split <> 'test')", 2)} AS train_val_mae,
          {r("avg(abs(y - prediction)) FILTER (WHERE fold = 'eval' AND split = 'test')", 2)} AS test_mae,
          {r("avg(abs(y - avg_us_aqi)) FILTER (WHERE fold = 'eval' AND split = 'test')", 2)} AS naive_mae
          FROM guessed WHERE config = '{STUMP}' AND split <> 'unlabelled' GROUP BY city""",
        "lab",
        "split",
    ),
)
def fit_eval_per_key(spark, sf):
    found = _evaluated(spark, sf, STUMP_SPEC, STUMP)
    return found.withColumns({"test_mae": round_half_away("_test", 2), "naive_mae": round_half_away("_naive", 2)}).drop("_test", "_naive")


@check("fit_eval_boosted")
def fit_eval_boosted(spark, sf):
    return _evaluated(spark, sf, SPEC, WINNER)


@check(
    "forecast_next_day",
    with_ctes(
        f"""{STUMP_SQL} SELECT city, {s('CAST(metric_date + 1 AS DATE)')} AS forecast_for_date, {s('metric_date')} AS reference_date,
        predicted AS predicted_value, {aqi_label('predicted')} AS predicted_category, avg_us_aqi AS reference_value,
        '{D.MODEL_VERSION}' AS model_version FROM series QUALIFY row_number() OVER (PARTITION BY city ORDER BY metric_date DESC) = 1""",
        "lab",
        "split",
    ),
)
def forecast_next_day(spark, sf):
    return FC.forecast_next_day(_series(spark, sf, STUMP_SPEC, STUMP), STUMP_SPEC, D.AQI_CUTS, D.AQI_TOP, D.MODEL_VERSION)


@check("forecast_next_day_boosted")
def forecast_next_day_boosted(spark, sf):
    return FC.forecast_next_day(_series(spark, sf), SPEC, D.AQI_CUTS, D.AQI_TOP, D.MODEL_VERSION)


@check(
    "backtest_series",
    with_ctes(
        f"""{STUMP_SQL} SELECT s.city, {s('CAST(s.metric_date + 1 AS DATE)')} AS date, s.predicted, n.avg_us_aqi AS actual
        FROM series s LEFT JOIN series n ON n.city = s.city AND n.metric_date = s.metric_date + 1""",
        "lab",
        "split",
    ),
)
def backtest_series(spark, sf):
    return FC.backtest_series(_series(spark, sf, STUMP_SPEC, STUMP), STUMP_SPEC)


@check("backtest_boosted")
def backtest_boosted(spark, sf):
    return FC.backtest_series(_series(spark, sf), SPEC)


USER_SPEC = FC.ForecastSpec(
    key="user_id", date="day", value="top", features=("top",), configs=SPEC.configs, fallback=SPEC.fallback, target="target"
)


@check(
    "short_history_fallback",
    f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS top FROM events GROUP BY 1, 2),
    l AS (SELECT *, lead(top) OVER (PARTITION BY user_id ORDER BY day) AS target FROM d),
    p AS (SELECT *, count(target) OVER (PARTITION BY user_id) AS n,
      row_number() OVER (PARTITION BY user_id ORDER BY target IS NULL, day DESC) AS pos FROM l),
    k AS (SELECT user_id, max(n) AS n, max_by(top, day) AS current_value,
      avg(abs(target - top)) FILTER (WHERE target IS NOT NULL AND pos <= 12) AS naive FROM p GROUP BY user_id)
    SELECT user_id, n AS n_labelled, CASE WHEN n >= 25 THEN 'evaluated' WHEN n >= 3 THEN 'fitted' ELSE 'carried' END AS mode,
    CASE WHEN n >= 25 THEN {r('naive', 2)} END AS naive_baseline_mae, CASE WHEN n < 3 THEN current_value END AS carried_value FROM k""",
)
def short_history_fallback(spark, sf):
    """Series per user: some are long enough to evaluate, most are not."""
    days = fx.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("top"))
    split = FC.split_frame(FC.feature_frame(days, USER_SPEC), USER_SPEC)
    return FC.short_history_fallback(split, USER_SPEC)


MEAN = "mean_7"
ERRORS = f""", e AS (SELECT city, count(*) AS total_samples, count(*) FILTER (WHERE split IN ('train', 'short')) AS train_samples,
      count(*) FILTER (WHERE split = 'val') AS val_samples, count(*) FILTER (WHERE split = 'test') AS test_samples,
      {r("avg(abs(target_next_day_aqi - rolling_7d_avg_aqi)) FILTER (WHERE split = 'val')", 2)} AS val_mae,
      {r("avg(abs(target_next_day_aqi - rolling_7d_avg_aqi)) FILTER (WHERE split IN ('train', 'val'))", 2)} AS train_val_mae,
      avg(abs(target_next_day_aqi - rolling_7d_avg_aqi)) FILTER (WHERE split = 'test') AS t,
      avg(abs(target_next_day_aqi - avg_us_aqi)) FILTER (WHERE split = 'test') AS b FROM split GROUP BY city),
    sc AS (SELECT *, {r('t', 2)} AS test_mae, {r('b', 2)} AS naive_baseline_mae, {improvement('b', 't')} AS delta_vs_baseline_pct,
      t < b AS beats_baseline FROM e)"""


def _mean_scores(spark, sf):
    """Score card of the 7-day mean as predictor, so every value has a SQL counterpart."""
    ensure_checkpoint_dir(spark)
    features = FC.feature_frame(fx.fact(spark, sf), SPEC, carry=["rolling_7d_avg_aqi"])
    split = FC.split_frame(features, SPEC).checkpoint()
    folds = F.explode(F.array(F.lit("val"), F.lit("eval"))).alias("fold")
    cells = split.select("city", "metric_date", folds, "split", F.col("rolling_7d_avg_aqi").alias("prediction"))
    predictions = cells.filter("split = 'val' OR (fold = 'eval' AND split IN ('train', 'test'))")
    return split, FC.score_card(FC.fit_eval_per_key(split, predictions, SPEC), MEAN, None)


@check(
    "score_card",
    with_ctes(
        f"""{ERRORS} SELECT city, total_samples, train_samples, val_samples, test_samples, val_mae, train_val_mae, test_mae,
        naive_baseline_mae, delta_vs_baseline_pct, beats_baseline, '{MEAN}' AS winning_config,
        CAST(NULL AS DOUBLE) AS aggregate_val_mae, CASE WHEN beats_baseline
          THEN 'Beats persistence baseline by ' || printf('%.1f', delta_vs_baseline_pct) || '%'
          ELSE 'Underperforms persistence baseline by ' || printf('%.1f', abs(delta_vs_baseline_pct))
            || '% (low atmospheric volatility / small sample)' END AS performance_summary,
        'Chronological 3-Way (' || train_samples || ' Train / ' || val_samples || ' Val / ' || test_samples || ' Test)' AS split_method
        FROM sc""",
        "split",
    ),
)
def score_card(spark, sf):
    return _mean_scores(spark, sf)[1]


@check(
    "locked_summary",
    with_ctes(
        f"""{ERRORS}, win AS (SELECT city, count(*) AS total_days, count(target_next_day_aqi) AS labeled_days,
          {s('min(metric_date)')} AS start_date, {s('max(metric_date)')} AS end_date FROM lab GROUP BY city),
        agg AS (SELECT avg(val_mae) AS v, avg(test_mae) AS t, avg(naive_baseline_mae) AS b,
          count(*) FILTER (WHERE beats_baseline) AS beat, count(*) AS n FROM sc)
        SELECT 'series' AS kind, city AS name, total_days, labeled_days, start_date, end_date, val_mae, test_mae,
          naive_baseline_mae AS base_mae, delta_vs_baseline_pct AS delta_pct, CAST(beats_baseline AS VARCHAR) AS beats_baseline, '{MEAN}' AS winning_config,
          CAST(NULL AS BIGINT) AS keys_beating_baseline, CAST(NULL AS BIGINT) AS total_keys
        FROM win JOIN sc USING (city)
        UNION ALL SELECT 'aggregate', 'all', NULL, NULL, NULL, NULL, {r('v', 2)}, {r('t', 2)}, {r('b', 2)}, {improvement('b', 't')},
          NULL, NULL, beat, n FROM agg""",
        "lab",
        "split",
    ),
)
def locked_summary(spark, sf):
    split, scores = _mean_scores(spark, sf)
    rows = forecasting.locked_summary(split, scores.checkpoint())

    def either(series, aggregate):
        return F.coalesce(F.col(f"metrics.{series}"), F.col(f"aggregate.{aggregate}")).alias(series)

    return rows.select(
        "kind", "name", "dataset.*",
        either("val_mae", "val_mae"), either("test_mae", "test_mae"), either("base_mae", "base_mae"),
        either("delta_pct", "overall_delta_pct"), F.col("metrics.beats_baseline").cast("string").alias("beats_baseline"), "winning_config",
        "aggregate.keys_beating_baseline", "aggregate.total_keys",
    )


ENCODED = f"""{DAYS_SQL}, enc AS (SELECT *, avg(y) OVER w AS key_mean, stddev_pop(y) OVER w AS key_spread FROM s0
      WINDOW w AS (PARTITION BY city ORDER BY metric_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@check(
    "key_encoding",
    with_ctes(
        f"""{ENCODED} SELECT city, {s('metric_date')} AS metric_date, {r('key_mean', 4)} AS key_mean, {r('key_spread', 4)} AS key_spread FROM enc""",
        "lab",
        "split",
    ),
)
def key_encoding(spark, sf):
    """A series by its earlier targets only."""
    found = FC.key_encoding(_split(spark, sf), SPEC)
    return found.select(
        "city", "metric_date", round_half_away("_key_mean", 4).alias("key_mean"), round_half_away("_key_spread", 4).alias("key_spread")
    )


@check(
    "pooled_forecast",
    with_ctes(
        f"""{ENCODED}, s1 AS (SELECT city, metric_date, split, y, [{FEATURE_SQL}, key_mean, key_spread] AS x FROM enc),
        longer AS (SELECT 'all' AS pool, 3 AS leaf, y, unnest(range(1, len(x) + 1)) AS f, unnest(x) AS v FROM s1 WHERE split IN ('train', 'val')),
        {tried_sql('pool')}
        SELECT city, {s('metric_date')} AS metric_date, split, y AS target_next_day_aqi,
        {r(f'least(500, greatest(0, {LEAF_SQL}))', 1)} AS predicted FROM s1 s, best b""",
        "lab",
        "split",
    ),
)
def pooled_forecast(spark, sf):
    """One split learned over all series."""
    return FC.pooled_stump(_split(spark, sf), SPEC)


@check("pooled_forecast_boosted")
def pooled_forecast_boosted(spark, sf):
    return FC.pooled_forecast(_split(spark, sf), SPEC)
