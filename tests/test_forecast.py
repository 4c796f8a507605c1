"""Properties of the forecast: no leakage, repeatable, better than the mean, gaps and short series."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forecast as FC
from tidemark.operators.boosting import boosted_cells, boosted_predictions
from tidemark.plans import defaults as D
from tidemark.plans.forecasting import run_forecast

SPEC = FC.ForecastSpec(
    key="k", date="d", value="v", features=("v", "lag1", "day_of_week"),
    configs={"deep": FC.TreeConfig(3, 0.1, None, 40), "flat": FC.TreeConfig(3, 0.1, 1, 40)},
    fallback=FC.TreeConfig(20, 0.1, None, 20),
)
START = dt.date(2026, 1, 5)


def series(spark, lengths, change_after=None):
    """Weekly pattern plus a level per key; optionally other values from one position on."""
    rows = []
    for key, n in lengths.items():
        values = [50.0 + 10 * ((i % 7) - 3) + len(key) for i in range(n)]
        if change_after is not None:
            values = [v if i <= change_after else 400.0 - i for i, v in enumerate(values)]
        rows += [(key, START + dt.timedelta(days=i), v, values[i - 1] if i else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, d date, v double, lag1 double")


def prepared(spark, lengths, **kw):
    return FC.split_frame(FC.feature_frame(series(spark, lengths, **kw), SPEC), SPEC)


def test_split_sizes(spark):
    counts = prepared(spark, {"long": 60, "edge": 26, "short": 25}).groupBy("k", "split").count().collect()
    got = {(r.k, r.split): r["count"] for r in counts}
    assert got == {
        ("long", "train"): 39, ("long", "val"): 8, ("long", "test"): 12, ("long", "unlabelled"): 1,
        ("edge", "train"): 5, ("edge", "val"): 8, ("edge", "test"): 12, ("edge", "unlabelled"): 1,
        ("short", "short"): 24, ("short", "unlabelled"): 1,
    }


def test_split_is_in_time_order(spark):
    bounds = prepared(spark, {"long": 60}).groupBy("split").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    at = {r.split: r for r in bounds.collect()}
    assert at["train"].b < at["val"].a and at["val"].b < at["test"].a and at["test"].b < at["unlabelled"].a


def test_test_rows_cannot_move_the_choice(spark):
    """Targets of train and val rows end before the changed values begin."""
    plain = FC.grid_search_validation(prepared(spark, {"a": 60, "bb": 60}), SPEC).collect()
    changed = FC.grid_search_validation(prepared(spark, {"a": 60, "bb": 60}, change_after=47), SPEC).collect()
    assert plain == changed and plain[0].n_keys == 2


def test_fit_is_repeatable_and_learns_the_week(spark):
    split = prepared(spark, {"a": 60, "bb": 60})
    first = sorted(map(str, FC.fit_cells(split, SPEC, ["val", "eval", "prod"], ["deep"]).collect()))
    again = sorted(map(str, FC.fit_cells(split.repartition(7), SPEC, ["val", "eval", "prod"], ["deep"]).collect()))
    assert first == again
    predictions = FC.fit_cells(split, SPEC, ["val", "eval"], ["deep"])
    scores = FC.score_card(FC.fit_eval_per_key(split, predictions, SPEC), "deep", 1.0).collect()
    assert all(s.beats_baseline and s.test_mae < s.naive_baseline_mae / 2 for s in scores)
    assert {(s.train_samples, s.val_samples, s.test_samples, s.total_samples) for s in scores} == {(39, 8, 12, 59)}
    assert scores[0].performance_summary.startswith("Beats persistence baseline by ")
    assert scores[0].split_method == "Chronological 3-Way (39 Train / 8 Val / 12 Test)"


def test_short_series_have_no_scores(spark):
    split = prepared(spark, {"long": 60, "short": 10, "tiny": 3, "one": 1})
    predictions = FC.fit_cells(split, SPEC, ["val", "eval", "prod"], ["deep"]).cache()
    assert {r[0] for r in predictions.filter("k != 'long'").select("config").distinct().collect()} == {"fallback"}
    scores = {s.k: s for s in FC.score_card(FC.fit_eval_per_key(split, predictions, SPEC), "deep", None).collect()}
    assert scores["long"].test_mae is not None
    assert scores["short"].test_mae is None and scores["short"].beats_baseline is None
    assert scores["short"].performance_summary is None
    modes = {r.k: (r.mode, r.carried_value) for r in FC.short_history_fallback(split, SPEC).collect()}
    assert modes["long"][0] == "evaluated" and modes["short"] == ("fitted", None)
    assert modes["tiny"][0] == "carried" and modes["one"][0] == "carried"
    series_ = FC.production_series(split, predictions, SPEC)
    ahead = {r.k: r for r in FC.forecast_next_day(series_, SPEC, D.AQI_CUTS, D.AQI_TOP, "v").collect()}
    assert set(ahead) == {"long", "short", "tiny", "one"}
    assert ahead["tiny"].predicted_value == ahead["tiny"].reference_value
    assert ahead["one"].forecast_for_date == START + dt.timedelta(days=1)


def test_backtest_uses_the_calendar(spark):
    rows = series(spark, {"a": 40}).filter(F.col("d") != START + dt.timedelta(days=20))
    split = FC.split_frame(FC.feature_frame(rows, SPEC), SPEC)
    s = FC.production_series(split, FC.fit_cells(split, SPEC, ["prod"], ["flat"]), SPEC)
    back = {r.date: r for r in FC.backtest_series(s, SPEC).collect()}
    assert len(back) == 39
    assert back[START + dt.timedelta(days=20)].actual is None
    assert back[START + dt.timedelta(days=21 + 1)].actual is not None
    assert all(0 <= r.predicted <= 500 for r in back.values())


def test_one_stump_is_the_best_split():
    """Against brute force over all cuts."""
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(40, 3)), rng.normal(size=40)
    got = boosted_predictions(x, y, np.ones(40, bool), 1.0, 4, 1, 1)
    best = None
    for j in range(3):
        for cut in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= cut
            if 4 <= left.sum() <= 36:
                fitted = np.where(left, y[left].mean(), y[~left].mean())
                loss = ((y - fitted) ** 2).sum()
                if best is None or loss < best[0]:
                    best = (loss, fitted)
    assert np.allclose(got, best[1])


def test_missing_values_get_their_own_side():
    x = np.array([[np.nan]] * 10 + [[float(i)] for i in range(10)])
    y = np.array([100.0] * 10 + [0.0] * 10)
    got = boosted_predictions(x, y, np.ones(20, bool), 1.0, 3, 1, 1)
    assert np.allclose(got, y)


def test_leaves_and_depth_are_limited():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(400, 2)), rng.normal(size=400)
    free = boosted_predictions(x, y, np.ones(400, bool), 1.0, 2, None, 1)
    assert len(np.unique(free.round(9))) == 31
    assert len(np.unique(boosted_predictions(x, y, np.ones(400, bool), 1.0, 2, 2, 1).round(9))) <= 4
    many = boosted_predictions(x, y, np.ones(400, bool), 0.1, 2, None, 60)
    assert np.abs(y - many).mean() < np.abs(y - y.mean()).mean() / 2


def test_rows_to_score_do_not_change_the_fit():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(60, 2)), rng.normal(size=60)
    train = np.arange(60) < 40
    alone = boosted_predictions(x[:40], y[:40], np.ones(40, bool), 0.1, 3, 3, 20)
    beside = boosted_predictions(x, np.where(train, y, np.nan), train, 0.1, 3, 3, 20)
    assert np.allclose(alone, beside[:40]) and np.isfinite(beside).all()


def test_cells_fitted_together_are_those_fitted_alone():
    rng = np.random.default_rng(7)
    kinds = [(3, 0.05, 3, 30), (2, 0.05, None, 30), (20, 0.1, None, 30), (1, 1.0, 2, 3)]
    cells = []
    for i, n in enumerate([1, 2, 3, 9, 26, 26, 27, 40, 90, 300, 26, 14]):
        x, y, train = rng.normal(size=(n, 4)).round(1), rng.normal(size=n).round(1), rng.random(n) < 0.8
        x[rng.random(x.shape) < 0.1 * (i % 3)] = np.nan
        y = np.where(train, 2.0 if i == 4 else y, np.nan)
        if i == 10:
            x[3, 1] = np.inf
        cells += [(x, y, train, kind) for kind in kinds]
    begin = np.cumsum([0] + [len(c[1]) for c in cells[:-1]])
    x, y, train = (np.concatenate([c[i] for c in cells]) for i in range(3))
    together = boosted_cells(x, y, train, begin, [c[3] for c in cells])
    for at, (x, y, train, (leaf, rate, depth, rounds)) in zip(begin, cells):
        alone = boosted_predictions(x, y, train, rate, leaf, depth, rounds) if train.sum() >= 3 else np.full(len(y), np.nan)
        assert np.array_equal(together[at : at + len(y)], alone, equal_nan=True)


def test_cells_go_on_from_batch_to_batch(spark):
    split = FC.split_frame(FC.feature_frame(series(spark, {"a": 40, "b": 30, "ccc": 4}), SPEC), SPEC).checkpoint()

    def fitted(size):
        with_size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            return sorted(map(tuple, FC.fit_cells(split, SPEC, ["val", "eval", "prod"], ["deep", "flat"]).collect()))
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_size)

    found = fitted("7")
    assert found == fitted("10000") and len({row[:4] for row in found}) == len(found)
    plan = FC.fit_cells(split, SPEC, ["val"], ["deep"])._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan  # no call of Python per cell


def test_whole_forecast_plan(spark):
    from checks import fixtures as fx

    fact = fx.fact(spark, "/root/testdata/sf0.001")
    result = run_forecast(fact, run_ts="2024-02-01 00:00:00")
    assert result.winner in D.FORECAST.configs
    assert result.ranking.count() == 6
    ahead = result.forecasts.collect()
    assert len(ahead) == 5 and all(0 <= r.predicted_aqi <= 500 for r in ahead)
    assert {str(r.forecast_for_date) for r in ahead} == {"2024-01-31"}
    assert all(r.mae is not None and r.naive_baseline_mae is not None for r in ahead)
    assert result.backtest.count() == fact.count()


@pytest.mark.parametrize("missing", [True, False])
def test_pooled_model_scores_every_row(spark, missing):
    split = prepared(spark, {"a": 40, "bb": 40})
    if missing:
        split = split.withColumn("lag1", F.when(F.col("day_of_week") != 2, F.col("lag1")))
    scored = FC.pooled_forecast(split, SPEC, max_iter=5)
    assert scored.count() == 80
    assert scored.filter("predicted IS NULL OR predicted < 0 OR predicted > 500").isEmpty()


def test_pooled_model_takes_any_number_of_keys(spark):
    split = prepared(spark, {f"k{i}": 32 for i in range(200)})
    scored = FC.pooled_forecast(split, SPEC, max_iter=2)
    assert scored.count() == 6400 and scored.filter("predicted IS NULL").isEmpty()


def stump_series(spark, n_keys=3, days=40, seed=5):
    """Series with gaps in their features, so that every way of treating missing values comes up."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n_keys):
        for d in range(days):
            x = [float(v) if rng.random() > 0.2 or c == 0 else None for c, v in enumerate(np.round(rng.normal(size=3) * 10, 1))]
            split = "train" if d < days - 20 else "val" if d < days - 12 else "test" if d < days - 1 else "unlabelled"
            y = None if split == "unlabelled" else float(np.round(20 + 3 * (x[1] is None) + (5 if (x[2] or 0) > 2 else 0) + rng.normal(), 1))
            rows.append((f"k{k}", d, *x, y, split, False))
    frame = spark.createDataFrame(rows, "city string, day int, a double, b double, c double, y double, split string, is_short boolean")
    return frame.withColumn("metric_date", F.date_add(F.lit("2026-01-01").cast("date"), F.col("day"))).drop("day")


def stump_spec(**configs):
    return FC.ForecastSpec(
        key="city", date="metric_date", value="a", features=("a", "b", "c"), configs=configs, fallback=FC.TreeConfig(3, 1.0, 1, 1), target="y"
    )


def test_stumps_by_aggregates_equal_the_grouped_learner(spark):
    spec = stump_spec(one=FC.TreeConfig(3, 1.0, 1, 1), half=FC.TreeConfig(6, 0.5, 1, 1), wide=FC.TreeConfig(15, 1.0, 1, 1))
    split = stump_series(spark)
    fast = FC.fit_cells(split, spec, ["val", "eval", "prod"], list(spec.configs))
    rows = FC.cells(split, spec, ["val", "eval", "prod"], list(spec.configs))
    schema = "city string, config string, fold string, metric_date date, prediction double"
    slow = rows.groupBy("city", "config", "fold").applyInPandas(FC._fit_group(spec), schema)
    key = ["city", "config", "fold", "metric_date"]
    got, want = ({tuple(r[:4]): r.prediction for r in df.select(*key, "prediction").collect()} for df in (fast, slow))
    assert len(got) == 3 * 3 * (8 + 39 + 40) and got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def test_a_cell_that_cannot_be_split_predicts_its_mean(spark):
    spec = stump_spec(one=FC.TreeConfig(30, 1.0, 1, 1))
    split = stump_series(spark, n_keys=1)
    got = {r.prediction for r in FC.fit_cells(split, spec, ["val"], ["one"]).collect()}
    mean = split.filter("split = 'train'").agg(F.avg("y")).first()[0]
    assert len(got) == 1 and got.pop() == pytest.approx(mean)
    few = split.filter("split <> 'train' OR metric_date < '2026-01-03'")
    assert {r.prediction for r in FC.fit_cells(few, spec, ["val"], ["one"]).collect()} == {None}


def test_a_label_cannot_move_the_features_of_its_own_or_earlier_rows(spark):
    spec = stump_spec()
    split = stump_series(spark, n_keys=2)
    at = "2026-01-21"
    moved = split.withColumn("y", F.when((F.col("metric_date") == at) & (F.col("city") == "k0"), F.col("y") + 1000).otherwise(F.col("y")))
    before, after = ({(r.city, str(r.metric_date)): (r._key_mean, r._key_spread) for r in FC.key_encoding(df, spec).collect()} for df in (split, moved))
    changed = {k for k in before if before[k] != after[k]}
    assert changed and all(city == "k0" and day > at for city, day in changed)
    assert before["k0", "2026-01-01"] == (None, None)


def test_score_cards_describe_the_model(spark):
    spec = stump_spec(one=FC.TreeConfig(3, 1.0, 1, 1))
    split = stump_series(spark)
    evaluation = FC.fit_eval_per_key(split, FC.fit_cells(split, spec, ["val", "eval"], ["one"]), spec)
    row = FC.score_card(evaluation, "one", 1.0, spec, "2026-03-01 00:00:00").first()
    assert row.params.asDict() == {"min_samples_leaf": 3, "learning_rate": 1.0, "max_depth": 1, "max_iter": 1}
    assert row.features == ["a", "b", "c"] and row.train_val_samples == 28 and str(row.fitted_at) == "2026-03-01 00:00:00"
