"""Next-day forecast per series, as Spark jobs.

A cell is one (key, config, fold): Spark replicates the daily rows over the configs
and folds asked for, shuffles and sorts them by cell and fits the cells of a batch together.
Only fitting and predicting happen in Python; every score is a Spark aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.labels import band
from tidemark.functions.numbers import clamp_round, improvement_pct, round_half_away
from tidemark.operators import boosting
from tidemark.operators.rollup import mean_absolute_error
from tidemark.operators.windows import chronological_split, labelled_rows, lead_target, next_day_lookup

cloudpickle.register_pickle_by_value(boosting)


@dataclass(frozen=True)
class TreeConfig:
    min_samples_leaf: int
    learning_rate: float
    max_depth: int | None
    max_iter: int


PARAMETERS = {"min_samples_leaf": "int", "learning_rate": "double", "max_depth": "int", "max_iter": "int"}


@dataclass(frozen=True)
class ForecastSpec:
    """Names and split sizes of one forecasting task."""

    key: str
    date: str
    value: str
    features: Sequence[str]
    configs: Mapping[str, TreeConfig]
    fallback: TreeConfig
    target: str = "target_next_day"
    test: int = 12
    val: int = 8
    min_train: int = 5
    low: float = 0.0
    high: float = 500.0


# Fold: rows it learns from, rows it scores. ``prod`` learns from every labelled row.
FOLDS = {
    "val": (("train",), ("val",)),
    "eval": (("train", "val"), ("train", "val", "test")),
    "prod": (("train", "val", "test", "short"), ("train", "val", "test", "short", "unlabelled")),
}


def feature_frame(gold: DataFrame, spec: ForecastSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Features known on day t and the next row's value as target; weekday has Monday = 0."""
    derived = {"day_of_week": F.weekday(F.col(spec.date)), "month": F.month(F.col(spec.date))}
    stored = [c for c in spec.features if c not in derived]
    columns = list(dict.fromkeys([spec.key, spec.date, *stored, spec.value, *carry]))
    return gold.select(*columns, lead_target(spec.key, spec.date, spec.value).alias(spec.target)).withColumns(derived)


def split_frame(features: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Split of every row, and whether its series is too short to evaluate."""
    return features.withColumns(
        {
            "split": chronological_split(spec.key, spec.date, spec.target, spec.test, spec.val, spec.min_train),
            "is_short": labelled_rows(spec.key, spec.target) < spec.test + spec.val + spec.min_train,
        }
    )


def persistence_baseline(split: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Error of predicting tomorrow = today on the test rows."""
    test = split.filter("split = 'test'")
    mae = mean_absolute_error(spec.target, spec.value)
    return test.groupBy(spec.key).agg(round_half_away(mae, 2).alias("naive_baseline_mae"))


def _fit_cells(spec: ForecastSpec):
    """The function over batches sorted by cell and date. It holds plain values only and ships its helper along, so
    executors need numpy and pyarrow but not this package."""
    features, target = list(spec.features), spec.target
    cell, out = [spec.key, "config", "fold"], [spec.key, "config", "fold", spec.date]
    configs = {name: astuple(c) for name, c in {**spec.configs, "fallback": spec.fallback}.items()}
    fit = boosting.boosted_cells

    def begins(rows):
        first = np.zeros(len(rows), bool)
        first[:1] = True
        for name in cell:
            code = pc.dictionary_encode(rows.column(name).combine_chunks(), null_encoding="encode")
            code = code if isinstance(code, pa.DictionaryArray) else code.combine_chunks()
            code = code.indices.to_numpy(zero_copy_only=False)
            first[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(first)

    def fitted(rows, begin):
        numbers = [rows.column(c).to_numpy() for c in (*features, target)]
        config = [configs[name] for name in rows.column("config").take(pa.array(begin)).to_pylist()]
        is_train = rows.column("is_train").to_numpy()
        prediction = fit(np.stack(numbers[:-1], axis=1), numbers[-1], is_train, begin, config)
        done = rows.select(out).append_column("prediction", pa.array(prediction, pa.float64(), from_pandas=True))
        return done.filter(rows.column("is_scored")).to_batches()

    def run(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            begin = begins(held)
            if len(begin) > 1:  # the last cell may go on in the next batch
                yield from fitted(held.slice(0, begin[-1]), begin[:-1])
                held = held.slice(begin[-1])
        if held is not None and len(held):
            yield from fitted(held, begins(held))

    return run


def _fit_group(spec: ForecastSpec):
    """One cell by itself, as a grouped function: what ``_fit_cells`` must equal."""
    features, target, key, date = list(spec.features), spec.target, spec.key, spec.date
    configs = {name: astuple(c) for name, c in {**spec.configs, "fallback": spec.fallback}.items()}
    predict = boosting.boosted_predictions

    def fit(rows):
        rows = rows.sort_values(date, kind="stable")
        min_samples_leaf, learning_rate, max_depth, max_iter = configs[rows["config"].iloc[0]]
        train = rows["is_train"].to_numpy(dtype=bool)
        out = rows[[key, "config", "fold", date]].copy()
        out["prediction"] = None
        if train.sum() >= 3:
            out["prediction"] = predict(
                rows[features].to_numpy(dtype=float),
                rows[target].to_numpy(dtype=float),
                train,
                learning_rate,
                min_samples_leaf,
                max_depth,
                max_iter,
            )
        return out[rows["is_scored"].to_numpy(dtype=bool)]

    return fit


def cells(split: DataFrame, spec: ForecastSpec, folds: Sequence[str], configs: Sequence[str]) -> DataFrame:
    """The rows of every (key, config, fold): (key, date, features, target, config, fold, is_train, is_scored).

    Series too short to split only have a ``prod`` fold and use the fallback configuration.
    """

    def pairs(names: Sequence[str]) -> Column:
        return F.array(*[F.struct(F.lit(c).alias("config"), F.lit(f).alias("fold")) for c in names for f in folds])

    own = F.when(F.col("is_short"), pairs(["fallback"])).otherwise(pairs(configs))
    is_train, is_scored = F.lit(False), F.lit(False)
    for name in folds:
        learn, score = FOLDS[name]
        here = F.col("_cell.fold") == name
        is_train = is_train | (here & F.col("split").isin(list(learn)))
        is_scored = is_scored | (here & F.col("split").isin(list(score)))
    numeric = [F.col(c).cast("double").alias(c) for c in (*spec.features, spec.target)]
    return (
        split.withColumn("_cell", F.explode(own))
        .select(
            spec.key, spec.date, *numeric, "_cell.config", "_cell.fold",
            is_train.alias("is_train"), is_scored.alias("is_scored"),
        )
        .filter("is_train OR is_scored")
    )


def fit_cells(split: DataFrame, spec: ForecastSpec, folds: Sequence[str], configs: Sequence[str]) -> DataFrame:
    """One prediction per (key, config, fold, date) scored.

    Fewer than three training rows give null predictions. Configurations of a single stump are searched by
    aggregates; cells of any other are fitted many at a time.
    """
    chosen = {name: spec.configs[name] for name in configs} | {"fallback": spec.fallback}
    if all((c.max_depth, c.max_iter) == (1, 1) for c in chosen.values()):
        return stump_predictions(cells(split, spec, folds, configs), spec, chosen)
    rows = cells(split, spec, folds, configs)
    schema = T.StructType(
        [split.schema[spec.key], T.StructField("config", T.StringType()), T.StructField("fold", T.StringType())]
        + [split.schema[spec.date], T.StructField("prediction", T.DoubleType())]
    )
    # A fit costs far more than its few rows suggest, so cells are spread out explicitly:
    # by their size alone AQE would merge them into one task.
    spark = split.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    cell = [spec.key, "config", "fold"]
    spread = rows.repartition(tasks, *cell).sortWithinPartitions(*cell, F.col(spec.date).asc_nulls_last())
    return spread.mapInArrow(_fit_cells(spec), schema)


def stump_search(train: DataFrame, cell: Sequence[str], features: Sequence[str], target: str, min_leaf: Column) -> DataFrame:
    """The best single split of each cell, by exact counts and sums: (cell, n, total, best).

    A cut lies half-way between two neighbouring values of a feature; rows with less or an equal value go left, rows
    without one to the side that is better. Of all cuts that leave ``min_leaf`` rows on both sides the one that
    lowers the squared error most is taken (compared to six digits, beyond which is summation noise); of equal ones
    missing values to the right, then the earlier feature, then the lower cut. ``best`` is null without any.

    Values are counted per (cell, feature, value) before they are sorted, so a window holds the distinct values of a
    feature in a cell.
    """
    value = F.array(*[F.col(c).cast("double") for c in features])
    counted = (
        train.select(*cell, F.col(target).alias("_y"), F.posexplode(value).alias("feature", "x"))
        .groupBy(*cell, "feature", "x")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"))
    )
    every = Window.partitionBy(*cell, "feature")
    upto = every.orderBy(F.col("x").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    stats = counted.select(
        *cell,
        "feature",
        "x",
        ((F.col("x") + F.lead("x").over(every.orderBy(F.col("x").asc_nulls_last()))) / 2).alias("cut"),
        F.sum("n").over(upto).alias("left_n"),
        F.sum("s").over(upto).alias("left_s"),
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("n"))).over(every), F.lit(0)).alias("missing_n"),
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("s"))).over(every), F.lit(0.0)).alias("missing_s"),
        F.sum("n").over(every).alias("n"),
        F.sum("s").over(every).alias("total"),
    ).filter("x IS NOT NULL AND cut IS NOT NULL")
    sides = F.when(F.col("missing_n") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = stats.withColumn("missing_left", F.explode(sides)).withColumns(
        {
            "left_n": F.col("left_n") + F.when(F.col("missing_left"), F.col("missing_n")).otherwise(0),
            "left_s": F.col("left_s") + F.when(F.col("missing_left"), F.col("missing_s")).otherwise(0.0),
        }
    )
    right_n, right_s = F.col("n") - F.col("left_n"), F.col("total") - F.col("left_s")
    gain = F.round(
        F.col("left_s") * F.col("left_s") / F.col("left_n") + right_s * right_s / right_n - F.col("total") * F.col("total") / F.col("n"), 6
    )
    allowed = both.filter((F.col("left_n") >= min_leaf) & (right_n >= min_leaf)).withColumn("gain", gain).filter("gain > 0")
    choice = F.struct(
        "feature", "cut", (F.col("missing_n") > 0).alias("knows_missing"), "missing_left",
        F.col("left_n"), right_n.alias("right_n"),
        (F.col("left_s") / F.col("left_n")).alias("left"), (right_s / right_n).alias("right"),
    )
    best = allowed.groupBy(*cell).agg(F.min_by(choice, F.struct(-F.col("gain"), F.col("missing_left"), F.col("feature"), F.col("cut"))).alias("best"))
    totals = train.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("total"))
    return totals.join(best, list(cell), "left")


def stump_predictions(rows: DataFrame, spec: ForecastSpec, configs: Mapping[str, TreeConfig]) -> DataFrame:
    """What ``fit_cells`` gives for one boosting round of depth one, by Spark aggregates alone."""
    cell = [spec.key, "config", "fold"]

    def of_config(part: str) -> Column:
        chain = F
        for name, config in configs.items():
            chain = chain.when(F.col("config") == name, F.lit(getattr(config, part)))
        return chain

    found = stump_search(rows.filter("is_train"), cell, spec.features, spec.target, of_config("min_samples_leaf"))
    value = F.element_at(F.array(*spec.features), F.col("best.feature") + 1)
    unseen = F.when(F.col("best.knows_missing"), F.col("best.missing_left")).otherwise(F.col("best.left_n") > F.col("best.right_n"))
    mean = F.col("total") / F.col("n")
    leaf = F.when(F.coalesce(value <= F.col("best.cut"), unseen), F.col("best.left")).otherwise(F.col("best.right"))
    prediction = mean + of_config("learning_rate") * (F.coalesce(leaf, mean) - mean)
    scored = rows.filter("is_scored").join(found, cell)
    return scored.select(*cell, spec.date, F.when(F.col("n") >= 3, prediction).alias("prediction"))


def grid_scores(split: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Validation error per (key, config). Test rows never reach a fit or a score."""
    usable = split.filter(F.col("split").isin("train", "val"))
    predictions = fit_cells(usable, spec, ["val"], list(spec.configs))
    actual = usable.filter("split = 'val'").select(spec.key, spec.date, spec.target)
    return (
        predictions.join(actual, [spec.key, spec.date])
        .groupBy(spec.key, "config")
        .agg(mean_absolute_error(spec.target, "prediction").alias("val_mae"))
    )


def grid_search_validation(split: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Configurations by mean validation error over keys, best first.

    Means are compared to nine digits: beyond that they hold summation noise,
    which must not decide between equal configurations.
    """
    scores = grid_scores(split, spec).groupBy("config")
    mean = scores.agg(F.round(F.avg("val_mae"), 9).alias("mean_val_mae"), F.count(F.lit(1)).alias("n_keys"))
    return mean.orderBy(F.col("mean_val_mae").asc_nulls_last(), "config")


def pick_config(ranking: DataFrame, spec: ForecastSpec) -> str:
    """Name of the winner: one row to the driver. Without any splittable series, the first config."""
    best = ranking.select("config").take(1)
    return best[0]["config"] if best else next(iter(spec.configs))


def fit_eval_per_key(split: DataFrame, predictions: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Validation, train+validation and single test error of the chosen config per key.

    ``predictions`` comes from ``fit_cells`` with the ``val`` and ``eval`` folds.
    Series too short to split have null errors.
    """
    keys = [spec.key, spec.date]
    labelled = split.filter(F.col("split") != "unlabelled").select(*keys, "split", spec.target, spec.value)
    scored = predictions.filter("fold IN ('val', 'eval')").select(*keys, "fold", "prediction")
    by_fold = (
        labelled.join(scored, keys, "left")
        .withColumn("error", F.abs(F.col(spec.target) - F.col("prediction")))
        .withColumn("naive", F.abs(F.col(spec.target) - F.col(spec.value)))
    )
    fold, part = F.col("fold"), F.col("split")
    days = F.count_distinct
    return by_fold.groupBy(spec.key).agg(
        days(spec.date).alias("total_samples"),
        days(F.when(part.isin("train", "short"), F.col(spec.date))).alias("train_samples"),
        days(F.when(part == "val", F.col(spec.date))).alias("val_samples"),
        days(F.when(part == "test", F.col(spec.date))).alias("test_samples"),
        round_half_away(F.avg(F.when(fold == "val", F.col("error"))), 2).alias("val_mae"),
        round_half_away(F.avg(F.when((fold == "eval") & (part != "test"), F.col("error"))), 2).alias("train_val_mae"),
        F.avg(F.when((fold == "eval") & (part == "test"), F.col("error"))).alias("_test"),
        F.avg(F.when((fold == "eval") & (part == "test"), F.col("naive"))).alias("_naive"),
    )


def score_card(
    evaluation: DataFrame,
    winning_config: str,
    aggregate_val_mae: float | None,
    spec: ForecastSpec | None = None,
    fitted_at: str | None = None,
) -> DataFrame:
    """Per-key scores with gain over persistence, a flag and a sentence.

    With ``spec`` the model is described too: its parameters, its features, how many rows it was refitted on and when.
    """
    delta = improvement_pct("_naive", "_test")
    beats = F.col("_test") < F.col("_naive")
    with_scores = evaluation.withColumns(
        {
            "test_mae": round_half_away("_test", 2),
            "naive_baseline_mae": round_half_away("_naive", 2),
            "delta_vs_baseline_pct": delta,
            "beats_baseline": beats,
            "winning_config": F.lit(winning_config),
            "aggregate_val_mae": F.lit(aggregate_val_mae).cast("double"),
        }
    ).drop("_test", "_naive")
    if spec is not None:
        config = spec.configs.get(winning_config, spec.fallback)
        params = [F.lit(value).cast(kind).alias(name) for (name, kind), value in zip(PARAMETERS.items(), astuple(config))]
        with_scores = with_scores.withColumns(
            {
                "params": F.struct(*params),
                "features": F.array(*[F.lit(c) for c in spec.features]),
                "train_val_samples": F.col("train_samples") + F.col("val_samples"),
                "fitted_at": F.lit(fitted_at).cast("timestamp_ntz"),
            }
        )
    return with_scores.withColumns(
        {
            "performance_summary": performance_summary("delta_vs_baseline_pct", "beats_baseline"),
            "split_method": F.format_string(
                "Chronological 3-Way (%d Train / %d Val / %d Test)", "train_samples", "val_samples", "test_samples"
            ),
        }
    )


def performance_summary(delta: str, beats: str) -> Column:
    # Fixed text.
    return (
        F.when(F.col(beats), F.format_string("Beats persistence baseline by %.1f%%", F.col(delta)))
        .when(
            ~F.col(beats),
            F.format_string(
                "Underperforms persistence baseline by %.1f%% (low atmospheric volatility / small sample)",
                F.abs(F.col(delta)),
            ),
        )
    )


def production_series(split: DataFrame, predictions: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Every row with the production prediction for the day after it, clamped and rounded.

    Without a model the current value is carried forward.
    """
    keys = [spec.key, spec.date]
    prod = predictions.filter("fold = 'prod'").select(*keys, "prediction")
    joined = split.select(*keys, spec.value).join(prod, keys, "left")
    value = F.coalesce(F.col("prediction"), F.col(spec.value))
    return joined.withColumn("predicted", clamp_round(value, spec.low, spec.high, 1)).drop("prediction")


def forecast_next_day(
    series: DataFrame, spec: ForecastSpec, cuts: Sequence[tuple[float, str]], top_label: str, model_version: str
) -> DataFrame:
    """One forecast per key from its newest row; the aggregate needs no sort of the series."""
    newest = series.groupBy(spec.key).agg(
        F.max_by(F.struct(spec.date, spec.value, "predicted"), F.col(spec.date)).alias("_newest")
    )
    return newest.select(
        spec.key,
        F.date_add(F.col("_newest")[spec.date], 1).alias("forecast_for_date"),
        F.col("_newest")[spec.date].alias("reference_date"),
        F.col("_newest")["predicted"].alias("predicted_value"),
        band(F.col("_newest")["predicted"], cuts, top_label).alias("predicted_category"),
        F.col("_newest")[spec.value].alias("reference_value"),
        F.lit(model_version).alias("model_version"),
    )


def backtest_series(series: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Prediction made on each day for the next calendar day, beside what that day brought."""
    return series.select(
        spec.key,
        F.date_add(F.col(spec.date), 1).alias("date"),
        "predicted",
        next_day_lookup(spec.key, spec.date, spec.value).alias("actual"),
    )


def short_history_fallback(
    split: DataFrame, spec: ForecastSpec, minimum: int = 3
) -> DataFrame:
    """How each series can be served: ``evaluated``, ``fitted`` (no scores) or ``carried``.

    A series that is not evaluated has null metrics; nothing is made up for it.
    """
    labelled = F.col("split") != "unlabelled"
    per_key = split.groupBy(spec.key).agg(
        F.count_if(labelled).alias("n_labelled"),
        F.max_by(F.col(spec.value), F.col(spec.date)).alias("current_value"),
        mean_absolute_error(
            F.when(F.col("split") == "test", F.col(spec.target)), F.when(F.col("split") == "test", F.col(spec.value))
        ).alias("_naive"),
    )
    enough = F.col("n_labelled") >= spec.test + spec.val + spec.min_train
    return per_key.select(
        spec.key,
        "n_labelled",
        F.when(enough, "evaluated").when(F.col("n_labelled") >= minimum, "fitted").otherwise("carried").alias("mode"),
        F.when(enough, round_half_away("_naive", 2)).alias("naive_baseline_mae"),
        F.when(F.col("n_labelled") < minimum, F.col("current_value")).alias("carried_value"),
    )


KEY_FEATURES = ("_key_mean", "_key_spread")


def key_encoding(split: DataFrame, spec: ForecastSpec) -> DataFrame:
    """A series as numbers: mean and spread of its own targets on the days before each row.

    A row's own label, and later ones, never enter its features; the first row of a series has none.
    """
    earlier = Window.partitionBy(spec.key).orderBy(F.col(spec.date).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return split.withColumns(
        {"_key_mean": F.avg(spec.target).over(earlier), "_key_spread": F.stddev_pop(spec.target).over(earlier)}
    )


def pooled_stump(split: DataFrame, spec: ForecastSpec, min_leaf: int = 3) -> DataFrame:
    """One split learned over all series, by aggregates alone; every row is scored."""
    known = key_encoding(split, spec).withColumns({"_all": F.lit("all"), "is_train": F.col("split").isin("train", "val"), "is_scored": F.lit(True)})
    rows = known.withColumns({"config": F.lit("stump"), "fold": F.lit("pooled")})
    features = [*spec.features, *KEY_FEATURES]
    found = stump_search(rows.filter("is_train"), ["_all"], features, spec.target, F.lit(min_leaf))
    value = F.element_at(F.array(*[F.col(c).cast("double") for c in features]), F.col("best.feature") + 1)
    unseen = F.when(F.col("best.knows_missing"), F.col("best.missing_left")).otherwise(F.col("best.left_n") > F.col("best.right_n"))
    leaf = F.when(F.coalesce(value <= F.col("best.cut"), unseen), F.col("best.left")).otherwise(F.col("best.right"))
    scored = rows.join(found, "_all").withColumn("prediction", F.coalesce(leaf, F.col("total") / F.col("n")))
    return scored.select(
        spec.key, spec.date, "split", spec.target, clamp_round("prediction", spec.low, spec.high, 1).alias("predicted")
    )


def pooled_forecast(
    split: DataFrame, spec: ForecastSpec, max_depth: int = 3, step: float = 0.05, min_leaf: int = 3,
    max_iter: int = 100, seed: int = 42,
) -> DataFrame:
    """The same target learned once over all series with Spark's own distributed trees.

    Fits on train+val rows and scores every row. Vectors cannot hold missing
    values, so a missing feature is filled with -1 and flagged. A series enters
    by its ``key_encoding``, so there may be any number of keys and none is gathered.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    known = key_encoding(split, spec)
    features = [*spec.features, *KEY_FEATURES]
    flags = {f"{c}_missing": F.col(c).isNull().cast("double") for c in features}
    filled = known.withColumns(flags).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features}
    )
    assemble = VectorAssembler(inputCols=[*features, *flags], outputCol="_features")
    trees = GBTRegressor(
        featuresCol="_features", labelCol=spec.target, predictionCol="prediction",
        maxDepth=max_depth, stepSize=step, minInstancesPerNode=min_leaf, maxIter=max_iter, seed=seed,
        checkpointInterval=10,
    )
    train = filled.filter(F.col("split").isin("train", "val"))
    model = Pipeline(stages=[assemble, trees]).fit(train)
    scored = model.transform(filled)
    return scored.select(
        spec.key, spec.date, "split", spec.target, clamp_round("prediction", spec.low, spec.high, 1).alias("predicted")
    )
