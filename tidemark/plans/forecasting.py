"""Forecast plan: features, config choice, evaluation, next-day forecast, backtest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.forecast import (
    ForecastSpec,
    backtest_series,
    feature_frame,
    fit_cells,
    fit_eval_per_key,
    forecast_next_day,
    grid_search_validation,
    pick_config,
    production_series,
    score_card,
    split_frame,
)
from tidemark.operators.rollup import aggregate_scores, dataset_window
from tidemark.plans import defaults as D
from tidemark.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ForecastResult:
    winner: str
    ranking: DataFrame
    scores: DataFrame
    forecasts: DataFrame
    backtest: DataFrame


def prepare(fact: DataFrame, spec: ForecastSpec = D.FORECAST) -> DataFrame:
    return split_frame(feature_frame(fact, spec), spec)


def run_forecast(fact: DataFrame, spec: ForecastSpec = D.FORECAST, run_ts: str | None = None) -> ForecastResult:
    """Choose one config over all series, then fit, score and forecast each of them.

    Features, ranking and predictions are checkpointed in the shared folder: each
    is used several times and a fit must not run twice, also after an executor is
    lost.
    """
    ensure_checkpoint_dir(fact.sparkSession)
    split = prepare(fact, spec).checkpoint()
    ranking = grid_search_validation(split, spec).checkpoint()
    winner = pick_config(ranking, spec)
    best = ranking.select("mean_val_mae").take(1)
    predictions = fit_cells(split, spec, ["val", "eval", "prod"], [winner]).checkpoint()
    scores = score_card(fit_eval_per_key(split, predictions, spec), winner, best[0][0] if best else None, spec, run_ts)
    series = production_series(split, predictions, spec)
    forecasts = with_scores(
        forecast_next_day(series, spec, D.AQI_CUTS, D.AQI_TOP, D.MODEL_VERSION), scores, spec, run_ts
    )
    return ForecastResult(winner, ranking, scores, forecasts, backtest_series(series, spec))


def with_scores(forecasts: DataFrame, scores: DataFrame, spec: ForecastSpec, run_ts: str | None = None) -> DataFrame:
    """Prediction rows as published."""
    stamp = F.current_timestamp() if run_ts is None else F.to_timestamp(F.lit(run_ts))
    joined = forecasts.join(scores, spec.key, "left")
    return joined.select(
        spec.key,
        "forecast_for_date",
        "reference_date",
        F.col("predicted_value").alias("predicted_aqi"),
        "predicted_category",
        F.col("reference_value").alias("reference_aqi"),
        "model_version",
        F.col("test_mae").alias("mae"),
        "naive_baseline_mae",
        "delta_vs_baseline_pct",
        "beats_baseline",
        stamp.alias("predicted_at"),
    )


def locked_summary(fact_features: DataFrame, scores: DataFrame, spec: ForecastSpec = D.FORECAST) -> DataFrame:
    """One row per series (its window and metrics), plus one ``aggregate`` row.

    Kept as rows instead of one nested document, so it stays distributed with
    many series; a reader that wants one document writes it out as JSON lines.
    """
    windows = dataset_window(fact_features, spec.key, spec.date, spec.target)
    per_key = windows.join(scores, spec.key, "left").select(
        F.lit("series").alias("kind"),
        F.col(spec.key).cast("string").alias("name"),
        F.struct("total_days", "labeled_days", "start_date", "end_date").alias("dataset"),
        F.struct(
            "val_mae",
            "test_mae",
            F.col("naive_baseline_mae").alias("base_mae"),
            F.col("delta_vs_baseline_pct").alias("delta_pct"),
            "beats_baseline",
        ).alias("metrics"),
        "winning_config",
        *[c for c in ("params",) if c in scores.columns],
    )
    overall = aggregate_scores(scores).select(
        F.lit("aggregate").alias("kind"),
        F.lit("all").alias("name"),
        F.struct(
            "val_mae", "test_mae", "base_mae", "overall_delta_pct", "keys_beating_baseline", "total_keys"
        ).alias("aggregate"),
    )
    return per_key.unionByName(overall, allowMissingColumns=True)
