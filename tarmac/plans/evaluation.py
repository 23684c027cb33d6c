"""Training and evaluating all models of a track, and comparing tracks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import features, metrics, models
from tarmac.session import materialise


def scored_by_model(trained: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Every model's scores in one long table, so all metrics are one grouped pass."""
    kept = [c for c in test.columns if c == "label" or c.startswith("key_")]
    parts = [models.score(m, test).select(F.lit(name).alias("model"), *kept, "score", "predicted")
             for name, m in trained.items()]
    return materialise(reduce(DataFrame.unionByName, parts))


def full_evaluation(scored: DataFrame) -> dict[str, DataFrame]:
    """Comparison, confusion, curves and calibration, keyed by model; scores are counted and ranked once for the first four."""
    by = ["model"]
    ranked = materialise(metrics.ranked_scores(metrics.score_counts(scored, prediction="predicted", by=by), by))
    return {
        "comparison": metrics.ranking_metrics(ranked, by).orderBy(F.col("roc_auc").desc_nulls_last(), "model"),
        "confusion": metrics.confusion_cells(ranked, by),
        "roc": metrics.roc_points(ranked, by),
        "pr": metrics.pr_points(ranked, by),
        "calibration": metrics.calibration(scored, by=by),
        "baseline": metrics.positive_rate(scored),
    }


def best_model(comparison: DataFrame, measure: str = "roc_auc") -> DataFrame:
    return comparison.agg(F.max_by("model", measure).alias("model"), F.max(measure).alias(measure))


def compare_tracks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Metrics of both tracks side by side and what track B gains."""
    measures = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    left = a.select("model", *[F.col(m).alias(f"{m}_a") for m in measures])
    right = b.select("model", *[F.col(m).alias(f"{m}_b") for m in measures])
    return left.join(right, "model").select(
        "model", *[c for m in measures for c in (f"{m}_a", f"{m}_b")],
        *[(F.col(f"{m}_b") - F.col(f"{m}_a")).alias(f"{m}_gain") for m in measures])


def evaluate_tracks(scored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``full_evaluation`` of each track's scores, united with the track named, and both tracks side by side."""
    parts = {track: full_evaluation(rows) for track, rows in scored.items()}
    names = next(iter(parts.values()))
    out = {name: reduce(DataFrame.unionByName, [p[name].withColumn("track", F.lit(t)) for t, p in parts.items()]) for name in names}
    if {"A", "B"} <= set(parts):
        out["tracks"] = compare_tracks(parts["A"]["comparison"], parts["B"]["comparison"])
    return out


def model_drift(model: PipelineModel, rows: DataFrame, wanted: Sequence[str], target: str = schema.TARGET) -> DataFrame:
    """A fitted model's metrics by year over ``rows``, whose gaps get the median of their own year. Give a stored table."""
    others = [c for c in wanted if c != "YEAR"]
    dated = rows.filter(F.col("YEAR").isNotNull()).select("YEAR", target, *others)
    gaps = models.columns_with_gaps([dated], others)  # medians of the other columns would fill nothing
    filled = features.fill_by_year(dated, gaps) if gaps else dated
    ready = models.feature_rows(filled, wanted, dict.fromkeys(wanted, 0.0), target, keep=["YEAR"])
    scored = materialise(models.score(model, ready).select(F.col("key_YEAR").alias("YEAR"), F.col("label").cast("int").alias("label"), "score", "predicted"))
    return metrics.drift(scored, prediction="predicted")


def train_and_score(train: DataFrame, test: DataFrame, track: str, settings: Mapping[str, Mapping] | None = None,
                    target: str = schema.TARGET, names=None, fit_rows: int | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the track's models on ``train`` and score ``test``; gaps get training medians.

    Both are read several times: give stored tables. ``fit_rows`` bounds the rows learnt from.
    """
    wanted = list(schema.TRACKS[track])
    medians = models.fill_values(train, wanted, [train, test])
    fitted = materialise(models.feature_rows(train, wanted, medians, target, keep=["YEAR"]))
    recipes = {n: r for n, r in models.RECIPES.items() if names is None or n in names}
    trained = models.train_all(fitted, wanted, settings, recipes, fit_rows)
    rows = materialise(models.feature_rows(test, wanted, medians, target, keep=["YEAR"]))
    return trained, scored_by_model(trained, rows)
