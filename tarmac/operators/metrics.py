"""Classifier metrics, exact and per group, from one table of score counts.

Rows are reduced to one per (group, score). Threshold, ranking and curve metrics
all read that table, so a drift table over years costs the same as one score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ranks import running_totals

_OUTCOMES = ("pos", "neg", "tp", "fp")


def score_counts(scored: DataFrame, label: str = "label", score: str = "score",
                 prediction: str | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Positives, negatives and predicted positives per distinct score.

    Without a prediction column, a score above one half predicts the positive class.
    """
    called = F.col(score) > 0.5 if prediction is None else (
        F.col(prediction) == 1 if isinstance(prediction, str) else prediction)
    y = F.col(label)
    known = scored.filter(y.isNotNull() & F.col(score).isNotNull())
    return known.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
        F.count_if(called & (y == 1)).alias("tp"), F.count_if(called & (y == 0)).alias("fp"))


def _threshold_metrics(tp: Column, fp: Column, pos: Column, neg: Column) -> dict[str, Column]:
    """Rates that divide by zero are reported as 0."""
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return {
        "accuracy": ratio(tp + (neg - fp), pos + neg),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, pos),
        "f1": ratio(2 * tp, tp + fp + pos),
    }


def threshold_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    sums = counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _OUTCOMES])
    parts = _threshold_metrics(*[F.col(c) for c in ("tp", "fp", "pos", "neg")])
    return sums.select(*by, (F.col("pos") + F.col("neg")).alias("n_samples"),
                       *[c.alias(name) for name, c in parts.items()])


def ranked_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score counts with everything scored higher, best score first."""
    return running_totals(counts, "score", list(_OUTCOMES), by, descending=True)


def compute_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                    prediction: str | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, ROC-AUC and average precision per group.

    ROC-AUC counts tied pairs as half; both ranking metrics are NULL when a group
    lacks one of the classes.
    """
    return ranking_metrics(ranked_scores(score_counts(scored, label, score, prediction, by), by), by)


def ranking_metrics(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``compute_metrics`` of ``ranked_scores``."""
    by = list(by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    total_pos, total_neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    lower_neg = total_neg - F.col("before_neg") - neg
    tp, fp = F.col("before_pos") + F.col("pos"), F.col("before_neg") + F.col("neg")
    wins = F.try_divide(pos * (lower_neg + neg / 2), total_pos * total_neg)
    steps = F.try_divide(pos, total_pos) * F.try_divide(tp, tp + fp)
    sums = ranked.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in _OUTCOMES], F.sum(wins).alias("roc_auc"), F.sum(steps).alias("pr_auc"))
    parts = _threshold_metrics(*[F.col(c) for c in ("tp", "fp", "pos", "neg")])
    return sums.select(*by, (F.col("pos") + F.col("neg")).alias("n_samples"),
                       *[c.alias(name) for name, c in parts.items()], "roc_auc", "pr_auc")


def confusion_matrix(scored: DataFrame, label: str = "label", score: str = "score",
                     prediction: str | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The four (actual, predicted) cells per group, empty ones included."""
    return confusion_cells(score_counts(scored, label, score, prediction, by), by)


def confusion_cells(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``confusion_matrix`` of ``score_counts``."""
    sums = counts.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _OUTCOMES])
    cells = {(0, 0): F.col("neg") - F.col("fp"), (0, 1): F.col("fp"),
             (1, 0): F.col("pos") - F.col("tp"), (1, 1): F.col("tp")}
    return sums.select(*by, F.inline(F.array(*[
        F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), n.alias("n"))
        for (y, p), n in cells.items()])))


def _anchor(ranked: DataFrame, by: Sequence[str], x: str, y: str, value: float) -> DataFrame:
    """The curve's fixed end (0, value) once per group, or once if there are none."""
    groups = ranked.select(*by).distinct() if by else ranked.sparkSession.range(1)
    return groups.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias(x),
                         F.lit(value).alias(y))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score, after the start point (0, 0) with no threshold."""
    return roc_points(ranked_scores(score_counts(scored, label, score, by=by), by), by)


def roc_points(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``roc_curve`` of ``ranked_scores``."""
    points = ranked.select(
        *by, F.col("score").alias("threshold"),
        F.try_divide(F.col("before_neg") + F.col("neg"), F.col("total_neg")).alias("fpr"),
        F.try_divide(F.col("before_pos") + F.col("pos"), F.col("total_pos")).alias("tpr"))
    return _anchor(ranked, by, "fpr", "tpr", 0.0).unionByName(points)


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score, and the end point (recall 0, precision 1)."""
    return pr_points(ranked_scores(score_counts(scored, label, score, by=by), by), by)


def pr_points(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``pr_curve`` of ``ranked_scores``."""
    tp, fp = F.col("before_pos") + F.col("pos"), F.col("before_neg") + F.col("neg")
    points = ranked.select(*by, F.col("score").alias("threshold"),
                           F.try_divide(tp, F.col("total_pos")).alias("recall"),
                           F.try_divide(tp, tp + fp).alias("precision"))
    return points.unionByName(_anchor(ranked, by, "recall", "precision", 1.0))


def calibration(scored: DataFrame, label: str = "label", score: str = "score", bins: int = 10,
                by: Sequence[str] = ()) -> DataFrame:
    """Mean score and positive share per uniform bin of [0, 1]; empty bins absent.

    A score on an inner edge belongs to the lower bin.
    """
    p = F.col(score).cast("double")
    slot = F.greatest(F.ceil(p * bins) - 1, F.lit(0)).cast("int")
    known = scored.filter(F.col(label).isNotNull() & p.isNotNull())
    return known.groupBy(*by, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_score"),
        F.avg(label).alias("positive_share")).orderBy(*by, "bin")


def positive_rate(scored: DataFrame, label: str = "label") -> DataFrame:
    """Baseline of the precision-recall plot."""
    return scored.agg(F.avg(label).alias("positive_rate"), F.count(label).alias("n"))


def drift(scored: DataFrame, label: str = "label", score: str = "score",
          prediction: str | Column | None = None, by: str = "YEAR") -> DataFrame:
    """Metrics per year in one grouped computation; years without labels do not appear."""
    return compute_metrics(scored, label, score, prediction, [by]).orderBy(by)
