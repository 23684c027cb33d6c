"""A full evaluation ranks the scores once and gives what its parts give."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import metrics
from tarmac.plans import evaluation


def test_scores_are_ranked_once(spark, monkeypatch):
    scored = spark.range(400).select(
        F.concat(F.lit("m"), F.col("id") % 3).alias("model"), (F.pmod(F.xxhash64("id"), F.lit(40)) / 40).alias("score"),
        F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 3 == 2, 1).otherwise((F.col("id") % 5 < 2).cast("int"))).alias("label"),
        (F.col("id") % 4 == 0).cast("int").alias("predicted"))
    by, named = ["model"], {"prediction": "predicted", "by": ["model"]}
    wanted = {"comparison": metrics.compute_metrics(scored, **named), "confusion": metrics.confusion_matrix(scored, **named),
              "roc": metrics.roc_curve(scored, by=by), "pr": metrics.pr_curve(scored, by=by),
              "calibration": metrics.calibration(scored, by=by), "baseline": metrics.positive_rate(scored)}
    ranked, ranks = [], metrics.ranked_scores
    monkeypatch.setattr(metrics, "ranked_scores", lambda *x: ranked.append(1) or ranks(*x))
    found = evaluation.full_evaluation(scored)
    assert len(ranked) == 1 and found.keys() == wanted.keys()
    for name, df in found.items():
        rows, expected = (sorted(map(tuple, x.collect()), key=str) for x in (df, wanted[name]))
        assert len(rows) == len(expected)
        for a, b in zip(rows, expected):
            assert a == pytest.approx(b, abs=1e-12, nan_ok=True)
    none = evaluation.full_evaluation(scored.limit(0))
    assert [none[name].count() for name in ("comparison", "confusion", "roc", "pr")] == [0] * 4
