"""Permuted scores against every pair counted, over several blocks and ranges."""

import math

import pytest
from pyspark.sql import functions as F

from tarmac.operators import explain, models, permuted


def _auc(scores, labels):
    pos, neg = ([s for s, y in zip(scores, labels) if y == k] for k in (1, 0))
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("n,levels,known", [(1, 3, True), (37, 5, True), (90, 1000, True), (90, 1, True), (40, 4, False)])
def test_equals_every_pair(spark, monkeypatch, n, levels, known):
    monkeypatch.setattr(permuted, "BLOCK", 16)  # seen by the functions that are sent, as they are made here
    rows = [(i, float(i * 7919 % 101 % levels), float(i * 31 % 17), (i * 13 % 5 < 2) * 1.0 if known or i % 3 else None) for i in range(n)]
    base = spark.createDataFrame(rows, "_i long, a double, b double, label double").repartition(3)
    terms = permuted.Terms([0.7, -0.2], [1.0, 2.0], [0.5, 0.25], -0.3)
    factors = [explain._factors(n, 42, k, 3) for k in range(2)]
    shifts = [[(5 + k * 3 + r) % n for r in range(3)] for k in range(2)]
    found = permuted.permuted_auc(base, n, ["a", "b"], terms, factors, shifts, [0.3, 0.4, 0.45]).collect()
    assert len(found) == 6
    for row in found:
        k, r = divmod(row["case"], 3)
        moved = [[x[1], x[2]] for x in rows]
        for i in range(n):
            moved[(i * factors[k][r] + shifts[k][r]) % n][k] = rows[i][1 + k]
        scores = []
        for a, b in moved:
            term = [0.7 * ((a - 1.0) * 0.5), -0.2 * ((b - 2.0) * 0.25)]
            scores.append(1 / (1 + math.exp(-(-0.3 + term[1 - k] + term[k]))))
        assert row["roc_auc"] == pytest.approx(_auc(scores, [x[3] for x in rows]), abs=1e-12)


def test_no_rows_and_plan_without_a_row_per_value(spark, monkeypatch):
    rows = spark.range(300).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                   (F.col("id") % 3 > 1).cast("double").alias("label"))
    model = models.train_one(rows, ["a", "b"], "logistic_regression")
    monkeypatch.setattr(explain, "_shuffled", None)  # the other models' way: a row for each value and repeat
    assert explain.permutation_importance(model, rows.limit(0), ["a", "b"], repeats=2).count() == 0
    assert explain.permutation_importance(model, rows, ["a", "b"], repeats=2).count() == 2
    one = explain.permutation_importance(model, rows.withColumn("label", F.lit(1.0)), ["a", "b"], repeats=2).collect()
    assert {r.importance_mean for r in one} == {None}
