"""Step-down adjusted p-values, and shuffles that are not rotations of each other."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import explain, inference


def test_step_down(spark):
    p = [0.01, 0.04, 0.03, 0.005, None, 0.03, 1.0]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(p)], "id int, p_value double")
    got = {r.id: r.p_adjusted for r in inference.step_down(rows).collect()}
    # six known values: 6 * .005, 5 * .01, 4 * .03 for both ties, 2 * .04 raised to what precedes it, 1
    assert got == {3: pytest.approx(0.03), 0: pytest.approx(0.05), 2: pytest.approx(0.12), 5: pytest.approx(0.12), 1: pytest.approx(0.12), 6: 1.0, 4: None}
    twice = rows.withColumn("test", F.explode(F.array(F.lit("a"), F.lit("b"))))
    assert {(r.id, r.p_adjusted) for r in inference.step_down(twice, by=["test"]).collect()} == set(got.items())
    assert inference.step_down(rows.limit(0)).count() == 0
    assert [r.p_adjusted for r in inference.step_down(rows.filter("p_value is null")).collect()] == [None]


def test_dunn_adjusted(op):
    rows = inference.step_down(inference.dunn(op)).collect()
    assert rows and all(r.p_value <= r.p_adjusted <= min(1, r.p_value * len(rows)) + 1e-12 for r in rows)


@pytest.mark.parametrize("n", [1, 2, 7, 30, 1001])
def test_shuffles_of_repeats_differ_by_more_than_an_offset(spark, n):
    rows = spark.range(n).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("repeat"))
    seen = {}
    for r in rows.select("i", "repeat", explain._shuffled(F.col("i"), n, 42, 3, 5, F.col("repeat")).alias("to")).collect():
        seen.setdefault(r["repeat"], {})[r.i] = r.to
    for to in seen.values():
        assert sorted(to.values()) == list(range(n))
    if n > 30:
        for a in range(5):
            for b in range(a):
                assert len({(seen[a][i] - seen[b][i]) % n for i in range(n)}) > 1
