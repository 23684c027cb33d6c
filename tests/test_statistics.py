"""Ranks, metrics and tests of significance against brute force."""

import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.functions.tails import chi2_tail, two_sided_normal
from tarmac.operators import distributions, encoding, inference, metrics, ordering, quality, ranks, summaries


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(7)
    return [(g, float(v)) for g, n in (("a", 400), ("b", 37), ("c", 1)) for v in (rng.randrange(60) for _ in range(n))]


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > q) + (p == q) / 2 for p, q in product(pos, neg)) / (len(pos) * len(neg))


def brute_ap(rows):
    total = sum(y for y, _ in rows)
    ap = last = 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp = sum(y for y, t in rows if t >= s)
        ap += (tp / total - last) * tp / sum(1 for _, t in rows if t >= s)
        last = tp / total
    return ap


def test_running_totals_cross_blocks(spark, numbers):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many blocks on purpose
    try:
        counts = spark.createDataFrame(numbers, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
        got = ranks.running_totals(counts, "v", ["n"], ["g"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for r in got:
        mine = [v for g, v in numbers if g == r.g]
        assert (r.before_n, r.total_n) == (sum(v < r.v for v in mine), len(mine))
    assert len(got) == len(set(numbers))


def test_quantiles_match_linear_interpolation(spark, numbers):
    df = spark.createDataFrame(numbers + [("a", None), ("d", None)], "g string, v double")
    got = {r.g: (r.q25, r.q50, r.q90) for r in ranks.quantiles(df, "v", [0.25, 0.5, 0.9], ["q25", "q50", "q90"], ["g"]).collect()}
    for g in "abc":
        mine = [v for h, v in numbers if h == g]
        assert got[g] == pytest.approx(tuple(np.quantile(mine, [0.25, 0.5, 0.9])))
    assert "d" not in got


def test_dense_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "x string")
    codes = ranks.dense_codes(df, "x")
    assert {r.x: r.code for r in codes.collect()} == {"a": 0, "b": 1, "c": 2}
    labelled = encoding.label_encode(df, "x", codes).collect()
    assert sorted((r.x or "", r.x_LABEL) for r in labelled) == [("", -1), ("a", 0), ("b", 1), ("b", 1), ("c", 2)]


def test_ranking_metrics_by_group(spark):
    rng = random.Random(3)
    rows = [(g, int(rng.random() < 0.3), round(rng.random(), d)) for g, d, n in ((2021, 1, 300), (2022, 6, 200)) for _ in range(n)]
    rows += [(2023, 0, 0.2), (2023, 0, 0.9)]
    df = spark.createDataFrame(rows, "YEAR int, label int, score double")
    got = {r.YEAR: r for r in metrics.drift(df).collect()}
    for year in (2021, 2022):
        mine = [(y, s) for g, y, s in rows if g == year]
        assert got[year].roc_auc == pytest.approx(brute_auc(mine))
        assert got[year].pr_auc == pytest.approx(brute_ap(mine))
        tp = sum(y for y, s in mine if s > 0.5)
        assert got[year].precision == pytest.approx(tp / sum(s > 0.5 for _, s in mine))
        assert got[year].accuracy == pytest.approx(sum((s > 0.5) == (y == 1) for y, s in mine) / len(mine))
    lone = got[2023]
    assert lone.roc_auc is None and lone.recall == 0 and lone.f1 == 0 and lone.n_samples == 2


def test_reversed_score_mirrors_auc(spark):
    rows = [(int(i % 3 == 0), (i * 37 % 101) / 101) for i in range(500)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(7)
    auc = metrics.compute_metrics(df).first().roc_auc
    mirrored = metrics.compute_metrics(df.withColumn("score", 1 - F.col("score"))).first().roc_auc
    assert auc + mirrored == pytest.approx(1)


def test_calibration_edges_and_confusion(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (1, 0.100001), (0, 1.0), (None, 0.5)], "label int, score double")
    assert [(r.bin, r.n) for r in metrics.calibration(df).collect()] == [(0, 2), (1, 1), (9, 1)]
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 2, (1, 1): 0}
    curve = metrics.roc_curve(df).orderBy("tpr", "fpr").collect()
    assert (curve[0].threshold, curve[0].fpr, curve[0].tpr) == (None, 0, 0) and (curve[-1].fpr, curve[-1].tpr) == (1, 1)


def test_chi_square_yates(spark):
    rows = [(2021, 0)] * 8 + [(2021, 1)] * 4 + [(2025, 0)] * 2 + [(2025, 1)] * 10 + [(2022, 1)] * 5
    df = spark.createDataFrame(rows, "YEAR int, ARR_DEL15 int")
    got = inference.chi_square(df).first()
    # |O - E| is 3 everywhere, E is 5 and 7: 2 * 2.5^2 * (1/5 + 1/7)
    chi2 = 2 * 2.5 ** 2 * (1 / 5 + 1 / 7)
    assert got.chi2 == pytest.approx(chi2) and got.dof == 1 and got.n == 24
    assert got.p_value == pytest.approx(math.erfc(math.sqrt(chi2 / 2)))
    assert got.cramers_v == pytest.approx(math.sqrt(chi2 / 24))
    empty_cell = spark.createDataFrame([(2021, 0)] * 5 + [(2025, 1)] * 5 + [(2025, 0)] * 5, "YEAR int, ARR_DEL15 int")
    expected = {(2021, 0): 10 / 3, (2021, 1): 5 / 3, (2025, 0): 20 / 3, (2025, 1): 10 / 3}
    seen = {(2021, 0): 5, (2021, 1): 0, (2025, 0): 5, (2025, 1): 5}
    want = sum((abs(seen[k] - e) - 0.5) ** 2 / e for k, e in expected.items())
    assert inference.chi_square(empty_cell).first().chi2 == pytest.approx(want)


@pytest.mark.parametrize("x, df, want", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05),
                                         (18.307038053275146, 10, 0.05), (28.869299430392623, 18, 0.05), (1.0, 4, 0.9097959895689501)])
def test_chi_square_tail(spark, x, df, want):
    assert spark.range(1).select(chi2_tail(F.lit(x), F.lit(df))).first()[0] == pytest.approx(want, rel=1e-9)


def test_tails_at_their_ends(spark):
    rows = [(0.0, 3), (-1.0, 4), (None, 2), (float("nan"), 2), (5.0, 0), (2000.0, 6), (1200.0, 1201), (1.0, 1), (4.0, 1), (9.0, 3)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double, k int").coalesce(1).select(chi2_tail(F.col("x"), F.col("k"))).collect()]
    assert got[:6] == [1.0, 1.0, None, None, None, 0.0] and 0.49 < got[6] < 0.51
    assert got[7:] == pytest.approx([math.erfc(math.sqrt(0.5)), math.erfc(math.sqrt(2)), math.erfc(math.sqrt(4.5)) + math.sqrt(18 / math.pi) * math.exp(-4.5)], rel=1e-12)
    z = [0.0, -0.3, 1.96, 2.9, -8.0, 30.0]
    got = spark.createDataFrame([(v,) for v in z], "z double").coalesce(1).select(two_sided_normal(F.col("z"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.erfc(abs(v) / math.sqrt(2)) for v in z], rel=1e-11)


def test_chi_square_counts_the_levels_it_finds(spark):
    rows = [(2021, 0)] * 3 + [(2021, 2)] * 2 + [(2025, 1)] * 2
    got = inference.chi_square(spark.createDataFrame(rows, "YEAR int, ARR_DEL15 int")).first()
    assert (got.n, got.dof) == (7, 2) and got.chi2 == pytest.approx(7) and got.p_value == pytest.approx(math.exp(-3.5))


def test_no_python_in_test_plans(spark, op):
    for df in (inference.chi_square(op), inference.kruskal_wallis(op), inference.dunn(op)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_one_scan(op):
    for df in (distributions.correlation_matrix(op), quality.quality_table(op)):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_sample_draws_single_copies(spark):
    df = spark.createDataFrame([(k % 3,) for k in range(900)], "v int")
    drawn = ordering.seeded_sample(df, 90).groupBy("v").count().collect()
    assert sum(r["count"] for r in drawn) == 90 and all(r["count"] > 10 for r in drawn)


def average_ranks(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def test_kruskal_wallis_and_dunn(spark, numbers):
    df = spark.createDataFrame(numbers, "g string, v double")
    values = [v for _, v in numbers]
    rank = average_ranks(values)
    n = len(values)
    between = sum(len(r) * (np.mean(r) - (n + 1) / 2) ** 2 for r in
                  ([x for x, (h, _) in zip(rank, numbers) if h == g] for g in "abc"))
    h = (n - 1) * between / sum((x - (n + 1) / 2) ** 2 for x in rank)
    got = inference.kruskal_wallis(df, "g", "v").first()
    assert (got.k, got.n) == (3, n) and got.h == pytest.approx(h)
    assert got.epsilon_squared == pytest.approx((h - 2) / (n - 3))
    assert got.p_value == pytest.approx(math.exp(-h / 2))  # two degrees of freedom
    pairs = {(r.level_a, r.level_b): r.z for r in inference.dunn(df, "g", "v").collect()}
    ties = sum(values.count(v) ** 3 - values.count(v) for v in set(values))
    mean = {g: np.mean([x for x, (k, _) in zip(rank, numbers) if k == g]) for g in "abc"}
    size = {g: sum(k == g for k, _ in numbers) for g in "abc"}
    for a, b in (("a", "b"), ("a", "c"), ("b", "c")):
        spread = (n * (n + 1) / 12 - ties / (12 * (n - 1))) * (1 / size[a] + 1 / size[b])
        assert pairs[a, b] == pytest.approx((mean[a] - mean[b]) / math.sqrt(spread))


def test_effect_sizes(spark, numbers):
    df = spark.createDataFrame(numbers, "g string, v double")
    a, b = ([v for g, v in numbers if g == x] for x in "ab")
    pooled = ((len(a) - 1) * np.var(a, ddof=1) + (len(b) - 1) * np.var(b, ddof=1)) / (len(a) + len(b) - 2)
    assert inference.cohens_d(df, "g", "a", "b", "v").first().cohens_d == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(pooled))
    values = np.array([v for _, v in numbers])
    between = sum(len(x) * (np.mean(x) - values.mean()) ** 2 for x in ([v for g, v in numbers if g == k] for k in "abc"))
    eta = inference.factor_effects(df, ["g"], "v").first().eta_squared
    assert eta == pytest.approx(between / ((values - values.mean()) ** 2).sum())


def test_correlation_ignores_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, None), (3.0, None, 1.0), (4.0, 8.0, 2.0), (5.0, 9.0, 2.5)], "a double, b double, c double")
    got = {(r.x, r.y): r.r for r in distributions.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "a"] == 1
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 4, 5], [2, 4.5, 8, 9])[0, 1])
    assert got["b", "c"] == pytest.approx(np.corrcoef([2, 8, 9], [5, 2, 2.5])[0, 1])


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    assert {r.bin: r.n for r in distributions.histogram(df, "v", -100, 100, 5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r.n) for r in distributions.histogram(same, "v", 0, 9, 4).collect()] == [(0, 2)]


def test_hexbin_counts_every_point_once(op):
    known = op.filter("TAXI_OUT IS NOT NULL AND ARR_DELAY IS NOT NULL").count()
    assert distributions.hexbin(op).agg(F.sum("n")).first()[0] == known


def test_ties_and_unknowns_in_top_k(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 9), ("d", None)], "k string, m int")
    assert [r.k for r in ordering.top_k(df, "m", 2, "k").collect()] == ["c", "a"]
    assert [r.k for r in ordering.top_k(df, "m", 4, "k", largest=False).collect()] == ["a", "b", "c", "d"]


def test_seeded_sample_does_not_depend_on_partitions(spark, op):
    df = op.select("YEAR", "ORIGIN", "DEST", "ARR_DELAY")
    first, second = (sorted(map(tuple, ordering.seeded_sample(x, 50).collect()), key=str) for x in (df, df.repartition(5)))
    assert first == second and len(first) == 50


def test_summaries_do_not_depend_on_partitions(op):
    for operator in (summaries.airport_pain_index, summaries.worst_busy_routes, summaries.carrier_ranking, distributions.yearly_distribution):
        mine, other = (sorted(map(str, operator(x).collect())) for x in (op, op.repartition(11)))
        assert [m[:40] for m in mine] == [o[:40] for o in other]


def test_describe_and_quality(spark, numbers):
    df = spark.createDataFrame(numbers + [("z", None)], "g string, v double")
    row = quality.describe(df).first()
    values = [v for _, v in numbers]
    assert (row["count"], row["min"], row["max"]) == (len(values), min(values), max(values))
    assert row["std"] == pytest.approx(np.std(values, ddof=1)) and row["q50"] == pytest.approx(np.median(values))
    table = {r.column: r for r in quality.quality_table(df).collect()}
    assert (table["g"].n_distinct, table["v"].n_distinct, table["v"].null_count) == (4, len(set(values)), 1)
    approximate = {r.column: r.n_distinct for r in quality.quality_table(df, approximate=True).collect()}
    assert approximate["g"] == 4


def test_quality_table_rounds_halves_to_even(spark):
    rows = spark.range(2000).select(F.when(F.col("id") >= 1, 1).alias("one"), F.when(F.col("id") >= 3, 1).alias("three"))
    table = {r.column: r.null_pct for r in quality.quality_table(rows).collect()}
    assert table == {"one": float(np.round(1 / 2000 * 100, 2)), "three": float(np.round(3 / 2000 * 100, 2))}


def test_recorded_invariants(full, op):
    total = quality.yearly_ingestion(full).filter("YEAR IS NULL").first()
    assert total.cancelled + total.diverted + total.rows_operated == total.rows_read == full.count()
    for r in quality.clock_statistics(full).collect():
        assert r.parsed + r.na == total.rows_read
    maps = encoding.Encodings.fit(encoding.train_rows(full))
    for r in maps.frequency.groupBy("source").agg(F.sum("freq").alias("s")).collect():
        assert r.s == pytest.approx(1)
