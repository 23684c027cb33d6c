"""Merged co-moments against the engine's own correlation, and where naive sums fail."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import distributions, moments


def test_equal_to_the_engine(op):
    columns = [c for c in schema.CORRELATION_COLUMNS if c in op.columns]
    got = {(r.x, r.y): r.r for r in distributions.correlation_matrix(op, columns).collect()}
    assert len(got) == len(columns) ** 2
    one = op.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x}|{y}") for k, x in enumerate(columns) for y in columns[k + 1:]]).first()
    for pair, want in one.asDict().items():
        x, y = pair.split("|")
        assert got[x, y] == got[y, x] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_merging_in_any_parts(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) + [0, 1e9, -5]
    x[:, 2] += x[:, 0]
    x[rng.random(x.shape) < 0.3] = np.nan
    whole = moments.Moments.of(x)
    merged = moments.Moments(3)
    for part in np.array_split(x, [3, 3, 40, 41, 400]):
        if len(part):
            merged.add(moments.Moments.of(part))
    for name in ("n", "mean", "m2", "c"):
        assert getattr(merged, name) == pytest.approx(getattr(whole, name), rel=1e-9, abs=1e-6)
    frame = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double")
    for parts in (1, 7):
        for r in moments.pair_moments(frame.repartition(parts), ["a", "b", "c"]).collect():
            both = x[~np.isnan(x[:, r.i]) & ~np.isnan(x[:, r.j])]
            gaps = both - both.mean(axis=0)
            assert r.n == len(both) and r.c == pytest.approx((gaps[:, r.i] * gaps[:, r.j]).sum(), rel=1e-6)


def test_edges(spark):
    rows = [(1.0, None, 5.0, 2), (2.0, None, 5.0, 1), (3.0, 4.0, 5.0, None), (float("nan"), None, None, 7)]
    frame = spark.createDataFrame(rows, "a double, b double, flat double, d int").withColumn("i", F.lit("kept"))
    r = {(x.x, x.y): x.r for x in moments.correlations(frame, ["a", "b", "flat", "d"]).collect()}
    assert r["a", "a"] == 1.0 and r["flat", "flat"] is None and r["a", "flat"] is None and r["a", "b"] is None and r["b", "b"] is None
    assert r["a", "d"] == pytest.approx(-1.0) and len(r) == 10
    assert moments.correlations(frame.limit(0), ["a", "b"]).count() == 0
    first = distributions.target_correlations(frame, ["a", "flat"], "d").collect()
    assert [(x.feature, x.abs_corr) for x in first] == [("a", pytest.approx(1.0)), ("flat", None)]
