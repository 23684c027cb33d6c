"""Quantiles from merged sketches: rank error against the data, and against the exact operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac.operators import distributions, features, quality, ranks, sketches

CHANCES, NAMES = [0.01, 0.25, 0.5, 0.75, 0.99], ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize("size", [128, 2048])
def test_rank_error_within_the_bound(spark, size):
    values = np.random.default_rng(11).lognormal(2, 2, 400_000)
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(len(values)) % 4, "v": values}))
    stored = sketches.value_sketches(df, "v", ["g"], size)
    for by in (["g"], []):
        found = sketches.sketched_quantiles(stored, CHANCES, NAMES, by)
        for row in sketches.rank_errors(df, "v", found, CHANCES, NAMES, by).collect():
            # The bound holds with 99 % confidence for one rank; twice the bound all but surely for all of them.
            assert max(row[q] for q in NAMES) <= 2 * sketches.rank_bound(size)
    largest = stored.agg(F.max(F.length("sketch"))).first()[0]
    assert largest < 64 * size


def test_exact_while_few(spark):
    df = spark.createDataFrame([(1, float(v)) for v in range(1, 102)] + [(2, 5.0)] * 50 + [(3, None), (None, 1.0), (2, float("nan")), (2, float("inf"))], "g int, v double")
    got = {r.g: (r.q, r.w) for r in sketches.quantiles(df, "v", [0.5, 1.0], ["q", "w"], ["g"]).collect()}
    assert got == {1: (51.0, 101.0), 2: (5.0, 5.0), None: (1.0, 1.0)}
    exact = {r.g: r.q for r in ranks.quantiles(df.filter("g = 1"), "v", [0.5], ["q"], ["g"]).collect()}
    assert exact[1] == got[1][0]
    assert sketches.quantiles(df.limit(0), "v", [0.5], ["q"]).count() == 0
    assert sketches.quantiles(df.limit(0), "v", [0.5], ["q"], ["g"]).count() == 0


def test_years_merge_into_any_union(spark, op):
    stored = sketches.value_sketches(op, "ARR_DELAY", ["YEAR"])
    some = sketches.sketched_quantiles(stored.filter("YEAR IN (2022, 2024)"), [0.25, 0.5, 0.75], ["a", "b", "c"])
    errors = sketches.rank_errors(op.filter("YEAR IN (2022, 2024)"), "ARR_DELAY", some, [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert errors["n"] == op.filter("YEAR IN (2022, 2024) AND ARR_DELAY IS NOT NULL").count()
    assert max(errors["a"], errors["b"], errors["c"]) <= sketches.rank_bound()


def test_operators_take_either(op):
    exact = {r.YEAR: r for r in distributions.yearly_distribution(op).collect()}
    for row in distributions.yearly_distribution(op, quantiles=sketches.quantiles).collect():
        assert (row.n, row.lowest, row.highest) == (exact[row.YEAR].n, exact[row.YEAR].lowest, exact[row.YEAR].highest)
        assert abs(row.q50 - exact[row.YEAR].q50) <= 2
    filled = features.fill_by_year(op.select("YEAR", "DEP_DELAY"), ["DEP_DELAY"], quantiles=sketches.quantiles)
    assert filled.filter("DEP_DELAY IS NULL").count() == 0


def test_describe(op):
    columns = ["ARR_DELAY", "TAXI_OUT", "CARRIER_DELAY"]
    exact = {r.column: r.asDict() for r in quality.describe(op, columns).collect()}
    found = {r.column: r.asDict() for r in sketches.describe(op, columns).collect()}
    assert list(found) and set(found) == set(exact)
    for c in columns:
        for key in ("count", "mean", "std", "min", "max"):
            assert found[c][key] == pytest.approx(exact[c][key], abs=1e-9)
        assert all(abs(found[c][q] - exact[c][q]) <= 3 for q in ("q25", "q50", "q75"))
