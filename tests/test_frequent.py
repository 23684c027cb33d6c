"""Busiest keys from a sketch and an exact recount: always those of the full count."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import frequent, ordering, summaries


@pytest.fixture(scope="module")
def facts(spark):
    """Forty hot keys of 30, 60, ... rows by pairs with equal counts, a hot one of a third, many keys of one row, and none."""
    n = F.col("id")
    hot = spark.range(40).select(F.concat(F.lit("h"), F.format_string("%02d", n)).alias("k"), ((F.floor(n / 2) + 1) * 150).cast("int").alias("c"))
    rows = hot.select("k", F.explode(F.sequence(F.lit(1), F.col("c")))).select("k")
    rest = spark.range(60_000).select(F.when(n % 2 == 0, "third").when(n % 7 > 0, F.concat(F.lit("s"), n.cast("string"))).alias("k"))
    return rows.unionByName(rest).repartition(7)


def _full(df, k):
    return [tuple(r) for r in ordering.top_k(frequent.counts(df, "k"), "n", k, "k").collect()]


@pytest.mark.parametrize("k", [1, 2, 3, 8, 9, 20, 41])
def test_equals_the_full_count_with_ties_at_the_boundary(facts, k):
    assert [tuple(r) for r in frequent.busiest_keys(facts, "k", k).orderBy(F.desc("n"), "k").collect()] == _full(facts, k)


def test_the_first_keys_need_no_full_count(facts):
    found = frequent.busiest_keys(facts, "k", 5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()  # counted rows, no plan over the facts
    assert [tuple(r) for r in found.orderBy(F.desc("n"), "k").collect()] == _full(facts, 5)
    fallen_back = frequent.busiest_keys(facts, "k", 300)
    assert "Exchange" in fallen_back._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("tracked", [512, 1024, 4096])
def test_small_sketches_fall_back(facts, tracked):
    for k in (3, 20, 60, 300):
        assert [tuple(r) for r in frequent.busiest_keys(facts, "k", k, tracked).orderBy(F.desc("n"), "k").collect()] == _full(facts, k)


def test_no_unnamed_key_exceeds_the_bound(facts):
    n = {r["k"]: r["n"] for r in frequent.counts(facts, "k").collect()}
    for k, tracked in ((2, 512), (10, 1024), (100, 4096), (100, frequent.TRACKED)):
        named, bound = frequent.candidates(facts, "k", k, tracked)
        assert len(named) <= max(4 * k, 256) and all(c <= bound for key, c in n.items() if key not in set(named))


def test_edges(facts):
    empty = facts.limit(0)
    assert frequent.busiest_keys(empty, "k", 3).count() == 0 and frequent.keep_busiest(empty, "k", 3).count() == 0
    assert frequent.busiest_keys(facts.filter("k is null"), "k", 3).count() == 0
    few = facts.filter("k in ('third', 'h01')")
    assert frequent.busiest_keys(few, "k", 3).count() == 2
    assert frequent.busiest_keys(facts, "k", 0).count() == 0
    ints = facts.sparkSession.range(5000).select((F.col("id") % 10).cast("int").alias("k"))
    assert [tuple(r) for r in frequent.busiest_keys(ints, "k", 4).orderBy("k").collect()] == [(j, 500) for j in range(4)]


def test_figures_of_the_busiest(op):
    for key in ("ORIGIN", "ROUTE"):
        want, got = summaries.busiest_otp(op, key, 20), summaries.frequent_otp(op, key, 20)
        assert [tuple(r) for r in want.collect()] == [tuple(r) for r in got.collect()]
    assert frequent.keep_busiest(op, "ORIGIN", 10).exceptAll(ordering.keep_busiest(op, "ORIGIN", 10).select(
        frequent.keep_busiest(op, "ORIGIN", 10).columns)).count() == 0
