"""Figures from the cube against the same figures from the flights."""

import math

import pytest
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import cube
from tarmac.plans.overview import overview, overview_from

PAGES = [
    ([2022, 2025], ["C01", "C05", "C09"], {}),
    ([2021, 2022, 2023, 2024, 2025], [f"C{k:02d}" for k in range(14)], {"origins": ["A01", "A03", "N99"]}),
    ([2023], ["C02"], {"dests": ["A04", "A05"], "blocks": ["0001-0559", "0800-0859"]}),
    ([2024, 2025], ["C03", "C04"], {"origins": ["A01"], "dests": ["A02", "A03"]}),
    ([1999], ["C01"], {}),
]


@pytest.fixture(scope="module")
def stored(full):
    return cube.build(full)


def rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in sorted(df.columns))) for r in df.collect()),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


def same(one, other):
    assert set(one) == set(other)
    for figure, df in one.items():
        assert sorted(df.columns) == sorted(other[figure].columns), figure
        assert rows(df) == rows(other[figure]), figure


@pytest.mark.parametrize("years, carriers, also", PAGES)
def test_equal_to_the_scan(full, stored, years, carriers, also):
    same(overview(full, years, carriers, min_flights=5, **also), overview_from(stored, years, carriers, min_flights=5, **also))


def test_smallest_grouping(stored):
    assert stored.kept(stored.smallest(["YEAR"])) == ["YEAR", "OP_CARRIER"]
    assert stored.kept(stored.smallest(["YEAR", "DEP_TIME_BLK"])) == ["YEAR", "OP_CARRIER", "DEP_TIME_BLK"]
    assert stored.kept(stored.smallest(["ORIGIN", cube.DELAY])) == ["YEAR", "OP_CARRIER", "ORIGIN", cube.DELAY]
    assert stored.kept(stored.smallest(["DEP_TIME_BLK", cube.DELAY])) == list(cube.DIMENSIONS)
    with pytest.raises(ValueError, match="TAXI_OUT"):
        stored.cells(["TAXI_OUT"])
    for grouping, cells in stored.sizes.items():
        assert stored.table.filter(F.col("grouping_id") == grouping).agg(F.sum("flights")).first()[0] == stored.cells(cube.DIMENSIONS).agg(F.sum("flights")).first()[0]
        assert cells == stored.cells(cube.DIMENSIONS).groupBy(*stored.kept(grouping)).agg(F.lit(1)).count()


def test_reads_only_its_grouping(stored):
    plan = stored.cells(["YEAR"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grouping_id" in plan


def test_null_keys_are_not_totals(spark, full):
    null = F.lit(None).cast("string")
    odd = full.limit(200).withColumns({"ORIGIN": F.when(F.col("DAY_OF_MONTH") % 3 > 0, F.col("ORIGIN")), "DEST": null, "EXTRA": F.lit(1), "grouping_id": F.lit(7)})
    both = cube.build(odd)
    found = {r["ORIGIN"]: r["n"] for r in both.cells(["ORIGIN"]).groupBy("ORIGIN").agg(F.sum("flights").alias("n")).collect()}
    assert found == {r["ORIGIN"]: r["count"] for r in odd.groupBy("ORIGIN").count().collect()} and None in found
    assert [r[0] for r in both.cells(["DEST"]).select("DEST").distinct().collect()] == [None]
    without = cube.build(odd.drop("DEST"))
    assert "DEST" not in without.dimensions
    same(overview(odd.drop("DEST"), [2022, 2023], ["C01", "C02"], dests=["A01"], min_flights=1),
         overview_from(without, [2022, 2023], ["C01", "C02"], dests=["A01"], min_flights=1))


def test_merged_and_empty(full, stored):
    early, late = cube.build(full.filter("YEAR < 2023")), cube.build(full.filter("YEAR >= 2023 OR YEAR IS NULL"))
    both = cube.merged(early, late)
    assert both.sizes == stored.sizes
    assert rows(both.table) == rows(stored.table)
    none = cube.build(full.limit(0))
    assert set(none.sizes.values()) == {0}
    assert cube.merged(none, late).sizes == late.sizes
    figures = cube.key_figures(none, [2022], ["C01"]).first()
    assert figures["total_flights"] == 0 and figures["otp_pct"] is None
    with pytest.raises(ValueError, match="different groupings"):
        cube.merged(early, cube.build(full.limit(5), groupings=[("YEAR",)]))


def test_repeated_rows_count_again(full, stored):
    twice = cube.build(full.unionByName(full))
    one, two = (cube.key_figures(c, [2022, 2023], ["C01"]).first() for c in (stored, twice))
    assert two["total_flights"] == 2 * one["total_flights"]
    assert math.isclose(one["avg_delay"], two["avg_delay"]) and math.isclose(one["cancel_pct"], two["cancel_pct"])


def test_one_distinct_delay_is_in_the_last_bin(spark):
    flights = spark.createDataFrame(
        [(2022, "C01", "A01", "A02", "0600-0659", 0, 0, delay, 0) for delay in (-20.0, -20.0, None)],
        "YEAR int, OP_CARRIER string, ORIGIN string, DEST string, DEP_TIME_BLK string, CANCELLED int, DIVERTED int, ARR_DELAY double, ARR_DEL15 int"
    ).withColumns({c: F.lit(0.0) for c in schema.CAUSES})
    for page in (overview(flights, [2022], ["C01"]), overview_from(cube.build(flights), [2022], ["C01"])):
        assert page["delay_histogram"].collect() == [(99, -20.0, -20.0, 2)]
