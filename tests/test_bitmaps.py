"""Distinct counts from merged bitmaps against counting values."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import bitmaps


def test_groups_and_their_union(full):
    names = ["DAY_OF_MONTH", "CRS_DEP_TIME_MIN", "CANCELLED", "ORIGIN", "ROUTE", "ARR_DELAY_CAT", "CANCELLATION_CODE"]
    stored = bitmaps.distinct_bitmaps(full, "YEAR", names)
    yearly = {(r.YEAR, r.column): r.n_distinct for r in bitmaps.distinct_counts(stored, ["YEAR"]).collect()}
    for row in full.groupBy("YEAR").agg(*[F.countDistinct(c).alias(c) for c in names]).collect():
        assert all(yearly.get((row.YEAR, c), 0) == row[c] for c in names)
    whole = full.agg(*[F.countDistinct(c).alias(c) for c in names]).first()
    assert {r.column: r.n_distinct for r in bitmaps.distinct_counts(stored).collect()} == {c: whole[c] for c in names if whole[c]}


def test_edges(spark):
    rows = [(1, -5, "a", 0.5), (1, -5, None, 0.5), (1, 2**40, "", 0.5), (2, None, "a", None), (None, 32_768, "b", 1.0), (2, 32_769, "é", None), (2, 0, "e", 2.0), (2, -32_768, "a", 2.0)]
    df = spark.createDataFrame(rows, "g int, n long, t string, d double").withColumn("bucket", F.lit(None).cast("string"))
    stored = bitmaps.distinct_bitmaps(df, "g")
    assert {(r.g, r.column): r.n_distinct for r in bitmaps.distinct_counts(stored, ["g"]).collect()} == {
        (1, "n"): 2, (1, "t"): 2, (2, "n"): 3, (2, "t"): 3, (None, "n"): 1, (None, "t"): 1}
    assert {r.column: r.n_distinct for r in bitmaps.distinct_counts(stored).collect()} == {"n": 6, "t": 5}
    assert bitmaps.distinct_bitmaps(df.limit(0), "g").count() == 0
    with pytest.raises(ValueError, match="d"):
        bitmaps.distinct_bitmaps(df, "g", ["n", "d"])
