"""Exact distinct counts that merge: bitmaps of whole numbers and of the codes of text values.

A stored table of bitmaps per group answers for each group and for any union of groups
without another scan of the facts. Values are reduced to distinct ones in each
task first, so a value holding most rows costs one row there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.ranks import running_totals
from tarmac.session import materialise

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _spread(df: DataFrame, columns: Sequence[str], by: str, kind: str) -> DataFrame:
    """(by, column, value) of known cells, each once."""
    cells = df.select(by, *[F.col(c).cast(kind).alias(f"_{k}") for k, c in enumerate(columns)])
    named = F.lit(list(columns))
    long = cells.select(by, F.posexplode(F.array(*[f"_{k}" for k in range(len(columns))])).alias("_at", "value"))
    return long.filter(F.col("value").isNotNull()).select(by, F.element_at(named, F.col("_at") + 1).alias("column"), "value").distinct()


def distinct_bitmaps(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(by, column, bucket, bits), a stored table: the values of every whole-number and text column in each group.

    Text values are numbered in their order, per column over all groups, so their bitmaps merge too.
    Columns of other kinds are refused if named and left out if not; null cells are in no bitmap; a null
    group is a group. An empty table gives an empty result.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    fits = [c for c in (columns or kinds) if c != by and isinstance(kinds[c], (*_WHOLE, T.StringType))]
    if columns and len(fits) < len([c for c in columns if c != by]):
        raise ValueError(f"neither whole numbers nor text: {sorted(set(columns) - set(fits) - {by})}")
    whole, text = ([c for c in fits if isinstance(kinds[c], T.StringType) == is_text] for is_text in (False, True))
    parts = []
    if whole:
        parts.append(_spread(df, whole, by, "long").withColumnRenamed("value", "number"))
    if text:
        pairs = materialise(_spread(df, text, by, "string"))
        codes = running_totals(pairs.select("column", "value").distinct().withColumn("n", F.lit(1)), "value", ["n"], by=["column"])
        parts.append(pairs.join(codes.select("column", "value", F.col("before_n").cast("long").alias("number")), ["column", "value"]).select(by, "column", "number"))
    if not parts:
        raise ValueError("no column of whole numbers or text")
    long = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return materialise(long.groupBy(by, "column", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_distinct) from stored bitmaps: per group with ``by``, over all groups without."""
    merged = bitmaps.groupBy(*by, "column", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "column").agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))
