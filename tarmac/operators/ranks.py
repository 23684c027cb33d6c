"""Running counts over a global order, without ever sorting in one task.

A window with no partition key would pull every row into a single task. Here rows
are first reduced to one per distinct value, range-partitioned into ordered blocks
and written once; block totals give each block its offset, and running sums are
taken inside blocks. Nothing depends on how many rows share a value or a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import materialise

_BLOCK = "_block"


def running_totals(counts: DataFrame, value: str, measures: Sequence[str],
                   by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add ``before_<m>``, the sum of ``m`` over rows ordered before this one, and
    ``total_<m>``, its sum over the group.

    ``counts`` must hold one row per (by, value), e.g. the output of a groupBy.
    """
    by = list(by)
    order = F.col(value).desc() if descending else F.col(value).asc()
    blocks = materialise(
        counts.repartitionByRange(*by, order).withColumn(_BLOCK, F.spark_partition_id())
    )
    totals = blocks.groupBy(_BLOCK, *by).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    # One row per block and group: as many as there are partitions, not rows.
    offsets = totals.select(
        F.col(_BLOCK).alias("_b"), *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_offset_{m}") for m in measures],
        *[F.sum(m).over(everything).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy(_BLOCK, *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.withColumns({
        f"before_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures
    })
    same = [F.col(_BLOCK) == F.col("_b"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    joined = local.join(offsets, reduce(lambda a, b: a & b, same))
    return joined.withColumns({
        f"before_{m}": F.col(f"before_{m}") + F.col(f"_offset_{m}") for m in measures
    }).select(*counts.columns, *[f"{part}_{m}" for part in ("before", "total") for m in measures])


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float],
              names: Sequence[str], by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, from value counts.

    One row per group with one column per probability; NULL values do not count.
    """
    by = list(by)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("n"))
    ranked = running_totals(counts, value, ["n"], by)
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col(value).cast("double")))

    picks = []
    for p, name in zip(probabilities, names):
        place = (F.col("total_n") - 1) * F.lit(float(p))
        low = F.floor(place)
        picks += [at(low).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}"),
                  F.max(place - low).alias(f"_part_{name}")]
    found = ranked.groupBy(*by).agg(*picks)
    return found.select(*by, *[
        (F.col(f"_lo_{x}") + (F.col(f"_hi_{x}") - F.col(f"_lo_{x}")) * F.col(f"_part_{x}")).alias(x)
        for x in names
    ])


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with codes 0, 1, 2 ... in value order, as a stored table."""
    distinct = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("n"))
    return materialise(running_totals(distinct, column, ["n"]).select(
        column, F.col("before_n").cast("int").alias("code")))
