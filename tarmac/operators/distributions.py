"""Correlations, histograms, quartiles and two-dimensional bins."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import delays
from tarmac.operators.moments import correlations
from tarmac.operators.ranks import quantiles


def correlation_matrix(df: DataFrame, columns: Sequence[str] = schema.CORRELATION_COLUMNS) -> DataFrame:
    """Pearson r of every ordered pair, each over rows where both are known, from one scan.

    A column agrees with itself unless it is constant or empty.
    """
    half = correlations(df, [c for c in columns if c in df.columns])
    ways = F.array_distinct(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return half.select(F.explode(ways).alias("_way"), "r").select("_way.x", "_way.y", "r")


def target_correlations(df: DataFrame, features: Sequence[str], target: str = schema.TARGET) -> DataFrame:
    """Absolute correlation of each feature with the target, strongest first; null for one without spread."""
    pairs = correlations(df, [*features, target]).filter((F.col("y") == target) & (F.col("x") != target))
    return pairs.select(F.col("x").alias("feature"), F.abs("r").alias("abs_corr")).orderBy(F.col("abs_corr").desc_nulls_last(), "feature")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, weight: str | None = None,
              lone_bin: int = 0) -> DataFrame:
    """Equal-width counts of clipped values over their observed range; empty bins absent.

    The last bin is closed. One aggregate finds the range; a second pruned scan counts bins, combined map-side.
    With ``weight`` a row stands for that many. One distinct value leaves the bins without width: all of it is in ``lone_bin``.
    """
    clipped = df.select(delays.clip(F.col(column), low, high).alias("v"),
                        (F.lit(1) if weight is None else F.col(weight)).alias("w")).filter(F.col("v").isNotNull())
    ends = clipped.agg(F.struct(F.min("v").alias("low"), ((F.max("v") - F.min("v")) / F.lit(bins)).alias("width"))).scalar()
    lowest, width = ends["low"], ends["width"]
    slot = F.when(width > 0, F.least(F.floor((F.col("v") - lowest) / width), F.lit(bins - 1))).otherwise(F.lit(lone_bin))
    placed = clipped.withColumn("bin", slot.cast("int")).groupBy("bin").agg(F.sum("w").alias("n"))
    return placed.select("bin", (lowest + F.col("bin") * width).alias("bin_low"),
                         (lowest + (F.col("bin") + 1) * width).alias("bin_high"), "n")


def yearly_distribution(df: DataFrame, column: str = "ARR_DELAY", low: float = -60, high: float = 200,
                        quantiles: Callable[..., DataFrame] = quantiles) -> DataFrame:
    """Count, extremes and quartiles of clipped values per year: exact, or from ``sketches.quantiles``."""
    clipped = df.select("YEAR", delays.clip(F.col(column), low, high).alias("v")).filter(F.col("v").isNotNull())
    ends = clipped.groupBy("YEAR").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lowest"),
                                       F.max("v").alias("highest"))
    quartiles = quantiles(clipped, "v", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], by=["YEAR"])
    return ends.join(quartiles, "YEAR").select("YEAR", "n", "lowest", "q25", "q50", "q75", "highest")


def hexbin(df: DataFrame, x: str = "TAXI_OUT", y: str = "ARR_DELAY",
           x_range: tuple[float, float] = (0, 60), y_range: tuple[float, float] = (-30, 120),
           grid: int = 30) -> DataFrame:
    """Counts on a hexagonal lattice: two offset rectangular lattices, nearer centre wins.

    The clip limits are the extent, so the lattice does not depend on the data.
    """
    columns, rows = grid, int(grid / math.sqrt(3))
    step_x, step_y = (x_range[1] - x_range[0]) / columns, (y_range[1] - y_range[0]) / rows
    u = (delays.clip(F.col(x), *x_range) - F.lit(float(x_range[0]))) / F.lit(step_x)
    v = (delays.clip(F.col(y), *y_range) - F.lit(float(y_range[0]))) / F.lit(step_y)
    points = df.select(u.alias("u"), v.alias("v")).filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    u, v = F.col("u"), F.col("v")
    whole_u, whole_v = F.floor(u + 0.5).cast("double"), F.floor(v + 0.5).cast("double")
    half_u, half_v = F.floor(u) + F.lit(0.5), F.floor(v) + F.lit(0.5)
    to_whole = F.pow(u - whole_u, 2) + 3 * F.pow(v - whole_v, 2)
    to_half = F.pow(u - half_u, 2) + 3 * F.pow(v - half_v, 2)
    nearer = to_whole < to_half
    return points.groupBy(
        F.when(nearer, whole_u).otherwise(half_u).alias("cell_u"),
        F.when(nearer, whole_v).otherwise(half_v).alias("cell_v"),
    ).agg(F.count(F.lit(1)).alias("n")).select(
        "cell_u", "cell_v",
        (F.lit(float(x_range[0])) + F.col("cell_u") * F.lit(step_x)).alias("center_x"),
        (F.lit(float(y_range[0])) + F.col("cell_v") * F.lit(step_y)).alias("center_y"), "n")
