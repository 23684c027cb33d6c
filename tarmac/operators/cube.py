"""Figures under a filter from stored sums instead of the flights.

Flights are reduced once to one row of sums and counts per combination of the filter columns; coarser
groupings are summed from those rows, never from the flights. A figure reads the smallest stored grouping that
holds its own keys and the columns of its filter. Sums add up, so the cubes of two periods merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import delays
from tarmac.operators import cleaning
from tarmac.session import materialise, shared_folder

# Arrival delay of flown flights, clipped to the ends of the page's histogram.
DELAY = "CLIPPED_DELAY"
DIMENSIONS = ("YEAR", "OP_CARRIER", "ORIGIN", "DEST", "DEP_TIME_BLK", DELAY)
# What the overview page asks for; the finest, all dimensions, is always stored.
GROUPINGS = (
    ("YEAR", "OP_CARRIER"),
    ("YEAR", "OP_CARRIER", "DEP_TIME_BLK"),
    ("YEAR", "OP_CARRIER", "ORIGIN", "DEP_TIME_BLK"),
    ("YEAR", "OP_CARRIER", "DEST", "DEP_TIME_BLK"),
    ("YEAR", "OP_CARRIER", "ORIGIN", "DEST", "DEP_TIME_BLK"),
    ("YEAR", "OP_CARRIER", DELAY),
    ("YEAR", "OP_CARRIER", "ORIGIN", DELAY),
    ("YEAR", "OP_CARRIER", "DEST", DELAY),
)
_COUNTS = ("flights", "flags", "cancelled", "flown", "known", "late", "timed")


@dataclass(frozen=True)
class Cube:
    """``table`` holds every grouping's cells under its ``grouping_id``, as the engine numbers them: a set bit is a
    dimension summed over, so a null key of a cell is told from a total. ``sizes`` has the cells of each grouping."""

    table: DataFrame
    dimensions: tuple[str, ...]
    sizes: dict[int, int]

    def kept(self, grouping: int) -> list[str]:
        """The dimensions that a grouping keeps."""
        last = len(self.dimensions) - 1
        return [d for i, d in enumerate(self.dimensions) if not grouping >> (last - i) & 1]

    def smallest(self, needed: Iterable[str]) -> int:
        """The grouping of fewest cells that keeps all ``needed`` dimensions."""
        needed = set(needed)
        fit = [g for g in self.sizes if needed <= set(self.kept(g))]
        if not fit:
            raise ValueError(f"no stored grouping keeps {sorted(needed)}")
        return min(fit, key=lambda g: (self.sizes[g], g))

    def cells(self, needed: Iterable[str]) -> DataFrame:
        grouping = self.smallest(needed)
        return self.table.filter(F.col("grouping_id") == grouping).select(
            *self.kept(grouping), *self.table.columns[len(self.dimensions) + 1:])

    def chosen(self, keys: Sequence[str], years: Sequence[int], carriers: Sequence[str], origins: Sequence[str] = (),
               dests: Sequence[str] = (), blocks: Sequence[str] = ()) -> DataFrame:
        """Cells under the page's filter, from the smallest grouping with ``keys`` and the filtered columns."""
        filters = {"ORIGIN": origins, "DEST": dests, "DEP_TIME_BLK": blocks}
        needed = {"YEAR", "OP_CARRIER", *keys, *[c for c, wanted in filters.items() if wanted and c in self.dimensions]}
        return cleaning.select_flights(self.cells(needed), years, carriers, *[f if c in needed else () for c, f in filters.items()])


def _grouping_id(dimensions: Sequence[str], kept: Iterable[str]) -> int:
    kept = set(kept)
    return sum(1 << (len(dimensions) - 1 - i) for i, d in enumerate(dimensions) if d not in kept)


def _stored(cells: DataFrame, dimensions: Sequence[str], groupings: Iterable[int]) -> Cube:
    spark = cells.sparkSession
    path = f"{shared_folder(spark)}/tarmac-tables/{uuid.uuid4().hex}"
    cells.write.partitionBy("grouping_id").parquet(path)
    columns = [c for c in cells.columns if c != "grouping_id"]
    table = spark.read.schema(cells.schema).parquet(path).select("grouping_id", *columns)
    # One row per grouping.
    found = {r["grouping_id"]: r["count"] for r in table.groupBy("grouping_id").count().collect()}
    return Cube(table, tuple(dimensions), {g: found.get(g, 0) for g in groupings})


def build(full: DataFrame, groupings: Sequence[Sequence[str]] = GROUPINGS, target: str = schema.TARGET,
          low: float = -60, high: float = 200) -> Cube:
    """The cube of cleaned flights, flown or not.

    Null keys are keys of their own. Flights with unknown flags count as flights and not as flown. A filter column
    that the table lacks is no dimension, and groupings lose it; other columns are ignored. An empty table gives a
    cube without cells. A key with most of the flights costs each task one row per combination it occurs in.
    """
    flown = delays.is_operated()

    def of_flown(c: str) -> Column:
        return F.when(flown, F.col(c).cast("double"))

    dimensions = [d for d in DIMENSIONS if d == DELAY or d in full.columns]
    causes = [c for c in schema.CAUSES if c in full.columns]
    sums = [F.sum(c).alias(c) for c in (*_COUNTS, "delay", *causes)]
    finest = materialise(full.withColumn(DELAY, F.when(flown, delays.clip(F.col("ARR_DELAY"), low, high))).groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("flights"), F.count("CANCELLED").alias("flags"),
        F.coalesce(F.sum(F.col("CANCELLED").cast("long")), F.lit(0)).alias("cancelled"), F.count_if(flown).alias("flown"),
        F.count(of_flown(target)).alias("known"), F.count_if(flown & (F.col(target) == 1)).alias("late"),
        F.count(of_flown("ARR_DELAY")).alias("timed"), F.coalesce(F.sum(of_flown("ARR_DELAY")), F.lit(0.0)).alias("delay"),
        *[F.coalesce(F.sum(of_flown(c)), F.lit(0.0)).alias(c) for c in causes]))
    ids = {_grouping_id(dimensions, g): [d for d in dimensions if d in g] for g in (*groupings, dimensions)}
    cells = finest.groupingSets([[F.col(d) for d in kept] for kept in ids.values()], *dimensions).agg(
        F.grouping_id().cast("int").alias("grouping_id"), *sums)
    return _stored(cells, dimensions, ids)


def merged(one: Cube, other: Cube) -> Cube:
    """The cube of both cubes' flights, without reading them; both need the same dimensions and groupings."""
    if one.dimensions != other.dimensions or set(one.sizes) != set(other.sizes):
        raise ValueError("cubes of different groupings")
    both = one.table.unionByName(other.table)
    measures = [c for c in both.columns if c not in ("grouping_id", *one.dimensions)]
    cells = both.groupBy("grouping_id", *one.dimensions).agg(*[F.sum(m).alias(m) for m in measures])
    return _stored(cells, one.dimensions, one.sizes)


def _rate(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part), F.col(whole))


def _otp(cells: DataFrame, *keys: str) -> DataFrame:
    """Keys with flown flights, their known outcomes and delay rate."""
    counted = cells.groupBy(*keys).agg(F.sum("flown").alias("_flown"), F.sum("known").alias("flights"), F.sum("late").alias("_late"))
    return counted.filter("_flown > 0").select(*keys, "flights", _rate("_late", "flights").alias("delay_rate"))


def key_figures(cube: Cube, *chosen, **also) -> DataFrame:
    sums = cube.chosen([], *chosen, **also).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*_COUNTS, "delay")])
    return sums.select(F.col("flights").alias("total_flights"), ((1 - _rate("late", "known")) * 100).alias("otp_pct"),
                       _rate("delay", "timed").alias("avg_delay"), (_rate("cancelled", "flags") * 100).alias("cancel_pct"))


def otp_by_year(cube: Cube, *chosen, **also) -> DataFrame:
    return _otp(cube.chosen(["YEAR"], *chosen, **also), "YEAR").select(
        "YEAR", "flights", "delay_rate", (F.col("delay_rate") * 100).alias("delay_pct"), (1 - F.col("delay_rate")).alias("otp")).orderBy("YEAR")


def carrier_otp(cube: Cube, min_flights: int, *chosen, **also) -> DataFrame:
    table = _otp(cube.chosen(["OP_CARRIER"], *chosen, **also), "OP_CARRIER").filter(F.col("flights") >= min_flights)
    return table.select("OP_CARRIER", "flights", "delay_rate", ((1 - F.col("delay_rate")) * 100).alias("otp_pct")).orderBy("otp_pct", "OP_CARRIER")


def cause_minutes(cube: Cube, *chosen, **also) -> DataFrame:
    cells = cube.chosen([], *chosen, **also)
    causes = [c for c in schema.CAUSES if c in cells.columns]
    return cells.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in causes]).unpivot([], causes, "cause", "minutes")


def otp_grid(cube: Cube, *chosen, **also) -> DataFrame:
    """On-time percentage by year and departure block; the columns are the blocks met under the filter."""
    cells = cube.chosen(["YEAR", "DEP_TIME_BLK"], *chosen, **also).filter(F.col("DEP_TIME_BLK").isNotNull())
    table = materialise(_otp(cells, "YEAR", "DEP_TIME_BLK").withColumn("otp_pct", (1 - F.col("delay_rate")) * 100))
    return table.groupBy("YEAR").pivot("DEP_TIME_BLK").agg(F.first("otp_pct")).orderBy("YEAR")


def delay_values(cube: Cube, *chosen, **also) -> DataFrame:
    """(ARR_DELAY, n): the clipped delays of flown flights under the filter and how often each occurs."""
    cells = cube.chosen([DELAY], *chosen, **also).filter(F.col(DELAY).isNotNull())
    return cells.groupBy(F.col(DELAY).alias("ARR_DELAY")).agg(F.sum("flights").alias("n"))
