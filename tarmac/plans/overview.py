"""The figures of the overview page for a filtered selection of flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators import cleaning, cube, distributions, quality, summaries


def choices(full: DataFrame) -> dict[str, DataFrame]:
    """Sorted values each filter can take."""
    return {c: quality.distinct_values(full, c)
            for c in ("YEAR", "OP_CARRIER", "ORIGIN", "DEST", "DEP_TIME_BLK") if c in full.columns}


def overview(full: DataFrame, years: Sequence[int], carriers: Sequence[str], origins: Sequence[str] = (),
             dests: Sequence[str] = (), blocks: Sequence[str] = (), min_flights: int = 500) -> dict[str, DataFrame]:
    chosen = cleaning.select_flights(full, years, carriers, origins, dests, blocks)
    op = cleaning.operated(chosen)
    return {
        "key_figures": summaries.key_figures(chosen),
        "otp_by_year": summaries.delay_by_year(op),
        "delay_histogram": distributions.histogram(op, "ARR_DELAY", -60, 200, 100, lone_bin=99),
        "carrier_otp": summaries.carrier_otp_table(op, min_flights),
        "cause_minutes": summaries.cause_minutes(op, by_year=False),
        "otp_grid": summaries.otp_grid(op, "YEAR", "DEP_TIME_BLK"),
    }


def overview_from(stored: cube.Cube, years: Sequence[int], carriers: Sequence[str], origins: Sequence[str] = (),
                  dests: Sequence[str] = (), blocks: Sequence[str] = (), min_flights: int = 500) -> dict[str, DataFrame]:
    """The figures of ``overview`` from a cube, without the flights."""
    chosen = (years, carriers, origins, dests, blocks)
    return {
        "key_figures": cube.key_figures(stored, *chosen),
        "otp_by_year": cube.otp_by_year(stored, *chosen),
        "delay_histogram": distributions.histogram(cube.delay_values(stored, *chosen), "ARR_DELAY", -60, 200, 100, weight="n", lone_bin=99),
        "carrier_otp": cube.carrier_otp(stored, min_flights, *chosen),
        "cause_minutes": cube.cause_minutes(stored, *chosen),
        "otp_grid": cube.otp_grid(stored, *chosen),
    }


def early_verdicts(flights: DataFrame) -> DataFrame:
    """Rule-of-thumb verdicts from the departure delay, one per track.

    No known delay means no verdict.
    """
    delay = F.col("DEP_DELAY")
    return flights.withColumns({
        "TRACK_A_VERDICT": F.when(delay <= 0, "on time").when(delay > 0, "may be late"),
        "TRACK_B_VERDICT": F.when(delay > 15, "very likely late").when(delay <= 15, "likely on time"),
    })


def planned_flights(requests: DataFrame, maps=None) -> DataFrame:
    """Feature rows for flights given by hour, minute, weekday and ends.

    ``requests`` has OP_CARRIER, ORIGIN, DEST, DEP_HOUR, DEP_MINUTE, DAY_OF_WEEK
    (Monday = 0), YEAR and DISTANCE; with maps the encoded columns are added.
    """
    from tarmac.functions import clock, dates
    from tarmac.operators import encoding

    minutes = (F.col("DEP_HOUR") * 60 + F.col("DEP_MINUTE")).cast("int")
    hour = F.lpad(F.col("DEP_HOUR").cast("string"), 2, "0")
    sine, cosine = clock.cyclic(F.col("CRS_DEP_TIME_MIN"))
    rows = cleaning.add_route(requests.withColumn("CRS_DEP_TIME_MIN", minutes)).withColumns({
        "IS_WEEKEND": dates.weekend_flag(F.col("DAY_OF_WEEK")),
        "CRS_DEP_SIN": sine, "CRS_DEP_COS": cosine,
        "DISTANCE_GROUP": (F.floor(F.col("DISTANCE") / 250) + 1).cast("smallint"),
        "DEP_TIME_BLK": F.when(F.col("DEP_HOUR") < 6, "0001-0559").otherwise(F.concat(hour, F.lit("00-"), hour, F.lit("59"))),
    })
    return rows if maps is None else encoding.encode(rows, maps)
