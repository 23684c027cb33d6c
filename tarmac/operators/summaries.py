"""On-time, cancellation and delay-cause summaries.

Each function takes the cleaned (or operated) table and needs one scan: rows are
reduced to one per key first, and rankings work on the reduced table. Where that
table has several readers it is stored, since column pruning would otherwise make
the readers differ and scan the data again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import clock, delays
from tarmac.operators.frequent import busiest_keys
from tarmac.operators.ordering import top_k
from tarmac.operators.ranks import quantiles
from tarmac.session import materialise


def _late(target: str = schema.TARGET) -> Column:
    return F.col(target)


def overall_otp(op: DataFrame) -> DataFrame:
    counted = op.agg(F.count_if(_late() == 0).alias("on_time"), F.count_if(_late() == 1).alias("delayed"))
    total = F.col("on_time") + F.col("delayed")
    return counted.select("on_time", "delayed", total.alias("total"),
                          delays.percent(F.col("on_time"), total).alias("otp_pct"))


def otp_by(op: DataFrame, *keys: str) -> DataFrame:
    """Flights with a known outcome, delay rate and on-time rate per key."""
    return (op.groupBy(*keys)
            .agg(F.count(_late()).alias("flights"), F.avg(_late()).alias("delay_rate"))
            .withColumn("otp", 1 - F.col("delay_rate")))


def delay_by_year(op: DataFrame) -> DataFrame:
    return otp_by(op, "YEAR").select("YEAR", "flights", "delay_rate",
                                     (F.col("delay_rate") * 100).alias("delay_pct"), "otp").orderBy("YEAR")


def carrier_ranking(op: DataFrame, edge: int = 5) -> DataFrame:
    """Carriers by on-time rate, tagged bottom / top / middle, with the median rate.

    Tags come from two k-row heaps over the carrier table, joined back; a carrier
    in both is a bottom one.
    """
    table = materialise(otp_by(op.filter(F.col("OP_CARRIER").isNotNull()), "OP_CARRIER")
                        .withColumn("otp_pct", F.col("otp") * 100).drop("otp"))
    bottom = table.orderBy(F.col("otp_pct").asc_nulls_last(), "OP_CARRIER").limit(edge)
    top = table.orderBy(F.col("otp_pct").desc_nulls_last(), F.col("OP_CARRIER").desc()).limit(edge)
    tags = (top.select("OP_CARRIER", F.lit(1).alias("is_top"), F.lit(0).alias("is_bottom"))
            .unionByName(bottom.select("OP_CARRIER", F.lit(0).alias("is_top"), F.lit(1).alias("is_bottom")))
            .groupBy("OP_CARRIER").agg(F.max("is_top").alias("is_top"), F.max("is_bottom").alias("is_bottom")))
    median = quantiles(table, "otp_pct", [0.5], ["median"]).scalar()
    # At most two heaps of ``edge`` rows.
    return table.join(F.broadcast(tags), "OP_CARRIER", "left").select(
        "OP_CARRIER", "flights", "delay_rate", "otp_pct",
        F.when(F.col("is_bottom") == 1, "bottom").when(F.col("is_top") == 1, "top").otherwise("middle").alias("tag"),
        median.alias("median_otp_pct"),
    ).orderBy("otp_pct", "OP_CARRIER")


def carrier_stability(op: DataFrame, k: int = 10) -> DataFrame:
    """Yearly on-time rate of the k busiest carriers; the ranking reads the yearly table."""
    yearly = materialise(op.filter(F.col("OP_CARRIER").isNotNull()).groupBy("YEAR", "OP_CARRIER").agg(
        F.count(F.lit(1)).alias("n"), F.avg(_late()).alias("delay_rate")))
    sizes = yearly.groupBy("OP_CARRIER").agg(F.sum("n").alias("n"))
    busiest = top_k(sizes, "n", k, "OP_CARRIER").select("OP_CARRIER")
    kept = yearly.join(F.broadcast(busiest), "OP_CARRIER", "left_semi")
    return kept.select("YEAR", "OP_CARRIER", "delay_rate",
                       ((1 - F.col("delay_rate")) * 100).alias("otp_pct")).orderBy("OP_CARRIER", "YEAR")


def airport_pain_index(op: DataFrame, k: int = 20) -> DataFrame:
    """Delay rate times mean delay, for the k origins with the most rows."""
    table = op.filter(F.col("ORIGIN").isNotNull()).groupBy("ORIGIN").agg(
        F.count(F.lit(1)).alias("n"), F.count(_late()).alias("flights"),
        F.avg(_late()).alias("delay_rate"), F.avg(F.col("ARR_DELAY_NEW").cast("double")).alias("avg_delay_min"))
    kept = top_k(table, "n", k, "ORIGIN")
    return kept.select(
        "ORIGIN", "flights", "delay_rate", "avg_delay_min",
        (F.col("delay_rate") * F.col("avg_delay_min")).alias("pain_index"),
        (F.col("delay_rate") * 100).alias("delay_pct"),
    ).orderBy(F.col("pain_index").desc(), "ORIGIN")


def _route_table(op: DataFrame) -> DataFrame:
    return op.filter(F.col("ROUTE").isNotNull()).groupBy("ROUTE").agg(
        F.count(_late()).alias("volume"), F.avg(_late()).alias("delay_rate"),
    ).withColumn("delay_pct", F.col("delay_rate") * 100)


def busiest_routes(op: DataFrame, k: int = 50) -> DataFrame:
    return top_k(_route_table(op), "volume", k, "ROUTE")


def worst_busy_routes(op: DataFrame, volume: int = 50, k: int = 10) -> DataFrame:
    """The k most delayed among the busiest routes."""
    return top_k(busiest_routes(op, volume), "delay_rate", k, "ROUTE")


def delay_heatmap(op: DataFrame) -> DataFrame:
    """Delay rate by departure block and weekday, one column per day."""
    pivoted = op.filter(F.col("DEP_TIME_BLK").isNotNull()).groupBy("DEP_TIME_BLK").pivot(
        "DAY_OF_WEEK", list(range(7))).agg(F.avg(_late()))
    return pivoted.select("DEP_TIME_BLK", *[F.col(str(i)).alias(d) for i, d in enumerate(schema.DAY_NAMES)]
                          ).orderBy("DEP_TIME_BLK")


def otp_grid(op: DataFrame, row: str, column: str, empty_otp: float | None = None,
             values: Sequence | None = None) -> DataFrame:
    """On-time percentage as a row x column grid; absent cells NULL unless filled.

    Without ``values`` the grid's columns are found on the already reduced table,
    so no column can be lost and the data is still scanned once.
    """
    reduced = op.filter(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row, column).agg(
        ((1 - F.avg(_late())) * 100).alias("otp_pct"))
    if values is None:
        reduced = materialise(reduced)
    pivoted = reduced.groupBy(row).pivot(column, list(values) if values is not None else None).agg(F.first("otp_pct"))
    if empty_otp is not None:
        pivoted = pivoted.fillna(empty_otp, [c for c in pivoted.columns if c != row])
    return pivoted.orderBy(row)


def carrier_extremes(op: DataFrame, k: int = 10, min_flights: int = 1000) -> DataFrame:
    """Best and worst k carriers among those with enough flights."""
    table = otp_by(op.filter(F.col("OP_CARRIER").isNotNull()), "OP_CARRIER").filter(F.col("flights") >= min_flights)
    table = materialise(table)
    best = top_k(table, "otp", k, "OP_CARRIER").withColumn("side", F.lit("top"))
    worst = top_k(table, "otp", k, "OP_CARRIER", largest=False).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def carrier_otp_table(op: DataFrame, min_flights: int = 500) -> DataFrame:
    table = otp_by(op.filter(F.col("OP_CARRIER").isNotNull()), "OP_CARRIER").filter(F.col("flights") >= min_flights)
    return table.select("OP_CARRIER", "flights", "delay_rate", (F.col("otp") * 100).alias("otp_pct")).orderBy(
        "otp_pct", "OP_CARRIER")


def busiest_otp(op: DataFrame, key: str, k: int = 20) -> DataFrame:
    """On-time rate of the k busiest origins, destinations or routes."""
    return top_k(otp_by(op.filter(F.col(key).isNotNull()), key), "flights", k, key)


def frequent_otp(op: DataFrame, key: str, k: int = 20) -> DataFrame:
    """``busiest_otp`` for keys too many to group by: only the busiest keys' rows are summed."""
    busiest = busiest_keys(op.filter(F.col("ARR_DEL15").isNotNull()), key, k).select(key)
    if busiest.limit(k).count() < k:  # keys without a known arrival complete the list
        return busiest_otp(op, key, k)
    return top_k(otp_by(op.join(F.broadcast(busiest), key, "left_semi"), key), "flights", k, key)


def worst_routes(op: DataFrame, k: int = 20, min_flights: int = 500) -> DataFrame:
    table = otp_by(op.filter(F.col("ROUTE").isNotNull()), "ROUTE").filter(F.col("flights") >= min_flights)
    return top_k(table, "otp", k, "ROUTE", largest=False)


def cancellation_by_year(full: DataFrame) -> DataFrame:
    table = full.groupBy("YEAR").agg(
        F.count("CANCELLED").alias("total"), F.coalesce(F.sum("CANCELLED"), F.lit(0)).alias("cancelled"),
        F.coalesce(F.sum("DIVERTED"), F.lit(0)).alias("diverted"))
    return table.select("*", delays.percent(F.col("cancelled"), F.col("total")).alias("cancel_rate"),
                        delays.percent(F.col("diverted"), F.col("total")).alias("divert_rate")).orderBy("YEAR")


def cancellations_by_airport(full: DataFrame, k: int = 20) -> DataFrame:
    table = full.filter((F.col("CANCELLED") == 1) & F.col("ORIGIN").isNotNull()).groupBy("ORIGIN").agg(
        F.count(F.lit(1)).alias("cancellations"))
    return top_k(table, "cancellations", k, "ORIGIN")


def cancellation_reasons(full: DataFrame) -> DataFrame:
    reason = delays.cancellation_reason(F.col("CANCELLATION_CODE"))
    return (full.filter(F.col("CANCELLED") == 1).select(reason.alias("reason")).filter(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "reason"))


def cause_minutes(op: DataFrame, by_year: bool = True) -> DataFrame:
    """Total minutes per delay cause, by year or overall, in long form."""
    causes = [c for c in schema.CAUSES if c in op.columns]
    keys = ["YEAR"] if by_year else []
    sums = op.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in causes])
    return sums.unpivot(keys, causes, "cause", "minutes")


def causes_by_carrier(op: DataFrame, k: int = 10) -> DataFrame:
    """Mean minutes per cause, for the k carriers highest on the first cause."""
    causes = [c for c in schema.CAUSES if c in op.columns]
    means = op.filter(F.col("OP_CARRIER").isNotNull()).groupBy("OP_CARRIER").agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in causes])
    return top_k(means, causes[0], k, "OP_CARRIER")


def mean_delay_by_hour(op: DataFrame) -> DataFrame:
    hour = clock.hour_of(F.col("CRS_DEP_TIME_MIN"))
    return (op.select(hour.alias("DEP_HOUR"), F.col("ARR_DELAY").cast("double").alias("d"))
            .filter(F.col("DEP_HOUR").isNotNull())
            .groupBy("DEP_HOUR").agg(F.avg("d").alias("mean_arr_delay")).orderBy("DEP_HOUR"))


def category_counts(op: DataFrame, edges: Sequence[float] = schema.DELAY_EDGES,
                    labels: Sequence[str] = schema.DELAY_LABELS, column: str = "ARR_DELAY") -> DataFrame:
    category = delays.delay_category(F.col(column), edges, labels)
    counts = op.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("category").isNotNull())
    return counts.withColumn("ord", delays.category_rank(F.col("category"), labels)).orderBy("ord")


def key_figures(full: DataFrame) -> DataFrame:
    """Flights, on-time rate, mean delay and cancel rate from one aggregate."""
    flown = delays.is_operated()
    return full.agg(
        F.count(F.lit(1)).alias("total_flights"),
        ((1 - F.avg(F.when(flown, _late()))) * 100).alias("otp_pct"),
        F.avg(F.when(flown, F.col("ARR_DELAY").cast("double"))).alias("avg_delay"),
        (F.avg("CANCELLED") * 100).alias("cancel_pct"),
    )
