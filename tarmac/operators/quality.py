"""Ingestion summaries and column profiles, each from one aggregate over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schema
from tarmac.functions import delays
from tarmac.operators.ranks import running_totals


def _long_form(one_row: DataFrame, names: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """One row per name out of a single row holding ``<name>__<part>`` columns."""
    entries = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"`{n}__{p}`").alias(p) for p in parts])
        for n in names
    ]
    return one_row.select(F.inline(F.array(*entries)))


def clock_statistics(cleaned: DataFrame) -> DataFrame:
    """Parsed and missing values per clock column."""
    names = [c for c in schema.CLOCK_COLUMNS if f"{c}_MIN" in cleaned.columns]
    aggregates = []
    for c in names:
        minutes = F.col(f"{c}_MIN")
        aggregates += [F.count(minutes).alias(f"{c}__parsed"),
                       F.count_if(minutes.isNull()).alias(f"{c}__na")]
    return _long_form(cleaned.agg(*aggregates), names, ["parsed", "na"])


def yearly_ingestion(cleaned: DataFrame) -> DataFrame:
    """Rows read, operated, cancelled and diverted per year, with a total row.

    The total row has a NULL year, which is unambiguous because undated rows never
    reach an output.
    """
    summary = cleaned.filter(F.col("YEAR").isNotNull()).rollup("YEAR").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(delays.is_operated()).alias("rows_operated"),
        F.count_if(F.col("CANCELLED") == 1).alias("cancelled"),
        F.count_if(F.col("DIVERTED") == 1).alias("diverted"),
    )
    return summary.select(
        "YEAR", "rows_read", F.col("rows_read").alias("rows_full"), "rows_operated",
        "cancelled", "diverted",
        delays.percent(F.col("cancelled"), F.col("rows_read")).alias("cancelled_pct"),
        delays.percent(F.col("diverted"), F.col("rows_read")).alias("diverted_pct"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type and share of missing cells of every column, over all rows."""
    names = df.columns
    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count(F.col(c)).alias(f"{c}__non_null") for c in names])
    kinds = F.create_map(*[x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    long = counted.select("_rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}__non_null`").alias("non_null")) for c in names])))
    missing = F.col("_rows") - F.col("non_null")
    return long.select(
        "column", kinds[F.col("column")].alias("dtype"), "non_null", missing.alias("null_count"),
        F.coalesce(delays.percent(missing, F.col("_rows")), F.lit(0.0)).alias("null_pct"),
    )


def distinct_per_column(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct known values of every column.

    The exact form goes through (column, value) pairs combined map-side, rather
    than one multi-distinct aggregate that would widen every row once per column.
    """
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(f"{c}__n_distinct") for c in df.columns])
        return _long_form(counted, df.columns, ["n_distinct"])
    return _value_counts(df).groupBy("column").agg(F.count_if("known").alias("n_distinct"))


def _value_counts(df: DataFrame) -> DataFrame:
    """(column, known, n): a row per column and value, missing being one; one scan, combined map-side.

    Values keep their kind: whole numbers, other numbers, and the rest as text.
    """
    whole, other = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)
    cells = []
    for f in df.schema:
        c, none = F.col(f"`{f.name}`"), F.lit(None)
        number = isinstance(f.dataType, whole)
        real = isinstance(f.dataType, other)
        cells.append(F.struct(
            F.lit(f.name).alias("column"), (c.cast("long") if number else none.cast("long")).alias("i"),
            (c.cast("double") if real else none.cast("double")).alias("d"),
            (none.cast("string") if number or real else c.cast("string")).alias("s"), c.isNotNull().alias("known")))
    spread = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return spread.groupBy("column", "i", "d", "s", "known").agg(F.count(F.lit(1)).alias("n")).select("column", "known", "n")


def quality_table(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Profile plus distinct counts, most incomplete columns first. The exact form takes both from one scan."""
    if approximate:
        distinct = distinct_per_column(df, approximate)
        # Both sides have one row per column of the schema.
        table = column_profile(df).join(F.broadcast(distinct), "column", "left")
        table = table.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    else:
        kinds = F.create_map(*[x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
        counted = _value_counts(df).groupBy("column").agg(
            F.sum("n").alias("_rows"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("non_null"),
            F.count_if("known").alias("n_distinct"))
        missing = F.col("_rows") - F.col("non_null")
        table = counted.select(
            "column", kinds[F.col("column")].alias("dtype"), "non_null", missing.alias("null_count"),
            F.coalesce(delays.percent(missing, F.col("_rows")), F.lit(0.0)).alias("null_pct"), "n_distinct")
    # Two places, halves of the scaled value to even, as numeric libraries round.
    two_places = F.bround(F.col("null_pct") * 100, 0) / 100
    return table.withColumn("null_pct", two_places).orderBy(F.col("null_pct").desc(), "column")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum.

    All figures come from one table of value counts, so the data is scanned once.
    """
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "value", ["n"], by=["column"])
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1
    aggregates = [F.sum("n").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"),
                  F.sum(F.col("value") * F.col("n")).alias("_sum")]
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    for name, p in quartiles.items():
        place = (F.col("total_n") - 1) * F.lit(p)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            aggregates.append(F.max(F.when((first <= rank) & (rank <= last), F.col("value"))).alias(f"_{side}_{name}"))
        aggregates.append(F.max(place - F.floor(place)).alias(f"_part_{name}"))
    summary = ranked.groupBy("column").agg(*aggregates).withColumn("mean", F.col("_sum") / F.col("count"))
    # Spread around the mean needs the mean first: a second pass over value counts only.
    centred = counts_with(ranked, summary.select("column", "mean"))
    spread = centred.groupBy("column").agg(
        F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)).alias("_squares"))
    joined = summary.join(F.broadcast(spread), "column")
    return joined.select(
        "column", "count", "mean",
        F.sqrt(F.try_divide(F.col("_squares"), F.col("count") - 1)).alias("std"), "min",
        *[(F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_part_{q}")).alias(q)
          for q in quartiles],
        "max",
    )


def counts_with(counts: DataFrame, means: DataFrame) -> DataFrame:
    """Value counts with their column's mean; one mean per schema column."""
    return counts.join(F.broadcast(means), "column")


def values_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def class_balance(df: DataFrame, target: str = schema.TARGET) -> DataFrame:
    """Counts, shares and the negative-to-positive ratio (1.0 without positives)."""
    counted = df.agg(F.count_if(F.col(target) == 0).alias("n_negative"),
                     F.count_if(F.col(target) == 1).alias("n_positive"))
    both = F.col("n_negative") + F.col("n_positive")
    return counted.select(
        "n_negative", "n_positive",
        F.try_divide(F.col("n_negative"), both).alias("share_negative"),
        F.try_divide(F.col("n_positive"), both).alias("share_positive"),
        F.coalesce(F.try_divide(F.col("n_negative"), F.col("n_positive")), F.lit(1.0)).alias("ratio"),
    )
