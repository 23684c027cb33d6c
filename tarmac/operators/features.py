"""Feature sets per track, and the audits that keep outcomes out of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators.ranks import quantiles


def track_table(encoded: DataFrame, track: str, target: str = schema.TARGET) -> DataFrame:
    """Rows with a known target, restricted to the track's features and the target."""
    wanted = [c for c in expected_features(track, target) if c in encoded.columns]
    return encoded.filter(F.col(target).isNotNull()).select(*wanted, target)


def expected_features(track: str, target: str = schema.TARGET) -> list[str]:
    """The track's features; history rates exist for the 0/1 target only."""
    history = () if target == "ARR_DEL15" else schema.HISTORY_FEATURES.values()
    return [c for c in schema.TRACKS[track] if c not in history]


def split_name(years: Sequence[int] = schema.TRAIN_YEARS):
    return F.when(F.col("YEAR").isin(*years), F.lit("train")).otherwise(F.lit("test"))


def row_counts(encoded: DataFrame, target: str = schema.TARGET,
               years: Sequence[int] = schema.TRAIN_YEARS) -> DataFrame:
    """Rows per track and split, from one count per split."""
    counts = (encoded.filter(F.col(target).isNotNull())
              .groupBy(split_name(years).alias("split")).agg(F.count(F.lit(1)).alias("n")))
    tracks = F.explode(F.array(*[F.lit(t) for t in schema.TRACKS]))
    return counts.select(tracks.alias("track"), "split", "n")


def column_differences(found: Iterable[str], expected: Iterable[str]) -> dict[str, list[str]]:
    found, expected = set(found), set(expected)
    return {"missing": sorted(expected - found), "extra": sorted(found - expected)}


def leaked_columns(found: Iterable[str], track: str, target: str = schema.TARGET) -> list[str]:
    return sorted(set(found) & (set(schema.FORBIDDEN[track]) - {target}))


def leakage_audit(tables: dict[str, DataFrame], target: str = schema.TARGET) -> DataFrame:
    """(track, column, verdict) for every column of the given track tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for track, table in tables.items():
        leaked = set(leaked_columns(table.columns, track, target))
        expected = {*expected_features(track, target), target}
        for c in table.columns:
            rows.append((track, c, "leaked" if c in leaked else "ok" if c in expected else "extra"))
        rows += [(track, c, "missing") for c in sorted(expected - set(table.columns))]
    return spark.createDataFrame(rows, "track string, column string, verdict string")


def missing_partitions(spark: SparkSession, observed: DataFrame,
                       years: Sequence[int] = schema.ALL_YEARS,
                       datasets: Sequence[str] = ("clean_full", "clean_operated")) -> DataFrame:
    """Expected (dataset, YEAR) pairs absent from ``observed``."""
    expected = spark.createDataFrame([(d, y) for d in datasets for y in years], "dataset string, YEAR int")
    return expected.join(observed, ["dataset", "YEAR"], "left_anti")


def fill_by_year(df: DataFrame, columns: Sequence[str], fallback: float = -1.0,
                 quantiles: Callable[..., DataFrame] = quantiles) -> DataFrame:
    """Replace missing numbers by the median of their year: exact, or from ``sketches.quantiles``.

    Exact medians come from value counts of a long (year, column) form, so no task ever
    holds a whole year. A column with no value in a year gets ``fallback``.
    """
    numbers = df.select("YEAR", *[F.col(c).cast("double").alias(c) for c in columns])
    long = numbers.unpivot(["YEAR"], list(columns), "column", "value")
    medians = quantiles(long, "value", [0.5], ["median"], by=["YEAR", "column"])
    # One row per year; the columns are known, so the pivot needs no extra job.
    wide = medians.groupBy(F.col("YEAR").alias("_year")).pivot("column", list(columns)).agg(F.first("median"))
    wide = wide.select("_year", *[F.col(c).alias(f"_median_{c}") for c in columns])
    joined = df.join(F.broadcast(wide), F.col("YEAR") == F.col("_year"), "left")
    return joined.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}"), F.lit(fallback)).alias(c)
        if c in columns else F.col(c) for c in df.columns
    ])
