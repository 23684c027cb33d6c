"""Parquet tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; the column list and later filters reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_by_year(df: DataFrame, path: str, overwrite: bool = True, compact: bool = False) -> None:
    """Write partitioned by YEAR, replacing only the years present in ``df``.

    Input files usually hold one year, so the write needs no shuffle. ``compact``
    adds a rebalance by year, which adaptive execution cuts into even files however
    unequal the years are. Undated rows have no partition and are left out. Without
    ``overwrite`` the years must be new: rows are never added to a year that is there.
    """
    dated = df.filter(F.col("YEAR").isNotNull())
    if compact:
        dated = dated.hint("rebalance", "YEAR")
    writer = dated.write.partitionBy("YEAR").option("compression", "snappy")
    if overwrite:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        years = [r["YEAR"] for r in dated.select("YEAR").distinct().collect()]  # one per year
        if exists(df.sparkSession, path):
            there = {r["YEAR"] for r in df.sparkSession.read.parquet(path).select("YEAR").distinct().collect()}
            if repeated := sorted(there & set(years)):
                raise ValueError(f"{path} already has YEAR {', '.join(map(str, repeated))}")
        writer.mode("append").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
