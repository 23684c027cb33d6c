"""Running totals of arriving files; a newer file of one key takes the place of the older.

Two streams. ``count_files`` reads each arriving file once and leaves one row of counts per file. ``total`` keeps, per
file key, the counts of its newest file in a state store and writes what each change adds and takes away; the totals
are the sum of those changes. So a replaced file is retracted without reading any other file again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tarmac import schema
from tarmac.functions import delays
from tarmac.operators import cleaning
from tarmac.session import tuned
from tarmac.sources import records
from tarmac.streaming.ingest import arrivals

COUNTS = ("r1_cancelled", "r2_diverted", "r3_clock_rows", "r4_date_rows", "weekday_mismatches", "negative_distance",
          "rows_without_year", "operated")
_YEARS = f"array<struct<YEAR: int, {', '.join(f'{c}: bigint' for c in COUNTS)}>>"
_COUNTED = "key string, version bigint, path string, years string"
_CHANGES = "key string, sign int, years string"
_TOTALS = f"YEAR int, {', '.join(f'{c} bigint' for c in COUNTS)}"


def base_name(path: Column) -> Column:
    """The file's name without folders and compression: a later delivery of that name replaces it."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(gz|bz2)$", "")


def count_files(spark: SparkSession, folder: str, out: str, checkpoint: str, target: str = schema.TARGET, month: int = 1,
                key: Callable[[Column], Column] = base_name, max_files: int = 10_000) -> StreamingQuery:
    """(key, version, path, years) of every file not seen before, one row a file, under ``out``; then stop.

    ``version`` is the file's time in microseconds, ``years`` its rule counts by year as JSON, null years among them.
    A file with a header and no rows counts nothing, and so takes back what its key held; a file of no bytes is
    never seen. A restart writes an interrupted batch again, which ``total`` then recognises by version and path.
    """
    def count(batch: DataFrame, number: int) -> None:
        named = batch.select("path", "file", key(F.col("path")).alias("key"), F.unix_micros("modificationTime").alias("version"))
        paths = [r["path"] for r in batch.select("path").collect()]  # at most max_files
        if not paths:
            return
        with tuned(batch.sparkSession):
            rows = records.read_records(batch.sparkSession, paths, target).withColumn("file", F.input_file_name())
            yearly = rows.groupBy("file", "YEAR").agg(
                *cleaning.rule_metrics(month), F.count_if(delays.is_operated()).alias("operated"))
            # One entry per year that the file holds.
            of_file = yearly.groupBy("file").agg(F.collect_list(F.struct(F.col("YEAR").cast("int").alias("YEAR"), *COUNTS)).alias("years"))
            named.join(of_file, "file", "left").select(
                "key", "version", "path", F.coalesce(F.to_json("years"), F.lit("[]")).alias("years"),
            ).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (arrivals(spark, folder, max_files).writeStream.foreachBatch(count)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _newest(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the newest file of the key (equal times: the larger path); tell what it adds and what it takes away."""
    held = tuple(state.get) if state.exists else None
    best = held
    for frame in frames:
        for version, path, years in zip(frame["version"], frame["path"], frame["years"]):
            if best is None or (int(version), path) > best[:2]:
                best = (int(version), path, years)
    if best != held:
        state.update(best)
        changes = [(key[0], 1, best[2])] + ([(key[0], -1, held[2])] if held else [])
        yield pd.DataFrame(changes, columns=["key", "sign", "years"])


def total(spark: SparkSession, counted: str, out: str, checkpoint: str) -> StreamingQuery:
    """Bring the changes under ``out`` up to the counted files; then stop.

    The state holds one row per file key. A micro-batch writes one row per year over whatever an interrupted try left.
    """
    def write(batch: DataFrame, number: int) -> None:
        parts = batch.select("sign", F.inline(F.from_json("years", _YEARS)))
        parts.groupBy("YEAR").agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    files = spark.readStream.schema(_COUNTED).parquet(f"{counted}/batch=*")
    changes = files.groupBy("key").applyInPandasWithState(
        _newest, _CHANGES, "version bigint, path string, years string", "update", GroupStateTimeout.NoTimeout)
    return (changes.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def totals(spark: SparkSession, out: str) -> DataFrame:
    """(YEAR, counts) of the files as they stand, from one small row per batch and year; years without rows are absent."""
    changes = spark.read.schema(_TOTALS).parquet(f"{out}/batch=*")
    return changes.groupBy("YEAR").agg(*[F.sum(c).alias(c) for c in COUNTS]).filter("r3_clock_rows > 0")


def rule_counts(running: DataFrame) -> DataFrame:
    """``cleaning.rule_counts`` of all rows, from ``totals``."""
    return running.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS if c != "operated"])


def yearly_ingestion(running: DataFrame) -> DataFrame:
    """``quality.yearly_ingestion`` from ``totals``."""
    summed = running.filter(F.col("YEAR").isNotNull()).rollup("YEAR").agg(
        F.sum("r3_clock_rows").alias("rows_read"), F.sum("operated").alias("rows_operated"),
        F.sum("r1_cancelled").alias("cancelled"), F.sum("r2_diverted").alias("diverted"))
    return summed.select("YEAR", "rows_read", F.col("rows_read").alias("rows_full"), "rows_operated", "cancelled", "diverted",
                         delays.percent(F.col("cancelled"), F.col("rows_read")).alias("cancelled_pct"),
                         delays.percent(F.col("diverted"), F.col("rows_read")).alias("diverted_pct"))
