"""Train-only maps kept up to date from statistics per input file.

Each file's key counts are stored once under the file's mark, a digest of its name, size
and time. A refresh reads only files whose mark is not stored, and adds up the counts of
the files that are there now: a replaced file has a new mark, so what the old one held
is left out, as is what a removed file held. Counts are sums, so the maps equal those of
a full fit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import cleaning, encoding
from tarmac.operators.encoding import Encodings
from tarmac.sources import records
from tarmac.sources.mappings import load
from tarmac.sources.tables import exists, write_table

_COUNTS = ("n_rows", "n_operated", "n_labelled", "n_delayed")
_STORED = "batch string, mark long, source string, key string, n_rows long, n_operated long, n_labelled long, n_delayed long"


def marks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, mark) of every input file, from the listing alone."""
    listing = spark.read.format("binaryFile").load(list(paths)).select(
        F.input_file_name().alias("file"), F.col("length").cast("string").alias("length"), F.col("modificationTime").cast("string").alias("time"))
    return listing.select("file", F.xxhash64("file", "length", "time").alias("mark"))


def file_statistics(spark: SparkSession, files: Sequence[str], target: str, years: Sequence[int], month: int) -> DataFrame:
    """``key_statistics`` of the training rows of each file, with the file's name; one pass over all these files."""
    cleaned = cleaning.clean(records.read_records(spark, files, target), target, month)
    # rows have not left the task that reads their file yet
    rows = encoding.train_rows(cleaned, years).withColumn("file", F.input_file_name())
    late = F.col(target) if target == "ARR_DEL15" else F.lit(None).cast("int")
    return encoding.statistics_by(rows, late, ["file"])


def refresh(spark: SparkSession, paths: str | Sequence[str], folder: str, target: str = schema.TARGET,
            years: Sequence[int] = schema.TRAIN_YEARS, month: int = 1) -> list[str]:
    """Bring the maps under ``folder`` to the files that ``paths`` hold now; returns the files that were read.

    Other settings (target, years, month) have statistics of their own. A refresh that broke off leaves a batch without
    its list of files, which is never read. Without any file left the maps are empty.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    setting = f"{target}-{month}-" + "_".join(map(str, sorted(years)))
    held, listed = f"{folder}/by_file/{setting}", f"{folder}/file_lists/{setting}"
    now = marks(spark, paths)
    known = spark.read.schema("batch string, file string, mark long").parquet(listed) if exists(spark, listed) else spark.createDataFrame([], "batch string, file string, mark long")
    # the names of changed files; a reader needs them on the driver whatever it does
    new = now.join(known.select("mark"), "mark", "left_anti").select("file", "mark").collect()
    if new:
        batch, names = uuid.uuid4().hex, spark.createDataFrame(new, "file string, mark long")
        counted = file_statistics(spark, [r["file"] for r in new], target, years, month)
        counted.join(names, "file").select(F.lit(batch).alias("batch"), "mark", "source", "key", *_COUNTS).write.mode("append").parquet(held)
        names.select(F.lit(batch).alias("batch"), "file", "mark").write.mode("append").parquet(listed)
        known = spark.read.schema("batch string, file string, mark long").parquet(listed)
    stored = spark.read.schema(_STORED).parquet(held) if exists(spark, held) else spark.createDataFrame([], _STORED)
    there = known.join(now.select("mark").distinct(), "mark").select("batch", "mark").distinct()
    current = stored.join(there, ["batch", "mark"]).groupBy("source", "key").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    write_table(current, f"{folder}/statistics")
    return sorted(r["file"] for r in new)


def encodings(spark: SparkSession, folder: str) -> Encodings:
    """The maps as of the last refresh."""
    return load(spark, folder)
