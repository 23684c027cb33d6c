"""Stored train-only maps and the manifest that says when they can be reused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import encoding
from tarmac.operators.encoding import Encodings
from tarmac.sources.tables import exists, write_table

MANIFEST = "target string, train_years string, inputs string, complete boolean"
_STATISTICS = "source string, key string, n_rows long, n_operated long, n_labelled long, n_delayed long"


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the input files' names, sizes and times, without reading them."""
    listing = spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
    line = F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    digest = listing.agg(F.bit_xor(F.xxhash64(line)).alias("x"), F.count(F.lit(1)).alias("n"))
    one = digest.first()
    return f"{one['n']}:{one['x']}"


def save(train: DataFrame, folder: str, target: str, years: Sequence[int], fingerprint: str) -> None:
    """Fit and write the maps; the manifest goes last, so a half-written folder is not reused."""
    statistics = encoding.key_statistics(train, target) if target == "ARR_DEL15" else encoding.frequency_statistics(train)
    write_table(statistics, f"{folder}/statistics")
    row = train.sparkSession.range(1).select(
        F.lit(target).alias("target"), F.lit(_years(years)).alias("train_years"),
        F.lit(fingerprint).alias("inputs"), F.lit(True).alias("complete"))
    write_table(row, f"{folder}/manifest")


def load(spark: SparkSession, folder: str) -> Encodings:
    """Stored maps. Without any, every key is unseen and the overall share is neutral."""
    path = f"{folder}/statistics"
    stored = exists(spark, path)
    return Encodings(spark.read.schema(_STATISTICS).parquet(path) if stored else spark.createDataFrame([], _STATISTICS))


def _years(years: Sequence[int]) -> str:
    return ",".join(map(str, sorted(years)))


def is_current(spark: SparkSession, folder: str, target: str, years: Sequence[int], fingerprint: str) -> bool:
    if not exists(spark, f"{folder}/manifest"):
        return False
    row = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").first()
    return row is not None and tuple(row) == (target, _years(years), fingerprint, True)


def fit_if_stale(train: DataFrame, folder: str, fingerprint: str, target: str = schema.TARGET,
                 years: Sequence[int] = schema.TRAIN_YEARS) -> bool:
    """Make the stored maps unless they come from the same inputs, years and target."""
    stale = not is_current(train.sparkSession, folder, target, years, fingerprint)
    if stale:
        save(train, folder, target, years, fingerprint)
    return stale
