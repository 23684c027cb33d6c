"""Newly arrived CSV files through the same row-local rules, once each.

The rules keep no state, so the stream has no watermark. What streams are the files
themselves: each micro-batch reads the headers of its own files and cleans them by
the batch projection, so files with other column orders land in the right columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac import schema
from tarmac.operators import cleaning
from tarmac.session import tuned
from tarmac.sources import records

_FILES = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, folder: str, max_files: int) -> DataFrame:
    """A stream of the paths, times and reader's names of CSV files in ``folder``, packed ones too; their content is not read."""
    reader = spark.readStream.schema(_FILES).format("binaryFile").option("pathGlobFilter", "*.csv{,.gz,.bz2}")
    return reader.option("maxFilesPerTrigger", max_files).load(folder).filter("length > 0").select(
        "path", "modificationTime", F.input_file_name().alias("file"))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, target: str = schema.TARGET,
           operated_only: bool = False, max_files: int = 10_000) -> StreamingQuery:
    """Process every file not seen before, then stop; rerun to pick up later arrivals.

    A micro-batch, of ``max_files`` files at most, writes the folder of its own number,
    over whatever an interrupted try left there, so a restart neither loses nor repeats rows.
    """
    def clean(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most max_files
        if not paths:
            return
        with tuned(batch.sparkSession):
            cleaned = cleaning.clean(records.read_records(batch.sparkSession, paths, target), target).filter(F.col("YEAR").isNotNull())
            if operated_only:
                cleaned = cleaning.operated(cleaned)
            cleaned.write.mode("overwrite").partitionBy("YEAR").parquet(f"{out}/batch={number}")

    return (arrivals(spark, folder, max_files).writeStream.foreachBatch(clean)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
