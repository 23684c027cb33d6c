"""Inputs shared by the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schema
from tarmac.operators import cleaning, encoding
from tarmac.session import materialise
from tarmac.sources.driver_tables import raw_flights

_SMALL = (T.ByteType, T.ShortType)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_flights(spark, folder)


def text_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records as a text file would hold them."""
    df = raw_flights(spark, folder)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw_flights(spark, folder))


def flown(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.operated(clean(spark, folder))


def with_maps(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, encoding.Encodings]:
    """Operated flights and the maps fitted on the training years, off one stored table.

    With ``columns`` it holds those and what maps and flags need, and nothing else is computed.
    """
    df = clean(spark, folder)
    if columns is not None:
        needed = {*columns, *schema.FREQUENCY_FEATURES, schema.TARGET, "YEAR", "CANCELLED", "DIVERTED"}
        df = df.select(*[c for c in df.columns if c in needed])
    full = materialise(df)
    return cleaning.operated(full), encoding.Encodings.fit(encoding.train_rows(full))


def encodings(spark: SparkSession, folder: str) -> encoding.Encodings:
    return encoding.Encodings.fit(encoding.train_rows(clean(spark, folder)))


def encoded(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    return encoding.encode(*with_maps(spark, folder, columns))


def history_score(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed, heavily tied score: one minus the carrier's historical on-time share."""
    df = encoding.add_history(*with_maps(spark, folder, ["DEP_DELAY"]))
    return df.filter(F.col("ARR_DEL15").isNotNull()).select(
        "YEAR", F.col("ARR_DEL15").cast("int").alias("label"),
        (1 - F.col("CARRIER_HIST_OTP").cast("double")).alias("score"), "DEP_DELAY")


def delay_score(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed score with many values: departure delay squeezed into [0, 1]."""
    delay = F.col("DEP_DELAY").cast("double")
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (delay + 40) / F.lit(400.0)))
    return flown(spark, folder).filter(F.col("ARR_DEL15").isNotNull() & delay.isNotNull()).select(
        "YEAR", F.col("ARR_DEL15").cast("int").alias("label"), score.alias("score"), "DEP_DELAY")


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: decimals at six places, small integers widened, dates as text."""
    columns = []
    for f in df.schema:
        cell = f"`{f.name}`"
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cell = f"round(CAST({cell} AS DOUBLE), 6) + 0.0D"
        elif isinstance(f.dataType, _SMALL):
            cell = f"CAST({cell} AS INT)"
        elif isinstance(f.dataType, T.DateType):
            cell = f"CAST({cell} AS STRING)"
        columns.append(f"{cell} AS `{f.name}`")
    return df.selectExpr(*columns)
