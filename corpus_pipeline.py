"""Documents to a training mix: each stage calls one operator and works on all that the one before kept.

Every stage function takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontam, mixing, pii, quality, simhash
from tarmac.llm.common import fold_of, materialise, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression classifier scores 0.3 or more."""
    learn_from = F.coalesce(fold_of(F.col("doc_id"), 5) != 0, F.lit(False))
    model = quality.train(docs, table(spark, sf_dir, "labels"), learn_from)
    return quality.score(docs, model, "_quality").where("_quality >= 0.3").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints of three-word shingles at three bits or fewer."""
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows."""
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.taken(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

#: SQL cannot state the fitted classifier, the fingerprints' components or the message passing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
