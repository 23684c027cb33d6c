"""Top-k with a tie rule, previews and seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, key: str | Sequence[str],
          largest: bool = True) -> DataFrame:
    """The k rows with the largest (smallest) measure; ties go to the smaller key.

    Unknown measures come last either way. Plans as a per-task heap of k rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = F.col(measure).desc_nulls_last() if largest else F.col(measure).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in keys]).limit(k)


def leader(table: DataFrame, by: str, measure: str, key: str) -> DataFrame:
    """The row with the largest measure in each group; ties go to the smaller key."""
    rest = [c for c in table.columns if c != by]
    best = F.min_by(F.struct(*rest), F.struct(-F.col(measure), F.col(key)))
    return table.filter(F.col(measure).isNotNull()).groupBy(by).agg(best.alias("_best")).select(by, "_best.*")


def busiest(df: DataFrame, key: str, k: int) -> DataFrame:
    """Keys of the k most frequent values; unknown keys do not compete."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, "n", k, key).select(key)


def keep_busiest(df: DataFrame, key: str, k: int) -> DataFrame:
    """Semi join against the k busiest keys; the k-row side is safe to broadcast."""
    return df.join(F.broadcast(busiest(df, key, k)), key, "left_semi")


def preview(df: DataFrame, n: int = 5, by: Sequence[str] | None = None) -> DataFrame:
    """The first n rows in the order of ``by``, else of all columns, so that it does not change between runs."""
    return df.orderBy(*(by or df.columns)).limit(n)


def seeded_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones for the same data and seed.

    Equal rows are counted, and each copy is drawn by itself. A draw is the md5 of the
    seed, the row's cells as text and the copy's number, joined by bars; unknown is ``\\N``.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    drawn = copies.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *cells, F.col("_copy").cast("string")).cast("binary")))
    return drawn.orderBy("_draw", *df.columns).limit(n).select(*df.columns)
