"""Counts, means and co-moments of pairs of columns, each pair over the rows where both are known.

A task keeps one matrix of each, updated a batch at a time around the batch's own means,
which stays accurate for values far from zero. Partial matrices are merged by the
same pairwise update, in SQL: what is shuffled is a row per pair and task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PARTS = "i int, j int, n double, mean_i double, mean_j double, m2_i double, m2_j double, c double"


class Moments:
    """Pairwise counts ``n``, means of the row's column where the other is known, their squares' sums and co-moments."""

    def __init__(self, size: int):
        self.n, self.mean, self.m2, self.c = (np.zeros((size, size)) for _ in range(4))

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """Of one batch of rows; NaN is unknown."""
        out = cls(x.shape[1])
        known = ~np.isnan(x)
        near = np.where(known.any(axis=0), np.nansum(x, axis=0) / np.maximum(known.sum(axis=0), 1), 0.0)
        x, k = np.where(known, x - near, 0.0), known.astype(float)
        out.n = k.T @ k
        safe = np.maximum(out.n, 1)
        sums = x.T @ k
        out.mean = sums / safe
        out.m2 = (x * x).T @ k - sums * out.mean
        out.c = x.T @ x - sums * out.mean.T
        out.mean += near[:, None]
        return out

    def add(self, other: Moments) -> None:
        n = self.n + other.n
        safe = np.maximum(n, 1)
        gap = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / safe
        self.m2 += other.m2 + gap * gap * weight
        self.c += other.c + gap * gap.T * weight
        self.mean = (self.mean * self.n + other.mean * other.n) / safe
        self.n = n


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, c, m2_i, m2_j) for each pair of positions i <= j in ``columns``: rows where both are known, the sum of products
    of their deviations, and the sums of squares of each. NaN counts as unknown; a pair never known together has n = 0.
    An empty table gives an empty result."""
    size = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(size)
        for batch in batches:
            if batch.num_rows:
                total.add(Moments.of(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        i, j = np.triu_indices(size)
        if total.n.any():
            values = (total.n[i, j], total.mean[i, j], total.mean[j, i], total.m2[i, j], total.m2[j, i], total.c[i, j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, values)], [c.split()[0] for c in _PARTS.split(", ")])

    parts = df.select(*[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(columns)]).mapInArrow(run, _PARTS)
    whole = Window.partitionBy("i", "j")
    n = F.greatest(F.sum("n").over(whole), F.lit(1.0))
    centred = parts.withColumns({f"_off_{s}": F.col(f"mean_{s}") - F.sum(F.col("n") * F.col(f"mean_{s}")).over(whole) / n for s in "ij"})
    a, b = F.col("_off_i"), F.col("_off_j")
    return centred.groupBy("i", "j").agg(
        F.sum("n").cast("long").alias("n"), F.sum(F.col("c") + F.col("n") * a * b).alias("c"),
        F.sum(F.col("m2_i") + F.col("n") * a * a).alias("m2_i"), F.sum(F.col("m2_j") + F.col("n") * b * b).alias("m2_j"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for each pair of ``columns`` in their order, each column with itself too. Without spread, or unknown throughout, r is null."""
    names = F.lit(list(columns))
    r = F.when((F.col("m2_i") > 0) & (F.col("m2_j") > 0), F.col("c") / F.sqrt(F.col("m2_i") * F.col("m2_j")))
    same = F.when(F.col("m2_i") > 0, F.lit(1.0))
    return pair_moments(df, columns).select(
        F.element_at(names, F.col("i") + 1).alias("x"), F.element_at(names, F.col("j") + 1).alias("y"), F.when(F.col("i") == F.col("j"), same).otherwise(r).alias("r"))
