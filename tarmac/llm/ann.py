"""Nearest neighbours by inner product with an inverted multi-index.

Each half of a vector is quantised by its own centroids, so a pair of centroids names
a cell and few centroids make many cells. A query visits cells in the order of the
summed distances of their two centroids, taken from a heap that holds one frontier
entry per row of the grid; the entries of the cells visited are ranked again by the
exact inner product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise

#: Rows of one block of the index at most, and blocks of it at least.
BLOCK_ROWS = 65_536
BLOCKS = 16
#: Queries that meet a block in one task at most.
QUERY_ROWS = 8192


class Index(NamedTuple):
    """``entries``: (vec_id, vector, cell, block) of every row that takes part; ``halves``: the centroids; ``places``: cell -> (first block, blocks, entries)."""

    entries: DataFrame
    halves: tuple[np.ndarray, np.ndarray]
    places: dict[int, tuple[int, int, int]]


def usable(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, vector) of vectors of ``dims`` finite components that are not all zero."""
    v = F.col("vector")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(fine, F.lit(False)) & F.col("vec_id").isNotNull())


def centroids(sample: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's algorithm from evenly spread rows of the sample; an empty cluster keeps its centroid."""
    found = sample[np.linspace(0, len(sample) - 1, min(k, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(sample, found)
        for c in range(len(found)):
            if (near == c).any():
                found[c] = sample[near == c].mean(axis=0)
    return found


def nearest(rows: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.argmin((found ** 2).sum(axis=1) - 2 * rows @ found.T, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def traversal(query: np.ndarray, halves: tuple[np.ndarray, np.ndarray]) -> Iterator[int]:
    """Cells by summed distance of their centroids, nearest first. Distance is how far a half falls short of its best inner product."""
    split = halves[0].shape[1]
    far = [-(half @ part) for half, part in zip(halves, (query[:split], query[split:]), strict=True)]
    rows, columns = np.argsort(far[0], kind="stable"), np.argsort(far[1], kind="stable")
    a, b = far[0][rows], far[1][columns]
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(rows[i] * len(columns) + columns[j])
        if j + 1 < len(columns):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def build(vectors: DataFrame, dims: int, cells: int = 32, sample: int = 8192) -> Index:
    """Indexes every usable row of ``vectors`` (vec_id, vector); the centroids are fitted on at most ``sample`` rows, the same on each run."""
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector"), dims)
    fitted = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    learnt = np.array([r.vector for r in fitted], np.float64).reshape(-1, dims)
    split = dims // 2
    halves = (centroids(learnt[:, :split], cells), centroids(learnt[:, split:], cells)) if len(learnt) else (np.zeros((1, split)), np.zeros((1, dims - split)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column(1))
                cell = nearest(m[:, :split], halves[0]) * len(halves[1]) + nearest(m[:, split:], halves[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["vec_id", "vector", "cell"])

    kind = rows.schema["vector"].dataType.simpleString()
    assigned = materialise(rows.mapInArrow(assign, f"vec_id long, vector {kind}, cell int"))
    counts = sorted((r.cell, r["count"]) for r in assigned.groupBy("cell").count().collect())  # cells * cells rows at most
    size = min(BLOCK_ROWS, max(1, -(-sum(n for _, n in counts) // BLOCKS)))
    places, block, filled = {}, 0, 0
    for cell, n in counts:
        if n > size:  # a cell of its own blocks, its rows dealt by hash
            block += filled > 0
            places[cell] = (block, -(-n // size), n)
            block, filled = block + places[cell][1], 0
        else:
            if filled + n > size:
                block, filled = block + 1, 0
            places[cell] = (block, 1, n)
            filled += n
    spark = vectors.sparkSession
    where = spark.createDataFrame([(c, first, parts) for c, (first, parts, _) in places.items()], "cell int, first_block int, parts int")
    entries = assigned.join(F.broadcast(where), "cell").select(
        "vec_id", "vector", "cell", (F.col("first_block") + F.pmod(F.xxhash64("vec_id"), "parts")).cast("int").alias("block"))
    return Index(entries, halves, places)


def search(index: Index, queries: DataFrame, k: int = 20, visit: float = 0.75) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest entries found for each row of ``queries`` (vec_id, vector), itself left out.

    Rows alike are one query; of several vectors under one vec_id each is a query. Other columns of ``queries`` are not read.

    A query visits the nearest ``visit`` of the cells that hold entries, and goes on until
    these hold ``k`` entries besides its own or no cell is left; all entries of a visited
    cell are ranked, however many. Ties go to the smaller vec_id.
    """
    halves, places = index.halves, index.places
    visited = max(1, math.ceil(visit * len(places)))
    kind = index.entries.schema["vector"].dataType.simpleString()

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            for q, (vector, own) in enumerate(zip(_matrix(batch.column(2)), batch.column(3).to_pylist(), strict=True)):
                blocks: dict[int, list[int]] = {}
                left, lacking = visited, k + own
                for cell in traversal(vector, halves):
                    if cell in places:
                        first, parts, held = places[cell]
                        for b in range(first, first + parts):
                            blocks.setdefault(b, []).append(cell)
                        left -= 1
                        lacking -= held
                        if left <= 0 and lacking <= 0:
                            break
                out += [(q, b, cells) for b, cells in blocks.items()]
            picked = batch.select([0, 1, 2]).take(pa.array([o[0] for o in out], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.list_(pa.int32()))],
                ["no", "query_id", "query", "block", "cells"])

    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")).distinct()
    own = index.entries.select(F.col("vec_id").alias("query_id")).join(asked.select("query_id"), "query_id", "left_semi").groupBy("query_id").agg(F.count("*").alias("own"))
    asked = materialise(asked.join(own, "query_id", "left").select(
        F.monotonically_increasing_id().alias("no"), "query_id", "query", F.coalesce("own", F.lit(0)).alias("own")))
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    planned = asked.mapInArrow(plan, f"no long, query_id long, query {kind}, block int, cells array<int>").withColumn(
        "part", F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int"))
    entries = index.entries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def rank(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, float]] = []
        if len(held) and len(wanted):
            m, ids, cell = np.array(held["vector"].tolist(), np.float64), held["vec_id"].to_numpy(), held["cell"].to_numpy()
            known, slot = np.unique(cell, return_inverse=True)
            for start in range(0, len(wanted), 256):
                some = wanted.iloc[start:start + 256]
                q = np.array(some["query"].tolist(), np.float64)
                scores = q @ m.T
                for row, (no, query_id, cells) in enumerate(zip(some["no"], some["query_id"], some["cells"], strict=True)):
                    s = np.where(np.isin(known, cells)[slot] & (ids != query_id), scores[row], -np.inf)
                    keep = min(k, len(s))
                    least = np.partition(s, len(s) - keep)[len(s) - keep]
                    near = np.flatnonzero((s >= least - 1e-9 * (1 + abs(least))) & (s > -np.inf)) if least > -np.inf else np.flatnonzero(s > -np.inf)
                    exact = (m[near] * q[row]).sum(axis=1)  # the same order of additions for equal vectors
                    best = np.lexsort((ids[near], -exact))[:k]
                    out += [(no, query_id, ids[near[b]], exact[b]) for b in best]
        return pd.DataFrame(out, columns=["no", "query_id", "vec_id", "score"])

    near = entries.groupBy("block", "part").cogroup(planned.groupBy("block", "part")).applyInPandas(rank, "no long, query_id long, vec_id long, score double")
    order = Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
