"""Ranked lexical search by the Best Position Algorithm.

Documents are dealt to shards; a shard holds, for each query term, the list of its
documents by falling impact. A query reads its lists from the top. Each document met is
looked up directly in the query's other lists, which gives its whole score and the
positions where it stands in them. A list's best position is the end of its unbroken
run of positions seen, by reading or by look-up; no document outside can score more
than the impacts at the best positions together. A shard stops when that bound is
strictly below its kth score. Impacts are whole numbers, so scores are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, pieces, utf8

#: Bits of the map of query terms: 2 MB, whatever the queries. More terms only let more through to the exact look-up.
BITMAP_BITS = 1 << 24
#: Postings of one shard, and (item, term) rows of one block of queries, about.
SHARD_POSTINGS = 500_000
QUERY_ROWS = 200_000
#: Positions that a query reads from each list at a time.
STEP = 32

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


class _Wanted(dict):
    """Term -> whether the map of query terms has its bit, remembered up to a bound."""

    def __init__(self, bitmap: np.ndarray):
        super().__init__()
        self.bitmap = bitmap

    def __missing__(self, term: bytes) -> bool:
        if len(self) > 150_000:
            self.clear()
        spot = xxhash.xxh64_intdigest(term, 42) % BITMAP_BITS
        self[term] = known = bool(self.bitmap[spot >> 5] >> np.uint32(spot & 31) & 1)
        return known


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, term, q): terms of each item with their number of times. Rows alike count as one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms, times = [], [], []
            for row, text in enumerate(batch.column(2)):
                counted = Counter(t for p in pieces(text.as_buffer().to_pybytes()) for t in _TERM.findall(p.lower()))
                rows += [row] * len(counted)
                terms += counted
                times += counted.values()
            picked = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(terms, pa.binary()), pa.array(times, pa.int64())], ["item", "item_id", "term", "q"])

    rows = benchmark.select(F.col("item_id").cast("long"), utf8(F.col("text")).alias("b")).distinct()
    return rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "b").mapInArrow(run, "item long, item_id long, term binary, q long")


def _bitmap(queries: DataFrame) -> np.ndarray:
    """One bit for each query term's hash; the driver gets at most its fixed size."""
    spots = queries.select(F.pmod(F.xxhash64("term"), F.lit(BITMAP_BITS)).alias("bit"))
    masks = spots.groupBy(F.expr("bit div 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("mask")).collect()
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    for word, mask in masks:
        out[word] = mask
    return out


def postings(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(row, doc_id, n, terms, tf) of each document with terms: how many it has, and those the map lets through with their number of times.

    A document's row is no longer than the query terms it holds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(bitmap)
        for batch in batches:
            rows, sizes, terms, times = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                n, held = 0, Counter()
                for piece in pieces(text.as_buffer().to_pybytes()):
                    found = _TERM.findall(piece.lower())
                    n += len(found)
                    for term, tf in Counter(found).items():
                        if wanted[term]:
                            held[term] += tf
                if n:
                    rows.append(row)
                    sizes.append(n)
                    terms.append(list(held))
                    times.append(list(held.values()))
            picked = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                ["row", "doc_id", "n", "terms", "tf"])

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), utf8(F.col("text")).alias("b"))
    return read.mapInArrow(run, "row long, doc_id long, n long, terms array<binary>, tf array<long>")


class Lists:
    """One shard's impact lists, one behind the other, and each document's places in them."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        """``doc`` rises: entry by entry the document, its term and the impact."""
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self.place = np.empty(len(order), np.int64)  # entry of a document -> position in the lists
        self.place[order] = np.arange(len(order))
        self.first = np.searchsorted(doc, np.arange(docs + 1))
        self.term = term

    def looked_up(self, found: np.ndarray) -> np.ndarray:
        """All entries of these documents."""
        sizes = self.first[found + 1] - self.first[found]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[found] - ends + sizes, sizes)

    def best(self, terms: np.ndarray, times: np.ndarray, names: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents met) of the ``k`` highest, equal scores by ``names``."""
        weight = np.zeros(len(self.start) - 1, np.int64)
        weight[terms] = times
        at, end = self.start[terms].copy(), self.start[terms + 1]
        seen, met = np.zeros(len(self.doc), bool), np.zeros(len(self.first) - 1, bool)
        top, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        while True:
            open_lists = np.flatnonzero(at < end)
            if not len(open_lists):
                break
            read = np.concatenate([np.arange(at[l], min(at[l] + step, end[l])) for l in open_lists])
            new = np.unique(self.doc[read])
            new = new[~met[new]]
            met[new] = True
            entries = self.looked_up(new)
            own = np.repeat(np.arange(len(new)), self.first[new + 1] - self.first[new])
            q = weight[self.term[entries]]
            entries, own, q = entries[q > 0], own[q > 0], q[q > 0]
            places = self.place[entries]
            seen[places] = True
            gained = np.zeros(len(new), np.int64)
            np.add.at(gained, own, q * self.impact[places])
            top, scores = np.concatenate([top, new]), np.concatenate([scores, gained])
            if len(top) > k:
                kept = np.lexsort((names[top], -scores))[:k]
                top, scores = top[kept], scores[kept]
            bound = 0
            for l in open_lists:
                gap = np.flatnonzero(~seen[at[l] + step:end[l]][:4096])  # what was read is seen
                ahead = min(at[l] + step, end[l])
                at[l] = ahead + (gap[0] if len(gap) else min(4096, end[l] - ahead))
                if at[l] < end[l]:
                    bound += int(times[l]) * int(self.impact[at[l] - 1])
            if len(top) == k and bound < scores.min():
                break
        return top, scores, int(met.sum())


def _ranked(held: pa.Table, asked: pa.Table, k: int, total: tuple[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, documents, scores) of the ``k`` best of a shard for each item asked."""
    vocabulary = pc.unique(asked["term"])
    weight = np.zeros(len(vocabulary), np.int64)
    of = pc.index_in(asked["term"], value_set=vocabulary).to_numpy()
    weight[of] = asked["w"].to_numpy()
    lists, times = (pa.concat_arrays(held[c].chunks) for c in ("terms", "tf"))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    term = pc.fill_null(pc.index_in(lists.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(held.num_rows), sizes)
    tf = times.flatten().to_numpy(zero_copy_only=False)
    doc, tf, term = doc[term >= 0], tf[term >= 0], term[term >= 0]
    documents, words = total
    m = 75 + (25 * documents * held["n"].to_numpy()) // max(1, words)
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    shard = Lists(doc, term, impact, held.num_rows, len(vocabulary))
    ids = held["doc_id"].to_pylist()
    # the order of equal scores: by doc_id, null last, then by row
    names = np.empty(held.num_rows, np.int64)
    names[sorted(range(len(ids)), key=lambda d: (ids[d] is None, ids[d] or 0, d))] = np.arange(len(ids))
    item, q = asked["item"].to_numpy(), asked["q"].to_numpy()
    order = np.argsort(item, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(item[order])) + 1) if len(order) else ():
        top, scores, _ = shard.best(of[rows], q[rows], names, k)
        keep = scores > 0
        yield int(item[rows[0]]), top[keep], scores[keep]


def search(docs: DataFrame, benchmark: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0, equal scores by ascending doc_id.

    A null or empty text has no terms: such a document is in no count, such an item finds nothing. Every row of
    ``docs`` is a document, so repeated rows rank one behind the other, and a null doc_id comes after the others.
    Items alike in id and text are one; of several texts under one id each is ranked on its own.
    An empty table on either side gives an empty result.
    """
    queries = materialise(items_of(benchmark))
    held = materialise(postings(docs, _bitmap(queries)))
    documents, words, found = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1))).alias("w")
    weighed = materialise(queries.join(queries.select("term").distinct().join(df, "term").select("term", w), "term"))
    shards = max(1, -(-found // SHARD_POSTINGS))
    blocks = max(1, -(-weighed.count() // QUERY_ROWS))
    whole = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = held.select("*", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")).withColumn("block", whole(blocks))
    # the stated query set meets every shard, a block of items at a time
    right = weighed.select("item", "term", "q", "w", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")).withColumn("shard", whole(shards))

    def ranked(mine: pa.Table, asked: pa.Table) -> pa.Table:
        items, rows, ids, scores = [], [], [], []
        if mine.num_rows and asked.num_rows:
            mine = mine.sort_by([("row", "ascending")])
            names, numbers = mine["doc_id"].to_pylist(), mine["row"].to_numpy()
            for item, top, values in _ranked(mine, asked, k, (documents, words)):
                items += [item] * len(top)
                rows += numbers[top].tolist()
                ids += [names[d] for d in top.tolist()]
                scores += values.tolist()
        return pa.table({"item": pa.array(items, pa.int64()), "row": pa.array(rows, pa.int64()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    top = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(ranked, "item long, row long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
