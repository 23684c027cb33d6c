"""Benchmark passages in documents, found by greedy string tiling.

A document's tokens matter only where runs of five equal a benchmark item's. A bitmap
of the benchmark's five-token hashes, of fixed size, finds those runs in one pass over
whole texts; what leaves the pass is small. The runs' five-token seeds are joined to
the items', pairs that share enough seeds are tiled: the longest common token runs
are marked first, found by rolling Karp-Rabin hashes of falling length, no token
twice. An item whose marked share reaches the threshold is in the document, in
whatever order its passages come.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import identified, materialise, pieces, utf8

SEED = 5
THRESHOLD = 0.8
#: The bitmap's bits. At 2**24 it takes 2 MB, whatever the benchmark; more seeds only let more through to the join.
BITMAP_BITS = 1 << 24

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Token -> 63-bit hash, remembered up to a bound."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[token] = h = xxhash.xxh64_intdigest(token) >> 1
        return h


_HASHES = _Hashes()


def tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's tokens: lower-cased runs of letters, digits and bytes outside ASCII."""
    out = [np.fromiter(map(_HASHES.__getitem__, _TOKEN.findall(p.lower())), np.int64) for p in pieces(text)]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def seeds(hashed: np.ndarray, n: int = SEED) -> np.ndarray:
    """The polynomial hash of each run of ``n`` tokens."""
    if len(hashed) < n:
        return np.empty(0, np.int64)
    h = np.zeros(len(hashed) - n + 1, np.uint64)
    for k in range(n):
        h = h * _BASE + hashed[k:len(hashed) - n + 1 + k].view(np.uint64)
    h ^= h >> np.uint64(29)
    return h.view(np.int64)


class _Rolling:
    """``seeds`` of one text for any length, in time that does not grow with the length: differences of prefix sums."""

    _INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def __init__(self, hashed: np.ndarray):
        n, one = len(hashed), np.ones(1, np.uint64)
        self.powers = np.cumprod(np.concatenate([one, np.full(n, _BASE)]))
        down = np.cumprod(np.concatenate([one, np.full(n, self._INVERSE)]))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed.view(np.uint64) * down[:n], dtype=np.uint64)])

    def seeds(self, n: int) -> np.ndarray:
        if len(self.prefix) <= n:
            return np.empty(0, np.int64)
        h = (self.prefix[n:] - self.prefix[:-n]) * self.powers[n - 1:-1]
        h ^= h >> np.uint64(29)
        return h.view(np.int64)


def tile(a: np.ndarray, b: np.ndarray, least: int = SEED) -> int:
    """Tokens of ``a`` that greedy string tiling with ``b`` marks, in tiles of ``least`` tokens or more.

    Of equally long matches the first in ``a`` is marked, with the first in ``b`` still unmarked. Empty sides mark
    nothing. Repetitive sides cost no more than others: a place is left once it is marked, pairs are never listed.
    """
    least = max(1, min(least, len(a)))
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    of_a, of_b = _Rolling(a), _Rolling(b)
    marked, most = 0, min(len(a), len(b))
    while length := _longest(of_a, of_b, free_a, free_b, most, least):
        # Karp-Rabin over stretches of unmarked tokens: equal hashes, then compared
        ha, hb = of_a.seeds(length), of_b.seeds(length)
        open_a, open_b = np.flatnonzero(_open(free_a, length)), np.flatnonzero(_open(free_b, length))
        open_b = open_b[np.isin(hb[open_b], ha[open_a])]
        places: dict[int, list[int]] = {}
        for j in reversed(open_b.tolist()):
            places.setdefault(int(hb[j]), []).append(j)
        for i in open_a[np.isin(ha[open_a], hb[open_b])].tolist():
            if not (free_a[i] and free_a[i + length - 1]):  # what was marked since is as long, so it covers an end
                continue
            at = places[int(ha[i])]  # the first place last
            while at and not (free_b[at[-1]] and free_b[at[-1] + length - 1]):
                at.pop()
            for j in reversed(at):
                if free_b[j] and free_b[j + length - 1] and (a[i:i + length] == b[j:j + length]).all():
                    free_a[i:i + length] = free_b[j:j + length] = False
                    marked += length
                    break
        most = length - 1
    return marked


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` tokens from each position are all unmarked."""
    total = np.concatenate([[0], np.cumsum(free)])
    return total[length:] - total[:-length] == length


def _longest(of_a: _Rolling, of_b: _Rolling, free_a, free_b, most: int, least: int) -> int:
    """The greatest length up to ``most`` at which unmarked stretches have an equal hash, by bisection; 0 if below ``least``."""
    def shared(n: int) -> bool:
        return bool(np.isin(of_a.seeds(n)[_open(free_a, n)], of_b.seeds(n)[_open(free_b, n)]).any())

    if most < least or not shared(least):
        return 0
    low, high = least, most
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if shared(middle) else (low, middle - 1)
    return low


def _bitmap(items: DataFrame) -> np.ndarray:
    """One bit for each seed's hash. Slices of it are merged on the executors; the driver gets its fixed size."""
    bits = BITMAP_BITS
    spots = items.select(F.explode("seeds").alias("h")).select(F.pmod("h", F.lit(bits)).alias("bit")).distinct()
    words = spots.groupBy(F.expr("bit div 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("mask")).collect()
    out = np.zeros(bits // 32, np.uint32)
    for word, mask in words:
        out[word] = mask
    return out


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, tokens, seeds) of items that have tokens; an item shorter than a seed is one shorter seed. Repeated items count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = [tokens(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            grams = [seeds(h, min(SEED, max(1, len(h)))) for h in hashed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h.tolist() for h in hashed], pa.list_(pa.int64())), pa.array([g.tolist() for g in grams], pa.list_(pa.int64()))],
                ["item_id", "tokens", "seeds"])

    rows = benchmark.select(F.col("item_id").cast("long"), utf8(F.col("text")).alias("b"))
    return rows.mapInArrow(run, "item_id long, tokens array<long>, seeds array<long>").where("size(tokens) > 0").distinct()


def _tiled(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """(_did, _th, doc_id, item_id, marked, item_tokens) of each pair of a document's row and an item that reaches ``threshold``."""
    items = materialise(items_of(benchmark).withColumn("item", F.monotonically_increasing_id()))
    bitmap = _bitmap(items)
    shortest = [r[0] for r in items.select(F.least(F.size("tokens"), F.lit(SEED))).distinct().collect()]  # at most five lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, list[int], list[int]]] = []
            for row, text in enumerate(batch.column(3)):
                hashed = tokens(text.as_buffer().to_pybytes())
                held, grams = np.zeros(len(hashed), bool), []
                for n in shortest:
                    g = seeds(hashed, n)
                    spot = (g % BITMAP_BITS)  # numpy's remainder is not negative, like pmod
                    hit = np.flatnonzero(bitmap[spot >> 5] >> (spot & 31).astype(np.uint32) & 1)
                    for k in range(n):
                        held[hit + k] = True
                    grams.append(g[hit])
                if held.any():
                    # runs of covered tokens, a zero between them that equals no token
                    edge = np.flatnonzero(np.diff(held.astype(np.int8), prepend=0) == 1)
                    kept = np.flatnonzero(held)
                    spaced = np.insert(hashed[kept], np.searchsorted(kept, edge), -1)
                    out.append((row, spaced.tolist(), np.unique(np.concatenate(grams)).tolist()))
            picked = batch.select([0, 1, 2]).take(pa.array([o[0] for o in out], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array([o[1] for o in out], pa.list_(pa.int64())), pa.array([o[2] for o in out], pa.list_(pa.int64()))],
                ["_did", "_th", "doc_id", "run", "seeds"])

    read = identified(docs).select("_did", "_th", F.col("doc_id").cast("long"), utf8(F.col("text")).alias("b"))
    runs = read.mapInArrow(run, "_did long, _th long, doc_id long, run array<long>, seeds array<long>")
    runs = materialise(runs.withColumn("row", F.monotonically_increasing_id()))
    # seeds that a document must share with an item: tiles of five tokens or more that cover the threshold
    wanted = items.select("item", F.size("tokens").alias("n"), F.posexplode("seeds").alias("at", "h"))
    shared = runs.select("row", F.explode("seeds").alias("h")).join(wanted, "h").groupBy("row", "item", "n").agg(F.count("*").alias("shared"))
    pairs = shared.where(F.col("shared") >= F.ceil(F.col("n") * threshold / SEED))

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = [tile(np.array(a, np.int64), np.array(b, np.int64)) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            n = [len(a) for a in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(marked, pa.int32()), pa.array(n, pa.int32())], ["_did", "_th", "doc_id", "item_id", "marked", "item_tokens"])

    sides = pairs.join(runs.drop("seeds"), "row").join(items.select("item", "item_id", "tokens"), "item")
    found = sides.select("_did", "_th", "doc_id", "item_id", "tokens", "run").mapInArrow(
        tiled, "_did long, _th long, doc_id long, item_id long, marked int, item_tokens int")
    return found.where(F.col("marked") >= F.col("item_tokens") * threshold)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, marked, item_tokens, coverage) of each item of which tiles mark at least ``threshold`` in a document.

    Null and empty texts match nothing. Documents that share a doc_id are each tried
    and the best coverage counts; a null doc_id is reported as null. Items shorter than
    five tokens must occur whole. An empty table on either side gives an empty result.
    """
    best = _tiled(docs, benchmark, threshold).groupBy("doc_id", "item_id").agg(F.max(F.struct("marked", "item_tokens")).alias("best"))
    return best.select("doc_id", "item_id", "best.*").withColumn("coverage", F.col("marked") / F.col("item_tokens"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay."""
    found = _tiled(docs, benchmark, threshold).select("_did", "_th").distinct()
    return identified(docs).join(found, ["_did", "_th"], "left_anti").select(docs.columns)
