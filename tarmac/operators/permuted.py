"""Exact ROC-AUC of a linear score after one column was permuted, for many columns and permutations at once.

Rows are numbered 0 .. n - 1; a permutation sends number i to (i * factor + shift) mod n. Values travel packed by
block of target numbers, scores packed by range of scores, so that there are two shuffles whatever the number of
permutations, of a few bytes more than the values and the scores take. A task holds a block or a range at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators import metrics
from tarmac.session import materialise

#: Target numbers of a block: a power of two, at most 65536, as places in a block are sent in two bytes.
BLOCK = 1 << 14
#: Scores of a range, about. Where it is cut decides how evenly tasks are loaded, not the result.
RANGE = 1 << 19
#: Records in one batch of packed values.
_RECORDS = 256

_VALUES = "block int, counts binary, places binary, cells binary, own_places binary, own_cells binary"
_SCORES = "case int, range int, pos binary, pos_n binary, neg binary, neg_n binary"
_COUNTS = "case int, range int, pos bigint, neg bigint, twice_wins bigint"


@dataclass(frozen=True)
class Terms:
    """Each column's term of the log-odds, weight * ((x - mean) * scale), and the intercept."""
    weights: Sequence[float]
    means: Sequence[float]
    scales: Sequence[float]
    intercept: float

    def of(self, k: int, x: np.ndarray) -> np.ndarray:
        return self.weights[k] * ((x - self.means[k]) * self.scales[k])


def _sender(columns: Sequence[str], n: int, factors: np.ndarray, shifts: np.ndarray):
    """Packs a batch's values by the blocks they go to under each permutation, and its rows by their own."""
    width, repeats = factors.shape
    cases = width * repeats
    blocks = -(-n // BLOCK)
    narrow = np.uint16 if blocks <= 1 << 16 else np.int64  # 16 bits are sorted by radix

    def packed(i: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        to = ((i * factors.reshape(-1, 1) + shifts.reshape(-1, 1)) % n).ravel()
        block = to // BLOCK
        order = np.argsort(block.astype(narrow), kind="stable")
        places = (to % BLOCK).astype(np.uint16)[order]
        values = np.repeat(cells[:width], repeats, axis=0).ravel()[order]
        case = np.repeat(np.arange(cases), len(i))
        met, slot = np.unique(block, return_inverse=True)
        counts = np.bincount(slot * cases + case, minlength=len(met) * cases).reshape(-1, cases).astype(np.int32)
        ends = np.cumsum(counts.sum(axis=1))
        home = i // BLOCK
        names = [part.split()[0] for part in _VALUES.split(", ")]
        rows = []
        for k, b in enumerate(met):
            here = slice(ends[k - 1] if k else 0, ends[k])
            rows.append((int(b), counts[k].tobytes(), places[here].tobytes(), values[here].tobytes(), b"", b""))
        for b in np.unique(home):
            own = home == b
            rows.append((int(b), b"", b"", b"", (i[own] % BLOCK).astype(np.uint16).tobytes(), cells[:, own].tobytes()))
        for at in range(0, len(rows), _RECORDS):
            some = zip(*rows[at:at + _RECORDS])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if c == "block" else pa.binary()) for c, x in zip(names, some)], names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                if size and size + part.num_rows > BLOCK:
                    yield from packed(*_arrays(held, columns))
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield from packed(*_arrays(held, columns))

    return send


def _arrays(batches: Sequence[pa.RecordBatch], columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, and the columns and the label one below the other; an unknown label is NaN."""
    table = pa.Table.from_batches(batches)
    return table["_i"].to_numpy(), np.stack([table[c].to_numpy() for c in [*columns, "label"]])


def _packed_scores(scores: np.ndarray, cuts: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Scores of each range in order, and how often each comes if many are equal, else no numbers."""
    scores = np.sort(scores)
    first = np.ones(len(scores), bool)
    first[1:] = scores[1:] != scores[:-1]
    many = 2 * np.count_nonzero(first) <= len(scores)
    if many:
        starts = np.flatnonzero(first)
        times, scores = np.diff(starts, append=len(scores)).astype(np.int32), scores[starts]
    ends = [0, *np.searchsorted(scores, cuts, side="left"), len(scores)]
    return [(scores[a:b].tobytes(), times[a:b].tobytes() if many else b"") for a, b in zip(ends, ends[1:])]


def _scorer(width: int, repeats: int, n: int, terms: Terms, cuts: np.ndarray):
    """Scores the rows of a block with the values that arrived, and packs the scores by range."""
    cases = width * repeats

    def score(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(BLOCK, n - key[0].as_py() * BLOCK)
        arrived, own = np.empty((cases, size)), np.empty((width + 1, size))
        for batch in batches:
            for counts, places, cells, own_places, own_cells in zip(*[batch.column(c).to_pylist() for c in range(1, 6)]):
                if counts:
                    case = np.repeat(np.arange(cases), np.frombuffer(counts, np.int32))
                    arrived[case, np.frombuffer(places, np.uint16)] = np.frombuffer(cells)
                else:
                    at = np.frombuffer(own_places, np.uint16)
                    own[:, at] = np.frombuffer(own_cells).reshape(width + 1, len(at))
        pos, neg = own[width] == 1, own[width] == 0
        term = [terms.of(k, own[k]) for k in range(width)]
        names = [part.split()[0] for part in _SCORES.split(", ")]
        for k in range(width):
            rest = np.full(size, terms.intercept)
            for other in range(width):
                if other != k:
                    rest += term[other]
            rows = []
            for case in range(k * repeats, (k + 1) * repeats):
                with np.errstate(over="ignore"):
                    scores = 1 / (1 + np.exp(-(rest + terms.of(k, arrived[case]))))
                sides = zip(_packed_scores(scores[pos], cuts), _packed_scores(scores[neg], cuts))
                rows += [(case, r, *p, *q) for r, (p, q) in enumerate(sides) if p[0] or q[0]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if c in ("case", "range") else pa.binary())
                                                  for c, x in zip(names, zip(*rows))], names)

    return score


def _ranked(values: Sequence[bytes], times: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All scores in order and how often each comes; the same score may come in several entries."""
    parts = [np.frombuffer(x) for x in values]
    scores = np.concatenate(parts)
    if not any(times):
        return np.sort(scores), np.ones(len(scores), np.int64)
    weights = np.concatenate([np.frombuffer(t, np.int32) if t else np.ones(len(x), np.int32) for x, t in zip(parts, times)])
    order = np.argsort(scores)
    return scores[order], weights[order].astype(np.int64)


def _count(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positives, negatives and twice the pairs won within a range, a tie being half a win."""
    packed = pa.Table.from_batches(list(batches))
    (pos, pos_n), (neg, neg_n) = [_ranked(packed[c].to_pylist(), packed[f"{c}_n"].to_pylist()) for c in ("pos", "neg")]
    below = np.concatenate([[0], np.cumsum(neg_n)])
    twice = (pos_n * (below[np.searchsorted(neg, pos, "left")] + below[np.searchsorted(neg, pos, "right")])).sum()
    yield pa.RecordBatch.from_pylist([{"case": key[0].as_py(), "range": key[1].as_py(), "pos": int(pos_n.sum()),
                                       "neg": int(neg_n.sum()), "twice_wins": int(twice)}],
                                     pa.schema([("case", pa.int32()), ("range", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("twice_wins", pa.int64())]))


def permuted_auc(base: DataFrame, n: int, columns: Sequence[str], terms: Terms, factors: Sequence[Sequence[int]],
                 shifts: Sequence[Sequence[int]], cuts: Sequence[float] = ()) -> DataFrame:
    """(case, roc_auc) of the score with one column's values sent to other rows.

    Case ``k * repeats + r`` is column ``k`` under its permutation ``r``. ``base`` holds ``_i``, the columns and
    ``label``; ``cuts`` are the inner bounds of the ranges of scores. Every row is scored in every case; ties are
    half a win, and the result is NULL where a class is absent.
    """
    width, repeats = len(columns), len(factors[0])
    cells = base.select("_i", *[F.col(c).cast("double").alias(c) for c in columns],
                        F.coalesce(F.col("label").cast("double"), F.lit(float("nan"))).alias("label"))
    sent = cells.mapInArrow(_sender(columns, n, np.array(factors, np.int64), np.array(shifts, np.int64)), _VALUES)
    blocks = max(1, -(-n // BLOCK))
    scored = sent.repartition(blocks, "block").groupBy("block").applyInArrow(
        _scorer(width, repeats, n, terms, np.array(cuts, float)), _SCORES)
    groups = width * repeats * (len(cuts) + 1)
    counted = scored.repartition(max(1, groups // 8), "case", "range").groupBy("case", "range").applyInArrow(_count, _COUNTS)
    # A row per case and range from here on.
    lower = F.coalesce(F.sum("neg").over(Window.partitionBy("case").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wins = F.col("twice_wins") + 2 * F.col("pos") * lower
    sums = materialise(counted).withColumn("wins", wins).groupBy("case").agg(*[F.sum(c).cast("double").alias(c) for c in ("wins", "pos", "neg")])
    return sums.select("case", F.try_divide(F.col("wins"), 2 * F.col("pos") * F.col("neg")).alias("roc_auc"))


def auc(scored: DataFrame) -> float | None:
    """ROC-AUC by the same whole numbers as ``permuted_auc``, so that equal scores give equal results."""
    ranked = metrics.ranked_scores(metrics.score_counts(scored, prediction="predicted"))
    wins = F.sum(F.col("pos") * (2 * (F.col("total_neg") - F.col("before_neg")) - F.col("neg"))).cast("double")
    pairs = 2 * F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    return ranked.agg(F.try_divide(wins, pairs)).first()[0]
