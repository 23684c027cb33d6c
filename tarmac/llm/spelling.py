"""Groups spelling variants: words one edit apart, each led to its commonest neighbour.

The words are cut into blocks by length, each packed into one row. Of two blocks of one
length, or of lengths one apart, a task multiplies the letter-count matrices, with the
squared lengths as two further columns: ``|a|^2 + |b|^2 - 2 ab`` are all squared distances
of letter counts at once. An inserted or deleted letter makes the distance 1 and a
replaced one 2, so pairs above two are dropped; the rest are compared letter by letter.
A task returns, for each word, how many neighbours it met and the commonest of them, never
the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, pieces, utf8

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How many times commoner than a word its form is.
RATIO = 5
#: One in this many runs of a document loses a letter, by the hash of the two.
DAMAGED = 199
#: Words of one block at most, and letters of it.
BLOCK_WORDS = 8192
BLOCK_LETTERS = 1 << 22
#: Words that a task counts before it passes the counts on.
COUNTED = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def damaged(doc_id: str, word: str) -> str:
    """``word`` as read in a document: without one letter if the hash of both says so."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % DAMAGED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of whole texts with at least so many letters and occurrences.

    A null or empty text has none; repeated rows count each; a null doc_id is hashed as empty text.
    Counts are combined in each task before they are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for piece in pieces(text.as_buffer().to_pybytes()):
                    for word, n in Counter(_RUN.findall(piece.lower().decode("utf-8", "replace"))).items():
                        read = damaged(doc_id, word)
                        if len(read) >= least_length:
                            total[read] += n
                    if len(total) > COUNTED:
                        yield flushed()
        yield flushed()

    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), utf8(F.col("text")).alias("b"))
    counted = read.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(rows: list[str]) -> np.ndarray:
    """A row of letter codes for each word of one length; all letters are below 256."""
    return np.frombuffer("".join(rows).encode("latin-1"), np.uint8).reshape(len(rows), -1)


def _counts(letters: np.ndarray) -> np.ndarray:
    """Letter counts of each word in 32 columns. Letters that share a column only bring counts nearer, so no pair is lost.
    Whole numbers: in single precision exact while two squared lengths are below 2**24."""
    n, length = letters.shape
    spots = (np.arange(n)[:, None] * 32 + (letters & 31)).ravel()
    return np.bincount(spots, minlength=n * 32).reshape(n, 32).astype(np.float32 if length < 2000 else np.float64)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` are one edit apart: one letter differs, or ``b`` has one letter more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def near_pairs(left: list[str], right: list[str] | None, rows: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs one edit apart: within ``left``, or between it and ``right`` of the same length or one letter longer."""
    a = _letters(left)
    b = a if right is None else _letters(right)
    x, y = _counts(a), _counts(b)
    x = np.column_stack([-2 * x, (x * x).sum(axis=1), np.ones(len(x), x.dtype)])
    y = np.column_stack([y, np.ones(len(y), y.dtype), (y * y).sum(axis=1)]).T.copy()
    step = max(1, (1 << 22) // max(1, a.shape[1]))
    for start in range(0, len(a), rows):
        i, j = np.divmod(np.flatnonzero(x[start:start + rows] @ y <= 2), len(b))
        i += start
        if right is None:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), step):
            p, q = i[k:k + step], j[k:k + step]
            fine = _one_edit(a[p], b[q])
            yield p[fine], q[fine]


_MET = "word string, n_near long, best_n long, best string"


def _met(group: pa.Table) -> pa.Table:
    """What the words of a pair of blocks, the shorter words first, or of one block alone, met in it."""
    blocks = sorted(group.to_pylist(), key=lambda r: r["side"])
    names = [r["words"].split("\n") for r in blocks]
    pairs = list(near_pairs(names[0], names[1] if len(names) > 1 else None)) if len(blocks) > 1 or blocks[0]["alone"] else []
    flat = np.array([w for block in names for w in block], object)
    n = np.concatenate([np.array(r["n"], np.int64) for r in blocks])
    i, j = (np.concatenate([np.empty(0, np.int64), *(p[k] for p in pairs)]) for k in (0, 1))
    j += len(names[0]) if len(names) > 1 else 0
    own, other = np.concatenate([i, j]), np.concatenate([j, i])
    place = np.empty(len(flat), np.int64)
    place[np.argsort(flat)] = np.arange(len(flat))  # by code points
    order = np.lexsort((place[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    columns = [flat[own[first]].tolist(), np.diff(first, append=len(own)), n[other[first]], flat[other[first]].tolist()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["word", "n_near", "best_n", "best"])


def neighbours(counted: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of words that have a neighbour: their number, and the commonest (ties: smallest in code points).

    ``counted`` is a stored (word, n) of distinct words. Words of one length are dealt to blocks by hash,
    at most about ``block`` words or ``BLOCK_LETTERS`` letters; a task holds two blocks.
    """
    sized = counted.withColumn("length", F.length("word"))
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(BLOCK_LETTERS) / F.col("length"))))
    # one row per word length
    lengths = sized.groupBy("length").agg(F.count("*").alias("words")).select("length", F.ceil(F.col("words") / most).cast("int").alias("parts"))
    longer = lengths.select((F.col("length") - 1).alias("length"), F.col("parts").alias("longer"))
    shorter = lengths.select((F.col("length") + 1).alias("length"), F.col("parts").alias("shorter"))
    around = lengths.join(longer, "length", "left").join(shorter, "length", "left").na.fill(0)
    placed = sized.join(around, "length").withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    # a row per block
    packed = placed.groupBy("length", "part", "parts", "longer", "shorter").agg(F.collect_list(F.struct("word", "n")).alias("held")).withColumns(
        {"words": F.array_join("held.word", "\n"), "n": F.col("held.n")})

    def spread(parts, make):
        """A struct (low, a, b, gap, side, alone) for each block that the word's block meets."""
        return F.when(parts > 0, F.transform(F.sequence(F.lit(0), parts - 1), make)).otherwise(F.array())

    def meeting(low, a, b, gap, side, alone):
        return F.struct(low.alias("low"), a.alias("a"), b.alias("b"), F.lit(gap).alias("gap"), side.alias("side"), alone.alias("alone"))

    part, length, no = F.col("part"), F.col("length"), F.lit(False)
    same = spread(F.col("parts"), lambda k: meeting(length, F.least(part, k), F.greatest(part, k), 0, (part > k).cast("int"), part == k))
    up = spread(F.col("longer"), lambda k: meeting(length, part, k, 1, F.lit(0), no))
    down = spread(F.col("shorter"), lambda k: meeting(length - 1, k, part, 1, F.lit(1), no))
    rows = packed.select("words", "n", F.explode(F.concat(same, up, down)).alias("at")).select("words", "n", "at.*")
    found = rows.groupBy("low", "a", "b", "gap").applyInArrow(_met, _MET)
    # the smallest of (-n, word) is the commonest neighbour, ties to the smaller word
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("least")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("least.m")).alias("best_n"), F.col("least.best").alias("best"))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that ``words`` gives.

    ``form`` is the word's commonest neighbour if that occurs ``ratio`` times as often or more, else null;
    ``root`` follows forms to the last. Forms grow commoner at each step, so there are no circles; roots are
    found by doubling the steps. An empty table, or texts without such words, give an empty result.
    """
    if ratio < 2:
        raise ValueError("a form has to be commoner than its word")
    counted = materialise(words(docs, least_length, least_count))
    close = F.coalesce(F.col("best_n") >= F.col("n") * ratio, F.lit(False))
    led = materialise(counted.join(neighbours(counted), "word", "left").select(
        "word", F.when(close, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(close, F.col("best_n")).alias("form_n")))
    most = led.agg(F.max("n")).first()[0] or least_count
    steps = max(1, math.ceil(math.log(max(most / least_count, 1), ratio)))  # the longest chain of forms
    root = led.select("word", F.coalesce("form", "word").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        further = root.select(F.col("word").alias("root"), F.col("root").alias("further"))
        root = materialise(root.join(further, "root").select("word", F.col("further").alias("root")))
    return led.join(root, "word").select("word", "form", "root", "n", "n_near", "form_n")
