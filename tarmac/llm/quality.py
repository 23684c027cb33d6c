"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on good labelled text, one on bad. A text is compressed in
blocks with each; ``(bad - good) / (bad + good)`` of the two sizes, and their mean per byte
(endless repetition shrinks to nothing with either), are put through a logistic
curve fitted on labelled texts that the dictionaries in use have not seen.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import logistic, sigmoid, utf8

DICTIONARY_BYTES = 262_144
BLOCK = 2048
#: Blocks of one text, evenly spread, that a dictionary is trained on: long texts should not fill it.
BLOCKS_LEARNT = 8


class Model(NamedTuple):
    """Two dictionaries and the curve: weights of a text's features, and a bias."""

    good: bytes
    bad: bytes
    curve: tuple[float, ...]


class Sample(NamedTuple):
    """Labelled texts, and how many times commoner label 1 is (as odds) among all labelled rows than among these."""

    rows: list[tuple[bytes, int]]
    odds: float = 1.0


def _sketch(text: bytes) -> int:
    words = text.split()
    return min((xxhash.xxh64_intdigest(b" ".join(g)) for g in zip(words, words[1:], words[2:], strict=False)), default=xxhash.xxh64_intdigest(text))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep, per_class: int, max_bytes: int) -> Sample:
    """At most ``per_class`` labelled texts of each class of at most ``max_bytes`` bytes, the same ones on each run.

    ``keep`` is the condition on doc_id that says which rows may be learnt from. Rows
    without a label of 0 or 1 are left out; of a doc_id labelled twice the larger
    counts; of several texts under it the one with the smallest hash. Copies would count for many: of texts with one
    smallest shingle hash the first is taken.
    """
    rows = (labels.where(F.col(label).isin(0, 1) & keep).groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = None
    for y in (0, 1):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", utf8(F.col("text")).alias("b")).where(F.length("b").between(1, max_bytes))
    # at most 2 * per_class ids, and one text of each
    one = F.min_by("b", F.struct(F.xxhash64("b"), "b")).alias("b")
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(one).collect()
    once: dict[tuple, tuple[bytes, int]] = {}
    for r in sorted(found, key=lambda r: (r.doc_id, bytes(r.b))):
        once.setdefault((_sketch(bytes(r.b)), r.y), (bytes(r.b), r.y))
    out = list(once.values())
    whole = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    taken = Counter(y for _, y in out)
    odds = whole[1] / whole[0] * taken[0] / taken[1] if taken[0] and taken[1] else 1.0
    return Sample(out, odds)


def _blocks(text: bytes) -> Iterator[bytes]:
    for k in range(0, len(text), BLOCK):
        yield text[k:k + BLOCK]


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = []
    for text in texts:
        own = list(_blocks(text))
        blocks += own[::-(-len(own) // BLOCKS_LEARNT)] if own else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself is the dictionary
        return b"".join(blocks)[:DICTIONARY_BYTES]


@functools.lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=3, **plain)
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), **plain)


def _features(text: bytes, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """The normalised difference, the same weighted by shortness, and the mean compressed size per byte."""
    a, b = _compressor(good), _compressor(bad)
    g = h = 0
    for block in _blocks(text):
        g += len(a.compress(block))
        h += len(b.compress(block))
    x = (h - g) / (h + g) if g + h else 0.0
    return x, x * min(1.0, 512 / (len(text) + 1)), (h + g) / 2 / max(1, len(text))


def fit(labelled: Sample) -> Model:
    """Dictionaries from all the sample; the curve from its two halves, each scored with the other half's dictionaries.

    With one class only, or no rows, the curve is constant: the class seen, or one half.
    """
    sample = labelled.rows
    halves = [sample[0::2], sample[1::2]]
    pick = lambda rows, y: _dictionary([t for t, v in rows if v == y])
    x, y = [], []
    for learnt, scored in (halves, halves[::-1]):
        good, bad = pick(learnt, 1), pick(learnt, 0)
        x += [_features(t, good, bad) for t, _ in scored]
        y += [v for _, v in scored]
    x = np.array(x).reshape(-1, 3)
    middle, spread = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(3), np.ones(3))
    curve = logistic((x - middle) / spread, np.array(y, float), ridge=1e-2)
    curve[:-1] /= spread
    curve[-1] += math.log(labelled.odds) - curve[:-1] @ middle
    return Model(pick(sample, 1), pick(sample, 0), tuple(float(w) for w in curve))


def score_text(text: bytes, model: Model) -> float:
    """The score of one text; an empty text gets the curve's value at sizes of zero."""
    return sigmoid(sum(w * x for w, x in zip(model.curve, (*_features(text, model.good, model.bad), 1.0), strict=True)))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with a column ``into`` from 0 to 1 over whole texts; a null text counts as empty.

    All columns and rows stay, repeated rows too; a column already named so is replaced.
    """
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([score_text(bytes(t), model) for t in texts], dtype="float64")

    return docs.withColumn(into, scored(utf8(F.col("text"))))


def train(docs: DataFrame, labels: DataFrame, keep, per_class: int = 2000, max_bytes: int = 65_536) -> Model:
    """Fits on at most ``per_class`` labelled texts of each class, each of at most ``max_bytes`` bytes."""
    return fit(labelled_sample(docs, labels, "quality", keep, per_class, max_bytes))
