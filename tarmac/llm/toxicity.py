"""Toxicity by a weighted lexicon, matched in one pass over folded text.

Folding lower-cases, strips accents and invisible characters, and undoes homoglyphs
and digit substitutions. The lexicon holds words and beginnings of words with their
log-odds, learnt from labelled text; an Aho-Corasick automaton finds them all. Hits
inside exception phrases do not count. The sum of weights, divided by the logarithm
of the text's length, goes through a fitted logistic curve.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import logistic, sigmoid
from tarmac.llm.quality import Sample, labelled_sample

#: Look-alikes of Latin letters, Cyrillic and Greek.
HOMOGLYPHS = dict(zip("асԁеһіјӏорԛѕԝхуαεικνορτυχ", "acdehijlopqswxyaeiknoptux", strict=True))
DIGITS = dict(zip("013457@$", "oieastas", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "idiot proof", "sore loser rule", "pond scum")


def _table() -> dict[int, str | None]:
    out: dict[int, str | None] = {}
    for code in [*range(0xC0, 0x250), *range(0xFF01, 0xFF5F)]:  # Latin letters with marks, full-width forms
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        out[code] = plain
    out |= {ord(k): v for k, v in (HOMOGLYPHS | DIGITS).items()} | {ord(c): None for c in INVISIBLE}
    return out | {k: " " for k in (9, 10, 11, 12, 13)}


TABLE = _table()
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    return text.lower().translate(TABLE)


class Lexicon(NamedTuple):
    """Weights of whole words and of beginnings of words (these end in ``*``), and the curve."""

    weights: dict[str, float]
    curve: tuple[float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS


def _entries(text: str, longest: int = 10) -> set[str]:
    """A text's candidate entries: each word, and its beginnings of four letters or more."""
    out = set()
    for w in set(_WORD.findall(text)):
        if len(w) >= 3:
            out.add(w)
            out.update(w[:k] + "*" for k in range(4, min(len(w), longest) + 1))
    return out


def learn(counts: dict[str, tuple[int, int]], toxic: int, clean: int, most: int = 2000) -> dict[str, float]:
    """Entries far commoner in toxic texts, the most telling first; one that an accepted beginning covers is left out.

    An entry's gain is the likelihood-ratio statistic of its counts; it must exceed what
    the best of as many entries reaches by chance.
    """
    ranked = []
    least_gain = 2 * math.log(len(counts) + 1)
    share = toxic / max(1, toxic + clean)
    for entry, (p, n) in counts.items():
        if p < 3 or p / (p + n) < 0.5 + share / 2:
            continue
        gain = 2 * (p * math.log(p / ((p + n) * share)) + (n * math.log(n / ((p + n) * (1 - share))) if n else 0))
        if gain >= least_gain:
            ranked.append((-gain, not entry.endswith("*"), len(entry), entry, math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))))
    out: dict[str, float] = {}
    for _, _, _, entry, weight in sorted(ranked):
        word = entry.rstrip("*")
        if len(out) < most and not any(word[:k] + "*" in out for k in range(4, len(word) + 1)) and word not in out:
            out[entry] = weight
    return out


@functools.lru_cache(maxsize=4)
def _automaton(entries: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]) -> ahocorasick.Automaton:
    words: dict[str, list] = {}
    for entry, weight in entries:
        words.setdefault(entry.rstrip("*"), [None, None, False])[entry.endswith("*")] = weight
    for phrase in exceptions:
        words.setdefault(fold(phrase), [None, None, False])[2] = True
    a = ahocorasick.Automaton()
    for word, (whole, beginning, excepted) in words.items():
        a.add_word(word, (len(word), whole, beginning, excepted))
    if len(a):
        a.make_automaton()
    return a


def hits(text: str, weights: dict[str, float], exceptions: tuple[str, ...] = ()) -> list[tuple[int, int, float]]:
    """(start, end, weight) in the folded text, outside exception phrases. A word counts once, by its best entry."""
    found: dict[int, tuple[int, float]] = {}
    shielded: list[tuple[int, int]] = []
    automaton = _automaton(tuple(sorted(weights.items())), exceptions)
    if not len(automaton):
        return []
    for end, (n, whole, beginning, excepted) in automaton.iter(text):
        start = end - n + 1
        if start and text[start - 1].isalpha():
            continue
        closed = end + 1 == len(text) or not text[end + 1].isalpha()
        if excepted and closed:
            shielded.append((start, end + 1))
        weight = max((w for w in (whole if closed else None, beginning) if w is not None), default=None)
        if weight is not None and weight > found.get(start, (0, -1.0))[1]:
            found[start] = (end + 1, weight)
    return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in shielded)]


def strength(text: str, weights: dict[str, float], exceptions: tuple[str, ...]) -> float:
    return sum(w for _, _, w in hits(text, weights, exceptions)) / math.log(8 + text.count(" "))


def fit(labelled: Sample, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon from all the sample; the curve from its two halves, each scored with the other half's lexicon."""
    halves = [[(fold(t.decode("utf-8", "replace")), y) for t, y in labelled.rows[k::2]] for k in (0, 1)]
    tallies = []
    for half in halves:
        toxic, clean = Counter(), Counter()
        for text, y in half:
            (toxic if y else clean).update(_entries(text))
        toxics = sum(y for _, y in half)
        tallies.append((toxic, clean, toxics, len(half) - toxics))

    def lexicon(parts) -> dict[str, float]:
        counts = {e: (sum(p[0][e] for p in parts), sum(p[1][e] for p in parts)) for p in parts for e, c in p[0].items() if c >= 2 or len(parts) > 1}
        return learn(counts, sum(p[2] for p in parts), sum(p[3] for p in parts))

    x, y = [], []
    for k in (0, 1):
        weights = lexicon([tallies[1 - k]])
        x += [[strength(text, weights, exceptions)] for text, _ in halves[k]]
        y += [label for _, label in halves[k]]
    a, b = logistic(np.array(x).reshape(-1, 1), np.array(y, float), ridge=1e-2)
    return Lexicon(lexicon(tallies), (float(a), float(b) + math.log(labelled.odds)), exceptions)


def score(docs: DataFrame, lexicon: Lexicon, into: str = "score") -> DataFrame:
    """``docs`` with a column ``into`` from 0 to 1 over whole texts; a null or empty text has no hits.

    All columns and rows stay, repeated rows too; a column already named so is replaced.
    """
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a, b = lexicon.curve
        for texts in batches:
            yield pd.Series([sigmoid(a * strength(fold(t), lexicon.weights, lexicon.exceptions) + b) for t in texts], dtype="float64")

    return docs.withColumn(into, scored(F.coalesce("text", F.lit(""))))


def train(docs: DataFrame, labels: DataFrame, keep, per_class: int = 3000, max_bytes: int = 65_536) -> Lexicon:
    """Learns from at most ``per_class`` labelled texts of each class, each of at most ``max_bytes`` bytes."""
    return fit(labelled_sample(docs, labels, "toxic", keep, per_class, max_bytes))
