"""Ranked search against scoring every document, and the edges."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import common, queries, ranked

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    size = [sum(c.values()) for _, c in counted]
    n, total = len(counted), sum(size)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for row, (doc_id, c) in enumerate(counted):
            m = 75 + (25 * size[row] * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, q in Counter(terms(text)).items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, row))
        out += [(item, rank + 1, None if none else d, -s) for rank, (s, none, d, _) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    assert rows_of(queries.REGISTRY["op13_best_position"](spark, SF)) == brute(docs, items)


def test_shards_and_blocks_of_any_size_find_the_same(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghij") for _ in range(n))
    docs = [(k // 2, text(rng.randrange(0, 30))) for k in range(200)]
    items = [(k, text(4)) for k in range(9)] + [(1, "A b? a"), (1, "A b? a")]
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", 100)
    monkeypatch.setattr(ranked, "QUERY_ROWS", 5)
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert rows_of(got) == brute(docs, items, 7)


@pytest.mark.parametrize("step", [1, 4])
def test_stops_before_the_end_and_strictly_below(step):
    rng = np.random.default_rng(5)
    found = []
    for _ in range(60):
        docs, words = 80, 4
        pairs = [(d, t) for d in range(docs) for t in range(words) if rng.random() < 0.6]
        doc, term = (np.array(x) for x in zip(*pairs, strict=True))
        impact = rng.integers(1, 6, len(doc)) ** 6  # many ties
        names = rng.permutation(docs)
        asked, times = np.array([0, 2, 3]), np.array([1, 2, 1])
        lists = ranked.Lists(doc, term, impact, docs, words)
        top, scores, met = lists.best(asked, times, names, 5, step)
        whole = np.zeros(docs, np.int64)
        for a, q in zip(asked, times, strict=True):
            np.add.at(whole, doc[term == a], q * impact[term == a])
        want = np.lexsort((names, -whole))[:5]
        assert sorted(zip(scores.tolist(), top.tolist(), strict=True)) == sorted(zip(whole[want].tolist(), want.tolist(), strict=True))
        found.append(met)
    assert min(found) < 60


def test_edges(spark):
    docs = [(1, "the same words"), (1, "the same words"), (2, None), (3, ""), (None, "The same é words"), (None, "x"), (4, "same " * 400_000), (5, "!?")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("kept") for c in ("row", "n", "terms", "tf", "shard", "rank")})
    items = [(1, "same words"), (1, "same words"), (1, "é"), (2, None), (3, "?"), (None, "THE x"), (4, "absent")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("kept") for c in ("item", "term", "q", "w", "b")})
    assert rows_of(ranked.search(frame, asked)) == brute(docs, items)
    assert ranked.search(frame.limit(0), asked).count() == 0 and ranked.search(frame, asked.limit(0)).count() == 0
    assert ranked.search(frame.where("doc_id = 5"), asked).count() == 0
