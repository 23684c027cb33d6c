"""Spelling variants against comparing every two words, and the edges."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.llm import common, queries, spelling

SF = "/root/testdata/sf0.001"


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    """Deleting one letter of the longer, or one at the same place of both, makes them equal."""
    if len(a) == len(b):
        return a != b and any(a[:k] + a[k + 1:] == b[:k] + b[k + 1:] for k in range(len(a)))
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(rows, ratio=5):
    n = counted(rows)
    near = {w: [] for w in n}
    # every pair of words that share a form with one letter left out; then the check itself
    holes = {}
    for w in n:
        for k in range(len(w)):
            holes.setdefault(w[:k] + w[k + 1:], set()).add(w)
        holes.setdefault(w, set()).add(w)
    for group in holes.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    near = {w: set(v) for w, v in near.items()}
    form = {}
    for w, v in near.items():
        best = min(v, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def rows_of(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_query_equals_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").collect()]
    got = rows_of(queries.REGISTRY["op11_spelling"](spark, SF))
    assert len(got) == len(set(got)) and set(got) == brute(texts)


@pytest.mark.parametrize("block", [3, 40])
def test_blocks_of_any_size_find_the_same(spark, block):
    rng = random.Random(7)
    words = {"".join(rng.choice("abcé") for _ in range(rng.choice([6, 6, 7, 8]))): rng.randrange(5, 400) for _ in range(300)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.neighbours(frame, block=block).collect()}
    want = {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-words[x], x))
            want[w] = (len(near), words[best], best)
    assert got == want


def test_chains_lead_to_the_last_form(spark):
    rows = [(1, " ".join(["abcdef"] * 5 + ["abcdeg"] * 40 + ["abcdxg"] * 300 + ["abyyyyg"] * 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(rows_of(spelling.variants(docs))) == brute(rows)
    assert {r.word: r.root for r in spelling.variants(docs).collect()}["abcdef"] == "abcdxg"


def test_edges(spark):
    word = "longword" * 300  # long enough for double precision
    rows = [(1, None), (2, ""), (None, "Wörter ÉTÉÉÉÉ étéééé " * 6), (None, "Wörter ÉTÉÉÉÉ étéééé " * 6), (3, f"{word} {word[1:]} " * 5), (4, "×÷×÷×÷ 1 a b " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("kept") for c in ("word", "n", "b", "id", "form")})
    assert set(rows_of(spelling.variants(docs))) == brute(rows)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.where("doc_id < 3")).count() == 0
