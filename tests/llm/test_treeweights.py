"""Context-tree weighting against the recursion written out, and the edges."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import common, queries, treeweights

SF = "/root/testdata/sf0.001"


def symbols(text, depth):
    data = b"\xff" * depth + (text or "").encode().lower() + b"\xff"
    for k in range(depth, len(data)):
        yield data[k - depth:k], data[k]


def brute(learnt, texts, depth):
    """log10 of each text's probability: every node's weighted probability by the recursion, the next bit's by the quotient of two of them."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for text in learnt:
        for context, byte in symbols(text, depth):
            for k in range(8):
                name = (1 << k) | byte >> (8 - k)
                for d in range(depth + 1):
                    counts[context[depth - d:], name][byte >> (7 - k) & 1] += 1
                    if d < depth:
                        children[context[depth - d:], name].add(context[depth - d - 1:])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(context, name, extra, path):
        """ln of the weighted probability of a node, with one more bit counted along ``path`` if ``extra`` is 0 or 1."""
        a, b = counts.get((context, name), (0, 0))
        on = extra is not None and path.endswith(context)
        own = kt(a + (on and extra == 0), b + (on and extra == 1))
        if len(context) == depth:
            return own
        nodes = set(children.get((context, name), ()))
        if on:
            nodes.add(path[len(path) - len(context) - 1:])
        below = sum(memo(c, name, extra if on and path.endswith(c) else None, path) for c in nodes)
        return math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))

    kept = {}

    def memo(context, name, extra, path):
        key = (context, name, extra, path if extra is not None else b"")
        if key not in kept:
            kept[key] = weighted(context, name, extra, path)
        return kept[key]

    out = []
    for text in texts:
        total = 0.0
        for context, byte in symbols(text, depth):
            for k in range(8):
                name, bit = (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1
                total += memo(b"", name, bit, context) - memo(b"", name, None, b"")
        out.append(total / math.log(10))
    return out


@pytest.mark.parametrize("depth", [1, 3])
def test_scores_equal_the_recursion(spark, depth):
    texts = ["the cat sat on the mat", "The mat sat on a cat", "öde Öde", "", None, "zzz the"]
    rows = [(k, t, k in (0, 1, 3)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep boolean")
    got = {r.doc_id: r for r in treeweights.score(docs, F.col("keep"), depth=depth, chunk_bytes=20).collect()}
    want = brute([t for _, t, keep in rows if keep], texts, depth)
    assert [got[k].score for k in range(6)] == pytest.approx(want, rel=1e-9)
    assert got[0].bits_per_byte == pytest.approx(-want[0] * math.log2(10) / 23)


def test_a_node_predicts_a_distribution(spark):
    """The chances of all next bytes in a seen and an unseen context add up to one."""
    codes = {int.from_bytes(c + bytes([x]), "big"): 3 if c == b"ab" and x in b"cd" else 0 for c in (b"ab", b"zz") for x in range(256)}
    found = np.array(sorted(codes))
    bucket = treeweights._bucket(found >> 8, 2)
    rows = [(1, int(b), treeweights.packed(found[bucket == b]), treeweights.packed(np.array([codes[c] for c in found[bucket == b].tolist()]))) for b in set(bucket.tolist())]
    held = spark.createDataFrame(rows, "chunk long, bucket int, ids binary, counts binary")
    sums = defaultdict(float)
    for r in treeweights.answers(held, treeweights.counts(held, 1), 1, depth=2).collect():
        for code, value in zip(treeweights.unpacked(r.ids).tolist(), np.frombuffer(r["values"], float), strict=True):
            sums[code >> 8] += 10 ** value
    assert list(sums.values()) == pytest.approx([1, 1], abs=1e-12)


def test_words_of():
    bodies = [b"  a bb\tccc", b"", b"\n \x0b", "é\u00a0x y ".encode(), b"z"]
    words, numbers = treeweights.words_of(bodies)
    assert words.to_pylist() == [w for b in bodies for w in b.split()] and numbers.tolist() == [len(b.split()) for b in bodies]
    assert treeweights.words_of([b"", b" "])[1].tolist() == [0, 0]


def test_packing_round_trip():
    for numbers in ([], [0], [5, 5, 9, 1 << 47], [7, -3, (1 << 56) - 1]):
        assert treeweights.unpacked(treeweights.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_log_gamma():
    z = np.array([0.5, 1, 1.5, 2, 7.5, 100, 12345.5, 1e9])
    assert treeweights.log_gamma(z) == pytest.approx([math.lgamma(x) for x in z], rel=1e-12, abs=1e-12)


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def held_out(doc_id, folds, at):
    return zlib.crc32(str(doc_id).encode()) % folds == at


def test_query_base_counts_and_better_than_words(spark):
    texts = {r.doc_id: r.text for r in common.table(spark, SF, "documents").collect()}
    c = Counter(t for d, x in texts.items() if not held_out(d, 7, 2) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    rows = queries.REGISTRY["op12_context_tree"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        own = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(r.doc_id, 7, 2), len(own), sum(t in c for t in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own), rel=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    size = sum(len((texts[r.doc_id] or "").encode()) + 1 for r in held)
    assert -sum(r.score for r in held) * math.log2(10) / size < 3  # bits per byte on texts not learnt from


def test_pieces_and_chunks_of_any_size_score_the_same(spark, monkeypatch):
    texts = ["some words " * 30, "other words and more", "some other " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = []
    monkeypatch.setattr(treeweights, "ANSWERED", 3)
    for chunk, piece in ((40, 16), (1 << 20, 1 << 20)):
        monkeypatch.setattr(treeweights, "pieces", lambda t, size=piece: common.pieces(t, size))
        scores.append([r.score for r in treeweights.score(docs, F.col("doc_id") != 1, chunk_bytes=chunk).orderBy("doc_id").collect()])
    for other in scores[1:]:
        assert other == pytest.approx(scores[0], rel=1e-12)


def test_edges(spark):
    rows = [(1, "same text"), (1, "same text"), (2, None), (None, "no id"), (3, ""), (4, "very long text " * 150_000), (5, "x" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("kept") for c in ("row", "chunk", "n", "b", "score", "window", "word", "learn")})
    got = treeweights.score(docs, F.col("doc_id") != 3).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "4", "5", "None"] and all(r.score < 0 for r in got)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.score)
    assert len(by[1]) == 1 and by[2] == by[3]
    assert [r.learn for r in got if r.doc_id is None] == [False]
    assert treeweights.score(docs.limit(0), F.lit(True)).count() == 0
    none = treeweights.score(docs.where("doc_id = 1"), F.lit(False)).collect()
    assert [r.score for r in none] == pytest.approx([-80 * math.log10(2)] * 2) and none[0].train_tokens == 0
