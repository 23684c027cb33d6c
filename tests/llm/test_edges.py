"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns have defined results."""

import pytest
from pyspark.sql import functions as F

from tarmac.llm import ann, decontam, mixing, pii, quality, simhash, suffixes, toxicity, urlgraph, warc
from tarmac.llm.queries import RULES

LONG = "word another third " * 120_000  # 2.3 MB

DOCS = [(1, "the same text of some words", "a"), (1, "the same text of some words", "a"), (2, None, None), (None, "no id here at all", "b"),
        (3, "", "b"), (4, " \n\t", "a"), (5, LONG, "b"), (6, "The Same text of some words", None), (None, None, None)]
CLASH = ["score", "b", "fp", "th", "did", "_did", "spans", "redacted", "size", "source_no", "target", "row", "rank", "key", "n"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    return frame.withColumns({c: F.lit("kept") for c in CLASH})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "same text of some words"), (1, "same text of some words"), (2, None), (3, ""), (None, "no id"), (5, "one")], "item_id long, text string")


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (5, 0, 1), (None, 1, None), (1, 0, 1), (9, 1, 1)]])
def test_classifiers(spark, docs, empty, labels):
    known = spark.createDataFrame(labels, LABELS)
    for operator in (quality, toxicity):
        model = operator.train(docs, known, F.lit(True))
        rows = operator.score(docs, model).collect()
        assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 for r in rows)
        by = {(r.doc_id, r.text): r.score for r in rows}
        assert by[2, None] == by[3, ""]
        assert operator.score(empty, model).count() == 0
        assert operator.score(docs, model, "other").select("score").distinct().collect()[0][0] == "kept"
        assert operator.train(empty, known, F.lit(True)) is not None


def test_mixing(docs, empty):
    rows = mixing.taken(docs).collect()
    assert len(rows) == len(DOCS)
    assert sorted((r["size"], r.taken <= 2 * r["size"]) for r in rows) == [(0, True)] * 4 + [(5, True), (6, True), (6, True), (6, True), (360_000, True)]
    assert mixing.taken(empty).count() == 0
    assert mixing.taken(docs.where("text is null or trim(text) = ''")).count() == 3


def test_near_duplicates(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert of == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 1}
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["2", "None"]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "None"]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_passages(docs, empty):
    rows = suffixes.without_repeats(docs).collect()
    assert len(rows) == len(DOCS)
    long = next(r for r in rows if r.doc_id == 5)
    assert long.n_bytes == len(LONG) == long.n_removed and long.n_spans == 1
    assert sum(r.n_removed for r in rows) == len(LONG)
    assert suffixes.without_repeats(empty).count() == 0
    twice = suffixes.without_repeats(docs.where("doc_id = 5").withColumn("text", F.substring("text", 1, 500)).withColumn("text", F.concat("text", F.expr("uuid()"))))
    assert twice.count() == 1


def test_decontamination(docs, empty, items):
    rows = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert rows == {(1, 1), (6, 1), (None, None)}
    kept = decontam.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "5", "None"]
    assert decontam.contaminated(empty, items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0 and decontam.without_contaminated(docs, items.limit(0)).count() == len(DOCS)


def test_personal_data(docs, empty):
    model = pii.train(docs)
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(DOCS) and all(r.spans == "" and r.n_email == 0 for r in rows)
    assert pii.find(empty, pii.train(empty)).count() == 0
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns and sorted(str(r.text) for r in clean.collect()) == sorted(str(t) for _, t, _ in DOCS)
    digits = "1" * 300_000
    assert pii.base_spans(digits + "@" + digits) == [] and pii.base_spans("a" * 300_000 + "@b.c") == [(0, 0, 300_004)]


def test_vectors(spark):
    good = [(k, [float(k % 3), 1.0, 0.5, float(k)]) for k in range(6)] + [(40, [1.0, 1.0, 1.0, 1.0]), (41, [1.0, 1.0, 1.0, 1.0]), (20, [0.0, 1.0, 0.0, 0.0])]
    bad = [(100, None), (60, [0.0] * 4), (101, [1.0, None, 1.0, 1.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [float("inf"), 1.0, 1.0, 1.0]), (104, [1.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame(good + bad, "vec_id long, vector array<double>").withColumn("cell", F.lit("kept"))
    index = ann.build(frame, dims=4)
    rows = ann.search(index, index.entries.where("vec_id % 20 = 0"), k=20, visit=1.0).collect()
    assert {r.query_id for r in rows} == {0, 20, 40}
    for q in (0, 20, 40):
        got = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        mine = dict(good)[q]
        want = sorted((-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in good if i != q)
        assert [g[1] for g in got] == [i for _, i in want] and [g[2] for g in got] == pytest.approx([-s for s, _ in want])
    none = ann.build(frame.limit(0), dims=4)
    assert ann.search(none, none.entries).count() == 0


def test_pages(spark):
    rows = [(1, "http://a.com/x", "p"), (1, "http://a.com/x", "p"), (2, None, "p"), (None, "http://b.com", None), (3, "", ""), (4, "http://c.com/\r\nx", "y\r\n\r\nWARC/1.1 é" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("kept") for c in ("host", "digest", "first", "value", "rule", "sha")})
    back = warc.round_trip(pages).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in back) == sorted([
        ("1", "revisit", 2, 1), ("1", "revisit", 2, 1), ("2", "response", None, 1), ("None", "response", None, 0), ("3", "response", None, 0), ("4", "response", None, 800_000)])
    assert warc.round_trip(pages.limit(0)).count() == 0
    judged = urlgraph.judge(pages, RULES, rounds=2).collect()
    assert len(judged) == len(rows) and {r.verdict for r in judged} == {"allow"}
    assert urlgraph.judge(pages.limit(0), RULES, rounds=2).count() == 0
