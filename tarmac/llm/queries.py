"""The operators applied to the test tables, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import ann, decontam, mixing, pii, quality, ranked, simhash, spelling, suffixes, toxicity, treeweights, urlgraph, warc
from tarmac.llm.common import fold_of, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(work: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[work.__name__] = work
    return work


def _held_out(folds: int, at: int):
    return F.coalesce(fold_of(F.col("doc_id"), folds) == at, F.lit(False))


@query
def op1_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    index = ann.build(vectors, dims=64)
    return ann.search(index, index.entries.where("vec_id % 20 = 0"), k=20)


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, held = table(spark, folder, "documents"), _held_out(5, 0)
    model = quality.train(docs, table(spark, folder, "labels"), ~held)
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, held = table(spark, folder, "documents"), _held_out(3, 1)
    lexicon = toxicity.train(docs, table(spark, folder, "labels"), ~held)
    return toxicity.score(docs.select("doc_id", "text"), lexicon).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


#: The rules that the query is defined by.
RULES = [
    urlgraph.Rule("net", "/", "block"),
    urlgraph.Rule("example.net", "/en/", "allow"),
    urlgraph.Rule("example.com", "/de/", "block"),
    urlgraph.Rule("org", "/fr/", "allow"),
]


@query
def op6_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return urlgraph.judge(table(spark, folder, "pages"), RULES)


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "range_no", "place")


@query
def op10_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_skip_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs)).drop("text")


@query
def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, folder, "documents"))


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query
def op12_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    scored = treeweights.score(table(spark, folder, "documents"), ~_held_out(7, 2))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op13_best_position(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op13_best_position"] = r"""
WITH terms AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS (SELECT doc_id, ts, len(ts)::BIGINT AS n FROM terms WHERE len(ts) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM docs),
items AS (
    SELECT item_id, term, count(*)::BIGINT AS q FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term),
posts AS (
    SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM docs)
    WHERE term IN (SELECT term FROM items) GROUP BY doc_id, n, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posts, totals GROUP BY term),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS impact
    FROM posts JOIN weights USING (term), totals),
scored AS (SELECT item_id, doc_id, sum(q * impact)::BIGINT AS score FROM items JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
WHERE rank <= 20
"""
