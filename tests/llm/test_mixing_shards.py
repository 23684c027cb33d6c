"""Counts of sources per output shard are multinomial, totals meet the targets, rows alike are spread."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing


@pytest.fixture(scope="module")
def planned(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.expr("repeat('word ', cast(200 + id % 50 as int))").alias("text"), F.format_string("s%d", F.col("id") % 3).alias("source"))
    return mixing.mix(docs, block=8, shard_slots=50)


def test_shard_counts_are_multinomial(planned):
    quota = {r.source_no: r.quota for r in planned.sources.collect()}
    rows = planned.draws.groupBy("shard", "source_no").count().collect()
    shards = 1 + max(r.shard for r in rows)
    total = sum(quota.values())
    assert shards == -(-total // 50) and shards > 400
    table = np.zeros((shards, 3))
    for r in rows:
        table[r.shard, r.source_no] = r["count"]
    assert table.sum() == total and (table[:-1].sum(axis=1) == 50).all()
    p = np.array([quota[k] / total for k in range(3)])
    whole = table[:-1]
    assert np.abs(whole.mean(axis=0) / (50 * p) - 1).max() < 0.01
    # the covariance of the counts over shards is that of the multinomial
    want = 50 * (np.diag(p) - np.outer(p, p))
    assert np.abs(np.cov(whole.T) / want - 1).max() < 0.35
    # neighbours in the row of shards are independent
    assert np.abs([np.corrcoef(whole[:-1, k], whole[1:, k])[0, 1] for k in range(3)]).max() < 0.15


def test_quotas_are_met_and_passes_are_whole(planned):
    sources = {r.source_no: r for r in planned.sources.collect()}
    times = Counter((r.source_no, r.block) for r in planned.draws.collect())
    for no, s in sources.items():
        mine = [times[no, b] for b in range(s.blocks)]
        assert sum(mine) == s.quota and abs(s.quota - s.target / 8) <= 1.5 and max(mine) - min(mine) <= 1 and max(mine) <= 2
    assert all(0 <= b < sources[no].blocks for no, b in times)


def test_rows_without_an_id_are_spread(spark):
    n = 20_000
    docs = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("a b "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    places = mixing.mix(docs, block=8).docs.select("start", "size").collect()
    assert sorted(r.start for r in places) == list(range(0, 3 * n, 3))
    [buckets] = [r.buckets for r in mixing.mix(docs, block=8).sources.collect()]
    sizes = Counter(r.bucket for r in docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).alias("bucket")).collect())
    assert buckets > 100 and max(sizes.values()) < 3 * n / buckets


def test_rows_alike_each_have_their_place(spark):
    n = 10_000  # more than one chunk
    docs = spark.range(n).select(F.lit(7).alias("doc_id"), F.lit("one two three").alias("text"), F.lit(None).cast("string").alias("source"))
    rows = mixing.taken(docs, block=8, weights=(1,)).collect()
    assert len(rows) == n and {r.source_size for r in rows} == {3 * n}
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 16 and max(r.taken for r in rows) <= 6


def test_many_sources_and_a_hot_one(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("a b c d e f g h i j k l").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("s%04d", F.col("id") % 500)).alias("source"))
    planned = mixing.mix(docs, block=4, shard_slots=64)
    got = {r.source_no: r["count"] for r in planned.draws.groupBy("source_no").count().collect()}
    assert got == {r.source_no: r.quota for r in planned.sources.collect() if r.quota}
