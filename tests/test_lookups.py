"""A lookup that no hot key can overload: equal to the broadcast one, its largest reducer bounded."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import encoding, lookups


@pytest.fixture()
def facts(spark):
    """A third of the rows under one key, a third without a key, the rest under many."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("k"), (n % 5000).cast("string")))
    return spark.range(60_000).select(n.alias("row"), key.alias("ORIGIN"), F.lit("kept").alias("salt"))


@pytest.fixture()
def keys(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("_key"), F.col("id").alias("value")).filter("value % 7 > 0")
    return rows.unionByName(spark.createDataFrame([("hot", -1), ("unseen", -2)], "_key string, value long"))


def test_equals_the_broadcast_join(facts, keys):
    got = lookups.left_lookup(facts, keys, "ORIGIN")
    want = facts.join(F.broadcast(keys), F.col("ORIGIN") == F.col("_key"), "left").drop("_key")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_reducer_holds_a_hot_key(spark, facts, keys):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        plain = facts.hint("merge").join(keys, F.col("ORIGIN") == F.col("_key"), "left")
        assert max(sizes(plain)) > 20_000  # what the salts are for
        assert max(sizes(lookups.left_lookup(facts, keys, "ORIGIN"))) < 2 * 60_000 / 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_heavy_keys(facts):
    heavy = {r["key"]: r["salts"] for r in lookups.heavy_keys(facts, "ORIGIN").collect()}
    assert set(heavy) == {"hot"} and 128 <= heavy["hot"] <= 140  # half of the rows with a key
    assert lookups.heavy_keys(facts.limit(0), "ORIGIN").count() == 0
    assert lookups.heavy_keys(facts.filter("ORIGIN is null"), "ORIGIN").count() == 0


def test_every_key_of_a_part_is_found(spark):
    """Keys of just over one part among many small ones."""
    n = F.col("id")
    rows = spark.range(200_000).select(F.when(n % 20 == 0, (n % 400).cast("string")).otherwise(F.concat(F.lit("s"), n.cast("string"))).alias("k"))
    shares = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    wanted = {k for k, c in shares.items() if c * 300 > 200_000}
    assert len(wanted) == 0
    wanted = {k for k, c in shares.items() if c * 1000 > 200_000}
    found = {r["key"] for r in lookups.heavy_keys(rows, "k", parts=1000).collect()}
    assert wanted and wanted <= found


def test_empty_sides(spark, facts, keys):
    assert lookups.left_lookup(facts.limit(0), keys, "ORIGIN").count() == 0
    rows = lookups.left_lookup(facts, keys.limit(0), "ORIGIN")
    assert rows.count() == 60_000 and rows.filter("value is not null").count() == 0


def test_encodings_over_large_maps(full, op, monkeypatch):
    maps = encoding.Encodings.fit(encoding.train_rows(full))
    want = encoding.encode(op, maps)
    monkeypatch.setattr(encoding, "BROADCAST_ROWS", 0)
    got = encoding.encode(op, maps)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    one = encoding.leave_one_out_history(encoding.train_rows(op), maps, "ORIGIN")
    monkeypatch.undo()
    assert one.exceptAll(encoding.leave_one_out_history(encoding.train_rows(op), maps, "ORIGIN")).count() == 0
