"""Models learn from every training row."""

import pytest

from checks import queries
from tarmac import schema
from tarmac.operators import models


@pytest.mark.parametrize("track", schema.TRACKS)
def test_models_learn_from_every_training_row(spark, monkeypatch, track):
    from pyspark.sql import functions as F

    n = queries.FIT_ROWS + 500
    wide = spark.range(n + 100).select(
        *[(F.col("id") * (k + 3) % 97).cast("double").alias(c) for k, c in enumerate(schema.TRACKS["B"]) if c != "YEAR"],
        F.when(F.col("id") < n, 2021).otherwise(2025).alias("YEAR"), (F.col("id") % 2).cast("int").alias(schema.TARGET))
    learnt = {}
    monkeypatch.setattr(queries, "_kept", {})
    monkeypatch.setattr(queries, "_split", lambda *_: (wide.filter("YEAR < 2025"), wide.filter("YEAR = 2025")))
    monkeypatch.setattr(models, "train_one", lambda rows, names, name, *x, **y: learnt.update({name: rows.count()}))
    for name in models.RECIPES:
        queries._model(spark, "", track, name)
    assert learnt == dict.fromkeys(models.RECIPES, n)
    names, test, train = queries._rows(spark, "", track)
    assert names == list(schema.TRACKS[track]) and (test.count(), train.count()) == (100, n)


def test_dealt_rows_are_whole_and_in_an_order_of_their_own(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(models, "DEALT_ROWS", 100)
    rows = spark.range(1000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id") * 0.5 % 35).alias("b"))

    def files(df):
        stored = models.dealt(df).withColumn("f", F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1))
        found = {}
        for r in stored.collect():
            found.setdefault(r.f, []).append((r.a, r.b))
        return found

    first = files(rows)
    assert len(first) == 10 and first == files(rows.orderBy(F.rand(1)).repartition(7))
    assert models.dealt(rows).exceptAll(rows).isEmpty() and rows.exceptAll(models.dealt(rows)).isEmpty()
    assert models.dealt(rows.limit(0)).count() == 0
