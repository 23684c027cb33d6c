"""A bounded fit leaves the validation rows of the grid search whole."""

from pyspark.sql import functions as F

from tarmac.operators import metrics, models


def test_every_validation_row_is_scored(spark, monkeypatch):
    rows = spark.range(900).select(
        (F.col("id") % 7).cast("double").alias("a"), ((F.col("id") % 7 + F.col("id") % 5) > 5).cast("int").alias("label"),
        (F.lit(2021) + F.col("id") % 3).cast("int").alias("key_YEAR"))
    scored, learnt, fit, measure = [], [], models.train_one, metrics.compute_metrics
    monkeypatch.setattr(models, "train_one", lambda r, *x, **y: learnt.append(r.count()) or fit(r, *x, **y))
    monkeypatch.setattr(models.metrics, "compute_metrics", lambda r, *x, **y: scored.append(r.count()) or measure(r, *x, **y))
    models.grid_search(rows, ["a"], "logistic_regression", years=(2021, 2022, 2023), grid={"C": [1.0]}, settings={"maxIter": 5}, fit_rows=50)
    assert sorted(scored) == [300, 300] and sorted(learnt) == [50, 50]


def test_registered_search_gets_all_training_rows(monkeypatch):
    from checks import queries
    seen = {}
    for name in ("tune", "tidy"):
        monkeypatch.setattr(queries, name, lambda x: x)
    monkeypatch.setattr(queries, "_rows", lambda *_: (["a"], "sample", "test", "train"))
    monkeypatch.setattr(queries.models, "grid_search", lambda rows, *x, **y: seen.update(rows=rows, **y))
    queries.REGISTRY["m14_grid_search"](None, "")
    assert seen == {"rows": "train", "fit_rows": queries.FIT_ROWS}
