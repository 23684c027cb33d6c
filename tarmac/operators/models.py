"""Delay classifiers on Spark ML: fit, score, tune."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import metrics
from tarmac.operators.ranks import quantiles
from tarmac.session import materialise, shared_folder

SEED = 42
#: Independent fits that run side by side at most.
FITS_AT_ONCE = 4
#: Rows of a stored file that fits read.
DEALT_ROWS = 1 << 16


@dataclass(frozen=True)
class Recipe:
    """A classifier's settings, its class weighting and the grid declared for tuning."""
    build: Callable[..., Estimator]
    settings: Mapping[str, object]
    weighting: str
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    scaled: bool = False


# Model settings. A tree needs 10 rows per leaf; Spark has no separate
# minimum for splitting. "boosted_ratio" weights positives by negatives/positives,
# the other recipes give both classes the same total weight.
RECIPES: dict[str, Recipe] = {
    "logistic_regression": Recipe(
        LogisticRegression, {"maxIter": 1000, "C": 1.0}, "balanced",
        {"C": [0.01, 0.1, 1.0, 10.0]}, scaled=True),
    "random_forest": Recipe(
        RandomForestClassifier, {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 10, "seed": SEED}, "balanced",
        {"numTrees": [100, 200, 300], "maxDepth": [10, 15, 20]}),
    "boosted_ratio": Recipe(
        GBTClassifier, {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
                        "featureSubsetStrategy": "0.8", "seed": SEED}, "ratio",
        {"maxIter": [200, 300, 500], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1, 0.2]}),
    "boosted_balanced": Recipe(
        GBTClassifier, {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
                        "featureSubsetStrategy": "0.8", "seed": SEED}, "balanced",
        {"maxIter": [200, 300, 500], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1, 0.2]}),
}


def class_sizes(rows: DataFrame, target: str = schema.TARGET) -> tuple[int, int]:
    """(negatives, positives): two numbers."""
    one = rows.agg(F.count_if(F.col(target) == 0).alias("n"), F.count_if(F.col(target) == 1).alias("p")).first()
    return one["n"], one["p"]


def class_weights(negatives: int, positives: int, weighting: str) -> tuple[float, float]:
    """Weights of a negative and a positive row; 1.0 each when a class is empty."""
    if not negatives or not positives:
        return 1.0, 1.0
    if weighting == "ratio":
        return 1.0, negatives / positives
    total = negatives + positives
    return total / (2 * negatives), total / (2 * positives)


def feature_medians(rows: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature, one number per feature; 0 for an empty one."""
    if not features:
        return {}
    numbers = rows.select(*[F.col(c).cast("double").alias(c) for c in features])
    long = numbers.unpivot([], list(features), "feature", "value")
    found = quantiles(long, "value", [0.5], ["median"], by=["feature"]).collect()
    known = {r["feature"]: r["median"] for r in found}
    return {c: known.get(c, 0.0) for c in features}


def columns_with_gaps(tables: Sequence[DataFrame], columns: Sequence[str]) -> list[str]:
    """The columns that are NULL as numbers somewhere in the tables; one row of counts per table."""
    found = set()
    for table in tables:
        n, *known = table.agg(F.count(F.lit(1)), *[F.count(F.col(c).cast("double")) for c in columns]).first()
        found.update(c for c, k in zip(columns, known) if k < n)
    return [c for c in columns if c in found]


def fill_values(train: DataFrame, features: Sequence[str], tables: Sequence[DataFrame]) -> dict[str, float]:
    """``feature_medians`` of the features with a gap in some of the tables; 0 for the others, which nothing fills.

    Counting values takes a row per cell, so columns without gaps are left out of it. Give stored tables.
    """
    return {**dict.fromkeys(features, 0.0), **feature_medians(train, columns_with_gaps(tables, features))}


def feature_rows(rows: DataFrame, features: Sequence[str], medians: Mapping[str, float],
                 target: str | None = schema.TARGET, keep: Sequence[str] = ()) -> DataFrame:
    """Features as doubles with gaps filled, plus the label; rows without one are dropped."""
    if target is not None:
        rows = rows.filter(F.col(target).isNotNull())
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))).alias(c) for c in features]
    label = [F.col(target).cast("double").alias("label")] if target is not None else []
    kept = [F.col(c).alias(f"key_{c}") for c in keep]
    return rows.select(*filled, *label, *kept)


def _estimator(recipe: Recipe, settings: Mapping[str, object], n: int) -> Estimator:
    params = {**recipe.settings, **settings}
    if "C" in params:
        # C multiplies a summed loss; Spark averages the loss over the weights, which sum to n.
        params["regParam"] = 1.0 / (float(params.pop("C")) * max(n, 1))
        params["standardization"] = False
    inputs = "scaled" if recipe.scaled else "features"
    return recipe.build(featuresCol=inputs, labelCol="label", weightCol="weight", **params)


def fit_sample(rows: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` rows, the same ones on each run: those with the smallest hashes of their cells.

    Of many rows only those below a bound that four times as many should pass are ordered; if too few
    pass, as with many equal rows, all are.
    """
    smallest = F.xxhash64(*rows.columns)
    n = rows.count()
    if n > 16 * fit_rows:
        bound = 2**64 * (4 * fit_rows + 1000) // n - 2**63
        picked = materialise(rows.filter(smallest < F.lit(min(bound, 2**63 - 1))).orderBy(smallest, *rows.columns).limit(fit_rows))
        if picked.count() == fit_rows:
            return picked
    return materialise(rows.orderBy(smallest, *rows.columns).limit(fit_rows))


def dealt(rows: DataFrame) -> DataFrame:
    """The rows stored in ``DEALT_ROWS`` or fewer to a file on average, in an order that depends on the rows alone.

    Small tables otherwise come as fewer tasks than a cluster has cores. Trees draw rows by their places in a task,
    so the order of a shuffle would make fits differ between runs.
    """
    cells = F.xxhash64(*rows.columns)
    files = max(1, -(-rows.count() // DEALT_ROWS))
    return materialise(rows.repartition(files, cells).sortWithinPartitions(cells, *rows.columns))


def train_one(rows: DataFrame, features: Sequence[str], name: str, settings: Mapping[str, object] | None = None,
              recipes: Mapping[str, Recipe] = RECIPES, fit_rows: int | None = None) -> PipelineModel:
    """Fit one named classifier on ``feature_rows`` output. Give it a stored table.

    ``fit_rows`` bounds the rows that are learnt from; without it all are. The many
    rounds of boosting cut their lineage in the context's checkpoint folder.
    """
    if name not in recipes:
        raise ValueError(f"unknown model {name!r}; available: {', '.join(recipes)}")
    recipe = recipes[name]
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(rows.sparkSession)}/tarmac-lineage")
    if fit_rows is not None:
        rows = fit_sample(rows, fit_rows)
    negatives, positives = class_sizes(rows, "label")
    w0, w1 = class_weights(negatives, positives, recipe.weighting)
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(w1)).otherwise(F.lit(w0)))
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]
    if recipe.scaled:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    stages.append(_estimator(recipe, settings or {}, negatives + positives))
    return Pipeline(stages=stages).fit(weighted)


def train_all(rows: DataFrame, features: Sequence[str], settings: Mapping[str, Mapping] | None = None,
              recipes: Mapping[str, Recipe] = RECIPES, fit_rows: int | None = None) -> dict[str, PipelineModel]:
    """Fit all named classifiers, ``FITS_AT_ONCE`` at a time."""
    if fit_rows is not None:
        rows = fit_sample(rows, fit_rows)
    with ThreadPoolExecutor(max_workers=FITS_AT_ONCE) as pool:
        fitted = pool.map(lambda name: train_one(rows, features, name, (settings or {}).get(name), recipes), recipes)
        return dict(zip(recipes, fitted))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add the positive-class probability as ``score`` and the 0/1 ``predicted`` label."""
    scored = model.transform(rows)
    return (scored.withColumn("score", vector_to_array("probability")[1])
            .withColumn("predicted", F.col("prediction").cast("int"))
            .select(*rows.columns, "score", "predicted"))


def grid_search(rows: DataFrame, features: Sequence[str], name: str, years: Sequence[int] = schema.TRAIN_YEARS,
                grid: Mapping[str, Sequence] | None = None, settings: Mapping[str, object] | None = None,
                year: str = "key_YEAR", fit_rows: int | None = None) -> DataFrame:
    """Mean ROC-AUC of every grid point over forward-chaining folds, best first.

    Each fold trains on all earlier years and validates on the next one. Points times
    folds are fitted, ``FITS_AT_ONCE`` at a time; each fit is distributed. ``fit_rows``
    bounds the rows that a fold learns from; every row of the validation year is scored.
    """
    grid = dict(RECIPES[name].grid if grid is None else grid)

    def fold(case: tuple) -> tuple:
        point, cut = case
        model = train_one(earlier[cut], features, name, {**(settings or {}), **point})
        valid = score(model, rows.filter(F.col(year) == cut))
        return name, str(point), int(cut), metrics.compute_metrics(valid, "label", "score", "predicted").first()["roc_auc"]

    cuts = sorted(years)[1:]
    earlier = {cut: rows.filter(F.col(year) < cut) for cut in cuts}
    if fit_rows is not None:
        earlier = {cut: fit_sample(x, fit_rows) for cut, x in earlier.items()}
    cases = [(dict(zip(grid, values)), cut) for values in product(*grid.values()) for cut in cuts]
    with ThreadPoolExecutor(max_workers=FITS_AT_ONCE) as pool:
        results = list(pool.map(fold, cases))
    folds = rows.sparkSession.createDataFrame(results, "model string, point string, year int, roc_auc double")
    return folds.groupBy("model", "point").agg(
        F.avg("roc_auc").alias("roc_auc"), F.count("roc_auc").alias("folds")).orderBy(F.col("roc_auc").desc(), "point")
