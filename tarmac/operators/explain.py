"""Feature importance and per-row attributions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import xxhash
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators import metrics, models, permuted
from tarmac.operators.ordering import seeded_sample, top_k
from tarmac.session import materialise


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Stored rows with dense numbers ``_i`` from 0, and how many there are; only counts per partition meet."""
    base = materialise(rows.withColumn("_id", F.monotonically_increasing_id()))
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = base.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    starts = materialise(counts.select("_part", (upto - F.col("_n")).alias("_start"), "_n"))
    total = starts.agg(F.sum("_n")).first()[0] or 0  # one row per partition
    joined = base.join(F.broadcast(starts.select("_part", "_start")), part == F.col("_part"))
    return materialise(joined.withColumn("_i", F.col("_start") + place).drop("_id", "_part", "_start")), total


def permutation_importance(model: PipelineModel, rows: DataFrame, features: Sequence[str], repeats: int = 10,
                           top: int = 20, seed: int = models.SEED) -> DataFrame:
    """Drop in ROC-AUC when one feature is shuffled: mean and deviation over repeats.

    Rows are numbered once. A shuffle is a pseudorandom permutation of the numbers, its
    own for each feature and repeat. Of a logistic model, all features and repeats go
    through ``permuted.permuted_auc`` together. Of others, every row sends its value to the
    number it maps to, and one equality join per feature brings all repeats' values to
    their rows; only scores and labels leave the scoring.
    """
    features = list(features)
    linear = _linear(model, features)
    base, n = _numbered(rows.select(*features, "label"))
    first = models.score(model, base.drop("_i"))
    if linear is not None:
        first = materialise(first.select("label", "score", "predicted"))
        baseline = permuted.auc(first)
    else:
        baseline = metrics.compute_metrics(first, prediction="predicted").select("roc_auc").first()[0]
    size = max(n, 1)

    def measured(number: int) -> DataFrame:
        feature = features[number]
        sent = base.select(F.col(feature).alias("_value"), "_i", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
        target = _shuffled(F.col("_i"), size, seed, number, repeats, F.col("repeat"))
        # No two rows of a task go to one number: single values are sent, not rows as wide as the repeats.
        arrived = sent.select(target.alias("_to"), "repeat", "_value").repartition("_to").groupBy("_to").agg(
            *[F.max(F.when(F.col("repeat") == r, F.col("_value"))).alias(f"_v{r}") for r in range(repeats)])
        joined = base.join(arrived, F.col("_i") == F.col("_to"))
        others = [c for c in features if c != feature]
        cases = joined.select(*others, "label", F.explode(F.array(*[
            F.struct(F.lit(r).alias("repeat"), F.col(f"_v{r}").alias(feature)) for r in range(repeats)])).alias("_case"))
        shuffled = cases.select("_case.repeat", F.col(f"_case.{feature}").alias(feature), *others, "label")
        scored = models.score(model, shuffled).select("repeat", "label", "score", "predicted")
        return materialise(metrics.compute_metrics(scored, prediction="predicted", by=["repeat"]).select(F.lit(feature).alias("feature"), "roc_auc"))

    if linear is not None:
        measures = _linear_measures(linear, base, n, features, repeats, seed, first)
    else:
        # a job per feature, a few at a time; each leaves one row per repeat
        with ThreadPoolExecutor(max_workers=4) as pool:
            measures = reduce(DataFrame.unionByName, pool.map(measured, range(len(features))))
    drop = F.lit(baseline) - F.col("roc_auc")
    table = measures.groupBy("feature").agg(F.avg(drop).alias("importance_mean"),
                                            F.stddev_pop(drop).alias("importance_std"))
    return top_k(table, "importance_mean", top, "feature")


def _linear_measures(terms: permuted.Terms, base: DataFrame, n: int, features: Sequence[str], repeats: int, seed: int,
                     first: DataFrame) -> DataFrame:
    """(feature, roc_auc) of every feature and repeat; ``first`` holds the scores before any shuffle."""
    size = max(n, 1)
    drawn = base.sparkSession.range(1).select(F.array(*[
        F.array(*[_shift(size, seed, k, F.lit(r)) for r in range(repeats)]) for k in range(len(features))]).alias("shifts"))
    ranges = -(-n // permuted.RANGE)
    cuts = first.approxQuantile("score", [k / ranges for k in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    factors = [_factors(size, seed, k, repeats) for k in range(len(features))]
    found = permuted.permuted_auc(base, n, features, terms, factors, drawn.first()["shifts"], sorted(set(cuts)))
    case = F.floor(F.col("case") / repeats).cast("int")
    return found.select(F.element_at(F.array(*[F.lit(c) for c in features]), case + 1).alias("feature"), "roc_auc")


def _linear(model: PipelineModel, features: Sequence[str]) -> permuted.Terms | None:
    """The features' terms of the log-odds of a scaled two-class logistic model of just these features."""
    if [type(s) for s in model.stages] != [VectorAssembler, StandardScalerModel, LogisticRegressionModel]:
        return None
    assembler, scaler, logistic = model.stages
    if list(assembler.getInputCols()) != list(features) or logistic.coefficientMatrix.numRows != 1:
        return None
    return permuted.Terms([float(x) for x in logistic.coefficients], [float(x) for x in scaler.mean],
                          [1.0 / float(x) if x else 0.0 for x in scaler.std], float(logistic.intercept))


def _factors(n: int, seed: int, number: int, repeats: int) -> list[int]:
    """A factor without a divisor in common with n for each repeat; no two are equal while n allows."""
    factors: list[int] = []
    for r in range(repeats):
        drawn = xxhash.xxh64_intdigest(f"{seed}:{number}:{r}".encode())
        factor = n // 4 + 1 + drawn % max(1, n // 2)
        for _ in range(n):
            if math.gcd(factor, n) == 1 and factor % n not in factors:
                break
            factor += 1
        while math.gcd(factor, n) > 1:  # there are fewer factors than repeats
            factor += 1
        factors.append(factor % n if n > 1 else 0)
    return factors


def _shift(n: int, seed: int, number: int, repeat: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(number), repeat), F.lit(n))


def _shuffled(i: Column, n: int, seed: int, number: int, repeats: int, repeat: Column) -> Column:
    """A pseudorandom permutation of 0 .. n - 1 for each feature and repeat: multiplied by a factor without a divisor
    in common with n, and shifted, both drawn for the repeat. No two repeats of a feature have one factor while n allows."""
    factors = _factors(n, seed, number, repeats)
    return F.pmod(i * F.element_at(F.lit(factors), repeat + 1) + _shift(n, seed, number, repeat), F.lit(n))


def sampled_attributions(model: PipelineModel, rows: DataFrame, features: Sequence[str], max_rows: int,
                         draws: int = 20, seed: int = models.SEED) -> DataFrame:
    """Shapley values of the score by sampling, for at most ``max_rows`` seeded rows; each result row tells of how many.

    For each row, draw and feature: a random feature order, a random background row,
    and the score with and without the feature on top of those ordered before it.
    All hypothetical rows are scored in one pass. Long form: row, feature, value,
    attribution, rows_used, rows_available.
    """
    features = list(features)
    sample = seeded_sample(rows.select(*features), max_rows, seed)
    # The sample is capped, so numbering it in one task is safe.
    numbered = materialise(sample.withColumn("row", F.row_number().over(Window.orderBy(*features)) - 1))
    n, available = numbered.count(), rows.count()
    tries = numbered.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    tries = tries.withColumn("_pick", F.pmod(F.xxhash64(F.lit(seed), "row", "draw"), F.lit(max(n, 1))).cast("int"))
    background = numbered.select(F.col("row").alias("_pick"), *[F.col(c).alias(f"_bg_{c}") for c in features])
    paired = tries.join(F.broadcast(background), "_pick")

    def place(name):
        return F.xxhash64(F.lit(seed), "row", "draw", name)

    cases = paired.withColumns({
        "feature": F.explode(F.array(*[F.lit(c) for c in features]))}).withColumn(
        "present", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_place", place(F.col("feature")))
    own = {c: (place(F.lit(c)) < F.col("_place")) | ((F.col("feature") == c) & (F.col("present") == 1))
           for c in features}
    value = F.coalesce(*[F.when(F.col("feature") == c, F.col(c)) for c in features])
    hypothetical = cases.select("row", "draw", "feature", "present", value.alias("value"),
                                *[F.when(own[c], F.col(c)).otherwise(F.col(f"_bg_{c}")).alias(c) for c in features])
    scored = models.score(model, hypothetical)
    signed = F.when(F.col("present") == 1, F.col("score")).otherwise(-F.col("score"))
    return scored.groupBy("row", "feature").agg(
        F.first("value").alias("value"), (F.sum(signed) / F.lit(draws)).alias("attribution"),
        F.lit(n).alias("rows_used"), F.lit(available).alias("rows_available"))


def linear_attributions(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact log-odds contributions of a logistic model: coefficient times distance from the mean."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    logistic = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    terms = []
    for i, c in enumerate(features):
        spread = float(scaler.std[i])
        weight = float(logistic.coefficients[i]) / spread if spread else 0.0
        terms.append((F.lit(weight) * (F.col(c) - F.lit(float(scaler.mean[i])))).alias(c))
    return rows.select(*terms)


def attribution_summary(attributions: DataFrame) -> DataFrame:
    """Features by mean absolute attribution."""
    return attributions.groupBy("feature").agg(
        F.avg(F.abs("attribution")).alias("mean_abs"), F.avg("attribution").alias("mean"),
        F.first("rows_used").alias("rows_used"), F.first("rows_available").alias("rows_available")).orderBy(
        F.col("mean_abs").desc(), "feature")
