"""Hypothesis tests and effect sizes, computed on reduced tables.

Every statistic is algebraic in group counts, so raw rows are scanned once and
nothing larger than a contingency or value-count table is carried further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions.tails import chi2_tail, two_sided_normal
from tarmac.operators.ranks import running_totals
from tarmac.session import materialise


def chi_square(df: DataFrame, row: str = "YEAR", column: str = schema.TARGET, rows: Sequence | None = (2021, 2025)) -> DataFrame:
    """Independence test with Yates' correction at one degree of freedom, and Cramér's V.

    Rows are reduced to counted pairs; margins are windows over these. A level seen in
    no row is none of the table's. Pairs that never occur need no cell of their own:
    all expected counts sum to n, so theirs are what the others leave.
    """
    if rows is not None:
        df = df.filter(F.col(row).isin(*rows))
    pairs = (df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
             .groupBy(F.col(row).alias("_row"), F.col(column).alias("_level")).agg(F.count(F.lit(1)).alias("_n")))
    # few pairs, whatever the data; one task may hold them
    whole = Window.partitionBy(F.lit(1))
    cells = pairs.withColumns({
        "_r": F.sum("_n").over(Window.partitionBy("_row")), "_c": F.sum("_n").over(Window.partitionBy("_level")),
    }).withColumns({"_all": F.sum("_n").over(whole)})
    expected = F.col("_r").cast("double") * F.col("_c") / F.col("_all")
    gap = F.abs(F.col("_n") - expected)
    one = cells.agg(
        F.countDistinct("_row").alias("_rows"), F.countDistinct("_level").alias("_levels"), F.sum("_n").alias("n"),
        F.count(F.lit(1)).alias("_cells"), F.sum(gap * gap / expected).alias("_plain"), F.sum(expected).alias("_expected"),
        F.max(gap).alias("_gap"), F.min("_r").cast("double").alias("_r1"), F.min("_c").cast("double").alias("_c1"))
    dof = (F.col("_rows") - 1) * (F.col("_levels") - 1)
    absent = F.when(F.col("_cells") < F.col("_rows") * F.col("_levels"), F.col("n") - F.col("_expected")).otherwise(F.lit(0.0))
    # of two rows and two levels every cell is off by the same
    n = F.col("n").cast("double")
    corrected = F.pow(F.greatest(F.col("_gap") - 0.5, F.lit(0.0)), 2) * n * n * n / (
        F.col("_r1") * (n - F.col("_r1")) * F.col("_c1") * (n - F.col("_c1")))
    chi2 = F.when(dof == 1, corrected).otherwise(F.col("_plain") + absent)
    result = one.select(chi2.alias("chi2"), dof.cast("int").alias("dof"), F.when(F.col("_cells") > 0, F.col("n")).alias("n"),
                        F.least("_rows", "_levels").alias("_smaller"))
    return result.select(
        "chi2", "dof", "n", chi2_tail(F.col("chi2"), F.col("dof")).alias("p_value"),
        F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.col("_smaller") - 1))).alias("cramers_v"))


def rank_sums(df: DataFrame, group: str = "DEP_TIME_BLK", value: str = "ARR_DELAY") -> tuple[DataFrame, DataFrame]:
    """Per-group rank sums with average ranks, and the one-row tie correction.

    Rows are reduced to (group, value) counts; the global order is taken over
    distinct values only.
    """
    counts = materialise(
        df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(group).alias("level"), F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n")))
    values = counts.groupBy("value").agg(F.sum("n").alias("ties"))
    ranked = materialise(running_totals(values, "value", ["ties"]))
    average = F.col("before_ties") + (F.col("ties") + 1) / F.lit(2.0)
    ranks = ranked.select(F.col("value").alias("_value"), average.alias("rank"))
    levels = counts.join(ranks, F.col("value") == F.col("_value")).groupBy("level").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("rank")).alias("rank_sum"))
    t = F.col("ties").cast("double")
    ties = ranked.agg(F.sum("ties").alias("total"), F.sum(t * t * t - t).alias("tie_sum"))
    return levels, ties


def kruskal_wallis(df: DataFrame, group: str = "DEP_TIME_BLK", value: str = "ARR_DELAY") -> DataFrame:
    """Tie-corrected H over the groups, its p-value and epsilon squared."""
    levels, ties = rank_sums(df, group, value)
    whole = ties.select(F.struct(F.col("total").cast("double").alias("total"), "tie_sum")).scalar()
    total, tie_sum = whole["total"], whole["tie_sum"]
    off_centre = F.col("rank_sum") / F.col("n") - (total + 1) / F.lit(2.0)
    summed = levels.agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * off_centre * off_centre).alias("_between"))
    plain = F.lit(12.0) / (total * (total + 1)) * F.col("_between")
    correction = 1 - tie_sum / (total * total * total - total)
    result = summed.select("k", total.cast("long").alias("n"), F.try_divide(plain, correction).alias("h"))
    return result.select(
        "k", "n", "h", chi2_tail(F.col("h"), (F.col("k") - 1).cast("int")).alias("p_value"),
        F.try_divide(F.col("h") - F.col("k") + 1, F.col("n") - F.col("k")).alias("epsilon_squared"))


def dunn(df: DataFrame, group: str = "DEP_TIME_BLK", value: str = "ARR_DELAY", control=None) -> DataFrame:
    """Pairwise z of mean ranks, one row for each pair of groups.

    All pairs are the test's own result, for a handful of groups; with ``control`` only
    that group is compared with the others, by an equality join.
    """
    levels, ties = rank_sums(df, group, value)
    whole = ties.select(F.struct(F.col("total").cast("double").alias("total"), "tie_sum")).scalar()
    total, tie_sum = whole["total"], whole["tie_sum"]
    means = materialise(levels.select("level", "n", (F.col("rank_sum") / F.col("n")).alias("mean_rank")))
    left = means.select(F.col("level").alias("level_a"), F.col("n").alias("_na"), F.col("mean_rank").alias("_ra"))
    right = means.select(F.col("level").alias("level_b"), F.col("n").alias("_nb"), F.col("mean_rank").alias("_rb"))
    if control is None:
        pairs = left.join(right, F.col("level_a") < F.col("level_b"))
    else:
        against = left.filter(F.col("level_a") == control).withColumn("_one", F.lit(1))
        others = right.filter(F.col("level_b") != control).withColumn("_one", F.lit(1))
        pairs = others.join(F.broadcast(against), "_one")  # one row
    spread = total * (total + 1) / F.lit(12.0) - tie_sum / (F.lit(12.0) * (total - 1))
    z = (F.col("_ra") - F.col("_rb")) / F.sqrt(spread * (1 / F.col("_na") + 1 / F.col("_nb")))
    return pairs.select("level_a", "level_b", z.alias("z")).withColumn("p_value", two_sided_normal(F.col("z")))


def step_down(pairs: DataFrame, p_value: str = "p_value", by: Sequence[str] = ()) -> DataFrame:
    """``pairs`` with ``p_adjusted``: each p-value times the number of those not smaller, at least what any smaller one
    was raised to, at most 1.

    Equal p-values are adjusted alike. A null p-value is null adjusted and not counted. With ``by`` each group of tests
    is a family of its own; without, the rows are one family, sorted in one task, which is for the pairs of a test's
    groups and not for facts.
    """
    p, family = F.col(p_value), [F.col(c) for c in by]
    order = Window.partitionBy(*family, p.isNull()).orderBy(p)
    left = F.count(p).over(Window.partitionBy(*family, p.isNull())) - F.row_number().over(order) + 1
    raised = pairs.withColumn("_raised", F.when(p.isNotNull(), F.least(p * left, F.lit(1.0))))
    # what equal values share is the largest of theirs, which comes first among them
    upto = Window.partitionBy(*family, p.isNull()).orderBy(p).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return raised.withColumn("p_adjusted", F.max("_raised").over(upto)).drop("_raised")


def cohens_d(df: DataFrame, group: str, first, second, value: str = "ARR_DELAY") -> DataFrame:
    """Standardised mean difference between two groups, pooled deviation."""
    x = F.col(value).cast("double")
    sides = {"a": F.when(F.col(group) == first, x), "b": F.when(F.col(group) == second, x)}
    aggregates = []
    for s, c in sides.items():
        aggregates += [F.count(c).alias(f"n_{s}"), F.avg(c).alias(f"mean_{s}"), F.var_samp(c).alias(f"_var_{s}")]
    one = df.agg(*aggregates)
    pooled = F.try_divide(
        (F.col("n_a") - 1) * F.col("_var_a") + (F.col("n_b") - 1) * F.col("_var_b"),
        F.col("n_a") + F.col("n_b") - 2)
    return one.select("n_a", "n_b", "mean_a", "mean_b",
                      F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(pooled)).alias("cohens_d"))


def factor_effects(df: DataFrame, factors: Sequence[str] = ("OP_CARRIER", "ROUTE", "DEP_TIME_BLK"),
                   value: str = "ARR_DELAY") -> DataFrame:
    """Eta squared of each factor: between-level over total sum of squares."""
    rows = df.select(*factors, F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    levels = (rows.unpivot(["x"], list(factors), "factor", "level").filter(F.col("level").isNotNull())
              .groupBy("factor", "level")
              .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")))
    # One mean per factor named by the caller.
    grand = levels.groupBy("factor").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    centred = levels.join(F.broadcast(grand), "factor")
    off = F.col("mean") - F.col("grand")
    squares = centred.groupBy("factor").agg(
        F.count(F.lit(1)).alias("levels"), F.sum("n").alias("n"),
        F.sum(F.col("n") * off * off).alias("ss_between"), F.sum(F.col("n") * F.col("var")).alias("_within"))
    return squares.select("factor", "levels", "n",
                          F.try_divide(F.col("ss_between"), F.col("ss_between") + F.col("_within")).alias("eta_squared"))


def cause_shares(df: DataFrame) -> DataFrame:
    """Share of each cause in all delay minutes; the weather share is one of them."""
    causes = [c for c in schema.CAUSES if c in df.columns]
    sums = df.agg(*[F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in causes])
    everything = sum((F.col(c) for c in causes), F.lit(0.0))
    shares = sums.select(*[F.try_divide(F.col(c), everything).alias(c) for c in causes])
    return shares.unpivot([], causes, "cause", "share")
