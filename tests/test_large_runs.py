"""What keeps the work of larger tables in proportion: plans and settings, and equal results by the shorter ways."""

SF = "/root/testdata/sf0.001"


def _start(line):
    return next((i for i, x in enumerate(line) if x.isalpha()), 0)


def test_writes_by_folder_do_not_sort(spark, tmp_path):
    from tarmac.session import tuned

    key = "spark.sql.maxConcurrentOutputFileWriters"
    with tuned(spark):
        before = spark.conf.get(key)
        spark.sql(f"CREATE TABLE by_year (v BIGINT, YEAR BIGINT) USING parquet PARTITIONED BY (YEAR) LOCATION '{tmp_path}'")
        try:
            plan = spark.sql("EXPLAIN INSERT INTO by_year SELECT id, id % 5 FROM range(100)").first()[0]
        finally:
            spark.sql("DROP TABLE by_year")
    assert int(before) >= 20 and "Sort" not in plan
    spark.conf.set(key, "3")
    with tuned(spark):
        pass
    assert spark.conf.get(key) == "3"
    spark.conf.set(key, before)


def test_order_lines_are_not_shuffled_by_customer(spark):
    from tarmac.sources.driver_tables import raw_flights

    lines = raw_flights(spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if "Join" in x and "o_custkey" in x)
    below = []
    for x in lines[at + 1:]:
        if _start(x) <= _start(lines[at]):
            break
        below.append(x)
    assert below and not any("l_partkey" in x for x in below)


def test_only_columns_with_gaps_are_counted_for_medians(spark, monkeypatch):
    from tarmac.operators import models

    train = spark.createDataFrame([(1.0, 5.0, None), (2.0, 6.0, None), (4.0, 9.0, None)], "a double, b double, c double")
    test = spark.createDataFrame([(None, 7.0, 1.0)], "a double, b double, c double")
    asked = []
    medians = models.feature_medians
    monkeypatch.setattr(models, "feature_medians", lambda rows, features: asked.extend(features) or medians(rows, features))
    assert models.fill_values(train, ["a", "b", "c"], [train, test]) == {"a": 2.0, "b": 0.0, "c": 0.0}
    assert asked == ["a", "c"]
    assert models.fill_values(train, ["b"], [train, test]) == {"b": 0.0}


def test_sample_of_many_rows_is_the_sample_by_order(spark):
    from pyspark.sql import functions as F

    from tarmac.operators import models

    rows = spark.range(3000).select((F.col("id") % 900).alias("a"), (F.col("id") * 7 % 11).cast("double").alias("b"))
    for df in (rows, rows.select((F.col("a") % 2).alias("a"), "b"), rows.limit(0)):
        plain = df.orderBy(F.xxhash64("a", "b"), "a", "b").limit(20).collect()
        assert sorted(models.fit_sample(df, 20).collect()) == sorted(plain)


def test_heavy_keys_of_all_columns_come_from_one_scan_before_the_joins(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tarmac.operators import lookups

    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 2)).alias("a"),
                                    F.col("id").cast("string").alias("b"))
    tables = {"a": spark.createDataFrame([("k1", 5)], "_key string, va int"), "b": spark.createDataFrame([("7", 6)], "_key string, vb int")}
    assert lookups.heavy_keys_of(rows, ["a", "b"]) == {
        c: [r.asDict() for r in lookups.heavy_keys(rows, c).collect()] for c in ("a", "b")}
    monkeypatch.setattr(lookups, "heavy_keys", None)  # would read the joins made so far
    found = lookups.left_lookups(rows, tables)
    assert found.agg(F.count(F.lit(1)), F.count_if(F.expr("va = 5 AND a = 'k1'")), F.count("va"), F.sum("vb")).first()[:] == (
        4000, rows.filter("a = 'k1'").count(), rows.filter("a = 'k1'").count(), 6)
    empty = lookups.left_lookups(rows.limit(0), tables)
    assert empty.columns == ["a", "b", "va", "vb"] and empty.count() == 0


def test_tracks_are_fitted_side_by_side(spark, monkeypatch):
    from threading import Barrier

    from checks import queries

    both = Barrier(2, timeout=30)
    monkeypatch.setattr(queries, "_split", lambda spark, folder: None)
    monkeypatch.setattr(queries, "_scored", lambda spark, folder, track: both.wait() * 0 + ord(track))
    assert queries._scored_tracks(spark, SF) == {"A": 65, "B": 66}


def test_stored_flights_hold_only_wanted_columns(spark):
    from checks import frames

    op, _ = frames.with_maps(spark, SF, ["DISTANCE"])
    assert "DISTANCE" in op.columns and not {"CARRIER_DELAY", "AIR_TIME", "FL_DATE"} & set(op.columns)


def test_permutation_importance_of_a_logistic_model_sends_no_features(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tarmac.operators import explain, models
    from tarmac.session import materialise

    h = F.pmod(F.xxhash64("id"), F.lit(97)).cast("double")
    rows = materialise(spark.range(400).select(h.alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.lit(3.0).alias("c"),
                                               (h + F.col("id") % 30 > 60).cast("double").alias("label")))
    names = ["a", "b", "c"]
    model = models.train_one(rows, names, "logistic_regression")
    scored = []
    score = models.score
    monkeypatch.setattr(models, "score", lambda m, df: scored.append(1) or score(m, df))
    fast = {r.feature: r for r in explain.permutation_importance(model, rows, names, repeats=3).collect()}
    assert len(scored) == 1  # the baseline
    monkeypatch.setattr(explain, "_linear", lambda model, features: None)
    slow = {r.feature: r for r in explain.permutation_importance(model, rows, names, repeats=3).collect()}
    assert len(scored) == 5 and fast.keys() == slow.keys()
    for c in names:
        assert abs(fast[c].importance_mean - slow[c].importance_mean) < 1e-9
        assert abs(fast[c].importance_std - slow[c].importance_std) < 1e-9
    assert fast["a"].importance_mean > 0.05 and fast["c"].importance_mean == 0


def test_parts_of_a_year_come_from_one_task_without_a_shuffle_of_records(spark):
    from pyspark.sql import functions as F

    from tarmac.sources.driver_tables import raw_flights

    dealt, plain = raw_flights(spark, SF, parts_of_year=4), raw_flights(spark, SF)
    placed = dealt.select("YEAR", (F.col("DAY_OF_MONTH") % 4).alias("part"), F.spark_partition_id().alias("task"))
    tasks = placed.groupBy("YEAR", "part").agg(F.count_distinct("task").alias("n"))
    assert {r.n for r in tasks.collect()} == {1} and tasks.count() == 20
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    plan = dealt._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(plan) if "RepartitionByExpression" in x)
    assert not any("CANCELLED" in x for x in plan[at:])
