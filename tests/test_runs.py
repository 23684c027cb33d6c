"""Files in, tables out: sources, the full run, streaming, encodings and models."""

import gzip

import pytest
from pyspark.sql import functions as F

from checks import frames
from conftest import SF
from tarmac import schema
from tarmac.operators import cleaning, encoding, explain, features, models
from tarmac.plans import evaluation, overview
from tarmac.plans.prepare import prepare
from tarmac.sources import mappings, records, tables
from tarmac.sources import models as model_store
from tarmac.streaming.ingest import ingest


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("raw")
    text = frames.text_raw(spark, SF).withColumn("_year", F.col("YEAR"))
    text.write.mode("overwrite").partitionBy("_year").option("header", True).csv(str(where))
    return [f"{where}/_year={y}" for y in schema.ALL_YEARS]


@pytest.fixture(scope="module")
def run(spark, inputs, tmp_path_factory):
    return prepare(spark, inputs, str(tmp_path_factory.mktemp("run")))


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_files_with_different_columns(spark, tmp_path):
    a = write(tmp_path / "a.csv", " year ,ORIGIN,Unnamed: 2\n2021,NA,1\n2022,JFK,2\n")
    b = write(tmp_path / "b.csv", "YEAR,DEST,\n2023,<NA>,\n,LAX,x\n")
    df = records.read_csv(spark, [a, b])
    assert df.columns == ["YEAR", "ORIGIN", "DEST"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("2021", None, None), ("2022", "JFK", None), ("2023", None, None), (None, None, "LAX")], key=str)
    assert records.read_csv(spark, [a], na_tokens=("JFK",)).filter("ORIGIN = 'NA'").count() == 1


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    write(tmp_path / "a.csv", "YEAR,ORIGIN,DEST,\n2021,JFK,LAX,\n")
    write(tmp_path / "b.csv", "YEAR,DEST,ORIGIN,\n2022,SFO,BOS,\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "_hidden.csv", "X\n1\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as packed:
        packed.write("ORIGIN,YEAR,ORIGIN\nORD,2023,x\n")
    df = records.read_csv(spark, str(tmp_path))
    assert sorted(map(tuple, df.select("YEAR", "ORIGIN", "DEST").collect())) == [("2021", "JFK", "LAX"), ("2022", "BOS", "SFO"), ("2023", "ORD", None)]
    with pytest.raises(ValueError, match="nothing"):
        records.read_csv(spark, str(tmp_path / "nothing*"))


def test_stream_reads_every_file_by_its_own_header(spark, tmp_path, full):
    text = frames.text_raw(spark, SF)
    names = text.columns
    for part, columns in (("2021", names), ("2022", names[::-1])):
        lines = [",".join([*columns, ""])] + [",".join(str(r[c] if r[c] is not None else "") for c in columns) + "," for r in text.filter(F.col("YEAR") == part).limit(50).collect()]
        write(tmp_path / f"{part}.csv", "\n".join(lines) + "\n")
    ingest(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("YEAR").agg(F.count_if(F.col("ORIGIN").rlike("^[A-Z]")).alias("n"), F.count("ROUTE").alias("routes"))
    assert sorted(map(tuple, got.collect())) == [(2021, 50, 50), (2022, 50, 50)]


def test_required_columns_on_every_input(spark, inputs, tmp_path):
    bad = write(tmp_path / "bad.csv", "YEAR,ORIGIN\n2021,JFK\n")
    with pytest.raises(ValueError, match="bad.csv.*CANCELLED"):
        records.read_records(spark, [inputs[0], bad])
    with pytest.raises(ValueError):
        records.read_records(spark, inputs, target="DEP_DELAY")


def test_full_run_matches_the_direct_rules(spark, run, full):
    assert run.rule_counts().first() == cleaning.rule_counts(frames.raw(spark, SF)).first()
    full = full.withColumn("CRS_DEP_TIME", F.nullif("CRS_DEP_TIME", F.lit("")))  # a blank cell in the file
    stored = run.table("clean_full").select(*full.columns)
    same = [c for c in full.columns if c != "MONTH"]  # not a declared column: stays text
    assert stored.select(same).exceptAll(full.select(same)).isEmpty()
    assert full.select(same).exceptAll(stored.select(same)).isEmpty()
    run.accept()
    assert {r.verdict for r in run.leakage().collect()} == {"ok"}
    for table in run.quality_tables().values():
        assert table.count() > 0


def test_acceptance_names_faults(spark, run):
    with pytest.raises(AssertionError, match="missing partition clean_full YEAR=2030"):
        run.accept(years=[2021, 2030])
    leaky = spark.createDataFrame([(1, 1, 1)], "TAXI_OUT int, ARR_DEL15 int, ODD int")
    verdicts = {(r.track, r.column): r.verdict for r in features.leakage_audit({"A": leaky, "B": leaky}).collect()}
    assert verdicts["A", "TAXI_OUT"] == "leaked" and verdicts["B", "TAXI_OUT"] == "ok"
    assert verdicts["A", "ODD"] == "extra" and verdicts["A", "ROUTE_FREQ"] == "missing"
    assert features.leaked_columns(["ARR_DEL15", "ARR_DELAY"], "A") == ["ARR_DELAY"]
    assert features.column_differences(["a"], ["b"]) == {"missing": ["b"], "extra": ["a"]}


def test_only_touched_years_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_year(spark.createDataFrame([(2021, 1), (2022, 2), (None, 9)], "YEAR int, v int"), path)
    tables.write_by_year(spark.createDataFrame([(2022, 5)], "YEAR int, v int"), path, compact=True)
    assert sorted(map(tuple, tables.read_table(spark, path, ["YEAR", "v"]).collect())) == [(2021, 1), (2022, 5)]
    tables.write_by_year(spark.createDataFrame([(2023, 6)], "YEAR int, v int"), path, overwrite=False)
    with pytest.raises(ValueError, match="2023"):
        tables.write_by_year(spark.createDataFrame([(2023, 6), (2024, 1)], "YEAR int, v int"), path, overwrite=False)
    assert tables.read_table(spark, path).count() == 3


def test_reruns_leave_other_years_out(spark, inputs, tmp_path):
    folder = str(tmp_path / "run")
    first = prepare(spark, inputs[:2], folder)
    rows = sorted(map(tuple, first.encodings().statistics.collect()), key=str)
    prepare(spark, inputs[2], folder)  # one path, not a list
    again = prepare(spark, inputs[:2], folder)
    assert sorted(map(tuple, again.encodings().statistics.collect()), key=str) == rows
    assert {r.YEAR for r in again.table("ml_track_b").select("YEAR").distinct().collect()} == {2021, 2022}
    assert {r.YEAR for r in again.table("clean_full").select("YEAR").distinct().collect()} == {2021, 2022, 2023}


def test_the_other_target_gets_maps_and_tracks(spark, inputs, tmp_path):
    run = prepare(spark, inputs[:1], str(tmp_path / "run"), target="ARR_DELAY_NEW", train_years=(2021,))
    run.accept(years=[2021])
    columns = set(run.table("ml_track_a").columns)
    assert {"ORIGIN_FREQ", "ROUTE_FREQ", "ARR_DELAY_NEW"} <= columns and not columns & {"ORIGIN_HIST_OTP", "CARRIER_HIST_OTP", "ARR_DEL15"}


def test_settings_of_the_caller_stay(spark, inputs, tmp_path):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        prepare(spark, inputs[:1], str(tmp_path / "run"))
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, before)


def test_year_filter_prunes_partitions(run):
    plan = run.table("clean_operated").filter("YEAR = 2025").select("ORIGIN", "ARR_DEL15")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in text and "ReadSchema: struct<ORIGIN:string,ARR_DEL15:smallint>" in text


def test_maps_are_reused_only_for_equal_inputs(spark, run, inputs, tmp_path):
    folder = f"{run.folder}/mappings"
    print_ = mappings.input_fingerprint(spark, inputs)
    assert print_ == mappings.input_fingerprint(spark, list(reversed(inputs)))
    assert mappings.is_current(spark, folder, "ARR_DEL15", schema.TRAIN_YEARS, print_)
    assert not mappings.is_current(spark, folder, "ARR_DEL15", (2021,), print_)
    assert not mappings.is_current(spark, folder, "ARR_DEL15", schema.TRAIN_YEARS, "0:0")
    empty = mappings.load(spark, str(tmp_path / "nowhere"))
    assert empty.global_otp == 0.5
    coded = encoding.encode(run.table("clean_operated"), empty)
    assert coded.select("ROUTE_FREQ", "ORIGIN_HIST_OTP").distinct().collect() == [(0.0, 0.5)]


def test_history_needs_the_binary_target(full):
    with pytest.raises(ValueError):
        encoding.key_statistics(full, "ARR_DELAY_NEW")


def test_large_maps_are_shuffled_not_broadcast(op, full, monkeypatch):
    maps = encoding.Encodings.fit(encoding.train_rows(full))
    small = encoding.add_frequency(op, maps)
    monkeypatch.setattr(encoding, "BROADCAST_ROWS", 0)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    wide = encoding.add_frequency(op, maps)
    assert "strategy=broadcast" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert small.exceptAll(wide).isEmpty() and wide.exceptAll(small).isEmpty()


def test_unknown_keys_and_single_rows(spark):
    ddl = "YEAR int, OP_CARRIER string, ORIGIN string, DEST string, ROUTE string, DEP_TIME_BLK string, CANCELLED int, DIVERTED int, ARR_DEL15 int"
    rows = [(2021, "X", "A", "B", "A-B", "t", 0, 0, 1), (2021, "X", "A", "B", "A-B", "t", 0, 0, 0),
            (2021, "Y", "C", None, None, "t", 0, 0, None), (2021, "Z", "D", "B", "D-B", "t", 1, 0, None),
            (2021, "X", None, "B", None, "t", 0, 0, 1)]
    train = spark.createDataFrame(rows, ddl)
    maps = encoding.Encodings.fit(train)
    assert maps.global_otp == pytest.approx((4 - 1) / 4)  # the delay without an origin is not counted
    freq = {(r.source, r.key): r.freq for r in maps.frequency.collect()}
    assert freq["ORIGIN", "A"] == 0.5 and freq["DEST", "B"] == 1.0 and ("DEST", None) not in freq
    otp = {(r.source, r.key): r.otp for r in maps.history.collect()}
    assert otp["ORIGIN", "A"] == 0.5 and otp["ORIGIN", "C"] == 0.5 and ("ORIGIN", "D") not in otp
    assert otp["OP_CARRIER", "X"] == pytest.approx(1 / 3)
    test = spark.createDataFrame([(2025, "N", None, "B", None, "t", 0, 0, 1), (2025, "X", "D", "B", "D-B", "t", 0, 0, 0)], ddl)
    got = sorted(encoding.encode(test, maps).collect(), key=lambda r: r.OP_CARRIER)
    assert (got[0].OP_CARRIER_FREQ, got[0].ORIGIN_FREQ, got[0].ORIGIN_HIST_OTP) == (0, 0, 0.75)
    assert (got[1].ORIGIN_FREQ, got[1].ORIGIN_HIST_OTP) == (0.25, 0.75)
    audit = {r.source: (r.total, r.unseen) for r in encoding.unseen_audit(test, maps).collect()}
    assert audit["OP_CARRIER"] == (2, 1) and audit["ORIGIN"] == (1, 0) and audit["otp_ORIGIN"] == (1, 1)
    own = encoding.leave_one_out_history(train.filter("ARR_DEL15 IS NOT NULL AND ORIGIN IS NOT NULL"), maps, "ORIGIN")
    assert sorted((r.ARR_DEL15, r.ORIGIN_LOO_OTP) for r in own.collect()) == [(0, 0.0), (1, 1.0)]


def test_median_fill(spark):
    rows = [(2021, 1.0, None), (2021, None, None), (2021, 4.0, None), (2022, None, 3.0)]
    got = features.fill_by_year(spark.createDataFrame(rows, "YEAR int, a double, b double"), ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [(2021, 1.0, -1.0), (2021, 2.5, -1.0), (2021, 4.0, -1.0), (2022, -1.0, 3.0)]


def test_stream_equals_batch_and_runs_twice(spark, inputs, tmp_path, full):
    root = inputs[0].rsplit("/", 1)[0]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second pass finds nothing new
        ingest(spark, f"{root}/_year=*", out, checkpoint, max_files=2).awaitTermination()
    got = spark.read.parquet(out)
    columns = ["YEAR", "DAY_OF_WEEK", "ROUTE", "CRS_DEP_TIME_MIN", "ARR_DELAY_CAT", "DOMINANT_DELAY_CAUSE", "ARR_DELAY"]
    assert got.count() == full.count()
    assert got.select(columns).exceptAll(full.select(columns)).isEmpty()


@pytest.fixture(scope="module")
def fitted(run):
    names = list(schema.TRACKS["B"])
    table = run.table("ml_track_b")
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    medians = models.feature_medians(train, names)
    rows = models.feature_rows(train, names, medians, keep=["YEAR"])
    return names, rows, models.feature_rows(test, names, medians, keep=["YEAR"])


def test_models_train_score_and_reload(spark, fitted, tmp_path):
    names, rows, test = fitted
    with pytest.raises(ValueError, match="logistic_regression"):
        models.train_one(rows, names, "nothing")
    quick = {"logistic_regression": {"maxIter": 20}, "random_forest": {"numTrees": 3, "maxDepth": 4}}
    trained = {n: models.train_one(rows, names, n, s) for n, s in quick.items()}
    scored = evaluation.scored_by_model(trained, test)
    parts = evaluation.full_evaluation(scored)
    comparison = {r.model: r for r in parts["comparison"].collect()}
    assert comparison["logistic_regression"].roc_auc > 0.9  # departure delay is in track B
    best = evaluation.best_model(parts["comparison"]).first()
    assert best.roc_auc == max(r.roc_auc for r in comparison.values())
    assert parts["confusion"].groupBy("model").agg(F.sum("n").alias("n")).select("n").distinct().first().n == test.count()
    gains = evaluation.compare_tracks(parts["comparison"], parts["comparison"]).collect()
    assert all(r.roc_auc_gain == 0 for r in gains)
    model_store.save_model(trained["random_forest"], str(tmp_path), "B", "random_forest")
    again = model_store.load_model(str(tmp_path), "B", "random_forest")
    same = models.score(again, test).exceptAll(models.score(trained["random_forest"], test))
    assert same.isEmpty()
    importance = explain.permutation_importance(trained["logistic_regression"], test, names, repeats=2)
    assert importance.first().feature in ("DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15") and importance.count() == 20


def test_attributions_add_up(spark):
    rows = [(float(i % 7), float(i % 5), float((i % 7) > 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = models.train_one(df, ["a", "b"], "logistic_regression", {"maxIter": 30})
    linear = models.score(model, df).select("score", *[c for c in ("a", "b")])
    parts = explain.linear_attributions(model, df.select("a", "b"), ["a", "b"])
    assert parts.count() == linear.count() == 300
    spread = parts.agg(F.stddev("a").alias("a"), F.stddev("b").alias("b")).first()
    assert spread.a > 50 * spread.b or spread.b < 0.05 * spread.a
    table = explain.sampled_attributions(model, df, ["a", "b"], max_rows=100, draws=10)
    assert table.count() == 200
    ranked = explain.attribution_summary(table).collect()
    assert ranked[0].feature == "a" and ranked[0].mean_abs > 5 * ranked[1].mean_abs


def test_forward_chaining_grid(fitted):
    names, rows, _ = fitted
    table = models.grid_search(rows, names, "logistic_regression", years=(2021, 2022, 2023), grid={"C": [0.1, 1.0]}, settings={"maxIter": 5})
    got = table.collect()
    assert len(got) == 2 and all(r.folds == 2 for r in got) and got[0].roc_auc >= got[1].roc_auc


def test_class_weights():
    assert models.class_weights(90, 10, "ratio") == (1.0, 9.0)
    w0, w1 = models.class_weights(90, 10, "balanced")
    assert w0 * 90 == pytest.approx(50) and w1 * 10 == pytest.approx(50)
    assert models.class_weights(5, 0, "ratio") == (1.0, 1.0)


def test_overview_and_planned_flights(spark, full):
    parts = overview.overview(full, [2021, 2022], ["C01", "C02"], min_flights=1)
    assert parts["key_figures"].first().total_flights == full.filter("YEAR IN (2021, 2022) AND OP_CARRIER IN ('C01', 'C02')").count()
    assert {r.YEAR for r in overview.choices(full)["YEAR"].collect()} == set(schema.ALL_YEARS)
    ask = spark.createDataFrame([(2025, 5, "C01", "A01", "A02", 499.0, 5, 30), (2025, 1, "C01", "A01", "A02", 500.0, 13, 5)],
                                "YEAR int, DAY_OF_WEEK int, OP_CARRIER string, ORIGIN string, DEST string, DISTANCE double, DEP_HOUR int, DEP_MINUTE int")
    got = overview.planned_flights(ask, encoding.Encodings.fit(encoding.train_rows(full))).orderBy("DEP_HOUR").collect()
    assert [(r.CRS_DEP_TIME_MIN, r.IS_WEEKEND, r.DISTANCE_GROUP, r.DEP_TIME_BLK) for r in got] == [
        (330, 1, 2, "0001-0559"), (785, 0, 3, "1300-1359")]
    assert all(r.OP_CARRIER_FREQ > 0 for r in got)


def test_shared_folder_is_the_named_one(spark):
    from tarmac.session import shared_folder

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
