"""Literal goldens for the row-local rules and their edges."""

import math

import pytest
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import clock, dates, delays
from tarmac.operators import cleaning


def one(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_clock_minutes_edges(spark):
    cases = {"": None, "abc": None, "600": 360, "0600": 360, " 600 ": 360, "2400": None, "1275": 795, "-5": 35,
             "600.5": None, "NaN": None, "0": 0, "2359": 1439, "2360": None, "5d": None, "600f": None, "0x1p3": None,
             "1e2": 60, "1e300": None, "Infinity": None, None: None, "600.0": 360}
    df = spark.createDataFrame([(k,) for k in cases], "CRS_DEP_TIME string")
    assert one(cleaning.add_clock_minutes(df), "CRS_DEP_TIME_MIN") == list(cases.values())


def test_cyclic_encoding(spark):
    df = spark.createDataFrame([(0,), (360,), (720,), (None,)], "m int")
    sine, cosine = clock.cyclic(F.col("m"))
    rows = df.select(sine.alias("s"), cosine.alias("c")).collect()
    assert [(round(r.s, 5), round(r.c, 5)) for r in rows[:3]] == [(0, 1), (1, 0), (0, -1)]
    assert rows[3].s is None and rows[3].c is None


def test_typed_cast(spark):
    cases = {"600": 600, "600.0": 600, "600.5": None, "99999": None, "x": None, "": None, "NaN": None, None: None}
    df = spark.createDataFrame([(k, k) for k in cases], "YEAR string, DEP_DELAY string")
    got = cleaning.conform(df)
    assert dict(got.dtypes) == {"YEAR": "smallint", "DEP_DELAY": "float"}
    assert one(got, "YEAR") == list(cases.values())
    assert one(got, "DEP_DELAY") == [600, 600, 600.5, 99999, None, None, None, None]


def test_numeric_nan_becomes_null(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (2.5,)], "TAXI_OUT double")
    assert one(cleaning.conform(df), "TAXI_OUT") == [None, None, 2.5]


def test_delay_categories(spark):
    cases = {-1.0: "<=0", 0.0: "<=0", 0.5: "1-15", 15.0: "1-15", 15.5: "16-60", 60.0: "16-60", 180.0: "61-180",
             181.0: ">180", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "d double")
    got = df.select(delays.delay_category(F.col("d")).alias("c"))
    assert one(got, "c") == list(cases.values())
    book = df.select(delays.delay_category(F.col("d"), schema.VARIANT_DELAY_EDGES, schema.VARIANT_DELAY_LABELS).alias("c"))
    assert one(book, "c")[-3] == "Extreme (>120)"
    with pytest.raises(ValueError):
        delays.delay_category(F.col("d"), (0, 1), ("a", "b"))


def test_dominant_cause(spark):
    columns = ", ".join(f"{c} double" for c in schema.CAUSES)
    rows = [(5.0, 5.0, 0.0, 0.0, 0.0), (0.0,) * 5, (None,) * 5, (None, 2.0, None, None, 3.0), (0.0, 0.0, 7.0, None, 7.0)]
    df = cleaning.add_dominant_cause(spark.createDataFrame(rows, columns))
    assert one(df, "DOMINANT_DELAY_CAUSE") == ["CARRIER_DELAY", None, None, "LATE_AIRCRAFT_DELAY", "NAS_DELAY"]


def test_masks(spark):
    ddl = "CANCELLED int, DIVERTED int, ARR_DELAY double, AIR_TIME double, ARR_TIME_BLK string, DIV_DISTANCE double, DEP_TIME_BLK string"
    rows = [(1, 0, 1.0, 1.0, "a", 1.0, "b"), (0, 1, 1.0, 1.0, "a", 1.0, "b"), (1, 1, 1.0, 1.0, "a", 1.0, "b"),
            (None, None, 1.0, 1.0, "a", 1.0, "b")]
    df = cleaning.blank_diverted(cleaning.blank_cancelled(spark.createDataFrame(rows, ddl)))
    got = [tuple(r)[2:] for r in df.collect()]
    assert got == [(None, None, "a", None, "b"), (None, 1.0, None, 1.0, "b"), (None, None, None, None, "b"),
                   (1.0, 1.0, "a", 1.0, "b")]
    assert cleaning.operated(df).count() == 0


def test_dates_and_weekdays(spark):
    rows = [(2021, 1, 5), (2021, 32, 1), (2021, 31, 7), (None, 3, 1), (2024, None, 1), (2025, 4, None)]
    df = spark.createDataFrame(rows, "YEAR int, DAY_OF_MONTH int, DAY_OF_WEEK int")
    flagged = df.select("*", cleaning.weekday_mismatch().alias("bad"))
    assert [r.bad for r in flagged.collect()] == [False, False, False, False, False, False]
    got = cleaning.add_calendar(df).collect()
    assert [str(r.FL_DATE) if r.FL_DATE else None for r in got] == ["2021-01-01", None, "2021-01-31", None, None, "2025-01-04"]
    assert [r.DAY_OF_WEEK for r in got] == [4, None, 6, None, None, 5]
    assert [r.IS_WEEKEND for r in got] == [0, 0, 1, 0, 0, 1]
    wrong = spark.createDataFrame([(2021, 1, 4)], df.schema)
    assert wrong.filter(cleaning.weekday_mismatch()).count() == 1
    february = df.select(dates.date_of(F.lit(2023), F.lit(29), 2).alias("d"))
    assert february.first().d is None


def test_route_and_clip_keep_unknowns(spark):
    df = spark.createDataFrame([("A", "B", 300.0), (None, "B", None)], "ORIGIN string, DEST string, d double")
    got = cleaning.add_route(df).select("ROUTE", delays.clip(F.col("d"), -60, 200).alias("c")).collect()
    assert [tuple(r) for r in got] == [("A-B", 200.0), (None, None)]


def test_names_and_required_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` year ` int, `Unnamed: 65` int, _c9 int")
    assert cleaning.normalise_names(df).columns == ["YEAR"]
    with pytest.raises(ValueError, match="DAY_OF_MONTH"):
        cleaning.require_columns(cleaning.normalise_names(df))


def test_flight_filter_excludes_unknown_carriers(spark):
    df = spark.createDataFrame([(2021, "X", "A"), (2021, None, "A"), (2022, "X", "B")], "YEAR int, OP_CARRIER string, ORIGIN string")
    assert cleaning.select_flights(df, [2021, 2022], ["X"]).count() == 2
    assert cleaning.select_flights(df, [2021, 2022], ["X"], origins=["B"]).count() == 1


def test_clean_is_one_narrow_stage(spark, full):
    from checks import frames

    text = spark.createDataFrame([tuple(map(str, range(len(schema.RAW_SCHEMA))))],
                                 ", ".join(f"{f.name} string" for f in schema.RAW_SCHEMA))
    plan = cleaning.clean(text)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "BatchEval" not in plan
    assert len(cleaning.clean(text).columns) == 82  # the 66 raw columns and 16 derived ones
    assert frames.tidy(full).columns == full.columns
