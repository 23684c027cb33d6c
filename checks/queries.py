"""Every registered query, by inventory id. Each reads whole tables from a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.frames import clean, delay_score, encoded, encodings, flown, history_score, raw, text_raw, tidy, with_maps
from tarmac import schema
from tarmac.functions import clock, dates, delays
from tarmac.operators import (bitmaps, cleaning, cube, distributions, encoding, explain, features, frequent, inference, lookups, metrics,
                              models, ordering, quality, ranks, sketches, summaries)
from tarmac.plans import evaluation, overview
from tarmac.plans.prepare import prepare
from tarmac.session import materialise, shared_folder, tune
from tarmac.sources import file_maps, mappings, records, tables
from tarmac.sources import models as model_store
from tarmac.sources.driver_tables import raw_flights
from tarmac.streaming import totals
from tarmac.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        REGISTRY[name] = lambda spark, folder: tidy(build(tune(spark), folder))
        return build
    return register


def _simple(name: str, source: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> None:
    query(name)(lambda spark, folder: operator(source(spark, folder), *args, **kwargs))


KEY = ("YEAR", "DAY_OF_MONTH", "OP_CARRIER", "ORIGIN", "DEST")

# --- sources -------------------------------------------------------------------


@query("io04_typed_cast")
def _(spark, folder):
    return cleaning.conform(text_raw(spark, folder))


def _csv(df, where):
    df.write.option("header", True).csv(where)
    return where


@query("io01_csv_scan")
def _(spark, folder):
    return records.read_records(spark, _text_files(spark, folder)[1]).drop("MONTH")


@query("io02_csv_union")
def _(spark, folder):
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    df = text_raw(spark, folder)
    early = _csv(df.filter("YEAR < 2024").drop("TAXI_OUT"), f"{where}/early")
    late = _csv(df.filter("YEAR >= 2024").drop("DEST"), f"{where}/late")
    return records.read_csv(spark, [early, late]).select("YEAR", "ORIGIN", "DEST", "TAXI_OUT", "CRS_DEP_TIME")


@query("io03_header_names")
def _(spark, folder):
    df = text_raw(spark, folder).select("YEAR", "OP_CARRIER", "ARR_DELAY")
    untidy = df.toDF(" year", "Op_Carrier ", "arr_delay").withColumn("Unnamed: 3", F.lit("x"))
    return cleaning.normalise_names(untidy)


@query("io05_required_columns")
def _(spark, folder):
    df = raw(spark, folder).drop("DIVERTED")
    try:
        cleaning.require_columns(df)
        found = "none"
    except ValueError as error:
        found = str(error)
    return df.agg(F.lit(found).alias("message"), F.count(F.lit(1)).alias("n"))


@query("io09_partition_overwrite")
def _(spark, folder):
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    df = flown(spark, folder).select("YEAR", "ORIGIN")
    tables.write_by_year(df, where)
    tables.write_by_year(df.filter("YEAR = 2025 AND ORIGIN = 'N99'"), where)
    return tables.read_table(spark, where).groupBy("YEAR").agg(F.count(F.lit(1)).alias("n"))


@query("io12_map_reuse")
def _(spark, folder):
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    train = encoding.train_rows(clean(spark, folder))
    mark = mappings.input_fingerprint(spark, [f"{folder}/lineitem.parquet", f"{folder}/orders.parquet"])
    made = [mappings.fit_if_stale(train, where, m) for m in (mark, mark, mark + "x")]
    one = encoding.global_history(mappings.load(spark, where).statistics)
    return one.select("total_train_operated", *[F.lit(m).alias(f"fitted_{i}") for i, m in enumerate(made)])


@query("io12_changed_files")
def _(spark, folder):
    """Maps after one file was added, one replaced and one removed, from statistics per file."""
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    df = text_raw(spark, folder)
    paths = {y: f"{where}/{y}" for y in (2021, 2022, 2023, 2024)}
    for y in (2021, 2022, 2023):
        _csv(df.filter(F.col("YEAR") == y), paths[y])
    file_maps.refresh(spark, [paths[y] for y in (2021, 2022, 2023)], f"{where}/maps")
    _csv(df.filter("YEAR = 2024"), paths[2024])
    df.filter("YEAR = 2022 AND DAY_OF_MONTH <= 15").write.mode("overwrite").option("header", True).csv(paths[2022])
    file_maps.refresh(spark, [paths[y] for y in (2022, 2023, 2024)], f"{where}/maps")
    return file_maps.encodings(spark, f"{where}/maps").statistics


@query("io06_scope_filter")
def _(spark, folder):
    scoped = cleaning.in_scope(raw(spark, folder), month=1, years=[2021, 2025])
    return scoped.groupBy("YEAR", "MONTH").agg(F.count(F.lit(1)).alias("n"))


@query("io07_projected_scan")
def _(spark, folder):
    return flown(spark, folder).select("ORIGIN", "ARR_DEL15", "ARR_DELAY_NEW")


# --- cleaning rules ------------------------------------------------------------

_MASKED = ("DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "TAXI_OUT", "TAXI_IN", "AIR_TIME",
           "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", *schema.CAUSES)


@query("p01_cancelled_blank")
def _(spark, folder):
    df = cleaning.blank_cancelled(cleaning.conform(raw(spark, folder)))
    return df.select(*KEY, "CANCELLED", "CANCELLATION_CODE", "DEP_TIME_BLK", *_MASKED)


@query("p01_every_column")
def _(spark, folder):
    df = cleaning.blank_cancelled(cleaning.conform(raw_flights(spark, folder, wide=True)))
    return df.select(*KEY, "CANCELLED", *schema.CANCELLED_BLANKS, *[c for c in df.columns if c.startswith("DIV_")])


@query("p02_every_column")
def _(spark, folder):
    df = cleaning.blank_diverted(cleaning.conform(raw_flights(spark, folder, wide=True)))
    return df.select(*KEY, "DIVERTED", *schema.DIVERTED_BLANKS)


@query("p03_every_clock")
def _(spark, folder):
    df = cleaning.add_clock_minutes(cleaning.conform(raw_flights(spark, folder, wide=True)))
    return df.select(*KEY, *[f"{c}_MIN" for c in schema.CLOCK_COLUMNS])


@query("p04_every_clock")
def _(spark, folder):
    return quality.clock_statistics(cleaning.clean(raw_flights(spark, folder, wide=True)))


@query("p02_diverted_blank")
def _(spark, folder):
    df = cleaning.blank_diverted(cleaning.conform(raw(spark, folder)))
    return df.select(*KEY, "DIVERTED", *_MASKED)


@query("p03_clock_minutes")
def _(spark, folder):
    return clean(spark, folder).select(*KEY, "CRS_DEP_TIME", "CRS_DEP_TIME_MIN", "CRS_ARR_TIME", "CRS_ARR_TIME_MIN")


_simple("p04_clock_statistics", clean, quality.clock_statistics)


@query("p05_cyclic_encoding")
def _(spark, folder):
    return clean(spark, folder).select(*KEY, "CRS_DEP_SIN", "CRS_DEP_COS", "CRS_ARR_SIN", "CRS_ARR_COS")


@query("p06_flight_date")
def _(spark, folder):
    return clean(spark, folder).select("YEAR", "DAY_OF_MONTH", "FL_DATE", "OP_CARRIER")


@query("p07_weekday_mismatch")
def _(spark, folder):
    df = cleaning.conform(raw(spark, folder))
    return df.groupBy("YEAR", cleaning.computed_weekday().alias("DAY_OF_WEEK")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(cleaning.weekday_mismatch()).alias("mismatches"))


@query("p08_weekend_flag")
def _(spark, folder):
    return clean(spark, folder).select("YEAR", "DAY_OF_MONTH", "DAY_OF_WEEK", "IS_WEEKEND", "ORIGIN")


@query("p09_route")
def _(spark, folder):
    return clean(spark, folder).select("ORIGIN", "DEST", "ROUTE", "YEAR")


@query("p10_delay_category")
def _(spark, folder):
    df = clean(spark, folder)
    variant = delays.delay_category(F.col("ARR_DELAY"), schema.VARIANT_DELAY_EDGES, schema.VARIANT_DELAY_LABELS)
    return df.select("ARR_DELAY", "ARR_DELAY_CAT", delays.category_rank(F.col("ARR_DELAY_CAT")).alias("ARR_DELAY_CAT_ORD"),
                     variant.alias("DELAY_CAT"), *KEY)


@query("p11_dominant_cause")
def _(spark, folder):
    return clean(spark, folder).select(*KEY, *schema.CAUSES, "DOMINANT_DELAY_CAUSE")


@query("p12_operated_filter")
def _(spark, folder):
    return flown(spark, folder).select(*KEY, "CANCELLED", "DIVERTED")


_simple("p13_rule_counts", raw, cleaning.rule_counts)


@query("p13_clean_record")
def _(spark, folder):
    return clean(spark, folder)


@query("p14_departure_hour")
def _(spark, folder):
    return clean(spark, folder).select("CRS_DEP_TIME_MIN", clock.hour_of(F.col("CRS_DEP_TIME_MIN")).alias("DEP_HOUR"), "YEAR")


@query("p15_clip")
def _(spark, folder):
    return clean(spark, folder).select("ARR_DELAY", delays.clip(F.col("ARR_DELAY"), -60, 200).alias("clipped"),
                                       delays.clip(F.col("TAXI_OUT"), 0, 30).alias("taxi_clipped"), "YEAR")


@query("p16_cancellation_reason")
def _(spark, folder):
    return clean(spark, folder).select(*KEY, "CANCELLATION_CODE",
                                       delays.cancellation_reason(F.col("CANCELLATION_CODE")).alias("reason"))


@query("p17_rates")
def _(spark, folder):
    grouped = clean(spark, folder).groupBy("ORIGIN").agg(
        F.count(F.lit(1)).alias("n"), F.sum("CANCELLED").alias("cancelled"), F.avg("ARR_DEL15").alias("delay_rate"))
    return grouped.select("ORIGIN", "n", delays.percent(F.col("cancelled"), F.col("n")).alias("cancel_pct"),
                          ((1 - F.col("delay_rate")) * 100).alias("otp_pct"))


@query("p18_own_flight_date")
def _(spark, folder):
    text = F.concat_ws("-", F.col("YEAR").cast("string"), F.lit("01"), F.lpad(F.col("DAY_OF_MONTH").cast("string"), 2, "0"))
    df = raw(spark, folder).withColumn("FL_DATE", F.when(F.col("CRS_DEP_TIME") == "", "unknown").otherwise(text))
    return cleaning.add_calendar_from_date(df).select("YEAR", "FL_DATE", "DAY_OF_WEEK", "DAY_OF_MONTH", "IS_WEEKEND", "ORIGIN")


@query("p19_flight_filter")
def _(spark, folder):
    kept = cleaning.select_flights(clean(spark, folder), [2022, 2025], ["C01", "C05", "C09"],
                                   origins=["A01", "A03", "A07", "N99"], blocks=["0001-0559", "0800-0859", "1700-1759"])
    return kept.groupBy("YEAR", "OP_CARRIER", "ORIGIN", "DEP_TIME_BLK").agg(F.count(F.lit(1)).alias("n"))


def _page(years, carriers, **also):
    """The page's figures from the cube, by the name of the query that shows each."""
    def shown(name, figure):
        query(name)(lambda spark, folder: overview.overview_from(
            cube.build(clean(spark, folder)), years, carriers, min_flights=50, **also)[figure])
    return shown


_by_carrier = _page([2022, 2025], ["C01", "C05", "C09"])
_by_carrier("a29_cube_key_figures", "key_figures")
_by_carrier("a05_cube_years", "otp_by_year")
_by_carrier("a11_cube_grid", "otp_grid")
_by_end = _page([2022, 2023, 2025], ["C01", "C05", "C09"], origins=["A01", "A03", "A07", "N99"])
_by_end("a26_cube_histogram", "delay_histogram")
_by_end("a18_cube_causes", "cause_minutes")
_page([2022, 2023, 2025], ["C01", "C05", "C09"], dests=["A02", "A04", "A11"], blocks=["0001-0559", "0800-0859", "1700-1759"])(
    "a12_cube_carriers", "carrier_otp")


@query("p20_median_fill")
def _(spark, folder):
    df = clean(spark, folder).select("YEAR", "ORIGIN", "DEP_DELAY", "TAXI_OUT", "CRS_DEP_TIME_MIN")
    return features.fill_by_year(df, ["DEP_DELAY", "TAXI_OUT", "CRS_DEP_TIME_MIN"])


# --- lookups and encodings -----------------------------------------------------


@query("j01_frequency_encode")
def _(spark, folder):
    df = encoding.add_frequency(*with_maps(spark, folder, KEY))
    return df.select(*KEY, *schema.FREQUENCY_FEATURES.values())


@query("j01_salted_lookup")
def _(spark, folder):
    """The encodings by the way for maps that are too large to broadcast."""
    op, maps = with_maps(spark, folder, KEY)
    op = op.select(*dict.fromkeys([*KEY, *schema.FREQUENCY_FEATURES]))
    op = lookups.left_lookups(op, {source: maps.known_keys(source).select("_key", F.col("freq").alias(column))
                                   for source, column in schema.FREQUENCY_FEATURES.items()})
    columns = list(schema.FREQUENCY_FEATURES.values())
    return op.select(*KEY, *[F.coalesce(F.col(c), F.lit(0.0)).cast("float").alias(c) for c in columns])


@query("j02_history_encode")
def _(spark, folder):
    df = encoding.add_history(*with_maps(spark, folder, KEY))
    return df.select(*KEY, *schema.HISTORY_FEATURES.values())


@query("j03_unseen_audit")
def _(spark, folder):
    return encoding.unseen_audit(*with_maps(spark, folder, []))


@query("j03_unseen_audit_2025")
def _(spark, folder):
    return encoding.unseen_audit(*with_maps(spark, folder, []), years=[2025])


@query("j04_busiest_semi_join")
def _(spark, folder):
    return ordering.keep_busiest(flown(spark, folder), "ORIGIN", 10).select(*KEY)


@query("j04_frequent_semi_join")
def _(spark, folder):
    return frequent.keep_busiest(flown(spark, folder), "ORIGIN", 10).select(*KEY)


@query("j05_dominant_group")
def _(spark, folder):
    table = summaries.otp_by(flown(spark, folder), "YEAR", "OP_CARRIER")
    return ordering.leader(table, "YEAR", "flights", "OP_CARRIER").select("YEAR", "OP_CARRIER", "flights", "otp")


@query("a01_frequency_maps")
def _(spark, folder):
    return encodings(spark, folder).frequency


@query("a02_history_maps")
def _(spark, folder):
    return encodings(spark, folder).history


@query("a03_global_history")
def _(spark, folder):
    return encoding.global_history(encoding.key_statistics(encoding.train_rows(clean(spark, folder))))


# --- summaries -----------------------------------------------------------------

_simple("a04_overall_otp", flown, summaries.overall_otp)
_simple("a05_delay_by_year", flown, summaries.delay_by_year)
_simple("a06_carrier_ranking", flown, summaries.carrier_ranking)
_simple("a07_carrier_stability", flown, summaries.carrier_stability)
_simple("a08_airport_pain_index", flown, summaries.airport_pain_index)
_simple("a09_busiest_routes", flown, summaries.busiest_routes)
_simple("a09_worst_busy_routes", flown, summaries.worst_busy_routes)
_simple("a10_delay_heatmap", flown, summaries.delay_heatmap)
_simple("a11_otp_year_block", flown, summaries.otp_grid, "YEAR", "DEP_TIME_BLK")
_simple("a11_otp_year_block_filled", flown, summaries.otp_grid, "YEAR", "DEP_TIME_BLK", empty_otp=100.0)
_simple("a12_carrier_extremes", flown, summaries.carrier_extremes)
_simple("a12_carrier_table", flown, summaries.carrier_otp_table)
_simple("a13_origin_otp", flown, summaries.busiest_otp, "ORIGIN")
_simple("a13_destination_otp", flown, summaries.busiest_otp, "DEST")
_simple("a14_route_otp", flown, summaries.busiest_otp, "ROUTE")
_simple("a13_frequent_origins", flown, summaries.frequent_otp, "ORIGIN")
_simple("a14_frequent_routes", flown, summaries.frequent_otp, "ROUTE")
_simple("a14_worst_routes", flown, summaries.worst_routes, min_flights=100)
_simple("a15_cancellation_by_year", clean, summaries.cancellation_by_year)
_simple("a16_cancellations_by_airport", clean, summaries.cancellations_by_airport)
_simple("a17_cancellation_reasons", clean, summaries.cancellation_reasons)
_simple("a18_cause_minutes_by_year", flown, summaries.cause_minutes)
_simple("a18_cause_minutes_overall", flown, summaries.cause_minutes, by_year=False)
_simple("a19_causes_by_carrier", flown, summaries.causes_by_carrier)
_simple("a20_otp_by_distance_group", flown, summaries.otp_by, "DISTANCE_GROUP")
_simple("a21_otp_by_weekday", flown, summaries.otp_by, "DAY_OF_WEEK")
_simple("a22_daily_otp", flown, summaries.otp_grid, "DAY_OF_MONTH", "YEAR")
_simple("a23_correlations", flown, distributions.correlation_matrix)
_simple("a24_delay_by_hour", flown, summaries.mean_delay_by_hour)
_simple("a25_delay_categories", flown, summaries.category_counts)
_simple("a25_delay_categories_variant", flown, summaries.category_counts,
        schema.VARIANT_DELAY_EDGES, schema.VARIANT_DELAY_LABELS)
_simple("a26_delay_histogram", flown, distributions.histogram, "ARR_DELAY", -60, 200, 100, lone_bin=99)


@query("a26_tail_histogram")
def _(spark, folder):
    late = flown(spark, folder).filter(F.col("ARR_DELAY") > 15)
    return distributions.histogram(late, "ARR_DELAY", 15, 500, 80, lone_bin=79)


_simple("a27_yearly_distribution", flown, distributions.yearly_distribution)


@query("a27_sketched_quartiles")
def _(spark, folder):
    """Quartiles from merged sketches, each told only by whether its rank keeps the stated bound: the values themselves are drawn."""
    chances, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    df = flown(spark, folder).select("YEAR", delays.clip(F.col("ARR_DELAY"), -60, 200).alias("v"))
    found = sketches.quantiles(df, "v", chances, names, by=["YEAR"])
    errors = sketches.rank_errors(df, "v", found, chances, names, by=["YEAR"])
    return errors.select("YEAR", "n", *[(F.col(q) <= sketches.rank_bound()).alias(f"{q}_within") for q in names])


_simple("a28_hexbin", flown, distributions.hexbin)
_simple("a29_key_figures", clean, summaries.key_figures)
_simple("a30_yearly_ingestion", clean, quality.yearly_ingestion)
_simple("a31_column_profile", clean, quality.column_profile)


@query("a32_quality_table")
def _(spark, folder):
    # Decimals print differently from engine to engine, so their distinct text is not compared.
    df = clean(spark, folder)
    return quality.quality_table(df.select(*[c for c in df.columns if not c.endswith(("_SIN", "_COS"))]))


def _yearly_bitmaps(spark, folder):
    return bitmaps.distinct_bitmaps(clean(spark, folder), "YEAR")


query("a32_distinct_by_year")(lambda spark, folder: bitmaps.distinct_counts(_yearly_bitmaps(spark, folder), ["YEAR"]))
query("a32_distinct_merged")(lambda spark, folder: bitmaps.distinct_counts(_yearly_bitmaps(spark, folder)))

_DESCRIBED = ("ARR_DELAY", "DEP_DELAY", "TAXI_OUT", "AIR_TIME", "DISTANCE", "CRS_DEP_TIME_MIN", "CARRIER_DELAY", "DAY_OF_WEEK")
_simple("a33_describe", clean, quality.describe, _DESCRIBED)
_simple("a34_values_by_year", clean, quality.values_by, "YEAR")
_simple("a34_distinct_blocks", clean, quality.distinct_values, "DEP_TIME_BLK")
_simple("a34_year_range", clean, quality.value_range, "YEAR")
_simple("a35_class_balance", flown, quality.class_balance)


@query("a36_target_correlations")
def _(spark, folder):
    numeric = ("DISTANCE", "CRS_ELAPSED_TIME", "DAY_OF_WEEK", "IS_WEEKEND", "CRS_DEP_TIME_MIN",
               "DEP_DELAY", "DEP_DEL15", "TAXI_OUT")
    return distributions.target_correlations(flown(spark, folder), numeric)


@query("a37_consistency")
def _(spark, folder):
    df = cleaning.conform(raw(spark, folder))
    return df.groupBy("YEAR").agg(F.count_if(F.col("DISTANCE") < 0).alias("negative_distance"),
                                  F.count_if(cleaning.weekday_mismatch()).alias("weekday_mismatches"))


# --- ordering and set operations -----------------------------------------------


@query("k01_top_k")
def _(spark, folder):
    by_route = summaries.otp_by(flown(spark, folder), "ROUTE")
    return ordering.top_k(by_route, "flights", 15, "ROUTE", largest=False)


@query("k02_full_sort")
def _(spark, folder):
    return summaries.otp_by(flown(spark, folder), "ROUTE").orderBy(F.col("otp").desc(), "ROUTE")


_simple("k03_preview", clean, lambda df: ordering.preview(df.select(*KEY, "ROUTE", "ARR_DEL15"), 10))


@query("k04_seeded_sample")
def _(spark, folder):
    return ordering.seeded_sample(flown(spark, folder).select(*KEY, "ARR_DEL15"), 1000)


@query("u01_concatenate")
def _(spark, folder):
    df = clean(spark, folder).select(*KEY, "ARR_DEL15", "TAXI_OUT")
    train, test = encoding.train_rows(df), encoding.test_rows(df).drop("TAXI_OUT")
    return train.unionByName(test, allowMissingColumns=True)


# --- feature sets --------------------------------------------------------------


@query("f01_year_split")
def _(spark, folder):
    return flown(spark, folder).groupBy("YEAR", features.split_name().alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("f02_track_a")
def _(spark, folder):
    return features.track_table(encoded(spark, folder, schema.TRACKS["A"]), "A")


@query("f03_track_b")
def _(spark, folder):
    return features.track_table(encoded(spark, folder, schema.TRACKS["B"]), "B")


@query("f04_leakage_audit")
def _(spark, folder):
    # Track A with one outcome column left in, on purpose; with what each column holds.
    wide = materialise(encoded(spark, folder).filter(F.col("ARR_DEL15").isNotNull()))
    tracks = {"A": wide.select(*schema.TRACK_A, "ARR_DEL15", "ARR_DELAY"), "B": features.track_table(wide, "B")}
    held = [quality.column_profile(t).select(F.lit(name).alias("track"), "column", "non_null") for name, t in tracks.items()]
    return features.leakage_audit(tracks).join(held[0].unionByName(held[1]), ["track", "column"], "left")


@query("f05_expected_columns")
def _(spark, folder):
    found = clean(spark, folder)
    gaps = features.column_differences(found.columns, [f.name for f in schema.RAW_SCHEMA])
    return found.agg(F.count(F.lit(1)).alias("n"), *[F.lit(",".join(names)).alias(kind) for kind, names in gaps.items()])


@query("f06_missing_partitions")
def _(spark, folder):
    df = clean(spark, folder)
    full = df.select(F.lit("clean_full").alias("dataset"), F.col("YEAR").cast("int").alias("YEAR")).distinct()
    op = cleaning.operated(df).select(F.lit("clean_operated").alias("dataset"), F.col("YEAR").cast("int").alias("YEAR")).distinct()
    # 2020 and 2026 are outside the data, so both must be reported for both tables.
    return features.missing_partitions(spark, full.unionByName(op), years=range(2020, 2027))


@query("f07_label_encode")
def _(spark, folder):
    df = clean(spark, folder)
    return encoding.label_encode(df.select("ROUTE", "YEAR"), "ROUTE", ranks.dense_codes(df, "ROUTE"))


@query("f08_frequency_feature")
def _(spark, folder):
    op, maps = with_maps(spark, folder)
    df = maps.lookup(op, "ROUTE", freq="ROUTE_FREQ")
    return df.select("ROUTE", F.coalesce("ROUTE_FREQ", F.lit(0.0)).alias("ROUTE_FREQ"), "YEAR")


@query("f09_leave_one_out")
def _(spark, folder):
    op, maps = with_maps(spark, folder)
    train = encoding.train_rows(op).filter(F.col("ARR_DEL15").isNotNull())
    return encoding.leave_one_out_history(train, maps, "ORIGIN").select("ORIGIN", "YEAR", "ARR_DEL15", "ORIGIN_LOO_OTP")


@query("f10_row_counts")
def _(spark, folder):
    return features.row_counts(flown(spark, folder))


@query("f11_feature_rows")
def _(spark, folder):
    op = flown(spark, folder)
    names = ["CRS_DEP_TIME_MIN", "DISTANCE", "IS_WEEKEND"]
    return models.feature_rows(op, names, models.feature_medians(encoding.train_rows(op), names), keep=["YEAR"])


# --- hypothesis tests ----------------------------------------------------------

_simple("h01_chi_square", flown, lambda df: inference.chi_square(df).drop("p_value"))
_simple("h01_chi_square_all_years", flown, lambda df: inference.chi_square(df, rows=None).drop("p_value"))
_simple("h01_p_values", flown, inference.chi_square)
_simple("h01_p_values_all_years", flown, lambda df: inference.chi_square(df, rows=None).select("dof", "p_value"))


@query("h02_cramers_v")
def _(spark, folder):
    return inference.chi_square(flown(spark, folder), "IS_WEEKEND", rows=None).select("n", "cramers_v")


@query("h03_kruskal_wallis")
def _(spark, folder):
    return inference.kruskal_wallis(flown(spark, folder)).select("k", "n", "h")


@query("h04_epsilon_squared")
def _(spark, folder):
    return inference.kruskal_wallis(flown(spark, folder), "OP_CARRIER").select("n", "epsilon_squared")


_simple("h03_p_values", flown, inference.kruskal_wallis)
_simple("h05_p_values", flown, inference.dunn)


@query("h05_dunn")
def _(spark, folder):
    return inference.dunn(flown(spark, folder)).select("level_a", "level_b", "z")


@query("h05_step_down")
def _(spark, folder):
    """Adjustment of given p-values, many of them equal: the shares of late flights of routes, a family per year."""
    given = flown(spark, folder).groupBy("YEAR", "ROUTE").agg((F.floor(F.avg("ARR_DEL15") * 10) / 1000).alias("p_value"))
    return inference.step_down(given, by=["YEAR"])


_simple("h06_cohens_d", flown, inference.cohens_d, "IS_WEEKEND", 0, 1)
_simple("h07_factor_effects", flown, inference.factor_effects)
_simple("h07_cause_shares", flown, inference.cause_shares)

# --- metrics on fixed scores ---------------------------------------------------


@query("m07_threshold_metrics")
def _(spark, folder):
    return metrics.threshold_metrics(metrics.score_counts(delay_score(spark, folder), prediction=F.col("DEP_DELAY") > 15))


_simple("m08_roc_auc_tied", history_score, lambda df: metrics.compute_metrics(df).select("n_samples", "roc_auc"))
_simple("m08_roc_auc", delay_score, lambda df: metrics.compute_metrics(df).select("n_samples", "roc_auc"))
_simple("m09_average_precision", delay_score, lambda df: metrics.compute_metrics(df).select("n_samples", "pr_auc"))
_simple("m09_average_precision_tied", history_score, lambda df: metrics.compute_metrics(df).select("n_samples", "pr_auc"))

@query("m10_confusion_matrix")
def _(spark, folder):
    return metrics.confusion_matrix(delay_score(spark, folder), prediction=F.col("DEP_DELAY") > 15)


_simple("m11_roc_curve", delay_score, metrics.roc_curve)
_simple("m11_pr_curve", delay_score, metrics.pr_curve)
_simple("m12_calibration", delay_score, metrics.calibration)
_simple("m12_positive_rate", delay_score, metrics.positive_rate)


@query("m17_drift")
def _(spark, folder):
    return metrics.drift(delay_score(spark, folder), prediction=F.col("DEP_DELAY") > 15)


# --- verdicts and hypothetical flights -----------------------------------------


@query("m19_early_verdicts")
def _(spark, folder):
    return overview.early_verdicts(clean(spark, folder)).select("DEP_DELAY", "TRACK_A_VERDICT", "TRACK_B_VERDICT", "YEAR")


@query("m20_planned_flights")
def _(spark, folder):
    # Every scheduled flight asked as a what-if, from its hour, minute and ends.
    minutes = F.col("CRS_ARR_TIME_MIN")
    asked = clean(spark, folder).select(
        "YEAR", "DAY_OF_WEEK", "OP_CARRIER", "ORIGIN", "DEST", "DISTANCE",
        F.floor(minutes / 60).cast("int").alias("DEP_HOUR"), F.pmod(minutes, F.lit(60)).alias("DEP_MINUTE"))
    return overview.planned_flights(asked).select(
        "YEAR", "ROUTE", "DEP_HOUR", "DEP_MINUTE", "CRS_DEP_TIME_MIN", "CRS_DEP_SIN", "CRS_DEP_COS", "DAY_OF_WEEK",
        "IS_WEEKEND", "DISTANCE_GROUP", "DEP_TIME_BLK")


# --- models: the stated settings, all models, both tracks; whole tables are scored ---

#: Rows that a fold of the grid search learns from at most. Every other model learns from all training rows.
FIT_ROWS = 4_000

_kept: dict[tuple, object] = {}


def _once(spark, *key, make):
    """What several queries of one session share: stored tables and fitted models."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _split(spark, folder):
    """Stored training and test rows of track B, which holds track A's columns."""
    wide = _once(spark, folder, "tracks", make=lambda: materialise(features.track_table(encoded(spark, folder, schema.TRACKS["B"]), "B")))
    return encoding.train_rows(wide), encoding.test_rows(wide)


def _rows(spark, folder, track):
    """Names, test and training rows of one track, both stored whole, gaps filled with training medians."""
    def make():
        train, test = _split(spark, folder)
        names = list(schema.TRACKS[track])
        medians = models.fill_values(train, names, [train, test])
        ready, learnt = [models.feature_rows(rows, names, medians, keep=["YEAR"]) for rows in (test, train)]
        return names, materialise(ready), models.dealt(learnt)
    return _once(spark, folder, track, "rows", make=make)


def _model(spark, folder, track, name):
    names, _, train = _rows(spark, folder, track)
    return _once(spark, folder, track, name, make=lambda: models.train_one(train, names, name))


def _scored(spark, folder, track, chosen=tuple(models.RECIPES)):
    _rows(spark, folder, track)
    with ThreadPoolExecutor(max_workers=models.FITS_AT_ONCE) as pool:
        trained = dict(zip(chosen, pool.map(lambda n: _model(spark, folder, track, n), chosen)))
    return _once(spark, folder, track, chosen, make=lambda: evaluation.scored_by_model(trained, _rows(spark, folder, track)[1]))


def _scored_tracks(spark, folder):
    """All models' scores of both tracks, whose fits run side by side: hundreds of short rounds leave a cluster idle."""
    _split(spark, folder)
    with ThreadPoolExecutor(max_workers=len(schema.TRACKS)) as pool:
        return dict(zip(schema.TRACKS, pool.map(lambda t: _scored(spark, folder, t), schema.TRACKS)))


def _model_query(name, track, model):
    query(name)(lambda spark, folder: metrics.compute_metrics(
        _scored(spark, folder, track, (model,)), prediction="predicted", by=["model"]))


_model_query("m01_logistic_regression", "A", "logistic_regression")
_model_query("m02_random_forest", "A", "random_forest")
_model_query("m03_boosted_ratio", "A", "boosted_ratio")
_model_query("m04_boosted_balanced", "A", "boosted_balanced")


@query("m05_train_all")
def _(spark, folder):
    return metrics.compute_metrics(_scored(spark, folder, "A"), prediction="predicted", by=["model"])


@query("m06_batch_scores")
def _(spark, folder):
    return _scored(spark, folder, "B", ("logistic_regression",))


@query("m13_model_comparison")
def _(spark, folder):
    comparison = evaluation.full_evaluation(_scored(spark, folder, "B"))["comparison"]
    return comparison.withColumn("best", F.col("model") == evaluation.best_model(comparison).select("model").scalar())


@query("m14_grid_search")
def _(spark, folder):
    names, *_, train = _rows(spark, folder, "A")
    return models.grid_search(train, names, "logistic_regression", fit_rows=FIT_ROWS)


@query("m15_permutation_importance")
def _(spark, folder):
    names, test, _ = _rows(spark, folder, "B")
    return explain.permutation_importance(_model(spark, folder, "B", "logistic_regression"), test, names)


@query("m16_attributions")
def _(spark, folder):
    names, test, _ = _rows(spark, folder, "B")
    model = _model(spark, folder, "B", "random_forest")
    return explain.attribution_summary(explain.sampled_attributions(model, test, names, max_rows=1000))


@query("m16_linear_attributions")
def _(spark, folder):
    names, test, _ = _rows(spark, folder, "A")
    return explain.linear_attributions(_model(spark, folder, "A", "logistic_regression"), test, names)


@query("m17_model_drift")
def _(spark, folder):
    model = _model(spark, folder, "B", "logistic_regression")
    train, test = _split(spark, folder)
    return evaluation.model_drift(model, train.unionByName(test), list(schema.TRACKS["B"]))


@query("m18_full_evaluation")
def _(spark, folder):
    tables = evaluation.evaluate_tracks(_scored_tracks(spark, folder))
    rows = [df.select(F.lit(name).alias("table"), "track" if "track" in df.columns else F.lit(None).cast("string").alias("track"),
                      "model" if "model" in df.columns else F.lit(None).cast("string").alias("model"),
                      F.to_json(F.struct(*[c for c in df.columns if c not in ("track", "model")])).alias("result")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


@query("j06_track_comparison")
def _(spark, folder):
    parts = [metrics.compute_metrics(s, prediction="predicted", by=["model"]) for s in _scored_tracks(spark, folder).values()]
    return evaluation.compare_tracks(*parts)


@query("j06_fixed_scores")
def _(spark, folder):
    # The same plan on two fixed scores standing for a model on each track.
    sides = [s(spark, folder).withColumn("model", F.lit("fixed")) for s in (history_score, delay_score)]
    both = evaluation.compare_tracks(*[metrics.compute_metrics(s, by=["model"]) for s in sides])
    return both.select("model", "accuracy_a", "accuracy_b", "roc_auc_a", "roc_auc_b", "roc_auc_gain")


@query("io13_saved_model")
def _(spark, folder):
    names, test, _ = _rows(spark, folder, "A")
    model = _model(spark, folder, "A", "random_forest")
    where = f"{shared_folder(spark)}/tarmac-models/{uuid.uuid4().hex}"
    model_store.save_model(model, where, "A", "random_forest")
    again = models.score(model_store.load_model(where, "A", "random_forest"), test)
    # Scores of the model and of its stored copy, row by row: as many rows on one side as on the other.
    sides = [df.groupBy("key_YEAR", "score").agg(F.count(F.lit(1)).alias("n")) for df in (again, models.score(model, test))]
    return sides[0].exceptAll(sides[1]).agg(F.count(F.lit(1)).alias("different")).crossJoin(again.agg(F.count(F.lit(1)).alias("n")))


# --- the whole run from text files ---------------------------------------------


def _text_files(spark, folder, reorder=False):
    """The flights as one folder of CSV files per year; with ``reorder`` some have their columns the other way round."""
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    df = text_raw(spark, folder).withColumn("_year", F.col("YEAR"))
    late = F.col("_year") >= "2024" if reorder else F.lit(False)
    df.filter(~late).write.partitionBy("_year").option("header", True).csv(f"{where}/raw")
    if reorder:
        df.filter(late).select(*df.columns[::-1]).write.mode("append").partitionBy("_year").option("header", True).csv(f"{where}/raw")
    return where, [f"{where}/raw/_year={y}" for y in schema.ALL_YEARS]


@query("io08_year_partitions")
def _(spark, folder):
    where, inputs = _text_files(spark, folder)
    run = prepare(spark, inputs, f"{where}/out")
    run.accept()
    return run.table("clean_operated").select(*KEY, "ROUTE", "ARR_DEL15", "TAXI_OUT")


@query("io10_feature_tables")
def _(spark, folder):
    where, inputs = _text_files(spark, folder)
    return prepare(spark, inputs, f"{where}/out").table("ml_track_b")


@query("io10_other_target")
def _(spark, folder):
    where, inputs = _text_files(spark, folder)
    run = prepare(spark, inputs, f"{where}/out", target="ARR_DELAY_NEW")
    run.accept()
    return run.table("ml_track_a")


@query("io11_stored_maps")
def _(spark, folder):
    where, inputs = _text_files(spark, folder)
    return prepare(spark, inputs, f"{where}/out").encodings().frequency


@query("io12_narrower_rerun")
def _(spark, folder):
    where, inputs = _text_files(spark, folder)
    prepare(spark, inputs[:2], f"{where}/out")
    prepare(spark, inputs[2], f"{where}/out")
    run = prepare(spark, inputs[:2], f"{where}/out")
    return run.table("ml_track_b").groupBy("YEAR").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("ORIGIN_FREQ").cast("double")).alias("origin_freq"))


@query("s01_incremental_ingest")
def _(spark, folder):
    where, _ = _text_files(spark, folder, reorder=True)
    ingest(spark, f"{where}/raw/*", f"{where}/stream", f"{where}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{where}/stream").select(*KEY, "ROUTE", "ARR_DEL15", "TAXI_OUT", "CANCELLED", "DIVERTED")


@query("s01_running_totals")
def _(spark, folder):
    """Totals after a wrong delivery of all files and a right one of half of them."""
    where = f"{shared_folder(spark)}/tarmac-runs/{uuid.uuid4().hex}"
    # Each year and part is in one task, so in one file.
    df = raw_flights(spark, folder, parts_of_year=4)
    right = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.col("YEAR").cast("string").alias("_year"),
                      (F.col("DAY_OF_MONTH").cast("int") % 4).alias("_part"))
    wrong = right.withColumn("CANCELLED", F.when(F.col("_part") < 2, F.lit("1")).otherwise(F.col("CANCELLED")))

    def deliver(rows, number):
        rows.write.partitionBy("_year", "_part").option("header", True).csv(f"{where}/raw/delivery={number}")
        totals.count_files(spark, f"{where}/raw/*/*/*", f"{where}/counted", f"{where}/counting",
                           key=lambda path: F.regexp_extract(path, "_year=[^/]*/_part=[^/]*", 0)).awaitTermination()
        totals.total(spark, f"{where}/counted", f"{where}/changes", f"{where}/totalling").awaitTermination()

    deliver(wrong, 1)
    deliver(right.filter("_part < 2"), 2)
    return totals.totals(spark, f"{where}/changes")
