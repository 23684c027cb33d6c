"""Typing and the row-local cleaning rules, as one projection over the raw record."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import cells, clock, dates, delays


def normalise_names(df: DataFrame) -> DataFrame:
    """Trim and upper-case headers, drop unnamed trailing columns."""
    named = df.toDF(*[c.strip().upper() for c in df.columns])
    # "_C12" is the name Spark gives a column whose header cell is empty.
    return named.select(*[named[c] for c in named.columns
                          if not re.match(r"UNNAMED|_C\d+$|$", c)])


def require_columns(df: DataFrame, target: str = schema.TARGET, where: str = "input") -> None:
    missing = [c for c in (*schema.REQUIRED, target) if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing from {where}: {', '.join(missing)}")


def conform(df: DataFrame) -> DataFrame:
    """Cast known columns to their declared types; others pass through untouched."""
    return cells.conformed(df, {f.name: f.dataType for f in schema.RAW_SCHEMA})


def in_scope(df: DataFrame, month: int = 1, years: Sequence[int] = schema.ALL_YEARS) -> DataFrame:
    """Keep one calendar month and the given years, each only if the column exists."""
    if "MONTH" in df.columns:
        df = df.filter(F.col("MONTH").cast("int") == month)
    if "YEAR" in df.columns:
        df = df.filter(F.col("YEAR").isin(*years))
    return df


def _blank_where(df: DataFrame, condition: Column, columns: Iterable[str]) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({
        c: F.when(condition, F.lit(None)).otherwise(F.col(c)) for c in columns if c in present
    })


def blank_cancelled(df: DataFrame) -> DataFrame:
    """Cancelled flights have no operational fields. An unknown flag masks nothing."""
    diversion = [c for c in df.columns if c.startswith(schema.CANCELLED_BLANK_PREFIX)]
    return _blank_where(df, F.col("CANCELLED") == 1, [*schema.CANCELLED_BLANKS, *diversion])


def blank_diverted(df: DataFrame) -> DataFrame:
    """Diverted flights have no arrival outcome at the planned airport."""
    return _blank_where(df, F.col("DIVERTED") == 1, schema.DIVERTED_BLANKS)


def add_clock_minutes(df: DataFrame) -> DataFrame:
    """``<col>_MIN`` for every clock column, sine and cosine for the planned ones."""
    kinds = {f.name: f.dataType for f in df.schema}
    present = [c for c in schema.CLOCK_COLUMNS if c in kinds]
    # Parse first, convert second: the conversion refers to the value several times.
    df = df.withColumns({f"{c}_MIN": cells.parsed(c, kinds[c]) for c in present})
    df = df.withColumns({f"{c}_MIN": clock.hhmm_to_minutes(F.col(f"{c}_MIN")) for c in present})
    waves = {}
    for minutes, prefix in schema.CYCLIC_COLUMNS.items():
        if minutes in df.columns:
            waves[f"{prefix}_SIN"], waves[f"{prefix}_COS"] = clock.cyclic(F.col(minutes))
    return df.withColumns(waves) if waves else df


def computed_weekday(month: int = 1) -> Column:
    return dates.weekday(dates.date_of(F.col("YEAR"), F.col("DAY_OF_MONTH"), month))


def weekday_mismatch(month: int = 1) -> Column:
    """The file counts Monday as 1; unknown on either side is not a mismatch."""
    return F.coalesce(F.col("DAY_OF_WEEK") - 1 != computed_weekday(month), F.lit(False))


def add_calendar(df: DataFrame, month: int = 1) -> DataFrame:
    """Flight date from its parts; the file's weekday is replaced by the computed one."""
    df = df.withColumn("FL_DATE", dates.date_of(F.col("YEAR"), F.col("DAY_OF_MONTH"), month))
    df = df.withColumn("DAY_OF_WEEK", dates.weekday(F.col("FL_DATE")))
    return df.withColumn("IS_WEEKEND", dates.weekend_flag(F.col("DAY_OF_WEEK")))


def add_calendar_from_date(df: DataFrame, column: str = "FL_DATE",
                           pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Variant for files that carry their own date text."""
    df = df.withColumn("FL_DATE", dates.parsed_date(F.col(column), pattern))
    return df.withColumns({
        "DAY_OF_WEEK": dates.weekday(F.col("FL_DATE")),
        "DAY_OF_MONTH": F.dayofmonth("FL_DATE").cast("smallint"),
    }).withColumn("IS_WEEKEND", dates.weekend_flag(F.col("DAY_OF_WEEK")))


def add_route(df: DataFrame) -> DataFrame:
    """ORIGIN-DEST; unknown ends give an unknown route rather than a text placeholder."""
    return df.withColumn("ROUTE", F.concat("ORIGIN", F.lit("-"), "DEST"))


def add_delay_category(df: DataFrame, target: str = schema.TARGET,
                       edges: Sequence[float] = schema.DELAY_EDGES,
                       labels: Sequence[str] = schema.DELAY_LABELS) -> DataFrame:
    source = "ARR_DELAY" if target == "ARR_DEL15" else "ARR_DELAY_NEW"
    if source not in df.columns:
        return df
    return df.withColumn("ARR_DELAY_CAT", delays.delay_category(F.col(source), edges, labels))


def add_dominant_cause(df: DataFrame) -> DataFrame:
    causes = [c for c in schema.CAUSES if c in df.columns]
    return df.withColumn("DOMINANT_DELAY_CAUSE", delays.dominant_cause(causes)) if causes else df


def clean(raw: DataFrame, target: str = schema.TARGET, month: int = 1) -> DataFrame:
    """All row-local rules in their fixed order. No shuffle: one projection."""
    df = conform(raw)
    df = blank_diverted(blank_cancelled(df))
    df = add_calendar(add_clock_minutes(df), month)
    df = add_delay_category(add_route(df), target)
    return add_dominant_cause(df)


def operated(df: DataFrame) -> DataFrame:
    """Flights flown as planned; rows with unknown flags are not counted as flown."""
    return df.filter(delays.is_operated())


def rule_metrics(month: int = 1) -> list[Column]:
    """Aggregates over the conformed, not yet cleaned record."""
    return [
        F.count_if(F.col("CANCELLED") == 1).alias("r1_cancelled"),
        F.count_if(F.col("DIVERTED") == 1).alias("r2_diverted"),
        F.count(F.lit(1)).alias("r3_clock_rows"),
        F.count(F.lit(1)).alias("r4_date_rows"),
        F.count_if(weekday_mismatch(month)).alias("weekday_mismatches"),
        F.count_if(F.col("DISTANCE") < 0).alias("negative_distance"),
        F.count_if(F.col("YEAR").isNull()).alias("rows_without_year"),
    ]


def rule_counts(raw: DataFrame, month: int = 1) -> DataFrame:
    return conform(raw).agg(*rule_metrics(month))


def select_flights(df: DataFrame, years: Sequence[int], carriers: Sequence[str],
                   origins: Sequence[str] = (), dests: Sequence[str] = (),
                   blocks: Sequence[str] = ()) -> DataFrame:
    """Multi-select filter: year and carrier always apply, the rest only if given."""
    wanted: Mapping[str, Sequence] = {"ORIGIN": origins, "DEST": dests, "DEP_TIME_BLK": blocks}
    df = df.filter(F.col("YEAR").isin(*years) & F.col("OP_CARRIER").isin(*carriers))
    for column, values in wanted.items():
        if values and column in df.columns:
            df = df.filter(F.col(column).isin(*values))
    return df
