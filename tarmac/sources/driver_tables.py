"""A flights table derived from order lines, for data that ships without flights.

The derivation is integer arithmetic only, so any SQL engine gives the same rows.
It yields raw records: clock times as text with blanks and 2400, wrong weekdays,
outcomes filled in on cancelled and diverted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How flights are derived from the test tables. The SQL twins of the queries repeat it.
_HASHES = {
    "h": "l_orderkey*31 + l_partkey*7 + l_suppkey*13 + l_linenumber*101"
         " + CAST(l_quantity AS BIGINT)*1009",
    "m": "(l_partkey*37 + l_linenumber*61) % 1440",
    "e": "60 + (l_partkey*11) % 300",
}
_PARTS = {
    "a": "CASE WHEN h % 1000 < 790 + l_suppkey % 14 * 3 THEN h % 41 - 26"
         " ELSE 15 + (h % 1000)*(h % 7 + 1) % 240 END",
    "yr": "CAST(2021 + l_orderkey % 5 AS INT)",
    "dom": "CAST(1 + (l_partkey + l_linenumber) % 31 AS INT)",
    "hh": "CAST((m - m % 60)/60 AS BIGINT)",
    "am": "(m+e) % 1440",
    "dist": "100 + (l_partkey*13) % 2400",
}
_COLUMNS = {
    "YEAR": "yr",
    "MONTH": "1",
    "DAY_OF_MONTH": "dom",
    "DAY_OF_WEEK": "CASE WHEN h % 997 = 0 THEN (weekday(make_date(yr,1,dom))+1) % 7 + 1"
                   " ELSE weekday(make_date(yr,1,dom))+1 END",
    "OP_CARRIER": "'C' || lpad(CAST(l_suppkey % 14 AS STRING),2,'0')",
    "ORIGIN": "CASE WHEN yr=2025 AND h % 211 = 0 THEN 'N99'"
              " ELSE 'A' || lpad(CAST(s_nationkey AS STRING),2,'0') END",
    "DEST": "'A' || lpad(CAST(c_nationkey AS STRING),2,'0')",
    "CRS_DEP_TIME": "CASE WHEN h % 499 = 0 THEN '' WHEN h % 503 = 0 THEN '2400'"
                    " ELSE lpad(CAST(m + 40*hh AS STRING),4,'0') END",
    "CRS_ARR_TIME": "lpad(CAST(CAST(am + 40*((am - am % 60)/60) AS BIGINT) AS STRING),4,'0')",
    "DEP_TIME_BLK": "CASE WHEN hh < 6 THEN '0001-0559' ELSE lpad(CAST(hh AS STRING),2,'0')"
                    " || '00-' || lpad(CAST(hh AS STRING),2,'0') || '59' END",
    "CRS_ELAPSED_TIME": "CAST(e AS DOUBLE)",
    "DISTANCE": "CAST(dist AS DOUBLE)",
    "DISTANCE_GROUP": "CAST((dist - dist % 250)/250 AS INT) + 1",
    "DEP_DELAY": "CAST(a - (h % 13 - 6) AS DOUBLE)",
    "DEP_DELAY_NEW": "CAST(greatest(a - (h % 13 - 6), 0) AS DOUBLE)",
    "DEP_DEL15": "CASE WHEN a - (h % 13 - 6) >= 15 THEN 1 ELSE 0 END",
    "TAXI_OUT": "CAST(8 + l_partkey % 35 AS DOUBLE)",
    "TAXI_IN": "CAST(3 + l_partkey % 12 AS DOUBLE)",
    "AIR_TIME": "CAST(e - (8 + l_partkey % 35) - (3 + l_partkey % 12) AS DOUBLE)",
    "ARR_DELAY": "CAST(a AS DOUBLE)",
    "ARR_DELAY_NEW": "CAST(greatest(a, 0) AS DOUBLE)",
    "ARR_DEL15": "CASE WHEN a >= 15 THEN 1 ELSE 0 END",
    "CANCELLED": "CASE WHEN h % 29 = 0 THEN 1 ELSE 0 END",
    "CANCELLATION_CODE": "CASE WHEN h % 29 = 0 THEN substr('ABCD', CAST(1 + h % 4 AS INT), 1) END",
    "DIVERTED": "CASE WHEN h % 29 <> 0 AND h % 307 = 0 THEN 1 ELSE 0 END",
}
_CAUSE_SLOTS = ("CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY")
_COLUMNS.update({
    name: f"CASE WHEN a < 15 THEN NULL ELSE CAST(CASE WHEN h % 5 = {slot} THEN a - a % 3"
          f" WHEN (h + 1) % 5 = {slot} THEN a % 3 ELSE 0 END AS DOUBLE) END"
    for slot, name in enumerate(_CAUSE_SLOTS)
})


def _hhmm(minutes: str) -> str:
    return f"lpad(CAST(CAST({minutes} + 40*(({minutes} - {minutes} % 60)/60) AS BIGINT) AS STRING),4,'0')"


#: The remaining columns that the cleaning rules know, for records as wide as the files are.
_MORE_COLUMNS = {
    "DEP_TIME": _hhmm("((m + h % 60) % 1440)"),
    "WHEELS_OFF": _hhmm("((m + h % 60 + 8 + l_partkey % 35) % 1440)"),
    "WHEELS_ON": _hhmm("((am + h % 50 + 1435) % 1440)"),
    "ARR_TIME": f"CASE WHEN h % 401 = 0 THEN '2400' ELSE {_hhmm('((am + h % 50) % 1440)')} END",
    "FIRST_DEP_TIME": f"CASE WHEN h % 17 = 0 THEN {_hhmm('m')} END",
    "DEP_DELAY_GROUP": "CAST(h % 15 - 2 AS INT)",
    "ARR_DELAY_GROUP": "CAST(h % 14 - 2 AS INT)",
    "ARR_TIME_BLK": "CASE WHEN am < 360 THEN '0001-0559' ELSE lpad(CAST(CAST((am - am % 60)/60 AS BIGINT) AS STRING),2,'0') || 'XX' END",
    "ACTUAL_ELAPSED_TIME": "CAST(e + h % 21 - 10 AS DOUBLE)",
    "TOTAL_ADD_GTIME": "CASE WHEN h % 17 = 0 THEN CAST(h % 40 AS DOUBLE) END",
    "LONGEST_ADD_GTIME": "CASE WHEN h % 17 = 0 THEN CAST(h % 30 AS DOUBLE) END",
    "DIV_AIRPORT_LANDINGS": "CAST(h % 3 AS INT)",
    "DIV_REACHED_DEST": "CASE WHEN h % 19 = 0 THEN CAST(h % 2 AS INT) END",
    "DIV_ACTUAL_ELAPSED_TIME": "CASE WHEN h % 19 = 0 THEN CAST(e + 100 AS DOUBLE) END",
    "DIV_ARR_DELAY": "CASE WHEN h % 19 = 0 THEN CAST(a + 60 AS DOUBLE) END",
    "DIV_DISTANCE": "CASE WHEN h % 19 = 0 THEN CAST(h % 300 AS DOUBLE) END",
}


# The columns read and their stored types. Stating them saves a footer
# scan per table; only these reach the scan.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
}


def raw_flights(spark: SparkSession, folder: str, wide: bool = False, parts_of_year: int | None = None) -> DataFrame:
    """Raw flight records over the tables in ``folder``, one per order line; ``wide`` adds the columns only the rules read.

    With ``parts_of_year`` the rows of a year whose DAY_OF_MONTH has one remainder by it come from one task. The
    order lines are shuffled for that, a quarter as wide as the records.
    """
    def table(name: str) -> DataFrame:
        return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")

    # Orders get their customer first: the order lines, four times as many and wider, are then shuffled once.
    placed = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    lines = (
        table("lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    if parts_of_year is not None:
        lines = lines.drop("o_orderkey", "s_suppkey").repartition(F.expr(_PARTS["yr"]), F.expr(f"({_PARTS['dom']}) % {parts_of_year}"))
    hashed = lines.withColumns({k: F.expr(v) for k, v in _HASHES.items()})
    parts = hashed.withColumns({k: F.expr(v) for k, v in _PARTS.items()})
    return parts.select(*[F.expr(sql).alias(name) for name, sql in (_COLUMNS | _MORE_COLUMNS if wide else _COLUMNS).items()])
