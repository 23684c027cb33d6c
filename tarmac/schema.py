"""Column vocabulary of the on-time table.

Everything in this module is a FIXED VALUE: public column names, types, code
lists and bin edges that have to be exactly these for results to be right.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw record, in file order. Clock times stay text because
# blanks, "2400" and unpadded values all have to reach the clock parser intact.
RAW_DDL = """
YEAR smallint, DAY_OF_MONTH smallint, DAY_OF_WEEK smallint,
OP_UNIQUE_CARRIER string, OP_CARRIER_AIRLINE_ID int, OP_CARRIER string,
TAIL_NUM string, OP_CARRIER_FL_NUM int,
ORIGIN_AIRPORT_ID int, ORIGIN_AIRPORT_SEQ_ID int, ORIGIN_CITY_MARKET_ID int,
ORIGIN string, ORIGIN_CITY_NAME string, ORIGIN_STATE_ABR string,
ORIGIN_STATE_FIPS smallint, ORIGIN_STATE_NM string, ORIGIN_WAC smallint,
DEST_AIRPORT_ID int, DEST_AIRPORT_SEQ_ID int, DEST_CITY_MARKET_ID int,
DEST string, DEST_CITY_NAME string, DEST_STATE_ABR string,
DEST_STATE_FIPS smallint, DEST_STATE_NM string, DEST_WAC smallint,
CRS_DEP_TIME string, DEP_TIME string, DEP_DELAY float, DEP_DELAY_NEW float,
DEP_DEL15 smallint, DEP_DELAY_GROUP smallint, DEP_TIME_BLK string,
TAXI_OUT float, WHEELS_OFF string, WHEELS_ON string, TAXI_IN float,
CRS_ARR_TIME string, ARR_TIME string, ARR_DELAY float, ARR_DELAY_NEW float,
ARR_DEL15 smallint, ARR_DELAY_GROUP smallint, ARR_TIME_BLK string,
CANCELLED smallint, CANCELLATION_CODE string, DIVERTED smallint,
CRS_ELAPSED_TIME float, ACTUAL_ELAPSED_TIME float, AIR_TIME float,
FLIGHTS smallint, DISTANCE float, DISTANCE_GROUP smallint,
CARRIER_DELAY float, WEATHER_DELAY float, NAS_DELAY float,
SECURITY_DELAY float, LATE_AIRCRAFT_DELAY float,
FIRST_DEP_TIME string, TOTAL_ADD_GTIME float, LONGEST_ADD_GTIME float,
DIV_AIRPORT_LANDINGS smallint, DIV_REACHED_DEST smallint,
DIV_ACTUAL_ELAPSED_TIME float, DIV_ARR_DELAY float, DIV_DISTANCE float
"""

_SPARK_TYPES = {"smallint": T.ShortType(), "int": T.IntegerType(),
                "float": T.FloatType(), "string": T.StringType()}

RAW_SCHEMA = T.StructType([
    T.StructField(name, _SPARK_TYPES[kind])
    for name, kind in (item.split() for item in RAW_DDL.split(",") if item.strip())
])

# Text cells that mean "missing" in the source files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Column groups used by the cleaning rules.
CANCELLED_BLANKS = (
    "DEP_TIME", "ARR_TIME", "WHEELS_OFF", "WHEELS_ON", "TAXI_OUT", "TAXI_IN",
    "ACTUAL_ELAPSED_TIME", "AIR_TIME",
    "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "DEP_DELAY_GROUP",
    "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "FIRST_DEP_TIME", "TOTAL_ADD_GTIME", "LONGEST_ADD_GTIME",
)
CANCELLED_BLANK_PREFIX = "DIV_"
DIVERTED_BLANKS = (
    "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP", "ARR_TIME_BLK",
    "WHEELS_ON", "TAXI_IN",
)
CLOCK_COLUMNS = (
    "CRS_DEP_TIME", "DEP_TIME", "WHEELS_OFF", "WHEELS_ON",
    "CRS_ARR_TIME", "ARR_TIME", "FIRST_DEP_TIME",
)
CYCLIC_COLUMNS = {"CRS_DEP_TIME_MIN": "CRS_DEP", "CRS_ARR_TIME_MIN": "CRS_ARR"}
CAUSES = (
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
)
CORRELATION_COLUMNS = (
    "DEP_DELAY", "ARR_DELAY", "TAXI_OUT", "TAXI_IN", "DISTANCE", "CRS_ELAPSED_TIME",
    "AIR_TIME", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY",
)

# Targets, years, codes, bins.
TARGETS = ("ARR_DEL15", "ARR_DELAY_NEW")
TARGET = "ARR_DEL15"
TRAIN_YEARS = (2021, 2022, 2023, 2024)
ALL_YEARS = (2021, 2022, 2023, 2024, 2025)
REQUIRED = (
    "YEAR", "DAY_OF_MONTH", "DAY_OF_WEEK", "OP_CARRIER", "ORIGIN", "DEST",
    "CRS_DEP_TIME", "CRS_ARR_TIME", "CANCELLED", "DIVERTED",
)
DELAY_EDGES = (0, 15, 60, 180)
DELAY_LABELS = ("<=0", "1-15", "16-60", "61-180", ">180")
VARIANT_DELAY_EDGES = (0, 15, 60, 120)
VARIANT_DELAY_LABELS = (
    "On-time/Early", "Slight (1-15)", "Late (16-60)", "Very Late (61-120)", "Extreme (>120)",
)
CANCELLATION_REASONS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# Encoded sources and the feature columns they produce.
FREQUENCY_FEATURES = {
    "OP_CARRIER": "OP_CARRIER_FREQ", "ORIGIN": "ORIGIN_FREQ", "DEST": "DEST_FREQ",
    "ROUTE": "ROUTE_FREQ", "DEP_TIME_BLK": "DEP_TIME_BLK_FREQ",
}
HISTORY_FEATURES = {"ORIGIN": "ORIGIN_HIST_OTP", "OP_CARRIER": "CARRIER_HIST_OTP"}
TRACK_A = (
    "YEAR", "DAY_OF_MONTH", "DAY_OF_WEEK", "IS_WEEKEND",
    "CRS_DEP_TIME_MIN", "CRS_ARR_TIME_MIN",
    "CRS_DEP_SIN", "CRS_DEP_COS", "CRS_ARR_SIN", "CRS_ARR_COS",
    "CRS_ELAPSED_TIME", "DISTANCE", "DISTANCE_GROUP",
    "OP_CARRIER_FREQ", "CARRIER_HIST_OTP",
    "ORIGIN_FREQ", "ORIGIN_HIST_OTP", "DEST_FREQ",
    "ROUTE_FREQ", "DEP_TIME_BLK_FREQ",
)
TRACK_B_EXTRA = ("DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "TAXI_OUT")
TRACKS = {"A": TRACK_A, "B": TRACK_A + TRACK_B_EXTRA}

# Columns that would leak the outcome into a track.
TRACK_A_FORBIDDEN = (
    "DEP_TIME", "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "DEP_DELAY_GROUP",
    "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN",
    "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP",
    "ACTUAL_ELAPSED_TIME", "AIR_TIME",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "FIRST_DEP_TIME", "TOTAL_ADD_GTIME", "LONGEST_ADD_GTIME",
    "CANCELLED", "DIVERTED",
)
TRACK_B_FORBIDDEN = (
    "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP",
    "ARR_TIME_BLK", "ACTUAL_ELAPSED_TIME", "AIR_TIME",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "WHEELS_ON", "TAXI_IN", "FIRST_DEP_TIME", "TOTAL_ADD_GTIME", "LONGEST_ADD_GTIME",
    "CANCELLED", "DIVERTED",
)
FORBIDDEN = {"A": TRACK_A_FORBIDDEN, "B": TRACK_B_FORBIDDEN}
