"""Independent SQL for the registered queries, written from the rules, not the Spark code.

``raw`` is the flights derivation, ``clean`` the row-local rules, ``op`` the flights
flown as planned.
"""

from __future__ import annotations

_CAUSE = ("CASE WHEN a < 15 THEN NULL ELSE CAST(CASE WHEN h % 5 = {k} THEN a - a % 3"
          " WHEN (h + 1) % 5 = {k} THEN a % 3 ELSE 0 END AS DOUBLE) END AS {name}")
CAUSES = ("CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY")

RAW = f"""
b AS (SELECT l.*, s_nationkey, c_nationkey,
  l_orderkey*31 + l_partkey*7 + l_suppkey*13 + l_linenumber*101 + CAST(l_quantity AS BIGINT)*1009 AS h,
  (l_partkey*37 + l_linenumber*61) % 1440 AS m, 60 + (l_partkey*11) % 300 AS e
 FROM lineitem l JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN supplier ON l_suppkey=s_suppkey),
c AS (SELECT *, CASE WHEN h % 1000 < 790 + l_suppkey % 14 * 3 THEN h % 41 - 26
   ELSE 15 + (h % 1000)*(h % 7 + 1) % 240 END AS a,
  CAST(2021 + l_orderkey % 5 AS INT) AS yr, CAST(1 + (l_partkey + l_linenumber) % 31 AS INT) AS dom,
  (m - m % 60)//60 AS hh, (m+e) % 1440 AS am, 100 + (l_partkey*13) % 2400 AS dist FROM b),
raw AS (SELECT yr AS YEAR, CAST(1 AS INT) AS MONTH, dom AS DAY_OF_MONTH,
  CAST(CASE WHEN h % 997 = 0 THEN isodow(make_date(yr,1,dom)) % 7 + 1 ELSE isodow(make_date(yr,1,dom)) END AS INT) AS DAY_OF_WEEK,
  'C' || lpad(CAST(l_suppkey % 14 AS VARCHAR),2,'0') AS OP_CARRIER,
  CASE WHEN yr=2025 AND h % 211 = 0 THEN 'N99' ELSE 'A' || lpad(CAST(s_nationkey AS VARCHAR),2,'0') END AS ORIGIN,
  'A' || lpad(CAST(c_nationkey AS VARCHAR),2,'0') AS DEST,
  CASE WHEN h % 499 = 0 THEN '' WHEN h % 503 = 0 THEN '2400' ELSE lpad(CAST(m + 40*hh AS VARCHAR),4,'0') END AS CRS_DEP_TIME,
  lpad(CAST(am + 40*((am - am % 60)//60) AS VARCHAR),4,'0') AS CRS_ARR_TIME,
  CASE WHEN hh < 6 THEN '0001-0559' ELSE lpad(CAST(hh AS VARCHAR),2,'0') || '00-' || lpad(CAST(hh AS VARCHAR),2,'0') || '59' END AS DEP_TIME_BLK,
  CAST(e AS DOUBLE) AS CRS_ELAPSED_TIME, CAST(dist AS DOUBLE) AS DISTANCE,
  CAST((dist - dist % 250)//250 AS INT) + 1 AS DISTANCE_GROUP,
  CAST(a - (h % 13 - 6) AS DOUBLE) AS DEP_DELAY, CAST(greatest(a - (h % 13 - 6), 0) AS DOUBLE) AS DEP_DELAY_NEW,
  CASE WHEN a - (h % 13 - 6) >= 15 THEN 1 ELSE 0 END AS DEP_DEL15,
  CAST(8 + l_partkey % 35 AS DOUBLE) AS TAXI_OUT, CAST(3 + l_partkey % 12 AS DOUBLE) AS TAXI_IN,
  CAST(e - (8 + l_partkey % 35) - (3 + l_partkey % 12) AS DOUBLE) AS AIR_TIME,
  CAST(a AS DOUBLE) AS ARR_DELAY, CAST(greatest(a, 0) AS DOUBLE) AS ARR_DELAY_NEW,
  CASE WHEN a >= 15 THEN 1 ELSE 0 END AS ARR_DEL15,
  CASE WHEN h % 29 = 0 THEN 1 ELSE 0 END AS CANCELLED,
  CASE WHEN h % 29 = 0 THEN substr('ABCD', CAST(1 + h % 4 AS INT), 1) END AS CANCELLATION_CODE,
  CASE WHEN h % 29 <> 0 AND h % 307 = 0 THEN 1 ELSE 0 END AS DIVERTED,
  {", ".join(_CAUSE.format(k=k, name=n) for k, n in enumerate(CAUSES))}
 FROM c)"""

_ONLY_CANCELLED = ("DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "TAXI_OUT", "AIR_TIME", *CAUSES)
_BOTH = ("ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "TAXI_IN")


def _masks(cancelled: bool = True, diverted: bool = True) -> str:
    parts = []
    for c in (*_ONLY_CANCELLED, *_BOTH):
        tests = []
        if cancelled:
            tests.append("CANCELLED = 1")
        if diverted and c in _BOTH:
            tests.append("DIVERTED = 1")
        if tests:
            parts.append(f"CASE WHEN {' OR '.join(tests)} THEN NULL ELSE {c} END AS {c}")
    return ", ".join(parts)


def _minutes(c: str) -> str:
    v = f"TRY_CAST({c} AS INT)"
    m = f"(({v} // 100) * 60 + {v} % 100)"
    return f"CASE WHEN {m} BETWEEN 0 AND 1439 THEN {m} END"


def _bins(c: str, edges, labels) -> str:
    tests = " ".join(f"WHEN {c} <= {e} THEN '{lab}'" for e, lab in zip(edges, labels))
    return f"CASE WHEN {c} IS NULL THEN NULL {tests} ELSE '{labels[-1]}' END"


STEP_EDGES, STEP_LABELS = (0, 15, 60, 180), ("<=0", "1-15", "16-60", "61-180", ">180")
BOOK_EDGES, BOOK_LABELS = (0, 15, 60, 120), (
    "On-time/Early", "Slight (1-15)", "Late (16-60)", "Very Late (61-120)", "Extreme (>120)")

_LARGEST = f"greatest({', '.join(CAUSES)})"
_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in CAUSES)
_DOMINANT = (f"CASE WHEN {_TOTAL} > 0 THEN CASE "
             + " ".join(f"WHEN {c} = {_LARGEST} THEN '{c}'" for c in CAUSES) + " END END")

CLEAN = f"""{RAW},
masked AS (SELECT * REPLACE ({_masks()}) FROM raw),
timed AS (SELECT * REPLACE (CAST(isodow(make_date(YEAR, 1, DAY_OF_MONTH)) - 1 AS INT) AS DAY_OF_WEEK),
  make_date(YEAR, 1, DAY_OF_MONTH) AS FL_DATE,
  {_minutes("CRS_DEP_TIME")} AS CRS_DEP_TIME_MIN, {_minutes("CRS_ARR_TIME")} AS CRS_ARR_TIME_MIN FROM masked),
clean AS (SELECT *,
  CAST(sin(2*pi()*CRS_DEP_TIME_MIN/1440) AS FLOAT) AS CRS_DEP_SIN, CAST(cos(2*pi()*CRS_DEP_TIME_MIN/1440) AS FLOAT) AS CRS_DEP_COS,
  CAST(sin(2*pi()*CRS_ARR_TIME_MIN/1440) AS FLOAT) AS CRS_ARR_SIN, CAST(cos(2*pi()*CRS_ARR_TIME_MIN/1440) AS FLOAT) AS CRS_ARR_COS,
  CASE WHEN DAY_OF_WEEK IN (5, 6) THEN 1 ELSE 0 END AS IS_WEEKEND, ORIGIN || '-' || DEST AS ROUTE,
  {_bins("ARR_DELAY", STEP_EDGES, STEP_LABELS)} AS ARR_DELAY_CAT, {_DOMINANT} AS DOMINANT_DELAY_CAUSE FROM timed)"""
OP = f"{CLEAN}, op AS (SELECT * FROM clean WHERE CANCELLED = 0 AND DIVERTED = 0)"

ENCODED_SOURCES = ("OP_CARRIER", "ORIGIN", "DEST", "ROUTE", "DEP_TIME_BLK")
HISTORY_SOURCES = ("ORIGIN", "OP_CARRIER")
_FREQ = " UNION ALL ".join(
    f"SELECT '{s}' AS source, {s} AS key, count(*) / (SELECT CAST(count({s}) AS DOUBLE) FROM train) AS freq"
    f" FROM train WHERE {s} IS NOT NULL GROUP BY {s}" for s in ENCODED_SOURCES)
_HIST = " UNION ALL ".join(
    f"SELECT '{s}' AS source, {s} AS key, coalesce((count(ARR_DEL15) - sum(ARR_DEL15)) / CAST(nullif(count(ARR_DEL15), 0) AS DOUBLE), 0.5) AS otp"
    f" FROM train_op WHERE {s} IS NOT NULL GROUP BY {s}" for s in HISTORY_SOURCES)
MAPS = f"""{OP},
train AS (SELECT * FROM clean WHERE YEAR BETWEEN 2021 AND 2024),
train_op AS (SELECT * FROM op WHERE YEAR BETWEEN 2021 AND 2024),
freqs AS ({_FREQ}),
hist AS ({_HIST}),
overall AS (SELECT count(*) AS total_train_operated, CAST(sum(ARR_DEL15) FILTER (WHERE ORIGIN IS NOT NULL) AS BIGINT) AS n_delayed FROM train_op),
globo AS (SELECT *, (total_train_operated - n_delayed) / CAST(total_train_operated AS DOUBLE) AS global_otp FROM overall),
enc AS (SELECT op.*,
  CAST(coalesce(f1.freq, 0) AS FLOAT) AS OP_CARRIER_FREQ, CAST(coalesce(f2.freq, 0) AS FLOAT) AS ORIGIN_FREQ,
  CAST(coalesce(f3.freq, 0) AS FLOAT) AS DEST_FREQ, CAST(coalesce(f4.freq, 0) AS FLOAT) AS ROUTE_FREQ,
  CAST(coalesce(f5.freq, 0) AS FLOAT) AS DEP_TIME_BLK_FREQ, coalesce(f4.freq, 0) AS route_freq_exact,
  CAST(coalesce(h1.otp, (SELECT global_otp FROM globo)) AS FLOAT) AS ORIGIN_HIST_OTP,
  CAST(coalesce(h2.otp, (SELECT global_otp FROM globo)) AS FLOAT) AS CARRIER_HIST_OTP
 FROM op LEFT JOIN freqs f1 ON f1.source = 'OP_CARRIER' AND f1.key = OP_CARRIER
 LEFT JOIN freqs f2 ON f2.source = 'ORIGIN' AND f2.key = ORIGIN
 LEFT JOIN freqs f3 ON f3.source = 'DEST' AND f3.key = DEST
 LEFT JOIN freqs f4 ON f4.source = 'ROUTE' AND f4.key = ROUTE
 LEFT JOIN freqs f5 ON f5.source = 'DEP_TIME_BLK' AND f5.key = DEP_TIME_BLK
 LEFT JOIN hist h1 ON h1.source = 'ORIGIN' AND h1.key = ORIGIN
 LEFT JOIN hist h2 ON h2.source = 'OP_CARRIER' AND h2.key = OP_CARRIER)"""

_TIED = f"""{MAPS},
scored AS (SELECT YEAR, ARR_DEL15 AS label, 1 - CAST(CARRIER_HIST_OTP AS DOUBLE) AS score, DEP_DELAY FROM enc
 WHERE ARR_DEL15 IS NOT NULL)"""
_SCORED = f"""{OP},
scored AS (SELECT YEAR, ARR_DEL15 AS label,
 greatest(0, least(1, (DEP_DELAY + 40) / CAST(400 AS DOUBLE))) AS score, DEP_DELAY FROM op
 WHERE ARR_DEL15 IS NOT NULL AND DEP_DELAY IS NOT NULL)"""


def _curve(by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f""",
pts AS (SELECT {keys}score, CAST(sum(label) AS BIGINT) AS p, CAST(sum(1 - label) AS BIGINT) AS q FROM scored GROUP BY {keys}score),
cum AS (SELECT *, sum(p) OVER ({part} ORDER BY score DESC) AS tp, sum(q) OVER ({part} ORDER BY score DESC) AS fp,
  sum(p) OVER ({part}) AS np, sum(q) OVER ({part}) AS nq FROM pts)"""


_AUC = "sum(p * ((nq - fp) + q / CAST(2 AS DOUBLE)) / (CAST(np AS DOUBLE) * nq))"
_AP = "sum((p / CAST(np AS DOUBLE)) * (tp / CAST(tp + fp AS DOUBLE)))"
_CALLED = "CASE WHEN DEP_DELAY > 15 THEN 1 ELSE 0 END"
_QUADRANTS = f"""SELECT {{keys}} count(*) AS n_samples,
  sum(CASE WHEN {_CALLED} = 1 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN {_CALLED} = 1 AND label = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN {_CALLED} = 0 AND label = 1 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN {_CALLED} = 0 AND label = 0 THEN 1 ELSE 0 END) AS tn
  FROM scored {{group}}"""
_RATES = """round((tp + tn) / CAST(n_samples AS DOUBLE), 6) AS accuracy,
  round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS "precision",
  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
  round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1"""

_KEY = "YEAR, DAY_OF_MONTH, OP_CARRIER, ORIGIN, DEST"
_MASKED = ("DEP_DELAY, DEP_DELAY_NEW, DEP_DEL15, TAXI_OUT, TAXI_IN, AIR_TIME, ARR_DELAY, ARR_DELAY_NEW, ARR_DEL15, "
           + ", ".join(CAUSES))
_TYPES = """YEAR, MONTH, DAY_OF_MONTH, DAY_OF_WEEK, OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME, CRS_ARR_TIME, DEP_TIME_BLK,
 CRS_ELAPSED_TIME, DISTANCE, DISTANCE_GROUP, CANCELLED, CANCELLATION_CODE, DIVERTED, """ + _MASKED
_OTP = "count(ARR_DEL15) AS flights, round(avg(ARR_DEL15), 6) AS delay_rate, round(1 - avg(ARR_DEL15), 6) AS otp"
_BLOCKS = ["0001-0559"] + [f"{h:02d}00-{h:02d}59" for h in range(6, 24)]
_DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _q(prefix: str, body: str) -> str:
    return f"WITH {prefix.strip()} {body}"


def _six(columns: str) -> str:
    return ", ".join(f"round({c.strip()}, 6) AS {c.strip()}" for c in columns.split(","))


def _grid(row: str, column: str, values, empty: str = "NULL") -> str:
    cells = ", ".join(
        f"coalesce(round(max(CASE WHEN k = '{v}' THEN otp END), 6), {empty}) AS \"{v}\"" for v in values)
    return (f"SELECT {row}, {cells} FROM (SELECT {row}, CAST({column} AS VARCHAR) AS k,"
            f" (1 - avg(ARR_DEL15)) * 100 AS otp FROM op GROUP BY ALL) GROUP BY {row}")


def _audit(where: str) -> str:
    parts = []
    for table, column, sources, tag in (("freqs", "freq", ENCODED_SOURCES, ""), ("hist", "otp", HISTORY_SOURCES, "otp_")):
        for s in sources:
            parts.append(
                f"SELECT '{tag}{s}' AS source, count(*) AS total,"
                f" count(*) FILTER (WHERE {s} NOT IN (SELECT key FROM {table} WHERE source = '{s}')) AS unseen"
                f" FROM op WHERE {s} IS NOT NULL {where}")
    return ("SELECT source, total, unseen, round(unseen / CAST(total AS DOUBLE) * 100, 6) AS rate_pct FROM ("
            + " UNION ALL ".join(parts) + ")")


def _describe(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,"
        f" round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,"
        f" round(CAST(max({c}) AS DOUBLE), 6) AS max FROM clean" for c in columns)


_STORED = {  # declared types of the cleaned record
    "smallint": "YEAR DAY_OF_MONTH DAY_OF_WEEK DISTANCE_GROUP DEP_DEL15 ARR_DEL15 CANCELLED DIVERTED IS_WEEKEND",
    "int": "MONTH CRS_DEP_TIME_MIN CRS_ARR_TIME_MIN",
    "float": "CRS_ELAPSED_TIME DISTANCE DEP_DELAY DEP_DELAY_NEW TAXI_OUT TAXI_IN AIR_TIME ARR_DELAY ARR_DELAY_NEW "
             + " ".join(CAUSES) + " CRS_DEP_SIN CRS_DEP_COS CRS_ARR_SIN CRS_ARR_COS",
    "string": "OP_CARRIER ORIGIN DEST CRS_DEP_TIME CRS_ARR_TIME DEP_TIME_BLK CANCELLATION_CODE ROUTE ARR_DELAY_CAT DOMINANT_DELAY_CAUSE",
    "date": "FL_DATE",
}
_KIND = {c: kind for kind, names in _STORED.items() for c in names.split()}
_MAPPED = [c for c, kind in _KIND.items() if kind in ("smallint", "int", "string") and c != "YEAR"]


def _profile(columns, distinct: bool) -> str:
    share = "(count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100"
    # The quality table has two places, halves of the scaled value to even.
    share = f"round_even({share} * 100, 0) / 100" if distinct else f"round({share}, 6)"
    extra = ", count(DISTINCT {c}) AS n_distinct" if distinct else ""
    return " UNION ALL ".join(
        (f"SELECT '{{c}}' AS \"column\", '{_KIND[c]}' AS dtype, count({{c}}) AS non_null, count(*) - count({{c}}) AS null_count,"
         f" {share} AS null_pct{extra} FROM clean").format(c=c)
        for c in columns)


def _hist(low: int, high: int, bins: int, where: str) -> str:
    return f""", v AS (SELECT CAST(greatest({low}, least({high}, ARR_DELAY)) AS DOUBLE) AS v FROM op WHERE ARR_DELAY IS NOT NULL {where}),
e AS (SELECT min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM v)
SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, count(*) AS n
FROM (SELECT CAST(least(floor((v - lo) / w), {bins - 1}) AS INT) AS bin, lo, w FROM v, e) GROUP BY bin, lo, w"""


def _chi(row: str, where: str) -> str:
    return f""", t AS (SELECT {row} AS r, ARR_DEL15 AS y FROM op WHERE ARR_DEL15 IS NOT NULL AND {row} IS NOT NULL {where}),
o AS (SELECT r, y, count(*) AS n FROM t GROUP BY r, y),
g AS (SELECT rr.r, yy.y, coalesce(o.n, 0) AS o, rr.n * CAST(yy.n AS DOUBLE) / (SELECT count(*) FROM t) AS e
 FROM (SELECT r, count(*) AS n FROM t GROUP BY r) rr CROSS JOIN (SELECT y, count(*) AS n FROM t GROUP BY y) yy
 LEFT JOIN o ON o.r = rr.r AND o.y = yy.y),
d AS (SELECT CAST((count(DISTINCT r) - 1) * (count(DISTINCT y) - 1) AS INT) AS dof, least(count(DISTINCT r), count(DISTINCT y)) AS k,
  (SELECT count(*) FROM t) AS n FROM t),
x AS (SELECT sum(power(CASE WHEN (SELECT dof FROM d) = 1 THEN greatest(abs(o - e) - 0.5, 0) ELSE abs(o - e) END, 2) / e) AS chi2 FROM g)"""


_RANKED = """, r AS (SELECT {g} AS g, rank() OVER (ORDER BY ARR_DELAY) + (count(*) OVER (PARTITION BY ARR_DELAY) - 1) / CAST(2 AS DOUBLE) AS rk
 FROM op WHERE ARR_DELAY IS NOT NULL AND {g} IS NOT NULL),
s AS (SELECT g, count(*) AS n, sum(rk) AS rs, avg(rk) AS mr FROM r GROUP BY g),
ties AS (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS ts, CAST(sum(t) AS DOUBLE) AS n FROM
 (SELECT count(*) AS t FROM op WHERE ARR_DELAY IS NOT NULL AND {g} IS NOT NULL GROUP BY ARR_DELAY)),
hh AS (SELECT (12 / (max(ties.n) * (max(ties.n) + 1)) * sum(s.rs * s.rs / s.n) - 3 * (max(ties.n) + 1))
  / (1 - max(ts) / (power(max(ties.n), 3) - max(ties.n))) AS h, count(*) AS k, CAST(max(ties.n) AS BIGINT) AS n FROM s, ties)"""

_ETA = " UNION ALL ".join(
    f"""SELECT '{f}' AS factor, count(*) AS levels, CAST(sum(n) AS BIGINT) AS n,
 round(sum(n * power(m - (SELECT avg(ARR_DELAY) FROM op WHERE {f} IS NOT NULL), 2))
  / (SELECT var_pop(ARR_DELAY) * count(ARR_DELAY) FROM op WHERE {f} IS NOT NULL), 6) AS eta_squared
 FROM (SELECT {f}, count(*) AS n, avg(ARR_DELAY) AS m FROM op WHERE ARR_DELAY IS NOT NULL AND {f} IS NOT NULL GROUP BY {f})"""
    for f in ("OP_CARRIER", "ROUTE", "DEP_TIME_BLK"))

_CORR = ("DEP_DELAY", "ARR_DELAY", "TAXI_OUT", "TAXI_IN", "DISTANCE", "CRS_ELAPSED_TIME", "AIR_TIME",
         "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY")
_TRACK_A = ("YEAR, DAY_OF_MONTH, DAY_OF_WEEK, IS_WEEKEND, CRS_DEP_TIME_MIN, CRS_ARR_TIME_MIN, "
            + _six("CRS_DEP_SIN, CRS_DEP_COS, CRS_ARR_SIN, CRS_ARR_COS, CRS_ELAPSED_TIME, DISTANCE") + ", DISTANCE_GROUP, "
            + _six("OP_CARRIER_FREQ, CARRIER_HIST_OTP, ORIGIN_FREQ, ORIGIN_HIST_OTP, DEST_FREQ, ROUTE_FREQ, DEP_TIME_BLK_FREQ"))
_MEANS = ", ".join(f"round(avg({c}), 6) AS {c}" for c in CAUSES)
_SHARES = ["CAST(coalesce(sum(" + c + "), 0) AS DOUBLE)" for c in CAUSES]
_HEX = """, p AS (SELECT greatest(0, least(60, TAXI_OUT)) / CAST(2 AS DOUBLE) AS u,
  (greatest(-30, least(120, ARR_DELAY)) + 30) / (CAST(150 AS DOUBLE) / 17) AS v FROM op WHERE TAXI_OUT IS NOT NULL AND ARR_DELAY IS NOT NULL),
z AS (SELECT *, floor(u + 0.5) AS u1, floor(v + 0.5) AS v1, floor(u) + 0.5 AS u2, floor(v) + 0.5 AS v2 FROM p),
w AS (SELECT power(u - u1, 2) + 3 * power(v - v1, 2) < power(u - u2, 2) + 3 * power(v - v2, 2) AS near, * FROM z),
cells AS (SELECT CASE WHEN near THEN u1 ELSE u2 END AS cell_u, CASE WHEN near THEN v1 ELSE v2 END AS cell_v, count(*) AS n FROM w GROUP BY 1, 2)
SELECT cell_u, cell_v, round(cell_u * 2, 6) AS center_x, round(-30 + cell_v * (CAST(150 AS DOUBLE) / 17), 6) AS center_y, n FROM cells"""
_FILL = "round(coalesce(CAST({c} AS DOUBLE), (SELECT m FROM med WHERE med.y = clean.YEAR AND med.c = '{c}'), -1), 6) AS {c}"
_MEDIANS = ", med AS (" + " UNION ALL ".join(
    f"SELECT YEAR AS y, '{c}' AS c, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m FROM clean GROUP BY YEAR"
    for c in ("DEP_DELAY", "TAXI_OUT", "CRS_DEP_TIME_MIN")) + ")"

ORACLES: dict[str, str] = {
    "io04_typed_cast": _q(RAW, f"SELECT * REPLACE (CAST(MONTH AS VARCHAR) AS MONTH) FROM (SELECT {_TYPES} FROM raw)"),
    "io06_scope_filter": _q(RAW, "SELECT YEAR, MONTH, count(*) AS n FROM raw WHERE MONTH = 1 AND YEAR IN (2021, 2025) GROUP BY YEAR, MONTH"),
    "io07_projected_scan": _q(OP, "SELECT ORIGIN, ARR_DEL15, ARR_DELAY_NEW FROM op"),
    "p01_cancelled_blank": _q(RAW, f"SELECT {_KEY}, CANCELLED, CANCELLATION_CODE, DEP_TIME_BLK, {_MASKED} FROM (SELECT * REPLACE ({_masks(diverted=False)}) FROM raw)"),
    "p02_diverted_blank": _q(RAW, f"SELECT {_KEY}, DIVERTED, {_MASKED} FROM (SELECT * REPLACE ({_masks(cancelled=False)}) FROM raw)"),
    "p03_clock_minutes": _q(CLEAN, f"SELECT {_KEY}, CRS_DEP_TIME, CRS_DEP_TIME_MIN, CRS_ARR_TIME, CRS_ARR_TIME_MIN FROM clean"),
    "p04_clock_statistics": _q(CLEAN, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}_MIN) AS parsed, count(*) - count({c}_MIN) AS na FROM clean" for c in ("CRS_DEP_TIME", "CRS_ARR_TIME"))),
    "p05_cyclic_encoding": _q(CLEAN, f"SELECT {_KEY}, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in ("CRS_DEP_SIN", "CRS_DEP_COS", "CRS_ARR_SIN", "CRS_ARR_COS")) + " FROM clean"),
    "p06_flight_date": _q(CLEAN, "SELECT YEAR, DAY_OF_MONTH, CAST(FL_DATE AS VARCHAR) AS FL_DATE, OP_CARRIER FROM clean"),
    "p07_weekday_mismatch": _q(RAW, """SELECT YEAR, CAST(isodow(make_date(YEAR, 1, DAY_OF_MONTH)) - 1 AS INT) AS DAY_OF_WEEK, count(*) AS n,
        count(*) FILTER (WHERE DAY_OF_WEEK <> isodow(make_date(YEAR, 1, DAY_OF_MONTH))) AS mismatches FROM raw GROUP BY 1, 2"""),
    "p08_weekend_flag": _q(CLEAN, "SELECT YEAR, DAY_OF_MONTH, DAY_OF_WEEK, IS_WEEKEND, ORIGIN FROM clean"),
    "p09_route": _q(RAW, "SELECT ORIGIN, DEST, concat(ORIGIN, '-', DEST) AS ROUTE, YEAR FROM raw"),
    "p10_delay_category": _q(CLEAN, f"""SELECT ARR_DELAY, ARR_DELAY_CAT,
        CASE ARR_DELAY_CAT {" ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(STEP_LABELS))} END AS ARR_DELAY_CAT_ORD,
        {_bins("ARR_DELAY", BOOK_EDGES, BOOK_LABELS)} AS DELAY_CAT, {_KEY} FROM clean"""),
    "p11_dominant_cause": _q(CLEAN, f"SELECT {_KEY}, {', '.join(CAUSES)}, DOMINANT_DELAY_CAUSE FROM clean"),
    "p12_operated_filter": _q(RAW, f"SELECT {_KEY}, CANCELLED, DIVERTED FROM raw WHERE CANCELLED = 0 AND DIVERTED = 0"),
    "p13_rule_counts": _q(RAW, """SELECT count(*) FILTER (WHERE CANCELLED = 1) AS r1_cancelled, count(*) FILTER (WHERE DIVERTED = 1) AS r2_diverted,
        count(*) AS r3_clock_rows, count(*) AS r4_date_rows,
        count(*) FILTER (WHERE DAY_OF_WEEK <> isodow(make_date(YEAR, 1, DAY_OF_MONTH))) AS weekday_mismatches,
        count(*) FILTER (WHERE DISTANCE < 0) AS negative_distance, count(*) FILTER (WHERE YEAR IS NULL) AS rows_without_year FROM raw"""),
    "p13_clean_record": _q(CLEAN, "SELECT * REPLACE (CAST(FL_DATE AS VARCHAR) AS FL_DATE, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in ("CRS_DEP_SIN", "CRS_DEP_COS", "CRS_ARR_SIN", "CRS_ARR_COS")) + ") FROM clean"),
    "p14_departure_hour": _q(CLEAN, "SELECT CRS_DEP_TIME_MIN, CAST(CRS_DEP_TIME_MIN // 60 AS INT) AS DEP_HOUR, YEAR FROM clean"),
    "p15_clip": _q(CLEAN, """SELECT ARR_DELAY, CASE WHEN ARR_DELAY < -60 THEN -60 WHEN ARR_DELAY > 200 THEN 200 ELSE ARR_DELAY END AS clipped,
        CASE WHEN TAXI_OUT < 0 THEN 0 WHEN TAXI_OUT > 30 THEN 30 ELSE TAXI_OUT END AS taxi_clipped, YEAR FROM clean"""),
    "p16_cancellation_reason": _q(CLEAN, f"""SELECT {_KEY}, CANCELLATION_CODE, CASE CANCELLATION_CODE WHEN 'A' THEN 'Carrier'
        WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'NAS' WHEN 'D' THEN 'Security' END AS reason FROM clean"""),
    "p17_rates": _q(CLEAN, """SELECT ORIGIN, count(*) AS n, round(sum(CANCELLED) / CAST(count(*) AS DOUBLE) * 100, 6) AS cancel_pct,
        round((1 - avg(ARR_DEL15)) * 100, 6) AS otp_pct FROM clean GROUP BY ORIGIN"""),
    "p18_own_flight_date": _q(RAW, """SELECT YEAR, CAST(d AS VARCHAR) AS FL_DATE, CAST(isodow(d) - 1 AS INT) AS DAY_OF_WEEK, CAST(day(d) AS INT) AS DAY_OF_MONTH,
        CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS IS_WEEKEND, ORIGIN
        FROM (SELECT *, CASE WHEN CRS_DEP_TIME <> '' THEN make_date(YEAR, 1, DAY_OF_MONTH) END AS d FROM raw)"""),
    "p19_flight_filter": _q(RAW, """SELECT YEAR, OP_CARRIER, ORIGIN, DEP_TIME_BLK, count(*) AS n FROM raw
        WHERE YEAR IN (2022, 2025) AND OP_CARRIER IN ('C01', 'C05', 'C09') AND ORIGIN IN ('A01', 'A03', 'A07', 'N99')
        AND DEP_TIME_BLK IN ('0001-0559', '0800-0859', '1700-1759') GROUP BY ALL"""),
    "p20_median_fill": _q(CLEAN + _MEDIANS, "SELECT YEAR, ORIGIN, " + ", ".join(
        _FILL.format(c=c) for c in ("DEP_DELAY", "TAXI_OUT", "CRS_DEP_TIME_MIN")) + " FROM clean"),
    "j01_frequency_encode": _q(MAPS, f"SELECT {_KEY}, " + _six("OP_CARRIER_FREQ, ORIGIN_FREQ, DEST_FREQ, ROUTE_FREQ, DEP_TIME_BLK_FREQ").replace("round(", "round(1.0::DOUBLE * ") + " FROM enc"),
    "j01_salted_lookup": _q(MAPS, f"SELECT {_KEY}, " + _six("OP_CARRIER_FREQ, ORIGIN_FREQ, DEST_FREQ, ROUTE_FREQ, DEP_TIME_BLK_FREQ").replace("round(", "round(1.0::DOUBLE * ") + " FROM enc"),
    "j02_history_encode": _q(MAPS, f"SELECT {_KEY}, " + _six("ORIGIN_HIST_OTP, CARRIER_HIST_OTP").replace("round(", "round(1.0::DOUBLE * ") + " FROM enc"),
    "j03_unseen_audit": _q(MAPS, _audit("")),
    "j03_unseen_audit_2025": _q(MAPS, _audit("AND YEAR = 2025")),
    "j04_busiest_semi_join": _q(OP, f"SELECT {_KEY} FROM op WHERE ORIGIN IN (SELECT ORIGIN FROM op GROUP BY ORIGIN ORDER BY count(*) DESC, ORIGIN LIMIT 10)"),
    "j05_dominant_group": _q(OP, """SELECT YEAR, OP_CARRIER, flights, otp FROM (SELECT YEAR, OP_CARRIER, count(ARR_DEL15) AS flights,
        round(1 - avg(ARR_DEL15), 6) AS otp, row_number() OVER (PARTITION BY YEAR ORDER BY count(ARR_DEL15) DESC, OP_CARRIER) AS rn
        FROM op GROUP BY YEAR, OP_CARRIER) WHERE rn = 1"""),
    "a01_frequency_maps": _q(MAPS, "SELECT source, key, round(freq, 6) AS freq FROM freqs"),
    "a02_history_maps": _q(MAPS, "SELECT source, key, round(otp, 6) AS otp FROM hist"),
    "a03_global_history": _q(MAPS, "SELECT total_train_operated, n_delayed, round(global_otp, 6) AS global_otp FROM globo"),
    "a04_overall_otp": _q(OP, """SELECT count(*) FILTER (WHERE ARR_DEL15 = 0) AS on_time, count(*) FILTER (WHERE ARR_DEL15 = 1) AS delayed,
        count(ARR_DEL15) AS total, round((1 - avg(ARR_DEL15)) * 100, 6) AS otp_pct FROM op"""),
    "a05_delay_by_year": _q(OP, f"SELECT YEAR, round(avg(ARR_DEL15) * 100, 6) AS delay_pct, {_OTP} FROM op GROUP BY YEAR"),
    "a06_carrier_ranking": _q(OP, """, t AS (SELECT OP_CARRIER, count(ARR_DEL15) AS flights, avg(ARR_DEL15) AS delay_rate, (1 - avg(ARR_DEL15)) * 100 AS otp_pct FROM op GROUP BY OP_CARRIER),
        n AS (SELECT *, row_number() OVER (ORDER BY otp_pct, OP_CARRIER) AS i, count(*) OVER () AS c FROM t)
        SELECT OP_CARRIER, flights, round(delay_rate, 6) AS delay_rate, round(otp_pct, 6) AS otp_pct,
        CASE WHEN i <= 5 THEN 'bottom' WHEN i > c - 5 THEN 'top' ELSE 'middle' END AS tag,
        round((SELECT median(otp_pct) FROM t), 6) AS median_otp_pct FROM n"""),
    "a07_carrier_stability": _q(OP, """SELECT YEAR, OP_CARRIER, round(avg(ARR_DEL15), 6) AS delay_rate, round((1 - avg(ARR_DEL15)) * 100, 6) AS otp_pct FROM op
        WHERE OP_CARRIER IN (SELECT OP_CARRIER FROM op GROUP BY OP_CARRIER ORDER BY count(*) DESC, OP_CARRIER LIMIT 10) GROUP BY YEAR, OP_CARRIER"""),
    "a08_airport_pain_index": _q(OP, """SELECT ORIGIN, count(ARR_DEL15) AS flights, round(avg(ARR_DEL15), 6) AS delay_rate, round(avg(ARR_DELAY_NEW), 6) AS avg_delay_min,
        round(avg(ARR_DEL15) * avg(ARR_DELAY_NEW), 6) AS pain_index, round(avg(ARR_DEL15) * 100, 6) AS delay_pct FROM op
        WHERE ORIGIN IN (SELECT ORIGIN FROM op GROUP BY ORIGIN ORDER BY count(*) DESC, ORIGIN LIMIT 20) GROUP BY ORIGIN"""),
    "a09_busiest_routes": _q(OP, """SELECT ROUTE, count(ARR_DEL15) AS volume, round(avg(ARR_DEL15), 6) AS delay_rate, round(avg(ARR_DEL15) * 100, 6) AS delay_pct
        FROM op GROUP BY ROUTE ORDER BY volume DESC, ROUTE LIMIT 50"""),
    "a09_worst_busy_routes": _q(OP, """SELECT ROUTE, volume, round(r, 6) AS delay_rate, round(r * 100, 6) AS delay_pct FROM
        (SELECT ROUTE, count(ARR_DEL15) AS volume, avg(ARR_DEL15) AS r FROM op GROUP BY ROUTE ORDER BY volume DESC, ROUTE LIMIT 50) ORDER BY r DESC, ROUTE LIMIT 10"""),
    "a10_delay_heatmap": _q(OP, "SELECT DEP_TIME_BLK, " + ", ".join(
        f"round(avg(ARR_DEL15) FILTER (WHERE DAY_OF_WEEK = {i}), 6) AS {d}" for i, d in enumerate(_DAYS)) + " FROM op GROUP BY DEP_TIME_BLK"),
    "a11_otp_year_block": _q(OP, _grid("YEAR", "DEP_TIME_BLK", _BLOCKS)),
    "a11_otp_year_block_filled": _q(OP, _grid("YEAR", "DEP_TIME_BLK", _BLOCKS, "100")),
    "a12_carrier_extremes": _q(OP, f""", t AS (SELECT OP_CARRIER, {_OTP}, 1 - avg(ARR_DEL15) AS o FROM op GROUP BY OP_CARRIER HAVING count(ARR_DEL15) >= 1000)
        SELECT OP_CARRIER, flights, delay_rate, otp, 'top' AS side FROM (SELECT * FROM t ORDER BY o DESC, OP_CARRIER LIMIT 10)
        UNION ALL SELECT OP_CARRIER, flights, delay_rate, otp, 'bottom' FROM (SELECT * FROM t ORDER BY o, OP_CARRIER LIMIT 10)"""),
    "a12_carrier_table": _q(OP, """SELECT OP_CARRIER, count(ARR_DEL15) AS flights, round(avg(ARR_DEL15), 6) AS delay_rate, round((1 - avg(ARR_DEL15)) * 100, 6) AS otp_pct
        FROM op GROUP BY OP_CARRIER HAVING count(ARR_DEL15) >= 500"""),
    "a13_origin_otp": _q(OP, f"SELECT ORIGIN, {_OTP} FROM op GROUP BY ORIGIN ORDER BY flights DESC, ORIGIN LIMIT 20"),
    "a13_destination_otp": _q(OP, f"SELECT DEST, {_OTP} FROM op GROUP BY DEST ORDER BY flights DESC, DEST LIMIT 20"),
    "a14_route_otp": _q(OP, f"SELECT ROUTE, {_OTP} FROM op GROUP BY ROUTE ORDER BY flights DESC, ROUTE LIMIT 20"),
    "a14_worst_routes": _q(OP, f"SELECT ROUTE, {_OTP} FROM op GROUP BY ROUTE HAVING count(ARR_DEL15) >= 100 ORDER BY 1 - avg(ARR_DEL15), ROUTE LIMIT 20"),
    "a15_cancellation_by_year": _q(CLEAN, """SELECT YEAR, count(CANCELLED) AS total, CAST(sum(CANCELLED) AS BIGINT) AS cancelled, CAST(sum(DIVERTED) AS BIGINT) AS diverted,
        round(sum(CANCELLED) / CAST(count(CANCELLED) AS DOUBLE) * 100, 6) AS cancel_rate, round(sum(DIVERTED) / CAST(count(CANCELLED) AS DOUBLE) * 100, 6) AS divert_rate
        FROM clean GROUP BY YEAR"""),
    "a16_cancellations_by_airport": _q(CLEAN, "SELECT ORIGIN, count(*) AS cancellations FROM clean WHERE CANCELLED = 1 GROUP BY ORIGIN ORDER BY cancellations DESC, ORIGIN LIMIT 20"),
    "a17_cancellation_reasons": _q(CLEAN, """SELECT CASE CANCELLATION_CODE WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'NAS' ELSE 'Security' END AS reason,
        count(*) AS n FROM clean WHERE CANCELLED = 1 AND CANCELLATION_CODE IN ('A', 'B', 'C', 'D') GROUP BY 1"""),
    "a18_cause_minutes_by_year": _q(OP, " UNION ALL ".join(f"SELECT YEAR, '{c}' AS cause, coalesce(sum({c}), 0) AS minutes FROM op GROUP BY YEAR" for c in CAUSES)),
    "a18_cause_minutes_overall": _q(OP, " UNION ALL ".join(f"SELECT '{c}' AS cause, coalesce(sum({c}), 0) AS minutes FROM op" for c in CAUSES)),
    "a19_causes_by_carrier": _q(OP, f"SELECT OP_CARRIER, {_MEANS} FROM op GROUP BY OP_CARRIER ORDER BY avg(CARRIER_DELAY) DESC NULLS LAST, OP_CARRIER LIMIT 10"),
    "a20_otp_by_distance_group": _q(OP, f"SELECT DISTANCE_GROUP, {_OTP} FROM op GROUP BY DISTANCE_GROUP"),
    "a21_otp_by_weekday": _q(OP, f"SELECT DAY_OF_WEEK, {_OTP} FROM op GROUP BY DAY_OF_WEEK"),
    "a22_daily_otp": _q(OP, _grid("DAY_OF_MONTH", "YEAR", range(2021, 2026))),
    "a23_correlations": _q(OP, " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM op" for x in _CORR for y in _CORR)),
    "a24_delay_by_hour": _q(OP, "SELECT CAST(CRS_DEP_TIME_MIN // 60 AS INT) AS DEP_HOUR, round(avg(ARR_DELAY), 6) AS mean_arr_delay FROM op WHERE CRS_DEP_TIME_MIN IS NOT NULL GROUP BY 1"),
    "a25_delay_categories": _q(OP, f"""SELECT ARR_DELAY_CAT AS category, count(*) AS n, CASE ARR_DELAY_CAT {" ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(STEP_LABELS))} END AS ord
        FROM op WHERE ARR_DELAY_CAT IS NOT NULL GROUP BY ARR_DELAY_CAT"""),
    "a25_delay_categories_variant": _q(OP, f"""SELECT category, count(*) AS n, CASE category {" ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(BOOK_LABELS))} END AS ord
        FROM (SELECT {_bins("ARR_DELAY", BOOK_EDGES, BOOK_LABELS)} AS category FROM op) WHERE category IS NOT NULL GROUP BY category"""),
    "a26_delay_histogram": _q(OP, _hist(-60, 200, 100, "")),
    "a26_tail_histogram": _q(OP, _hist(15, 500, 80, "AND ARR_DELAY > 15")),
    "a27_yearly_distribution": _q(OP, """SELECT YEAR, count(v) AS n, min(v) AS lowest, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
        round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS highest FROM (SELECT YEAR, CAST(greatest(-60, least(200, ARR_DELAY)) AS DOUBLE) AS v FROM op WHERE ARR_DELAY IS NOT NULL) GROUP BY YEAR"""),
    "a28_hexbin": _q(OP, _HEX),
    "a29_key_figures": _q(CLEAN, """SELECT count(*) AS total_flights, round((SELECT (1 - avg(ARR_DEL15)) * 100 FROM clean WHERE CANCELLED = 0 AND DIVERTED = 0), 6) AS otp_pct,
        round((SELECT avg(ARR_DELAY) FROM clean WHERE CANCELLED = 0 AND DIVERTED = 0), 6) AS avg_delay, round(avg(CANCELLED) * 100, 6) AS cancel_pct FROM clean"""),
    "a30_yearly_ingestion": _q(CLEAN, """SELECT YEAR, count(*) AS rows_read, count(*) AS rows_full, count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS rows_operated,
        count(*) FILTER (WHERE CANCELLED = 1) AS cancelled, count(*) FILTER (WHERE DIVERTED = 1) AS diverted,
        round(count(*) FILTER (WHERE CANCELLED = 1) / CAST(count(*) AS DOUBLE) * 100, 6) AS cancelled_pct,
        round(count(*) FILTER (WHERE DIVERTED = 1) / CAST(count(*) AS DOUBLE) * 100, 6) AS diverted_pct FROM clean GROUP BY ROLLUP (YEAR)"""),
    "a31_column_profile": _q(CLEAN, _profile(_KIND, False)),
    "a32_quality_table": _q(CLEAN, _profile([c for c in _KIND if not c.endswith(("_SIN", "_COS"))], True)),
    "a32_distinct_by_year": _q(CLEAN, " UNION ALL ".join(
        f"SELECT YEAR, '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM clean GROUP BY YEAR HAVING count({c}) > 0" for c in _MAPPED)),
    "a32_distinct_merged": _q(CLEAN, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM clean HAVING count({c}) > 0" for c in _MAPPED)),
    "a33_describe": _q(CLEAN, _describe(("ARR_DELAY", "DEP_DELAY", "TAXI_OUT", "AIR_TIME", "DISTANCE", "CRS_DEP_TIME_MIN", "CARRIER_DELAY", "DAY_OF_WEEK"))),
    "a34_values_by_year": _q(RAW, "SELECT YEAR, count(*) AS n FROM raw GROUP BY YEAR"),
    "a34_distinct_blocks": _q(RAW, "SELECT DISTINCT DEP_TIME_BLK FROM raw"),
    "a34_year_range": _q(RAW, "SELECT min(YEAR) AS lowest, max(YEAR) AS highest FROM raw"),
    "a35_class_balance": _q(OP, """SELECT count(*) FILTER (WHERE ARR_DEL15 = 0) AS n_negative, count(*) FILTER (WHERE ARR_DEL15 = 1) AS n_positive,
        round(1 - avg(ARR_DEL15), 6) AS share_negative, round(avg(ARR_DEL15), 6) AS share_positive,
        round(count(*) FILTER (WHERE ARR_DEL15 = 0) / CAST(count(*) FILTER (WHERE ARR_DEL15 = 1) AS DOUBLE), 6) AS ratio FROM op"""),
    "a36_target_correlations": _q(OP, " UNION ALL ".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, ARR_DEL15)), 6) AS abs_corr FROM op" for c in (
        "DISTANCE", "CRS_ELAPSED_TIME", "DAY_OF_WEEK", "IS_WEEKEND", "CRS_DEP_TIME_MIN", "DEP_DELAY", "DEP_DEL15", "TAXI_OUT"))),
    "a37_consistency": _q(RAW, """SELECT YEAR, count(*) FILTER (WHERE DISTANCE < 0) AS negative_distance,
        count(*) FILTER (WHERE DAY_OF_WEEK <> isodow(make_date(YEAR, 1, DAY_OF_MONTH))) AS weekday_mismatches FROM raw GROUP BY YEAR"""),
    "k01_top_k": _q(OP, f"SELECT ROUTE, {_OTP} FROM op GROUP BY ROUTE ORDER BY flights, ROUTE LIMIT 15"),
    "k02_full_sort": _q(OP, f"SELECT ROUTE, {_OTP} FROM op GROUP BY ROUTE ORDER BY otp DESC, ROUTE"),
    "u01_concatenate": _q(CLEAN, f"SELECT {_KEY}, ARR_DEL15, CASE WHEN YEAR <> 2025 THEN TAXI_OUT END AS TAXI_OUT FROM clean"),
    "f01_year_split": _q(OP, "SELECT YEAR, CASE WHEN YEAR = 2025 THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM op GROUP BY ALL"),
    "f02_track_a": _q(MAPS, f"SELECT {_TRACK_A.replace('round(', 'round(1.0::DOUBLE * ')}, ARR_DEL15 FROM enc WHERE ARR_DEL15 IS NOT NULL"),
    "f03_track_b": _q(MAPS, f"SELECT {_TRACK_A.replace('round(', 'round(1.0::DOUBLE * ')}, DEP_DELAY, DEP_DELAY_NEW, DEP_DEL15, TAXI_OUT, ARR_DEL15 FROM enc WHERE ARR_DEL15 IS NOT NULL"),
    "f06_missing_partitions": _q(RAW, """SELECT d AS dataset, y AS YEAR FROM (SELECT unnest(['clean_full', 'clean_operated']) AS d) a, (SELECT CAST(unnest(range(2020, 2027)) AS INT) AS y) b
        WHERE NOT EXISTS (SELECT 1 FROM raw WHERE raw.YEAR = y AND (d = 'clean_full' OR (CANCELLED = 0 AND DIVERTED = 0)))"""),
    "f07_label_encode": _q(CLEAN, "SELECT ROUTE, YEAR, CAST(dense_rank() OVER (ORDER BY ROUTE) - 1 AS INT) AS ROUTE_LABEL FROM clean"),
    "f08_frequency_feature": _q(MAPS, "SELECT ROUTE, round(route_freq_exact, 6) AS ROUTE_FREQ, YEAR FROM enc"),
    "f09_leave_one_out": _q(MAPS, """SELECT ORIGIN, YEAR, ARR_DEL15, round(coalesce(1 - (sum(ARR_DEL15) OVER w - ARR_DEL15) / CAST(nullif(count(ARR_DEL15) OVER w - 1, 0) AS DOUBLE),
        (SELECT global_otp FROM globo)), 6) AS ORIGIN_LOO_OTP FROM train_op WHERE ARR_DEL15 IS NOT NULL WINDOW w AS (PARTITION BY ORIGIN)"""),
    "f10_row_counts": _q(OP, """SELECT track, CASE WHEN YEAR = 2025 THEN 'test' ELSE 'train' END AS split, count(*) AS n
        FROM op, (SELECT unnest(['A', 'B']) AS track) t WHERE ARR_DEL15 IS NOT NULL GROUP BY ALL"""),
    "h02_cramers_v": _q(OP + _chi("IS_WEEKEND", ""), "SELECT n, round(sqrt(chi2 / (n * (k - 1))), 6) AS cramers_v FROM x, d"),
    "h03_kruskal_wallis": _q(OP + _RANKED.format(g="DEP_TIME_BLK"), "SELECT k, n, round(h, 6) AS h FROM hh"),
    "h04_epsilon_squared": _q(OP + _RANKED.format(g="OP_CARRIER"), "SELECT n, round((h - k + 1) / (n - k), 6) AS epsilon_squared FROM hh"),
    "h05_dunn": _q(OP + _RANKED.format(g="DEP_TIME_BLK"), """SELECT a.g AS level_a, b.g AS level_b,
        round((a.mr - b.mr) / sqrt((ties.n * (ties.n + 1) / 12 - ts / (12 * (ties.n - 1))) * (1 / CAST(a.n AS DOUBLE) + 1 / CAST(b.n AS DOUBLE))), 6) AS z
        FROM s a JOIN s b ON a.g < b.g, ties"""),
    "h05_step_down": _q(OP, """, given AS (SELECT YEAR, ROUTE, floor(avg(ARR_DEL15) * 10) / 1000 AS p_value FROM op GROUP BY YEAR, ROUTE),
        ranked AS (SELECT *, least(1.0, p_value * (count(p_value) OVER (PARTITION BY YEAR) - row_number() OVER (PARTITION BY YEAR ORDER BY p_value NULLS LAST) + 1)) AS raised FROM given)
        SELECT YEAR, ROUTE, round(p_value, 6) AS p_value, CASE WHEN p_value IS NOT NULL THEN
          round(max(raised) OVER (PARTITION BY YEAR ORDER BY p_value NULLS LAST RANGE UNBOUNDED PRECEDING), 6) END AS p_adjusted FROM ranked"""),
    "h06_cohens_d": _q(OP, """, t AS (SELECT count(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 0) AS n_a, count(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 1) AS n_b,
        avg(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 0) AS mean_a, avg(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 1) AS mean_b,
        var_samp(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 0) AS va, var_samp(ARR_DELAY) FILTER (WHERE IS_WEEKEND = 1) AS vb FROM op)
        SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b,
        round((mean_a - mean_b) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2)), 6) AS cohens_d FROM t"""),
    "h07_factor_effects": _q(OP, _ETA),
    "h07_cause_shares": _q(OP, " UNION ALL ".join(f"SELECT '{c}' AS cause, round({s} / ({' + '.join(_SHARES)}), 6) AS share FROM op" for c, s in zip(CAUSES, _SHARES))),
    "m07_threshold_metrics": _q(_SCORED, f", t AS ({_QUADRANTS.format(keys='', group='')}) SELECT n_samples, {_RATES} FROM t"),
    "m08_roc_auc_tied": _q(_TIED + _curve(), f"SELECT CAST(sum(p + q) AS BIGINT) AS n_samples, round({_AUC}, 6) AS roc_auc FROM cum"),
    "m08_roc_auc": _q(_SCORED + _curve(), f"SELECT CAST(sum(p + q) AS BIGINT) AS n_samples, round({_AUC}, 6) AS roc_auc FROM cum"),
    "m09_average_precision": _q(_SCORED + _curve(), f"SELECT CAST(sum(p + q) AS BIGINT) AS n_samples, round({_AP}, 6) AS pr_auc FROM cum"),
    "m09_average_precision_tied": _q(_TIED + _curve(), f"SELECT CAST(sum(p + q) AS BIGINT) AS n_samples, round({_AP}, 6) AS pr_auc FROM cum"),
    "m10_confusion_matrix": _q(_SCORED, f""", t AS ({_QUADRANTS.format(keys='', group='')})
        SELECT 0 AS actual, 0 AS predicted, CAST(tn AS BIGINT) AS n FROM t UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM t
        UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM t UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM t"""),
    "m11_roc_curve": _q(_SCORED + _curve(), """SELECT round(score, 6) AS threshold, round(fp / CAST(nq AS DOUBLE), 6) AS fpr, round(tp / CAST(np AS DOUBLE), 6) AS tpr FROM cum
        UNION ALL SELECT NULL, 0, 0"""),
    "m11_pr_curve": _q(_SCORED + _curve(), """SELECT round(score, 6) AS threshold, round(tp / CAST(np AS DOUBLE), 6) AS recall, round(tp / CAST(tp + fp AS DOUBLE), 6) AS "precision" FROM cum
        UNION ALL SELECT NULL, 0, 1"""),
    "m12_calibration": _q(_SCORED, """SELECT CAST(greatest(ceil(score * 10) - 1, 0) AS INT) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive_share
        FROM scored GROUP BY 1"""),
    "m12_positive_rate": _q(_SCORED, "SELECT round(avg(label), 6) AS positive_rate, count(label) AS n FROM scored"),
    "m17_drift": _q(_SCORED + _curve("YEAR"), f""", t AS ({_QUADRANTS.format(keys='YEAR,', group='GROUP BY YEAR')}),
        a AS (SELECT YEAR, round({_AUC}, 6) AS roc_auc, round({_AP}, 6) AS pr_auc FROM cum GROUP BY YEAR)
        SELECT t.YEAR, n_samples, {_RATES}, roc_auc, pr_auc FROM t JOIN a ON t.YEAR = a.YEAR"""),
}
_ENCODED = "YEAR, DAY_OF_MONTH, DAY_OF_WEEK, IS_WEEKEND, CRS_DEP_TIME_MIN, CRS_ARR_TIME_MIN, CRS_DEP_SIN, CRS_DEP_COS, CRS_ARR_SIN, CRS_ARR_COS, CRS_ELAPSED_TIME, DISTANCE, DISTANCE_GROUP, OP_CARRIER_FREQ, CARRIER_HIST_OTP, ORIGIN_FREQ, ORIGIN_HIST_OTP, DEST_FREQ, ROUTE_FREQ, DEP_TIME_BLK_FREQ, ARR_DEL15".split(", ")
_VERDICTS = [("A", c, "ok") for c in _ENCODED] + [("A", "ARR_DELAY", "leaked")] + [
    ("B", c, "ok") for c in (*_ENCODED, "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "TAXI_OUT")]
_ABSENT = sorted("""OP_UNIQUE_CARRIER OP_CARRIER_AIRLINE_ID TAIL_NUM OP_CARRIER_FL_NUM ORIGIN_AIRPORT_ID ORIGIN_AIRPORT_SEQ_ID ORIGIN_CITY_MARKET_ID
 ORIGIN_CITY_NAME ORIGIN_STATE_ABR ORIGIN_STATE_FIPS ORIGIN_STATE_NM ORIGIN_WAC DEST_AIRPORT_ID DEST_AIRPORT_SEQ_ID DEST_CITY_MARKET_ID DEST_CITY_NAME
 DEST_STATE_ABR DEST_STATE_FIPS DEST_STATE_NM DEST_WAC DEP_TIME DEP_DELAY_GROUP WHEELS_OFF WHEELS_ON ARR_TIME ARR_DELAY_GROUP ARR_TIME_BLK
 ACTUAL_ELAPSED_TIME FLIGHTS FIRST_DEP_TIME TOTAL_ADD_GTIME LONGEST_ADD_GTIME DIV_AIRPORT_LANDINGS DIV_REACHED_DEST DIV_ACTUAL_ELAPSED_TIME
 DIV_ARR_DELAY DIV_DISTANCE""".split())
_ADDED = sorted("""MONTH CRS_DEP_TIME_MIN CRS_ARR_TIME_MIN CRS_DEP_SIN CRS_DEP_COS CRS_ARR_SIN CRS_ARR_COS FL_DATE IS_WEEKEND ROUTE ARR_DELAY_CAT
 DOMINANT_DELAY_CAUSE""".split())
ORACLES |= {
    "io01_csv_scan": _q(RAW, f"SELECT * EXCLUDE (MONTH) REPLACE (nullif(CRS_DEP_TIME, '') AS CRS_DEP_TIME) FROM (SELECT {_TYPES} FROM raw)"),
    "io02_csv_union": _q(RAW, """SELECT CAST(YEAR AS VARCHAR) AS YEAR, ORIGIN, CASE WHEN YEAR < 2024 THEN DEST END AS DEST,
        CASE WHEN YEAR >= 2024 THEN format('{:.1f}', TAXI_OUT) END AS TAXI_OUT, nullif(CRS_DEP_TIME, '') AS CRS_DEP_TIME FROM raw"""),
    "io03_header_names": _q(RAW, "SELECT CAST(YEAR AS VARCHAR) AS YEAR, OP_CARRIER, format('{:.1f}', ARR_DELAY) AS ARR_DELAY FROM raw"),
    "io05_required_columns": _q(RAW, "SELECT 'required columns missing from input: DIVERTED' AS message, count(*) AS n FROM raw"),
    "io09_partition_overwrite": _q(OP, "SELECT YEAR, count(*) AS n FROM op WHERE YEAR < 2025 OR ORIGIN = 'N99' GROUP BY YEAR"),
    "io12_changed_files": _q(CLEAN + ", left_over AS (SELECT * FROM clean WHERE YEAR IN (2023, 2024) OR (YEAR = 2022 AND DAY_OF_MONTH <= 15))",
        " UNION ALL ".join(f"""SELECT '{c}' AS source, {c} AS key, count(*) AS n_rows,
          count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS n_operated,
          count(ARR_DEL15) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS n_labelled,
          CAST(coalesce(sum(ARR_DEL15) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0), 0) AS BIGINT) AS n_delayed
          FROM left_over GROUP BY {c}""" for c in ENCODED_SOURCES)),
    "io12_map_reuse": _q(MAPS, "SELECT total_train_operated, true AS fitted_0, false AS fitted_1, true AS fitted_2 FROM globo"),
    "f04_leakage_audit": _q(MAPS, " UNION ALL ".join(
        f"SELECT '{t}' AS track, '{c}' AS \"column\", '{v}' AS verdict, count({c}) AS non_null FROM enc WHERE ARR_DEL15 IS NOT NULL" for t, c, v in _VERDICTS)),
    "f05_expected_columns": _q(RAW, f"SELECT count(*) AS n, '{','.join(_ABSENT)}' AS missing, '{','.join(_ADDED)}' AS extra FROM raw"),
    "f11_feature_rows": _q(OP, """, m AS (SELECT quantile_cont(CAST(CRS_DEP_TIME_MIN AS DOUBLE), 0.5) AS t FROM op WHERE YEAR < 2025)
        SELECT coalesce(CAST(CRS_DEP_TIME_MIN AS DOUBLE), t) AS CRS_DEP_TIME_MIN, DISTANCE, CAST(IS_WEEKEND AS DOUBLE) AS IS_WEEKEND,
        CAST(ARR_DEL15 AS DOUBLE) AS label, YEAR AS key_YEAR FROM op, m WHERE ARR_DEL15 IS NOT NULL"""),
    "m19_early_verdicts": _q(CLEAN, """SELECT DEP_DELAY, CASE WHEN DEP_DELAY <= 0 THEN 'on time' WHEN DEP_DELAY > 0 THEN 'may be late' END AS TRACK_A_VERDICT,
        CASE WHEN DEP_DELAY > 15 THEN 'very likely late' WHEN DEP_DELAY <= 15 THEN 'likely on time' END AS TRACK_B_VERDICT, YEAR FROM clean"""),
    "m20_planned_flights": _q(CLEAN, """SELECT YEAR, ROUTE, CAST(CRS_ARR_TIME_MIN // 60 AS INT) AS DEP_HOUR, CAST(CRS_ARR_TIME_MIN % 60 AS INT) AS DEP_MINUTE,
        CAST(CRS_ARR_TIME_MIN AS INT) AS CRS_DEP_TIME_MIN, round(CAST(CRS_ARR_SIN AS DOUBLE), 6) + 0.0 AS CRS_DEP_SIN,
        round(CAST(CRS_ARR_COS AS DOUBLE), 6) + 0.0 AS CRS_DEP_COS, DAY_OF_WEEK, IS_WEEKEND, CAST(floor(DISTANCE / 250) + 1 AS INT) AS DISTANCE_GROUP,
        CASE WHEN CRS_ARR_TIME_MIN < 360 THEN '0001-0559' ELSE format('{:02d}00-{:02d}59', CRS_ARR_TIME_MIN // 60, CRS_ARR_TIME_MIN // 60) END AS DEP_TIME_BLK FROM clean"""),
    "io08_year_partitions": _q(OP, f"SELECT {_KEY}, ROUTE, ARR_DEL15, TAXI_OUT FROM op"),
    "io10_feature_tables": _q(MAPS, f"""SELECT {_TRACK_A.replace('round(', 'round(1.0::DOUBLE * ')}, DEP_DELAY, DEP_DELAY_NEW, DEP_DEL15, TAXI_OUT, ARR_DEL15,
        CASE WHEN YEAR = 2025 THEN 'test' ELSE 'train' END AS split FROM enc WHERE ARR_DEL15 IS NOT NULL"""),
    "io10_other_target": _q(MAPS, f"""SELECT * EXCLUDE (ORIGIN_HIST_OTP, CARRIER_HIST_OTP) FROM (
        SELECT {_TRACK_A.replace('round(', 'round(1.0::DOUBLE * ')}, ARR_DELAY_NEW, CASE WHEN YEAR = 2025 THEN 'test' ELSE 'train' END AS split FROM enc WHERE ARR_DELAY_NEW IS NOT NULL)"""),
    "io12_narrower_rerun": _q(MAPS, """SELECT YEAR, count(*) AS n, round(sum(CAST(CAST(f.n / CAST(t.n AS DOUBLE) AS FLOAT) AS DOUBLE)), 6) AS origin_freq FROM op
        JOIN (SELECT ORIGIN, count(*) AS n FROM clean WHERE YEAR IN (2021, 2022) AND ORIGIN IS NOT NULL GROUP BY ORIGIN) f USING (ORIGIN),
        (SELECT count(ORIGIN) AS n FROM clean WHERE YEAR IN (2021, 2022)) t WHERE YEAR IN (2021, 2022) AND ARR_DEL15 IS NOT NULL GROUP BY YEAR"""),
    "h01_p_values_all_years": _q(OP + _chi("YEAR", ""), "SELECT dof, round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value FROM x, d"),
    "h03_p_values": _q(OP + _RANKED.format(g="DEP_TIME_BLK"), """SELECT k, n, round(h, 6) AS h, round((h - k + 1) / (n - k), 6) AS epsilon_squared,
        round(exp(-h / 2) * list_sum([pow(h / 2, i) / CAST(factorial(CAST(i AS INT)) AS DOUBLE) for i in range(CAST((k - 1) // 2 AS BIGINT))]), 6) AS p_value FROM hh"""),
    "k03_preview": _q(CLEAN, f"SELECT {_KEY}, ROUTE, ARR_DEL15 FROM clean ORDER BY {', '.join(c + ' NULLS FIRST' for c in (_KEY + ', ROUTE, ARR_DEL15').split(', '))} LIMIT 10"),
    "k04_seeded_sample": _q(OP, f"""SELECT {_KEY}, ARR_DEL15 FROM (SELECT *, md5(concat_ws('|', '42', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '{chr(92)}N')" for c in (_KEY + ', ARR_DEL15').split(', '))},
        CAST(row_number() OVER (PARTITION BY {_KEY}, ARR_DEL15) AS VARCHAR))) AS draw FROM op) ORDER BY draw LIMIT 1000"""),
    "io13_saved_model": _q(MAPS, "SELECT CAST(0 AS BIGINT) AS different, count(*) AS n FROM enc WHERE ARR_DEL15 IS NOT NULL AND YEAR = 2025"),
    "io11_stored_maps": _q(MAPS, "SELECT source, key, round(freq, 6) AS freq FROM freqs"),
    "s01_incremental_ingest": _q(CLEAN, f"SELECT {_KEY}, ROUTE, ARR_DEL15, TAXI_OUT, CANCELLED, DIVERTED FROM clean"),
}
for _name, _row, _where in (("h01_chi_square", "YEAR", "AND YEAR IN (2021, 2025)"), ("h01_chi_square_all_years", "YEAR", "")):
    ORACLES[_name] = _q(OP + _chi(_row, _where), "SELECT round(chi2, 6) AS chi2, dof, n, round(sqrt(chi2 / (n * (k - 1))), 6) AS cramers_v FROM x, d")
_SIDE = """SELECT (SELECT avg(CASE WHEN (score > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) FROM scored) AS accuracy, {auc} AS roc_auc FROM cum"""
ORACLES["j06_fixed_scores"] = f"""SELECT 'fixed' AS model, round(a.accuracy, 6) AS accuracy_a, round(b.accuracy, 6) AS accuracy_b,
 round(a.roc_auc, 6) AS roc_auc_a, round(b.roc_auc, 6) AS roc_auc_b, round(b.roc_auc - a.roc_auc, 6) AS roc_auc_gain
 FROM ({_q(_TIED + _curve(), _SIDE.format(auc=_AUC))}) a, ({_q(_SCORED + _curve(), _SIDE.format(auc=_AUC))}) b"""


def _clock(m: str) -> str:
    return f"lpad(CAST({m} + 40 * ({m} // 60) AS VARCHAR), 4, '0')"


_WIDE = RAW.removesuffix("\n FROM c)") + f""",
  {_clock('((m + h % 60) % 1440)')} AS DEP_TIME, {_clock('((m + h % 60 + 8 + l_partkey % 35) % 1440)')} AS WHEELS_OFF,
  {_clock('((am + h % 50 + 1435) % 1440)')} AS WHEELS_ON, CASE WHEN h % 401 = 0 THEN '2400' ELSE {_clock('((am + h % 50) % 1440)')} END AS ARR_TIME,
  CASE WHEN h % 17 = 0 THEN {_clock('m')} END AS FIRST_DEP_TIME, CAST(h % 15 - 2 AS INT) AS DEP_DELAY_GROUP, CAST(h % 14 - 2 AS INT) AS ARR_DELAY_GROUP,
  CASE WHEN am < 360 THEN '0001-0559' ELSE lpad(CAST(am // 60 AS VARCHAR), 2, '0') || 'XX' END AS ARR_TIME_BLK,
  CAST(e + h % 21 - 10 AS DOUBLE) AS ACTUAL_ELAPSED_TIME, CASE WHEN h % 17 = 0 THEN CAST(h % 40 AS DOUBLE) END AS TOTAL_ADD_GTIME,
  CASE WHEN h % 17 = 0 THEN CAST(h % 30 AS DOUBLE) END AS LONGEST_ADD_GTIME, CAST(h % 3 AS INT) AS DIV_AIRPORT_LANDINGS,
  CASE WHEN h % 19 = 0 THEN CAST(h % 2 AS INT) END AS DIV_REACHED_DEST, CASE WHEN h % 19 = 0 THEN CAST(e + 100 AS DOUBLE) END AS DIV_ACTUAL_ELAPSED_TIME,
  CASE WHEN h % 19 = 0 THEN CAST(a + 60 AS DOUBLE) END AS DIV_ARR_DELAY, CASE WHEN h % 19 = 0 THEN CAST(h % 300 AS DOUBLE) END AS DIV_DISTANCE
 FROM c)"""
_BLANK_IF_CANCELLED = """DEP_TIME ARR_TIME WHEELS_OFF WHEELS_ON TAXI_OUT TAXI_IN ACTUAL_ELAPSED_TIME AIR_TIME DEP_DELAY DEP_DELAY_NEW DEP_DEL15
 DEP_DELAY_GROUP ARR_DELAY ARR_DELAY_NEW ARR_DEL15 ARR_DELAY_GROUP CARRIER_DELAY WEATHER_DELAY NAS_DELAY SECURITY_DELAY LATE_AIRCRAFT_DELAY
 FIRST_DEP_TIME TOTAL_ADD_GTIME LONGEST_ADD_GTIME DIV_AIRPORT_LANDINGS DIV_REACHED_DEST DIV_ACTUAL_ELAPSED_TIME DIV_ARR_DELAY DIV_DISTANCE""".split()
_BLANK_IF_DIVERTED = "ARR_TIME ARR_DELAY ARR_DELAY_NEW ARR_DEL15 ARR_DELAY_GROUP ARR_TIME_BLK WHEELS_ON TAXI_IN".split()
_CLOCKS = "CRS_DEP_TIME DEP_TIME WHEELS_OFF WHEELS_ON CRS_ARR_TIME ARR_TIME FIRST_DEP_TIME".split()
_LOST = {c: [f for f, blanks in (("CANCELLED", _BLANK_IF_CANCELLED), ("DIVERTED", _BLANK_IF_DIVERTED)) if c in blanks] for c in _CLOCKS}


def _unless(flag: str, columns) -> str:
    return ", ".join(f"CASE WHEN {flag} = 1 THEN NULL ELSE {c} END AS {c}" for c in columns)


ORACLES |= {
    "p01_every_column": _q(_WIDE, f"SELECT {_KEY}, CANCELLED, {_unless('CANCELLED', _BLANK_IF_CANCELLED)} FROM raw"),
    "p02_every_column": _q(_WIDE, f"SELECT {_KEY}, DIVERTED, {_unless('DIVERTED', _BLANK_IF_DIVERTED)} FROM raw"),
    "p03_every_clock": _q(_WIDE, f"SELECT {_KEY}, {', '.join(f'{_minutes(c)} AS {c}_MIN' for c in _CLOCKS)} FROM raw"),
    "p04_every_clock": _q(_WIDE, " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(v) AS parsed, count(*) - count(v) AS na FROM (SELECT CASE WHEN {' OR '.join([f + ' = 1' for f in _LOST[c]] or ['false'])} THEN NULL ELSE {_minutes(c)} END AS v FROM raw)""" for c in _CLOCKS)),
}


def _picked(years: str, more: str) -> str:
    """The page's filter on all flights; ``op`` are those flown among them."""
    where = f"YEAR IN ({years}) AND OP_CARRIER IN ('C01', 'C05', 'C09') {more}"
    return f"{CLEAN}, picked AS (SELECT * FROM clean WHERE {where}), op AS (SELECT * FROM picked WHERE CANCELLED = 0 AND DIVERTED = 0)"


_BY_CARRIER = _picked("2022, 2025", "")
_BY_END = _picked("2022, 2023, 2025", "AND ORIGIN IN ('A01', 'A03', 'A07', 'N99')")
_BY_DEST = _picked("2022, 2023, 2025", "AND DEST IN ('A02', 'A04', 'A11') AND DEP_TIME_BLK IN ('0001-0559', '0800-0859', '1700-1759')")
ORACLES |= {
    "a29_cube_key_figures": _q(_BY_CARRIER, """SELECT count(*) AS total_flights, round((SELECT (1 - avg(ARR_DEL15)) * 100 FROM op), 6) AS otp_pct,
        round((SELECT avg(ARR_DELAY) FROM op), 6) AS avg_delay, round(avg(CANCELLED) * 100, 6) AS cancel_pct FROM picked"""),
    "a05_cube_years": _q(_BY_CARRIER, f"SELECT YEAR, round(avg(ARR_DEL15) * 100, 6) AS delay_pct, {_OTP} FROM op GROUP BY YEAR"),
    "a11_cube_grid": _q(_BY_CARRIER, _grid("YEAR", "DEP_TIME_BLK", _BLOCKS)),
    "a26_cube_histogram": _q(_BY_END, _hist(-60, 200, 100, "")),
    "a18_cube_causes": _q(_BY_END, " UNION ALL ".join(f"SELECT '{c}' AS cause, coalesce(sum({c}), 0) AS minutes FROM op" for c in CAUSES)),
    "a12_cube_carriers": _q(_BY_DEST, """SELECT OP_CARRIER, count(ARR_DEL15) AS flights, round(avg(ARR_DEL15), 6) AS delay_rate, round((1 - avg(ARR_DEL15)) * 100, 6) AS otp_pct
        FROM op GROUP BY OP_CARRIER HAVING count(ARR_DEL15) >= 50"""),
    "a27_sketched_quartiles": _q(OP, """SELECT YEAR, count(ARR_DELAY) AS n, true AS q25_within, true AS q50_within, true AS q75_within
        FROM op GROUP BY YEAR HAVING count(ARR_DELAY) > 0"""),
}
ORACLES["s01_running_totals"] = _q(RAW, """SELECT YEAR, count(*) FILTER (WHERE CANCELLED = 1) AS r1_cancelled, count(*) FILTER (WHERE DIVERTED = 1) AS r2_diverted,
    count(*) AS r3_clock_rows, count(*) AS r4_date_rows, count(*) FILTER (WHERE DAY_OF_WEEK <> isodow(make_date(YEAR, 1, DAY_OF_MONTH))) AS weekday_mismatches,
    count(*) FILTER (WHERE DISTANCE < 0) AS negative_distance, count(*) FILTER (WHERE YEAR IS NULL) AS rows_without_year,
    count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS operated FROM raw GROUP BY YEAR""")
# the same rows as the full count, whatever the sketch names
ORACLES |= {"j04_frequent_semi_join": ORACLES["j04_busiest_semi_join"], "a13_frequent_origins": ORACLES["a13_origin_otp"], "a14_frequent_routes": ORACLES["a14_route_otp"]}
