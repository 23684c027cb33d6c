"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracles import ORACLES
from checks.queries import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when both engines give the same columns and the same multiset of rows."""
    df = REGISTRY[name](spark, folder)
    mine_columns, mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    other_columns, other = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if mine_columns != other_columns:
        return f"columns {mine_columns} vs {other_columns}"
    if mine == other:
        return None
    return (f"{sum(mine.values())} vs {sum(other.values())} rows; only Spark {list((mine - other).items())[:3]};"
            f" only SQL {list((other - mine).items())[:3]}")


def main(argv: list[str]) -> int:
    from tarmac.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in REGISTRY:
        if name not in ORACLES or (argv[1:] and not name.startswith(tuple(argv[1:]))):
            continue
        start = time.time()
        try:
            problem = difference(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differences; without SQL: {[n for n in REGISTRY if n not in ORACLES]}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
