"""Left joins to a large table of keys when a few keys hold most of the rows.

A frequent-items sketch of the key column, combined map-side, names every key that may
hold more than a bounded share of the rows. The rows of such a key are dealt to as many
salts as its share asks for, and its one table row is repeated under each of them; rows
without a key are spread too, as they match nothing. So no reducer gets more of one key
than that share, with or without adaptive execution.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key's rows go to one reducer only while they are at most this part of all rows.
PARTS = 256
#: Items that the sketch tracks: its counts are off by at most 3.5 / TRACKED of the rows, well below a part.
TRACKED = 8192


def heavy_keys(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """(key, salts) of the keys that may hold over one of ``parts`` of the rows with a key: at most about ``parts`` rows.

    ``salts`` is how many parts the key's rows are dealt to. No key of that share is missed; the sketch's
    estimate is an upper bound. An empty column gives none.
    """
    column = F.col(key)
    one = df.filter(column.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.call_function("approx_top_k", column, F.lit(2 * parts), F.lit(TRACKED)).alias("top"))
    found = one.select("rows", F.inline("top"))
    return found.select(F.col("item").alias("key"), F.ceil(F.col("count") * parts / F.col("rows")).cast("int").alias("salts")).filter("salts > 1")


def salted(df: DataFrame, heavy: list, key: str, parts: int = PARTS):
    """The salt of each row: dealt evenly for heavy keys and for rows without a key, 0 for the rest."""
    dealt = F.xxhash64(F.monotonically_increasing_id())
    salt = F.when(F.col(key).isNull(), F.pmod(dealt, F.lit(parts)))
    if heavy:
        salts = F.create_map(*[F.lit(x) for r in heavy for x in (r["key"], r["salts"])])
        salt = salt.otherwise(F.coalesce(F.pmod(dealt, salts[F.col(key)]), F.lit(0)))
    return F.coalesce(salt, F.lit(0)).cast("int")


def heavy_keys_of(df: DataFrame, keys: Sequence[str], parts: int = PARTS) -> dict[str, list]:
    """``heavy_keys`` of several columns, all from one scan of ``df``: one row, its sketches hold ``2 * parts`` items a column."""
    sketches = [x for i, c in enumerate(keys) for x in (
        F.count(F.col(c)).alias(f"rows{i}"),
        F.expr(f"approx_top_k(`{c}`, {2 * parts}, {TRACKED}) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"top{i}"))]
    one = df.agg(*sketches).first()
    heavy = {}
    for i, c in enumerate(keys):
        salts = [{"key": t["item"], "salts": math.ceil(t["count"] * parts / one[f"rows{i}"])} for t in one[f"top{i}"] or []]
        heavy[c] = [x for x in salts if x["salts"] > 1]
    return heavy


def left_lookups(df: DataFrame, tables: Mapping[str, DataFrame], table_key: str = "_key", parts: int = PARTS) -> DataFrame:
    """``left_lookup`` of a table per key column of ``df``, the heavy keys of all columns named by one scan before any join."""
    heavy = heavy_keys_of(df, list(tables), parts)
    for key, table in tables.items():
        df = left_lookup(df, table, key, table_key, parts, heavy[key])
    return df


def left_lookup(df: DataFrame, table: DataFrame, key: str, table_key: str = "_key", parts: int = PARTS,
                heavy: list | None = None) -> DataFrame:
    """``df`` with the columns of ``table`` but its key, which is unique there; null where ``table`` has no such key.

    All rows and columns of ``df`` stay. Names of ``table`` must be new to ``df``. ``heavy`` is ``heavy_keys`` of the
    column if that is known: finding it reads ``df``, whatever joins it holds already.
    """
    if heavy is None:
        heavy = heavy_keys(df, key, parts).collect()  # at most about `parts` rows
    rows = df.withColumn("_salt", salted(df, heavy, key, parts))
    salts = F.lit(1)
    if heavy:
        salts = F.coalesce(F.create_map(*[F.lit(x) for r in heavy for x in (r["key"], r["salts"])])[F.col(table_key)], F.lit(1))
    repeated = table.withColumn("_table_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    # the sizes were measured for this way: a size estimate must not bring the broadcast back
    joined = rows.hint("merge").join(repeated, (F.col(key) == F.col(table_key)) & (F.col("_salt") == F.col("_table_salt")), "left")
    return joined.drop("_salt", "_table_salt", table_key)
