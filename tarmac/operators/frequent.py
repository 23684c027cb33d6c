"""The busiest keys of a column with very many keys, without shuffling every key.

A frequent-items sketch, combined map-side and merged, names candidates: a bounded multiple
of k. A second scan, of the key column alone, counts these exactly. The sketch's error bound
then says whether a key outside the candidates could still be among the first k or tie with the
last of them; if it could, every key is counted after all. So the answer is always that of the
full count, and the shuffle is bounded by k wherever the first k stand out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ordering import top_k

#: Items that a sketch tracks. Its estimates are at most 3.5 / TRACKED of the rows above the true counts.
TRACKED = 65_536
#: Candidates for each key asked for, and at least this many.
PER_KEY, LEAST = 4, 256


def counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of every known key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def candidates(df: DataFrame, key: str, k: int, tracked: int = TRACKED) -> tuple[list, int]:
    """At most max(4 k, 256) keys that include the k busiest, if these stand out, and a bound: no other key has more rows."""
    asked = min(max(PER_KEY * k, LEAST), tracked)
    known = df.filter(F.col(key).isNotNull())
    one = known.agg(F.count(F.lit(1)).alias("rows"), F.call_function("approx_top_k", F.col(key), F.lit(asked), F.lit(tracked)).alias("top")).first()
    top = one["top"] or []
    # the sketch lists a key only if its estimate less the error exceeds the error: an unlisted one has two errors at most
    unlisted = int(2 * 3.5 / tracked * one["rows"]) + 1
    return [r["item"] for r in top], max([unlisted, *([min(r["count"] for r in top)] if len(top) == asked else [])])


def busiest_keys(df: DataFrame, key: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """(key, n) of the k keys with the most rows, ties to the smaller key; all keys if there are fewer. Rows without a key do not count."""
    spark = df.sparkSession
    named, bound = candidates(df, key, k, tracked)
    if len(named) >= k:
        listed = spark.createDataFrame([(v,) for v in named], df.select(key).schema)
        # a bounded number of rows, so the counting needs no exchange but that of the candidates' partial counts
        exact = top_k(counts(df.join(F.broadcast(listed), key, "left_semi"), key), "n", k, key).collect()
        if len(exact) == k and (k == 0 or exact[-1]["n"] > bound):
            return spark.createDataFrame([tuple(r) for r in exact], counts(df, key).schema)
    return top_k(counts(df, key), "n", k, key)


def keep_busiest(df: DataFrame, key: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """Rows of the k busiest keys."""
    return df.join(F.broadcast(busiest_keys(df, key, k, tracked).select(key)), key, "left_semi")
