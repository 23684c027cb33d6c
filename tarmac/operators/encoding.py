"""Train-only frequency and history encodings.

One scan of the training rows gives a small table of per-key counts; every map is
read off that table, and the fact table is joined to it once per source column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import delays
from tarmac.operators import lookups
from tarmac.session import BROADCAST_BYTES, BROADCAST_ROWS, materialise

NEUTRAL_OTP = 0.5


def train_rows(df: DataFrame, years: Sequence[int] = schema.TRAIN_YEARS) -> DataFrame:
    return df.filter(F.col("YEAR").isin(*years))


def test_rows(df: DataFrame, years: Sequence[int] = schema.TRAIN_YEARS) -> DataFrame:
    """Every dated row outside the training years."""
    return df.filter(~F.col("YEAR").isin(*years))


def key_statistics(train: DataFrame, target: str = schema.TARGET,
                   sources: Sequence[str] = tuple(schema.FREQUENCY_FEATURES)) -> DataFrame:
    """Counts per (source, key) in one scan, unknown keys included.

    Each row is fanned out to its keys and combined map-side, so a key holding a
    third of all rows reaches the shuffle as one row per task.
    """
    if target != "ARR_DEL15":
        raise ValueError("history rates need the 0/1 target ARR_DEL15")
    return _key_statistics(train, F.col(target), sources)


def frequency_statistics(train: DataFrame, sources: Sequence[str] = tuple(schema.FREQUENCY_FEATURES)) -> DataFrame:
    """``key_statistics`` for targets that have no history rates: no row is labelled."""
    return _key_statistics(train, F.lit(None).cast("int"), sources)


def _key_statistics(train: DataFrame, late: Column, sources: Sequence[str]) -> DataFrame:
    return statistics_by(train, late, [], sources)


def statistics_by(train: DataFrame, late: Column, by: Sequence[str],
                  sources: Sequence[str] = tuple(schema.FREQUENCY_FEATURES)) -> DataFrame:
    """Counts per (by, source, key); ``late`` is the 0/1 target, or null where there is none."""
    flown = delays.is_operated()
    narrow = train.select(*by, *sources, flown.alias("_flown"), F.when(flown, late).alias("_late"))
    long = narrow.unpivot([*by, "_flown", "_late"], list(sources), "source", "key")
    return long.groupBy(*by, "source", "key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_flown")).alias("n_operated"),
        F.count("_late").alias("n_labelled"),
        F.coalesce(F.sum("_late"), F.lit(0)).alias("n_delayed"),
    )


def frequency_map(stats: DataFrame) -> DataFrame:
    """Share of each known key among all training rows with a known key."""
    known = stats.filter(F.col("key").isNotNull())
    # One row per encoded column: a handful, whatever the data.
    totals = known.groupBy("source").agg(F.sum("n_rows").alias("total"))
    return known.join(F.broadcast(totals), "source").select(
        "source", "key", (F.col("n_rows") / F.col("total")).alias("freq"))


def history_map(stats: DataFrame, sources: Sequence[str] = tuple(schema.HISTORY_FEATURES)) -> DataFrame:
    """On-time share of each key among operated training rows."""
    seen = stats.filter(F.col("key").isNotNull() & F.col("source").isin(*sources)
                        & (F.col("n_operated") > 0))
    on_time = F.try_divide(F.col("n_labelled") - F.col("n_delayed"), F.col("n_labelled"))
    return seen.select("source", "key", F.coalesce(on_time, F.lit(NEUTRAL_OTP)).alias("otp"))


def global_history(stats: DataFrame, source: str = "ORIGIN") -> DataFrame:
    """One row: operated training rows, delayed ones, and the overall on-time share.

    The denominator counts every operated row; delays are those with a known origin.
    """
    one = stats.filter(F.col("source") == source).agg(
        F.coalesce(F.sum("n_operated"), F.lit(0)).alias("total_train_operated"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n_delayed"))), F.lit(0)).alias("n_delayed"),
    )
    share = F.try_divide(F.col("total_train_operated") - F.col("n_delayed"), F.col("total_train_operated"))
    return one.withColumn("global_otp", F.coalesce(share, F.lit(NEUTRAL_OTP)))


class Encodings:
    """Train-only maps: one small stored table of key counts plus a few totals.

    The totals (a row per encoded column) are the only values brought to the driver;
    rates are column arithmetic on the table.
    """

    def __init__(self, statistics: DataFrame):
        self.statistics = statistics
        known = F.col("key").isNotNull()
        totals = statistics.groupBy("source").agg(
            F.count_if(known).alias("keys"), F.sum(F.when(known, F.col("n_rows"))).alias("rows"),
            F.sum(F.octet_length("key")).alias("bytes"), F.sum("n_operated").alias("operated"), F.sum(F.when(known, F.col("n_delayed"))).alias("delayed"))
        self.totals = {r["source"]: r for r in totals.collect()}
        origin = self.totals.get("ORIGIN")
        empty = origin is None or not origin["operated"]
        self.global_otp = NEUTRAL_OTP if empty else (
            origin["operated"] - (origin["delayed"] or 0)) / origin["operated"]

    @classmethod
    def fit(cls, train: DataFrame, target: str = schema.TARGET) -> Encodings:
        return cls(materialise(key_statistics(train, target)))

    @property
    def frequency(self) -> DataFrame:
        return frequency_map(self.statistics)

    @property
    def history(self) -> DataFrame:
        return history_map(self.statistics)

    def known_keys(self, source: str) -> DataFrame:
        """One source's keys with their rates; ``otp`` is NULL for keys never operated."""
        totals = self.totals.get(source)
        rows = totals["rows"] if totals is not None and totals["rows"] else 1
        share = F.try_divide(F.col("n_labelled") - F.col("n_delayed"), F.col("n_labelled"))
        otp = F.when(F.col("n_operated") > 0, F.coalesce(share, F.lit(NEUTRAL_OTP)))
        return self.statistics.filter((F.col("source") == source) & F.col("key").isNotNull()).select(
            F.col("key").alias("_key"), (F.col("n_rows") / F.lit(rows)).alias("freq"), otp.alias("otp"),
            "n_labelled", "n_delayed")

    def lookup(self, df: DataFrame, source: str, **columns: str) -> DataFrame:
        """Left join one source's columns, e.g. ``freq="ORIGIN_FREQ"``.

        The key table is broadcast while its counted rows and the bytes of its keys
        stay under their limits. Beyond them rows and keys are shuffled, heavy keys under salts.
        """
        table = self.known_keys(source).select(
            "_key", *[F.col(kind).alias(column) for kind, column in columns.items()])
        totals = self.totals.get(source)
        if totals is None or (totals["keys"] <= BROADCAST_ROWS and (totals["bytes"] or 0) <= BROADCAST_BYTES):
            return df.join(F.broadcast(table), F.col(source) == F.col("_key"), "left").drop("_key")
        return lookups.left_lookup(df, table, source)


def _encode(df: DataFrame, maps: Encodings, frequency: bool, history: bool) -> DataFrame:
    """One join per source; unseen and unknown keys give frequency 0 and the overall share."""
    filled = {}
    for source in schema.FREQUENCY_FEATURES:
        wanted = {}
        if frequency:
            wanted["freq"] = schema.FREQUENCY_FEATURES[source]
            filled[wanted["freq"]] = F.lit(0.0)
        if history and source in schema.HISTORY_FEATURES:
            wanted["otp"] = schema.HISTORY_FEATURES[source]
            filled[wanted["otp"]] = F.lit(maps.global_otp)
        if wanted:
            df = maps.lookup(df, source, **wanted)
    return df.withColumns({c: F.coalesce(F.col(c), default).cast("float") for c, default in filled.items()})


def add_frequency(df: DataFrame, maps: Encodings) -> DataFrame:
    return _encode(df, maps, frequency=True, history=False)


def add_history(df: DataFrame, maps: Encodings) -> DataFrame:
    return _encode(df, maps, frequency=False, history=True)


def encode(df: DataFrame, maps: Encodings) -> DataFrame:
    return _encode(df, maps, frequency=True, history=True)


def leave_one_out_history(train: DataFrame, maps: Encodings, source: str,
                          target: str = schema.TARGET) -> DataFrame:
    """History share of the other training rows with the same key.

    For operated training rows only; a key seen once falls back to the overall share.
    """
    joined = maps.lookup(train, source, n_labelled="_labelled", n_delayed="_delayed")
    late: Column = F.col("_delayed") - F.col(target)
    share = F.coalesce(1 - F.try_divide(late, F.col("_labelled") - 1), F.lit(maps.global_otp))
    return joined.withColumn(f"{source}_LOO_OTP", share).drop("_labelled", "_delayed")


def unseen_audit(df: DataFrame, maps: Encodings, years: Sequence[int] | None = None) -> DataFrame:
    """Rows with a known key that a map has never seen, per source.

    Keys are counted first, so the join is between two key tables.
    """
    if years is not None:
        df = df.filter(F.col("YEAR").isin(*years))
    sources = list(schema.FREQUENCY_FEATURES)
    keys = (df.select(*sources).unpivot([], sources, "source", "key")
            .filter(F.col("key").isNotNull())
            .groupBy("source", "key").agg(F.count(F.lit(1)).alias("n")))
    table = maps.statistics.filter(F.col("key").isNotNull()).select(
        "source", "key", F.lit(True).alias("counted"), (F.col("n_operated") > 0).alias("flown"))
    joined = keys.join(table, ["source", "key"], "left")
    audits = []
    for kind, prefix, chosen in (("counted", "", schema.FREQUENCY_FEATURES), ("flown", "otp_", schema.HISTORY_FEATURES)):
        missing = F.when(F.coalesce(F.col(kind), F.lit(False)), 0).otherwise(F.col("n"))
        audits.append(joined.filter(F.col("source").isin(*chosen)).groupBy(
            F.concat(F.lit(prefix), F.col("source")).alias("source")).agg(
            F.sum("n").alias("total"), F.sum(missing).alias("unseen")))
    both = audits[0].unionByName(audits[1])
    return both.withColumn("rate_pct", F.coalesce(delays.percent(F.col("unseen"), F.col("total")), F.lit(0.0)))


def label_encode(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Attach integer codes; values without a code, and unknown ones, get -1.

    ``codes`` is a stored table, so counting it reads only its footers.
    """
    renamed = codes.select(F.col(column).alias("_key"), F.col("code").alias(f"{column}_LABEL"))
    if codes.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    joined = df.join(renamed, F.col(column) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(f"{column}_LABEL", F.coalesce(F.col(f"{column}_LABEL"), F.lit(-1)))
