"""Mixes sources to target weights by drawing fixed-length blocks of words.

Each source is one stream of words, its documents in a hashed order, cut into blocks
of equal length. The mix is a row of slots, dealt to output shards. For each shard the number
of slots of each source is drawn from a multinomial over the targets: a slot's source is
where its uniform point falls among the sources' shares, and the points of a shard are
independent. Over the shards the points at one place of a shard are an even grid, whose
order is a pseudorandom permutation of the shards of its own, so the totals stay close to the targets; the few slots
by which a source exceeds its quota go to sources below theirs. A shard's counts are
ranges of its sources' draws. A source's draws walk through its blocks in the order of a
pseudorandom permutation, a new one for each pass. Blocks and draws are joined by index.
Only DataFrame expressions run; the same input gives the same mix.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise

#: ASCII whitespace, between words.
SPACES = " \t\n\x0b\f\r"
#: Draws that one row is spread to at a time.
CHUNK = 4096


#: Rounds of a permutation, each of which exchanges about half of the indexes in pairs.
ROUNDS = 10
#: Draws that a task spreads, if the session has not more tasks than that asks for.
TASK_DRAWS = 1 << 22
#: Shards whose counts are summed into one before running totals are taken.
GROUP = 1024


class Mix(NamedTuple):
    """``docs``: a row per document; ``draws``: (shard, source_no, block), a row per slot; ``sources``: targets, sizes, quotas."""

    docs: DataFrame
    draws: DataFrame
    sources: DataFrame


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII whitespace; 0 for null."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", 0).otherwise(F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x"))).cast("long")


def _hashed(text: Column) -> Column:
    """32 bits of an md5 as a long; other engines have it too."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _permuted(index: Column, n: Column, key: Column) -> Column:
    """The place of ``index`` in a permutation of 0 .. n - 1 that ``key`` chooses.

    A swap-or-not shuffle: each round pairs index x with (k - x) modulo n, and a hashed bit of the pair says
    whether the two change places. It is a permutation for every n, without a table and without a sort.
    """
    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swap = F.transform(F.array(other), lambda y: F.when(F.xxhash64(key, -1 - r, F.greatest(x, y)).bitwiseAND(F.lit(1)) == 1, y).otherwise(x))
        return swap[0]

    # never null, so that joins on it add no second reckoning to test that
    return F.coalesce(F.aggregate(F.array(*map(F.lit, range(ROUNDS))), index, step), F.lit(0).cast("long"))


def _running(df: DataFrame, by: str, at: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` before row ``at`` within ``by``; groups of rows first, so that no task holds all of a key."""
    df = df.withColumn("_group", F.expr(f"{at} div {GROUP}"))
    before = Window.partitionBy(by).orderBy("_group").rowsBetween(Window.unboundedPreceding, 0)
    groups = df.groupBy(by, "_group").agg(F.sum(value).alias("_in")).withColumn("_before", F.sum("_in").over(before) - F.col("_in"))
    within = Window.partitionBy(by, "_group").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.join(groups.select(by, "_group", "_before"), [by, "_group"])
    return joined.withColumn(out, F.col("_before") + F.sum(value).over(within) - F.col(value)).drop("_group", "_before")


def _filled(sources: DataFrame, shard_slots: int) -> DataFrame:
    """(shard, source_no, i): the draws of each source, numbered from 0 to its quota, and the shards that they fill.

    ``sources`` (source_no, quota, upto), ``upto`` the running sum of the quotas.
    """
    spark = sources.sparkSession
    total, least = (int(v) for v in sources.agg(F.coalesce(F.max("upto"), F.lit(0)), F.greatest(F.count(F.when(F.col("quota") > 0, 1)), F.lit(1))).first())
    shards = max(1, -(-total // shard_slots))
    in_last = total - (shards - 1) * shard_slots
    slots = spark.range(total).select(F.expr(f"id div {shard_slots}").alias("shard"), (F.col("id") % shard_slots).alias("place"))
    # the shards that have this place; the last one may be shorter
    having = F.when(F.col("place") < in_last, shards).otherwise(max(1, shards - 1)).cast("long")
    slots = slots.withColumn("turn", _permuted(F.col("shard"), having, F.col("place")))
    point = F.pmod(F.xxhash64(F.lit("point"), F.col("place")), F.lit(max(1, total)))
    slots = slots.withColumn("x", (point + F.col("turn") * F.floor(F.lit(total) / having).cast("long")) % max(1, total))
    # sources are found by the cell of the point: as many cells as sources, so each holds few
    width = max(1, -(-total // least))
    shares = sources.where("quota > 0").select("source_no", (F.col("upto") - F.col("quota")).alias("lower"), "upto")
    cells = shares.withColumn("cell", F.explode(F.expr(f"sequence(lower div {width}, (upto - 1) div {width})")))
    drawn = slots.withColumn("cell", F.expr(f"x div {width}")).join(cells, "cell").where("x >= lower and x < upto")
    drawn = materialise(drawn.groupBy("shard", "source_no").agg(F.count("*").alias("c")))
    counts = materialise(_running(drawn, "source_no", "shard", "c", "offset"))

    # what a source drew beyond its quota fills what others drew below theirs, in the order of the sources
    every = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    settled = sources.join(counts.groupBy("source_no").agg(F.sum("c").alias("drawn")), "source_no", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    settled = settled.withColumns({"over": F.greatest(F.col("drawn") - F.col("quota"), F.lit(0)), "under": F.greatest(F.col("quota") - F.col("drawn"), F.lit(0))})
    settled = materialise(settled.select("source_no", "quota", "drawn", "under", (F.sum("over").over(every) - F.col("over")).alias("over_before"),
                                         (F.sum("under").over(every) - F.col("under")).alias("under_before")))
    # a few rows of ranges become many draws: dealt by a stated number, as adaptive execution would join such small parts
    dealt = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_DRAWS)
    ranges = counts.repartition(dealt, "shard", "source_no").join(settled, "source_no").withColumn("end", F.col("offset") + F.col("c"))
    kept = ranges.where("offset < quota").select("shard", "source_no", F.explode(F.expr("sequence(offset, least(end, quota) - 1)")).alias("i"))
    spare = ranges.where("end > quota").select(
        "shard", F.explode(F.expr("sequence(over_before + greatest(offset, quota) - quota, over_before + end - quota - 1)")).alias("r"))
    open_ = settled.where("under > 0").select("source_no", "drawn", "under_before", F.explode(F.expr(f"sequence(0L, under - 1, {CHUNK}L)")).alias("chunk"), "under").withColumn(
        "k", F.explode(F.expr(f"sequence(chunk, least(chunk + {CHUNK}, under) - 1)")))
    # spread from a few rows too: no small side
    moved = spare.join(open_.select((F.col("under_before") + F.col("k")).alias("r"), "source_no", (F.col("drawn") + F.col("k")).alias("i")).hint("merge"), "r")
    return kept.unionByName(moved.select("shard", "source_no", "i"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds ``source_no`` (by code point, null last), ``weight`` and ``target`` to rows of (source, source_size).

    Targets share ``share`` times all sizes by weight. A source stops at ``most`` times
    its size and its excess goes to the others by weight: the level at which that
    settles is read off the sources in the order of their room per weight.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    out = sources.withColumn("source_no", F.row_number().over(every) - 1)
    out = out.withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("source_no") % len(weights) + 1).cast("int")))
    room = F.col("source_size") * F.lit(float(most))
    by_room = Window.orderBy(room / F.col("weight"), "source_no")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_room.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum(room).over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    out = out.withColumn("room", room).withColumn("level", level)
    settled = F.min(F.when(F.col("room") > F.col("level") * F.col("weight"), F.struct(F.col("room") / F.col("weight"), "source_no", "level"))).over(whole)
    out = out.withColumn("settled", settled["level"])
    return out.withColumn("target", F.when(F.col("settled").isNull(), F.col("room")).otherwise(
        F.least("room", F.col("settled") * F.col("weight")))).select("source", "source_no", "source_size", "n", "weight", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        block: int = 64, shard_slots: int = 1024) -> Mix:
    """Plans the mix of ``docs`` (doc_id, text, source).

    A null source is a source of its own, a null text has no words; documents without
    words are in no block and keep a row with ``taken`` 0. Repeated rows are documents
    of their own, those without a doc_id too: a document's place is hashed from its doc_id and text. An empty table gives empty results.
    One task goes over the table of sources, a row each.
    """
    sized = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", words(F.col("text")).alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("hashed")).groupBy("doc_id", "source", "size", "hashed").agg(F.count("*").alias("copies")))
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n"))
    sources = targets(totals, weights, share, most)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")).withColumn(
        "mean_draws", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    # quotas: the expected draws, rounded so that their running sum stays within one of its own
    run = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    sources = sources.withColumn("mean_upto", F.sum("mean_draws").over(run))
    point = _hashed(F.concat(F.lit("stratum"), F.floor("mean_upto").cast("string"))) / 4294967296.0
    sources = sources.withColumn("last", F.floor("mean_upto") + F.when(point < F.col("mean_upto") - F.floor("mean_upto"), 1).otherwise(0))
    first = F.coalesce(F.lag("last").over(Window.orderBy("source_no")), F.lit(0))
    sources = sources.withColumn("quota", F.least(F.col("last") - first, F.col("blocks") * int(most))).withColumn("upto", F.sum("quota").over(run))
    sources = materialise(sources.drop("last", "mean_upto").withColumn(
        "buckets", F.ceil(F.col("n") / F.greatest(F.lit(128.0), F.floor(F.sqrt(F.col("n").cast("double"))))).cast("long")))

    placed = sized.join(sources.select("source", "source_no", "source_size", "target", "buckets"), sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "source_no", "size", "source_size", "target", "hashed", "copies", (F.col("size") * F.col("copies")).alias("all"), F.pmod("hashed", "buckets").alias("bucket"))
    # where a document starts in its source: buckets before its own, then documents before it in the bucket
    bucket = ["source_no", "bucket"]
    offsets = placed.groupBy(*bucket).agg(F.sum("all").alias("in_bucket")).withColumn(
        "before", F.sum("in_bucket").over(Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_bucket"))
    within = Window.partitionBy(*bucket).orderBy("hashed", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.join(offsets.select(*bucket, "before"), bucket).withColumn("start", F.col("before") + F.sum("all").over(within) - F.col("all"))
    # rows alike in doc_id and text follow one another; a chunk at a time, as they may be very many
    placed = placed.withColumn("chunk", F.explode(F.expr(f"sequence(0L, copies - 1, {CHUNK}L)"))).withColumn(
        "copy", F.explode(F.expr(f"sequence(chunk, least(chunk + {CHUNK}, copies) - 1)")))
    placed = placed.select("doc_id", "source_no", "size", "source_size", "target", (F.col("start") + F.col("copy") * F.col("size")).alias("start"), "copy", "hashed")

    draws = _filled(sources.select("source_no", "quota", "upto"), shard_slots).join(sources.select("source_no", "blocks"), "source_no")
    order = F.xxhash64("source_no", F.expr("i div blocks"))
    draws = draws.select("shard", "source_no", _permuted(F.expr("i % blocks"), F.col("blocks"), order).alias("block"))
    return Mix(placed, draws, sources)


def parts(placed: DataFrame, block: int = 64) -> DataFrame:
    """The blocks' contents: (source_no, block, doc_id, start, words), the words of a document from word ``start`` of its source."""
    cut = placed.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {int(block)}, (start + size - 1) div {int(block)})")))
    return cut.withColumn("words", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block))


def taken(docs: DataFrame, block: int = 64, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and the words that the mix takes of it, repeats counted."""
    planned = mix(docs, block=block, **options)
    times = planned.draws.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    columns = ["doc_id", "size", "source_size", "target"]
    # draws are spread from a few rows of sources, so the planner takes them for a small side, which they are not
    found = parts(planned.docs, block).join(times.hint("merge"), ["source_no", "block"], "left").groupBy(*columns, "source_no", "start", "copy").agg(
        F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = planned.docs.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return found.select(*columns, F.col("taken").cast("long").alias("taken")).unionByName(empty)
