"""Byte passages that occur more than once, and what is left of texts without them.

Sorting every suffix of a corpus by difference-cover names moves tens of bytes for
each byte of text at each level. Only the first 400 bytes of a suffix matter here, and
whether another suffix shares them, so the scheme is kept and its parts made lighter:

* The sample is a difference cover chosen by content: of each window's first 256
  starting points, the one whose 32-byte gram has the least hash. Two equal windows
  have it at the same place, as two suffixes have a sampled place at a common distance.
* A sampled place is named by hashes instead of ranks: ``key`` of the 145 bytes that
  every window sampled there holds, ``name`` of its context, all bytes that its windows hold.
* Names that recur settle whole ranges of suffixes. Only under keys with several
  names are the remaining suffixes, the windows beside the sampled place, merged:
  compared with each other over all 400 bytes.

Positions are byte offsets in one document, and no window reaches beyond it.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import shared_folder, utf8

WINDOW = 400
GRAM = 32
REACH = 256
#: Bytes from a sampled place on that are in every window it is the sample of.
COMMON = WINDOW - REACH + 1
#: Window starts of one text taken at a time, so that long texts need bounded memory.
SEGMENT = 1 << 21
#: Contexts under one key that a task compares; windows of larger keys are counted one by one, wherever they are.
CONTEXTS = 4096
#: The places of a name go to one task only while they are at most this part of all places under keys with several names.
PARTS = 256

_PLACE = np.uint64((1 << 23) - 1)
_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.Generator(np.random.PCG64(400))
_LETTERS = _RANDOM.integers(0, 1 << 64, (2, 256), dtype=np.uint64)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, inverse))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(1 << 16, 1 << (n - 1).bit_length()))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any slices of a text, from prefix sums: two independent ones."""

    def __init__(self, data: np.ndarray, kinds: tuple[int, ...] = (0, 1)):
        power, self.inverse = _power(len(data) + 1)
        self.sums = {k: np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS[k][data] * power[:len(data)], dtype=np.uint64)]) for k in kinds}

    def of(self, kind: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[kind][end] - self.sums[kind][start]) * self.inverse[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n = len(values)
    blocks = np.concatenate([values, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def sampled(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, name, lo, hi): the sampled places of a text, each with the window starts ``lo`` .. ``hi`` that it stands for."""
    found = []
    data = np.frombuffer(text, np.uint8)
    windows = len(data) - WINDOW + 1
    for at in range(0, max(0, windows), SEGMENT):
        part = data[at:at + SEGMENT + WINDOW - 1]
        n = len(part) - WINDOW + 1
        hashes = Hashes(part)
        starts = np.arange(n + REACH - 1)
        grams = (hashes.of(0, starts, starts + GRAM) & ~_PLACE) | starts.astype(np.uint64)
        place = (_least(grams, REACH) & _PLACE).astype(np.int64)
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        lo, hi = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [n - 1]])
        place = place[lo]
        key = hashes.of(0, place, place + COMMON)
        name = _mixed(hashes.of(1, lo, hi + WINDOW) + (place - lo).astype(np.uint64) * np.uint64(512) + (hi - lo).astype(np.uint64))
        found.append((key.view(np.int64), name.view(np.int64), lo + at, hi + at))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else tuple(np.empty(0, np.int64) for _ in range(4))


def _joined(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ranges with those that touch made one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    return lo[new], hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])]


_PLACES = "did long, th long, key long, name long, lo long, hi long, weight int"


def places(docs: DataFrame) -> DataFrame:
    """A row per sampled place of ``docs`` (did, th, b). Of places that recur inside a document one is kept, with
    their number as its weight; the ranges of the others are rows without a key, settled already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut, out = 0, []
            for row, text in enumerate(batch.column(2)):
                if text.as_buffer().size < WINDOW:
                    continue
                key, name, lo, hi = sampled(text.as_buffer().to_pybytes())
                _, first, inverse, weight = np.unique(name ^ key, return_index=True, return_inverse=True, return_counts=True)
                again = np.ones(len(key), bool)
                again[first] = False
                more_lo, more_hi = _joined(lo[again], hi[again])
                rows = len(first) + len(more_lo)
                pad = np.zeros(len(more_lo), np.int64)
                out.append((
                    np.full(rows, row), np.concatenate([key[first], pad]), np.concatenate([np.zeros(len(first), bool), np.ones(len(more_lo), bool)]),
                    np.concatenate([name[first], pad]), np.concatenate([lo[first], more_lo]), np.concatenate([hi[first], more_hi]), np.concatenate([weight, pad])))
                cut += rows
                if cut > 50_000:
                    yield packed(batch, out)
                    cut, out = 0, []
            if out:
                yield packed(batch, out)

    def packed(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        row, key, none, name, lo, hi, weight = (np.concatenate(c) for c in zip(*out, strict=True))
        picked = batch.select([0, 1]).take(pa.array(row))
        return pa.RecordBatch.from_arrays(
            [*picked.columns, pa.array(key, pa.int64(), mask=none), pa.array(name), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(weight, pa.int32())],
            [c.split()[0] for c in _PLACES.split(", ")])

    return docs.select("did", "th", "b").mapInArrow(run, _PLACES)


_SLICES = "did long, th long, sub long, other long, lo long, n int, weight int, context binary"


def slices(texts: DataFrame) -> DataFrame:
    """Contexts of the places listed beside each text (did, th, b, places). Where the key is crowded, a row per window
    with its two hashes instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SLICES.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
        for batch in batches:
            rows: list[tuple] = []
            for row, (text, wanted) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), strict=True)):
                data = text.as_buffer().to_pybytes()
                for p in wanted:
                    lo, hi = p["lo"], p["hi"]
                    context = data[lo:hi + WINDOW]
                    if p["crowded"]:
                        at = np.arange(hi - lo + 1)
                        hashes = Hashes(np.frombuffer(context, np.uint8))
                        one, two = (hashes.of(k, at, at + WINDOW).view(np.int64).tolist() for k in (0, 1))
                        rows += [(row, a, b, lo + k, 1, p["weight"], b"") for k, (a, b) in enumerate(zip(one, two, strict=True))]
                    else:
                        rows.append((row, p["key"], 0, lo, hi - lo + 1, p["weight"], context))
                if len(rows) > 20_000:
                    yield packed(batch, rows, names, kinds)
                    rows = []
            if rows:
                yield packed(batch, rows, names, kinds)

    def packed(batch, rows, names, kinds) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        picked = batch.select([0, 1]).take(pa.array(columns[0]))
        return pa.RecordBatch.from_arrays([*picked.columns, *[pa.array(c, k) for c, k in zip(columns[1:], kinds[2:], strict=True)]], names)

    return texts.select("did", "th", "b", "places").mapInArrow(run, _SLICES)


_RANGES = "did long, th long, lo long, hi long"


def _compared(group: pa.Table) -> pa.RecordBatch | None:
    """Ranges of the windows that occur more than once among the contexts of whole groups."""
    weight = group.column("weight").to_numpy()
    if not (weight == 1).any():
        return None
    contexts = group.column("context").to_pylist()
    data = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(c) for c in contexts])[:-1]]).astype(np.int64)
    n = group.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = starts[row] + step
    hashes = Hashes(data)
    both = hashes.of(0, at, at + WINDOW) ^ _mixed(hashes.of(1, at, at + WINDOW) + group.column("sub").to_numpy().view(np.uint64)[row])
    _, inverse = np.unique(both, return_inverse=True)
    again = (np.bincount(inverse, weights=weight[row])[inverse] >= 2) & (weight[row] == 1)
    if not again.any():
        return None
    row, step = row[again], step[again]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(row) - 1]])
    lo = group.column("lo").to_numpy()[row]
    picked = group.select(["did", "th"]).take(pa.array(row[first])).combine_chunks()
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in picked.columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array((lo + step)[first]), pa.array((lo + step)[last])], ["did", "th", "lo", "hi"])


def compared(contexts: DataFrame) -> DataFrame:
    """(did, th, lo, hi): windows of ``contexts`` that another context under their key holds too."""
    dealt = contexts.repartition("sub").sortWithinPartitions("sub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # whole groups only: what shares the last key waits for the next batch
            sub = batch.column(2).to_numpy()
            cut = int(np.searchsorted(sub, sub[-1])) if len(sub) else 0
            if not cut and held and len(sub) and held[-1].column(2)[-1].as_py() != sub[0]:
                yield from filter(None, [_compared(pa.Table.from_batches(held))])
                held = []
            if cut:
                held.append(batch.slice(0, cut))
                yield from filter(None, [_compared(pa.Table.from_batches(held))])
                held = []
            if len(sub):
                held.append(batch.slice(cut))
        if held:
            yield from filter(None, [_compared(pa.Table.from_batches(held))])

    return dealt.mapInArrow(run, _RANGES)


def _stored(df: DataFrame) -> DataFrame:
    """Like ``materialise``, with contexts that overlap compressed well."""
    path = f"{shared_folder(df.sparkSession)}/tarmac-tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crowds(names: DataFrame) -> DataFrame:
    """``names`` (key, name, ...) and whether their key is ``crowded``. Crowded keys, one for ``CONTEXTS`` names at most, are broadcast."""
    crowded = names.groupBy("key").count().where(F.col("count") > CONTEXTS).select("key", F.lit(True).alias("crowded"))
    return names.join(F.broadcast(crowded), "key", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))


def recurring(several: DataFrame, names: DataFrame) -> DataFrame:
    """(did, th, lo, hi): the places of ``several`` whose key and name occur more than once, as ``names`` (key, name, all, rows) tells.

    Names with over one of ``PARTS`` of the rows, fewer than that by construction, are broadcast and their places stay where they are.
    """
    often = names.where("all > 1").withColumn("frequent", F.col("rows") * PARTS > names.agg(F.sum("rows")).scalar())
    on = ["key", "name"]
    frequent = F.broadcast(often.where("frequent").select(on))
    rest = several.join(frequent, on, "left_anti").join(often.where("not frequent").select(on), on)
    return several.join(frequent, on).unionByName(rest).select("did", "th", "lo", "hi")


def repeated(docs: DataFrame) -> DataFrame:
    """(did, th, lo, hi): ranges of the window starts in ``docs`` (did, th, b) whose 400 bytes also start elsewhere."""
    sample = _stored(places(docs))
    keys = sample.where("key is not null").groupBy("key").agg(
        F.sum("weight").alias("all"), F.min("name").alias("a"), F.max("name").alias("b")).where(F.col("all") > 1).select("key", (F.col("a") != F.col("b")).alias("several"))
    shared = _stored(sample.join(keys, "key").select("did", "th", "key", "name", "lo", "hi", "weight", "several"))
    # under keys with several names: each name once, as one document has it, and whether it recurs
    several = shared.where("several")
    names = _stored(several.groupBy("key", "name").agg(
        F.sum("weight").alias("all"), F.count("*").alias("rows"), F.min(F.struct("did", "th", "lo", "hi")).alias("at")))
    wanted = crowds(names).select(
        "at.*", F.struct("key", F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"), F.least("all", F.lit(2)).cast("int").alias("weight"), "crowded").alias("place"))
    listed = wanted.groupBy("did", "th").agg(F.collect_list("place").alias("places"))
    cut = _stored(slices(docs.join(listed, ["did", "th"])))
    near = compared(cut.where("other = 0 and n > 0 and length(context) > 0"))
    windows = cut.where("length(context) = 0")
    often = windows.groupBy("sub", "other").agg(F.sum("weight").alias("all")).where(F.col("all") > 1).select("sub", "other")
    single = windows.where("weight = 1").join(often, ["sub", "other"]).select("did", "th", "lo", F.col("lo").alias("hi"))
    found = ["did", "th", "lo", "hi"]
    return (sample.where("key is null").select(found).unionByName(sample.where("key is not null and weight > 1").select(found))
            .unionByName(shared.where("not several").select(found))
            .unionByName(recurring(several, names))
            .unionByName(near).unionByName(single))


def _kept(text: bytes, ranges: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    lo, hi = np.array([r["lo"] for r in ranges], np.int64), np.array([r["hi"] for r in ranges], np.int64)
    starts, ends = _joined(lo, hi + WINDOW - 1)
    removed, at, kept = 0, 0, []
    for s, e in zip(starts.tolist(), (ends + 1).tolist(), strict=True):
        kept.append(text[at:s])
        removed += e - s
        at = e
    return removed, len(starts), b"".join([*kept, text[at:]])


def without_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and (``keep_text``) the bytes kept.

    Each byte goes that some 400-byte string covers which also starts elsewhere, in this
    document or another; overlapping occurrences count. Null texts are empty; texts shorter
    than 400 bytes lose nothing. Repeated rows are documents of their own, so each
    covers the other. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("b"))
    texts = texts.select("doc_id", "b", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"), F.xxhash64("b").alias("th"))
    ranges = repeated(texts).groupBy("did", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                removed, spans, kept = _kept(data, found or [])
                rows.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns[:5 if keep_text else 4]], [c.split()[0] for c in schema.split(", ")])

    return texts.join(ranges, ["did", "th"], "left").select("doc_id", "b", "ranges").mapInArrow(run, schema)
