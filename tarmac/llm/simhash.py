"""SimHash fingerprints of three-word shingles, linked at a few differing bits.

Two 64-bit fingerprints that differ in at most three bits share at least five of
their eight bytes, position by position. The index therefore lists each fingerprint
under fourteen keys of four positional bytes: the blocks of the Steiner system
S(3, 4, 8), in which any three damaged bytes leave a whole key. Fingerprints under
one key are paired, their shared positional bytes tallied, pairs that reach five
kept, and those verified by bits. From a key's fingerprints only the links of a
spanning forest leave the task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import components, identified, materialise, pieces, utf8

SHINGLE = 3
BITS = 3
#: Fingerprints under one key that a task compares at a time; larger keys are cut into this many and paired by blocks.
BLOCK = 2048


def _blocks() -> list[int]:
    """The 14 blocks of S(3, 4, 8) as byte masks: four of eight positions that sum (XOR) to zero."""
    return [sum(1 << p for p in c) for c in itertools.combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


KEYS = _blocks()


def _mask(block: int) -> int:
    """The block's bytes as a signed 64-bit mask."""
    m = sum(0xFF << (8 * p) for p in range(8) if block >> p & 1)
    return m - (1 << 64) if m >> 63 else m


def fingerprint(text: bytes) -> int:
    """SimHash of one text's bytes: XXH64 (seed 42) of each shingle; a bit is set if it is in over half of them."""
    tally, n, words = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        words += piece.lower().split()
        grams = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in zip(words, words[1:], words[2:], strict=False)]
        if grams:
            bits = np.unpackbits(np.array(grams, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
            for k in range(0, len(bits), 8192):
                tally += bits[k:k + 8192].sum(axis=0, dtype=np.int64)
        n += len(grams)
        words = words[-(SHINGLE - 1):] if len(words) >= SHINGLE else words
    if not n:
        if not words:
            return 0
        n, h = 1, xxhash.xxh64_intdigest(b" ".join(words), 42)
        tally += np.unpackbits(np.array([h], ">u8").view(np.uint8)).astype(np.int64)
    return int.from_bytes(np.packbits(tally * 2 > n).tobytes(), "big")


_PRINTS = "doc_id long, _did long, _th long, fp long"


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, _did, _th, fp) per row: the row's identity and its fingerprint as a signed long. Null and empty texts get zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in batch.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], [c.split()[0] for c in _PRINTS.split(", ")])

    return identified(docs).select(F.col("doc_id").cast("long"), "_did", "_th", utf8(F.col("text")).alias("b")).mapInArrow(run, _PRINTS)


def _forest(left: np.ndarray, right: np.ndarray | None) -> list[tuple[int, int]]:
    """Links of a spanning forest among ``left`` (or between ``left`` and ``right``) at ``BITS`` bits or fewer."""
    nodes = left if right is None else np.concatenate([left, right])
    others, shift = (left, 0) if right is None else (right, len(left))
    label = np.arange(len(nodes))
    out = []
    for k, fp in enumerate(left):
        x = others[k + 1:] ^ fp if right is None else others ^ fp
        same = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # shared positional bytes
        near = np.flatnonzero(same >= 8 - BITS)
        near = near[np.bitwise_count(x[near]) <= BITS] + shift + (k + 1 if right is None else 0)
        for other in np.unique(label[near]):
            if other != label[k]:
                out.append((int(fp), int(nodes[near[label[near] == other][0]])))
                label[label == other] = label[k]
    return out


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v) of distinct fingerprints: enough links within ``BITS`` bits to connect all that such links connect.

    ``prints`` has distinct ``fp``. A key with more than ``block`` fingerprints is cut
    into parts, and each two parts meet in a task of their own, so no task holds more
    than two parts of a key; every pair under the key is still compared.
    """
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(b))) for b in KEYS])).alias("j", "masked"))
    sizes = keyed.groupBy("j", "masked").agg(F.count("*").alias("n")).where("n > 1").select(
        "j", "masked", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    rows = keyed.join(sizes, ["j", "masked"]).withColumn("part", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("j", "masked", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp")
    group = ["j", "masked", "a", "b"]
    # as many partitions as the session deals out to; a group is at most two parts
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                now = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(6)])
                rest = now if rest is None else np.concatenate([rest, now])
            if rest is None or not len(rest):
                continue
            starts = np.flatnonzero(np.any(rest[1:, :4] != rest[:-1, :4], axis=1)) + 1
            bounds = [0, *starts.tolist(), *([len(rest)] if batch is None else [])]
            out: list[tuple[int, int]] = []
            for s, e in zip(bounds, bounds[1:], strict=False):
                if e - s > 1:
                    fps, part = rest[s:e, 5].copy(), rest[s:e, 4]
                    out += _forest(fps, None) if rest[s, 2] == rest[s, 3] else _forest(fps[part == rest[s, 2]], fps[part == rest[s, 3]])
            rest = rest[bounds[-1]:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _grouped(prints: DataFrame) -> DataFrame:
    """(fp, component, least): each distinct fingerprint, the fingerprint that names its component, and its smallest doc_id."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(distinct.select("fp")))
    return materialise(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), "least"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach.

    Equal fingerprints are always linked; texts without words have fingerprint zero
    and are linked like any other. Repeated rows stay. A row without a doc_id is linked too; only a
    component of such rows has a null component_id. An empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs))
    grouped = _grouped(prints)
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null last), of several texts under it
    the one with the smallest hash, and of rows alike one. All columns stay."""
    prints = materialise(fingerprints(docs))
    chosen = prints.join(_grouped(prints), "fp").groupBy("component").agg(F.min(F.struct("_did", "_th")).alias("row")).select("row.*")
    rows = identified(docs).join(chosen, ["_did", "_th"])
    first = F.row_number().over(Window.partitionBy("_did", "_th").orderBy(F.lit(0)))
    return rows.withColumn("_row", first).where("_row = 1").select(docs.columns)
