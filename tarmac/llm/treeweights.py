"""Scores texts by context-tree weighting over bytes.

A byte is eight binary choices, each named by the bits before it. For each choice there
is a tree of contexts: the bytes before, up to five. A node of it has the
Krichevsky-Trofimov estimate of the bits counted there, and its weighted probability is
half its own estimate and half the product of its children's. The counts come from the
learning texts; with them fixed, a bit's probability is the estimates of all depths,
each weighted by what its node's estimate is worth against its children.

Texts are read as lower-cased (A-Z) UTF-8 with an end mark. They are cut into pieces and
the pieces gathered into chunks of bounded size. A chunk asks for each six-byte window it
holds once: its windows are dealt to buckets by the two bytes before the last, packed,
and answered by bucket with each window's logarithm. So distinct windows per chunk are
shuffled instead of positions. The longest contexts are worked out inside their bucket;
the depths above are DataFrames of nodes, one per depth: sums go up from children to
parents, weights come down. The words of the base are counted and answered the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, pieces, utf8

#: Bytes of the longest context.
DEPTH = 5
#: Ends a text and stands before its first byte; not part of any UTF-8 text.
EDGE = b"\xff"
#: Bytes of the texts of one chunk, and of one stored block of it, about.
CHUNK_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
#: Windows that a task keeps apart, beyond those it has added up, before it adds up equal ones.
KEPT = 1 << 18
#: Bytes of texts whose words a task looks up at a time.
LOOKED_UP = 2 << 20
#: Buckets of windows, as a number of bits; buckets of words, numbered on from there; and chunks that one task adds up or answers for a bucket.
BUCKET_BITS = 10
WORD_BUCKETS = 256
ANSWERED = 1024
#: The word that ends each text among the base's tokens; no word is empty.
END = b""

_BLOCKS = "chunk long, row array<long>, doc_id array<long>, learn array<boolean>, last array<boolean>, before array<binary>, size array<long>, packed binary"
_BLOCK_KINDS = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary())


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed differences, byte by byte of their width."""
    steps = np.diff(numbers.astype(np.int64), prepend=0)
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def blocks(docs: DataFrame, learn: Column, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Lower-cased pieces of the texts, cut between words, compressed a block at a time, with the bytes before each piece.

    A chunk is consecutive pieces of one task up to ``chunk_bytes``. A null text is empty. A word is never cut.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, filled, held, out = TaskContext.get().partitionId() << 24, 0, 0, []

        def passed() -> pa.RecordBatch:
            *lists, bodies = (list(c) for c in zip(*out, strict=True))
            values = [chunk, *lists, [len(b) for b in bodies], zstandard.compress(b"".join(bodies), 3)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _BLOCK_KINDS, strict=True)], _names(_BLOCKS))

        for batch in batches:
            ids = [batch.column(k).to_pylist() for k in range(3)]
            for row, doc_id, learnt, text in zip(*ids, batch.column(3), strict=True):
                before, cuts = EDGE * depth, list(pieces(text.as_buffer().to_pybytes().lower()))
                for k, piece in enumerate(cuts):
                    out.append((row, doc_id, learnt, k == len(cuts) - 1, before, piece))
                    before = (before + piece)[-depth:]
                    filled, held = filled + len(piece), held + len(piece)
                    if held >= min(BLOCK_BYTES, chunk_bytes):
                        yield passed()
                        out, held = [], 0
                        if filled >= chunk_bytes:
                            chunk, filled = chunk + 1, 0
        if out:
            yield passed()

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), learn.alias("learn"), utf8(F.col("text")).alias("b"))
    return read.mapInArrow(run, _BLOCKS)


def _pieces_of(block: dict) -> list[bytes]:
    data, ends = zstandard.decompress(block["packed"]), np.cumsum(block["size"]).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _ended(bodies: list[bytes], last: list[bool]) -> list[bytes]:
    return [b + EDGE if end else b for b, end in zip(bodies, last, strict=True)]


def windows(befores: list[bytes], bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ends): for each byte of each body, itself and the ``depth`` bytes before it as one number; and where each body's codes end."""
    data = np.frombuffer(b"".join(x for pair in zip(befores, bodies, strict=True) for x in pair), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    ends = np.cumsum(sizes)
    starts = np.cumsum(sizes + depth) - sizes  # the first byte of each body
    inside = np.ones(len(data), bool)
    inside[(starts[:, None] - 1 - np.arange(depth)).ravel()] = False
    codes = np.zeros(max(0, len(data) - depth), np.int64)
    for k in range(depth + 1):
        codes <<= 8
        codes |= data[k:len(data) - depth + k]
    return codes[inside[depth:]], ends


def _bucket(context, depth: int):
    """The bucket of a context, as an array or a column: by its last two bytes, or all that the parents of the deepest nodes have."""
    mask, down = (1 << 8 * min(2, depth - 1)) - 1, 16 - BUCKET_BITS
    if isinstance(context, Column):
        return F.shiftright((context.bitwiseAND(F.lit(mask)) * 40503).bitwiseAND(F.lit(65535)), down).cast("int")
    return (((context & mask) * 40503 & 65535) >> down).astype(np.int32)


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def words_of(bodies: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """(words, numbers): the words of all bodies in order, runs of bytes other than ASCII whitespace, and how many each body has."""
    data = b" ".join([*bodies, b""])
    space = np.concatenate([[True], _SPACE[np.frombuffer(data, np.uint8)]])
    edges = np.flatnonzero(space[1:] != space[:-1])  # a word's start, its end, the next one's start
    if not len(edges):
        return pa.array([], pa.binary()), np.zeros(len(bodies), np.int64)
    runs = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])
    ends = np.cumsum([len(b) + 1 for b in bodies])
    return runs.take(pa.array(np.arange(0, len(edges), 2))), np.diff(np.searchsorted(edges[::2], ends), prepend=0)


def _added(parts: list[tuple]) -> tuple:
    """Equal windows, or equal words, with the sum of their numbers."""
    if isinstance(parts[0][0], np.ndarray):
        codes = np.concatenate([p[0] for p in parts])
        order = np.argsort(codes)
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        return codes[first], np.add.reduceat(np.concatenate([p[1] for p in parts])[order], first) if len(first) else codes
    coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    at, found = coded.indices.to_numpy(), coded.dictionary
    return found, np.bincount(at, np.concatenate([p[1] for p in parts]), len(found)).astype(np.int64)


class _Sums(list):
    """Counted parts, added up whenever those that came since outgrow what there was."""

    def __init__(self):
        super().__init__()
        self.known = 0

    def take(self, part: tuple) -> None:
        self.append(part)
        if sum(len(p[0]) for p in self) > 1.5 * self.known + KEPT:
            self[:] = [_added(self)]
            self.known = len(self[0][0])

    def whole(self) -> tuple:
        out = _added(self)
        self.clear()
        self.known = 0
        return out


def _counted(codes: np.ndarray, learnt: bool) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.diff(first, append=len(codes)) * learnt


def _written(words: pa.BinaryArray) -> bytes:
    return zstandard.compress(b"\n".join(words.to_pylist()), 1)


def _read(data: bytes) -> pa.BinaryArray:
    return pa.array(zstandard.decompress(data).split(b"\n"), pa.binary())


_ASKED = "chunk long, bucket int, ids binary, counts binary"


def asked(cut: DataFrame, depth: int = DEPTH) -> DataFrame:
    """What each chunk holds, a row per bucket: packed windows, or written words, and their numbers in learning texts (maybe 0).

    A chunk that a scan cuts in two gives two rows of a bucket, which does no harm.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held, words = _Sums(), _Sums()

        def dealt(bucket: np.ndarray, order: np.ndarray, ids, n: np.ndarray, write) -> pa.RecordBatch:
            bucket = bucket[order]
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            spans = [order[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * len(spans), pa.int64()), pa.array(bucket[edges[:-1]], pa.int32()),
                 pa.array([write(ids, s) for s in spans], pa.binary()), pa.array([packed(n[s]) for s in spans], pa.binary())], _names(_ASKED))

        def passed() -> Iterator[pa.RecordBatch]:
            if held:
                found, n = held.whole()
                bucket = _bucket(found >> 8, depth)
                yield dealt(bucket, np.lexsort((found, bucket)), found, n, lambda ids, s: packed(ids[s]))
                found, n = words.whole()
                bucket = np.array([xxhash.xxh64_intdigest(w) % WORD_BUCKETS for w in found.to_pylist()]) + (1 << BUCKET_BITS)
                yield dealt(bucket, np.argsort(bucket, kind="stable"), found, n, lambda ids, s: _written(ids.take(pa.array(s))))

        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                if block["chunk"] != now:
                    yield from passed()
                    now = block["chunk"]
                bodies, learn = _pieces_of(block), np.array(block["learn"])
                codes, ends = windows(block["before"], _ended(bodies, block["last"]), depth)
                known = np.repeat(learn, np.diff(ends, prepend=0))
                held.take(_counted(codes[known], True))
                held.take(_counted(codes[~known], False))
                found, numbers = words_of(bodies)
                words.take(_added([(found, np.repeat(learn, numbers))]))
                words.take((pa.array([END], pa.binary()), np.array([int((learn & np.array(block["last"])).sum())])))
        yield from passed()

    return cut.mapInArrow(run, _ASKED)


def _group(bucket: int, ids: list[bytes], counts: list[bytes]) -> tuple:
    """The windows or words of some rows of a bucket, added up; windows rise."""
    read = unpacked if bucket < 1 << BUCKET_BITS else _read
    found, n = _added([(read(i), unpacked(c)) for i, c in zip(ids, counts, strict=True)])
    if bucket < 1 << BUCKET_BITS:
        order = np.argsort(found)
        return found[order], n[order]
    return found, n


def counts(held: DataFrame, chunks: int) -> DataFrame:
    """(bucket, ids, counts), a row per bucket: what ``asked`` gives, added up over all chunks, ``ANSWERED`` rows in a task at a time."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        found, n = _group(bucket, rows["ids"].to_pylist(), rows["counts"].to_pylist())
        ids = packed(found) if bucket < 1 << BUCKET_BITS else _written(found)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "ids": pa.array([ids], pa.binary()), "counts": pa.array([packed(n)], pa.binary())})

    rows, parts = held.select("bucket", F.xxhash64("chunk").alias("part"), "ids", "counts"), max(1, chunks)
    while True:
        parts = -(-parts // ANSWERED)
        rows = rows.withColumn("part", F.pmod("part", F.lit(parts))).groupBy("bucket", "part").applyInArrow(run, "bucket int, part long, ids binary, counts binary")
        if parts == 1:
            return rows.drop("part")


#: Stirling's series of ln of the gamma function, by falling powers of the squared inverse.
_SERIES = np.poly1d([1 / 1188, -1 / 1680, 1 / 1260, -1 / 360, 1 / 12])


def log_gamma(z: np.ndarray) -> np.ndarray:
    """ln of the gamma function for z >= 1/2: Stirling's series eight places further, and the steps back."""
    far = z + 8
    r = 1 / far
    return (far - 0.5) * np.log(far) - far + 0.5 * math.log(2 * math.pi) + _SERIES(r * r) * r - np.log(
        z * (z + 1) * (z + 2) * (z + 3) * (z + 4) * (z + 5) * (z + 6) * (z + 7))


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones in any one order."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def _leaves(found: np.ndarray, n: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each bit of a byte: (parent, zeros, ones) of the deepest nodes, which node each window is in, and its bit.

    ``found`` rises, so windows that share a context and first bits stand together. ``parent`` is the context
    without its oldest byte, and the name of the choice in the last eight bits.
    """
    for k in range(8):
        first = np.flatnonzero(np.diff(found >> (8 - k), prepend=-1))
        bit = found >> (7 - k) & 1
        ones = np.add.reduceat(n * bit, first)
        zeros = np.add.reduceat(n, first) - ones
        name = (found[first] & 255 | 256) >> (8 - k)
        parent = (found[first] >> 8 & (1 << 8 * (depth - 1)) - 1) << 8 | name
        node = np.cumsum(np.bincount(first, minlength=len(found))) - 1
        yield parent, zeros, ones, node, bit


_NODES = "ctx long, p int, zeros long, ones long, below double, own double"


def parents(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The nodes one above the deepest, with the sums over their children. A bucket holds all children of its nodes, and at
    most so many windows as two further bytes of context and the byte itself can make for its last two bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, n in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                parts = [(key, zeros, ones, estimate(zeros, ones)) for key, zeros, ones, _, _ in _leaves(unpacked(ids), unpacked(n), depth)]
                key, zeros, ones, own = (np.concatenate(x) for x in zip(*parts, strict=True))
                node, at = np.unique(key, return_inverse=True)
                sums = [np.bincount(at, x, len(node)) for x in (zeros, ones, own)]
                yield pa.RecordBatch.from_arrays([pa.array(node >> 8), pa.array((node & 255).astype(np.int32)), *[pa.array(x.astype(np.int64)) for x in sums[:2]], pa.array(sums[2]), pa.array(estimate(*sums[:2]))], _names(_NODES))

    return counted.where(F.col("bucket") < 1 << BUCKET_BITS).select("ids", "counts").mapInArrow(run, _NODES)


def tree(lowest: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The nodes of each depth but the deepest, root first: (ctx, p, zeros, ones, below, own). ``below`` is the sum of the
    children's log weighted probabilities, ``own`` the node's estimate. A node has at most 256 children."""
    @F.pandas_udf("double")
    def estimated(zeros: pd.Series, ones: pd.Series) -> pd.Series:
        return pd.Series(estimate(zeros.to_numpy(np.float64), ones.to_numpy(np.float64)))

    levels: list[DataFrame] = []
    nodes = lowest
    for d in range(depth - 2, -2, -1):
        levels.insert(0, materialise(nodes))
        own, below = F.col("own"), F.col("below")
        weighted = F.greatest(own, below) + F.log1p(F.exp(-F.abs(own - below))) - math.log(2)
        up = levels[0].select(F.col("ctx").bitwiseAND(F.lit((1 << 8 * max(0, d)) - 1)).alias("ctx"), "p", "zeros", "ones", weighted.alias("w"))
        nodes = up.groupBy("ctx", "p").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("w").alias("below")).withColumn("own", estimated("zeros", "ones"))
    return levels


def chances(levels: list[DataFrame]) -> DataFrame:
    """(ctx, p, added, left) of the lowest of ``levels``: what the depths so far give the probability of a one, and the weight left to the children.

    From the root down a node takes over what its parent has added; the weight of its own
    estimate is what that is worth against its children's.
    """
    ahead = None
    for d, nodes in enumerate(levels):
        here = nodes.select("ctx", "p", ((F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)).alias("kt"), (1 / (1 + F.exp(F.col("below") - F.col("own")))).alias("share"))
        if ahead is None:
            here = here.withColumns({"added": F.lit(0.0), "left": F.lit(1.0)})
        else:
            parent = F.col("ctx").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1))
            here = here.withColumn("parent", parent).join(ahead.withColumnRenamed("ctx", "parent"), ["parent", "p"]).drop("parent")
        added = F.col("added") + F.col("left") * F.col("share") * F.col("kt")
        ahead = here.select("ctx", "p", added.alias("added"), (F.col("left") * (1 - F.col("share"))).alias("left"))
    return ahead


def _logs(found: np.ndarray, n: np.ndarray, upper: pa.Table, depth: int) -> np.ndarray:
    """log10 of the probability of each window's last byte, in one bucket; ``upper`` has the parents of its deepest nodes."""
    key = upper["ctx"].to_numpy() << 8 | upper["p"].to_numpy().astype(np.int64)
    order = np.argsort(key)
    key, added, left = key[order], upper["added"].to_numpy()[order], upper["left"].to_numpy()[order]
    total = np.zeros(len(found))
    for parent, zeros, ones, node, bit in _leaves(found, n, depth):
        at = np.searchsorted(key, parent)
        one = added[at] + left[at] * (ones + 0.5) / (zeros + ones + 1.0)
        total += np.log10(np.where(bit == 1, one[node], 1 - one[node]))
    return total


def answers(held: DataFrame, counted: DataFrame, chunks: int, depth: int = DEPTH) -> DataFrame:
    """(chunk, bucket, ids, values): for the rows of ``asked`` log10 of the probability of each window's last byte after the bytes
    before, or each word's number in all learning texts."""
    upper = chances(tree(parents(counted, depth), depth)).select(_bucket(F.col("ctx"), depth).alias("bucket"), "ctx", "p", "added", "left")
    known = counted.unionByName(upper, allowMissingColumns=True)
    salts = max(1, -(-chunks // ANSWERED))  # a bucket's chunks are answered in so many tasks
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    wanted = held.select("bucket", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt"), "chunk", "ids")

    def run(key: tuple, model: pa.Table, rows: pa.Table) -> pa.Table:
        bucket, one = key[0].as_py(), model.filter(model["ids"].is_valid()).to_pylist()[0]
        if bucket < 1 << BUCKET_BITS:
            found, n = unpacked(one["ids"]), unpacked(one["counts"])
            logs = _logs(found, n, model.filter(model["p"].is_valid()), depth)
            values = [logs[np.searchsorted(found, unpacked(i))].tobytes() for i in rows["ids"].to_pylist()]
        else:
            found, n = _read(one["ids"]), unpacked(one["counts"])
            values = [packed(n[pc.index_in(_read(i), value_set=found).to_numpy()]) for i in rows["ids"].to_pylist()]
        return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "ids": rows["ids"], "values": pa.array(values, pa.binary())})

    return known.groupBy("bucket", "salt").cogroup(wanted.groupBy("bucket", "salt")).applyInArrow(run, "chunk long, bucket int, ids binary, values binary")


_SCORED = "row long, doc_id long, learn boolean, bytes long, n_tokens long, n_known long, base_score double, score double"
_SCORED_KINDS = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())


def _chunk_scores(total: int, kinds: int, depth: int):
    """Scores the pieces of a chunk with the logarithms of its windows and the counts of its words."""
    rest = math.log10(total + kinds + 1)

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        bucket = known["bucket"].to_numpy()
        some = known.filter(pa.array(bucket < 1 << BUCKET_BITS))
        codes = np.concatenate([np.empty(0, np.int64), *map(unpacked, some["ids"].to_pylist())])
        values = np.frombuffer(b"".join(some["values"].to_pylist()), np.float64)
        codes, first = np.unique(codes, return_index=True)
        index, values = pd.Index(codes), values[first]
        some = known.filter(pa.array(bucket >= 1 << BUCKET_BITS))
        names = pa.concat_arrays([pa.array([], pa.binary()), *map(_read, some["ids"].to_pylist())])
        n = np.concatenate([np.empty(0, np.int64), *map(unpacked, some["values"].to_pylist())])
        logs, end = np.log10(n + 1.0) - rest, pc.index(names, END).as_py()
        out: list[pa.Table] = []
        waiting: list[dict] = []

        def scored() -> None:
            bodies = [b for block in waiting for b in block["bodies"]]
            words, numbers = words_of(bodies)
            at = pc.index_in(words, value_set=names).to_numpy(zero_copy_only=False)
            ends = np.cumsum(numbers)
            base, seen = (np.concatenate([[0], np.cumsum(x[at])])[np.concatenate([[0], ends])] for x in (logs, n > 0))
            last = np.array([x for block in waiting for x in block["last"]], bool)
            columns = [
                *[pa.array([x for block in waiting for x in block[c]], k) for c, k in (("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()))],
                pa.array([len(b) for b in bodies], pa.int64()), pa.array(numbers + last, pa.int64()), pa.array(np.diff(seen) + last * (n[end] > 0), pa.int64()),
                pa.array(np.diff(base) + last * logs[end]), pa.array(np.concatenate([block["score"] for block in waiting]))]
            out.append(pa.table(columns, names=_names(_SCORED)))
            waiting.clear()

        for k in range(texts.num_rows):
            block = texts.slice(k, 1).to_pylist()[0]
            bodies = _pieces_of(block)
            found, ends = windows(block["before"], _ended(bodies, block["last"]), depth)
            sums = np.concatenate([[0.0], np.cumsum(values[index.get_indexer(found)])])
            waiting.append({**block, "bodies": bodies, "score": np.diff(sums[np.concatenate([[0], ends])])})
            if sum(sum(b["size"]) for b in waiting) >= LOOKED_UP:
                scored()
        if waiting:
            scored()
        del index, values, names, logs
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out) if out else pa.table([pa.array([], k) for k in _SCORED_KINDS], names=_names(_SCORED))

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words the learning texts have, and how many different ones, by bucket."""
    for batch in batches:
        n = [unpacked(x) for x in batch.column("counts").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n], pa.int64()), pa.array([int((x > 0).sum()) for x in n], pa.int64())], ["total", "kinds"])


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, learn, bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row of ``docs`` (doc_id, text).

    The trees, and the counts of the base, are learnt from the rows where ``learn`` is true; null counts as false.
    ``score`` is log10 of the model's probability of the whole text and its end, ``bits_per_byte`` its code length
    shared over the bytes and the end. ``base_score`` is the same of single words with add-one counts. A null text counts as
    empty, which has only an end; repeated rows stay; without learning rows every bit has probability one half.
    An empty table gives an empty result.
    """
    if not 1 <= depth <= 6:
        raise ValueError("a window of depth + 1 bytes has to fit a long")
    cut = materialise(blocks(docs, F.coalesce(learn, F.lit(False)), depth, chunk_bytes))
    held = materialise(asked(cut, depth))
    chunks = held.select("chunk").distinct().count()
    counted = materialise(counts(held, chunks))
    one = counted.where(F.col("bucket") >= 1 << BUCKET_BITS).mapInArrow(_totals, "total long, kinds long").agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    parts = cut.groupBy("chunk").cogroup(answers(held, counted, chunks, depth).groupBy("chunk")).applyInArrow(_chunk_scores(*one, depth), _SCORED)
    summed = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("learn").alias("learn"), *[F.sum(c).alias(c) for c in ("bytes", "n_tokens", "n_known", "base_score", "score")])
    bits = -F.col("score") * math.log2(10) / (F.col("bytes") + 1)
    return summed.select("doc_id", "learn", "bytes", "n_tokens", "n_known", F.lit(one[0]).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))
