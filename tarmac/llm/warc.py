"""WARC archives written and read by Spark, and their merged capture index.

Records are text up to the two line ends that close them, so Spark's text writer with
those as line separator writes whole archives in parallel to any file system that
Spark reaches. Reading takes the files as bytes and follows Content-Length. Each
archive yields a run of index entries sorted by URL key and time; runs are dealt to
ranges of the key and merged there by a loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, shared_folder

LINE = "\r\n"
#: Captures have no time of their own; page_id counts seconds from here.
EPOCH = 1_577_836_800
RECORDS_PER_FILE = 1000


def url_key(url: Column) -> Column:
    """The sort key of a URL: host labels reversed and comma-joined, ``)``, then the path and query; lower-cased. Null gives an empty key."""
    plain = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", ""))
    host = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*", 0), r":[0-9]+$|^www\.", "")
    rest = F.regexp_extract(plain, r"^[^/?]*(.*)$", 1)
    return F.when(plain == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(sha: Column) -> Column:
    """A SHA-1 in hex as upper-case base32: ten hex digits are 40 bits, eight symbols."""
    groups = [F.conv(F.substring(sha, 10 * k + 1, 10), 16, 10).cast("long") for k in range(4)]
    symbols = [F.substring(F.lit(_SYMBOLS), (F.shiftright(g, 35 - 5 * j).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for g in groups for j in range(8)]
    return F.concat(*symbols)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record per row of ``pages`` (page_id, url, html): the text up to its closing line ends.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the
    largest page_id carries the payload; the others are revisits of it. A null html is
    an empty payload, a null url an empty target; repeated rows of one page_id are
    all responses if theirs is the largest.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "sha": F.sha1(F.col("payload").cast("binary"))})
    last = rows.where(F.col("bytes") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("first"))
    rows = rows.join(last, "sha", "left").withColumn("digest", base32(F.col("sha")))
    revisit = F.col("page_id") < F.col("first")
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = lambda n: F.concat(F.lit("<urn:page:"), n.cast("string"), F.lit(">"))
    target = F.regexp_replace("url", r"[\r\n]", " ")
    block = F.when(revisit, "").otherwise(F.col("payload"))
    head = F.concat_ws(
        LINE, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(name(F.col("page_id")), F.lit("<urn:page:>"))), F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Target-URI: "), target), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("Payload-Length: "), F.col("bytes").cast("string"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return rows.select(F.concat(head, F.lit(LINE * 2), block).alias("value"))


def write(pages: DataFrame, folder: str, per_file: int = RECORDS_PER_FILE, least_bytes: int = 0) -> None:
    """Gzipped archives of at most ``per_file`` records in ``folder``, written where the partitions are."""
    records(pages, least_bytes).write.option("lineSep", LINE * 2).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(header fields, block, offset, length) of each record; a broken record raises ValueError."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].decode("utf-8").split(LINE)[1:]:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, data[start:stop], at, stop - at
        at = stop + 4


_READ = ("page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string,"
         " url string, captured string, file string, offset long, length long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives in ``folder``. Digests and lengths of responses are taken from the payload read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(text: str | None) -> int | None:
            digits = (text or "")[len("<urn:page:"):-1]
            return int(digits) if digits else None

        names = [f.split()[0] for f in _READ.split(",")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for path, packed in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for fields, block, offset, length in parse(gzip.decompress(packed.as_buffer())):
                    revisit = fields["warc-type"] == "revisit"
                    rows.append((
                        number(fields["warc-record-id"]), fields["warc-type"], number(fields.get("warc-refers-to")),
                        int(fields["payload-length"]) if revisit else len(block),
                        fields["warc-payload-digest"].removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(block).digest()).decode(),
                        fields["warc-target-uri"], fields["warc-date"], path.as_py().rpartition("/")[2], offset, length))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInArrow(run, _READ)


class LoserTree:
    """Merges sorted runs: each step replays one leaf's path, about log2(k) comparisons."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._replay(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node > 0:
            if self.losers[node] < 0 and building:
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.losers[0]] is not None:
            leaf = self.losers[0]
            yield self.heads[leaf]
            self.heads[leaf] = next(self.runs[leaf], None)
            self._replay(leaf)


def merged_index(captures: DataFrame) -> DataFrame:
    """``captures`` in global order of (url_key, captured, page_id): ``range_no`` and ``place`` within the range give it.

    Each archive's entries are a sorted run. Entries are dealt to ranges of the whole
    key, so one URL with very many captures is cut as well; inside a range the runs,
    still in their order, are merged.
    """
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    order = ["url_key", "captured", "page_id"]
    ranges = keyed.repartitionByRange(*order)
    # a run's entries come sorted; runs stay apart, for the tree to merge
    runs = ranges.withColumn("range_no", F.spark_partition_id()).sortWithinPartitions("file", *order, "offset")
    schema = runs.schema
    columns = schema.names
    spots = [columns.index(c) for c in (*order, "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        key, when, page, offset = (rows.column(s).to_pylist() for s in spots)
        files = rows.column(columns.index("file")).to_pylist()
        starts = [k for k in range(len(files)) if k == 0 or files[k] != files[k - 1]]
        tree = LoserTree([
            ((key[k], when[k], -1 if page[k] is None else page[k], offset[k], k) for k in range(s, e))
            for s, e in zip(starts, [*starts[1:], len(files)], strict=True)])
        merged = rows.take(pa.array([entry[-1] for entry in tree], pa.int64())).combine_chunks()
        merged = merged.append_column("place", pa.array(range(len(files)), pa.int64()))
        yield from merged.to_batches(max_chunksize=10_000)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return runs.mapInArrow(run, f"{ddl}, place long")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder, reads them back and merges their index."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/tarmac-warc/{uuid.uuid4().hex}"
    write(pages, folder, least_bytes=least_bytes)
    return merged_index(materialise(read(spark, folder)))
