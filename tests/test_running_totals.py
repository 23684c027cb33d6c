"""Running totals of files against the batch figures: late, replaced, emptied and packed files, restarts."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from checks import frames
from conftest import SF
from tarmac.operators import cleaning, quality
from tarmac.sources import records
from tarmac.streaming import totals


@pytest.fixture
def feed(spark, tmp_path):
    text = frames.text_raw(spark, SF).withColumn("CRS_DEP_TIME", F.nullif("CRS_DEP_TIME", F.lit("")))
    names = text.columns

    def put(delivery, name, rows, when, columns=names):
        (tmp_path / "in" / delivery).mkdir(parents=True, exist_ok=True)
        path = tmp_path / "in" / delivery / name
        lines = [",".join(columns)] + [",".join(str(r[c] if r[c] is not None else "") for c in columns) for r in rows]
        data = ("\n".join(lines) + "\n").encode()
        path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        os.utime(path, (when, when))
        return str(path)

    def run():
        totals.count_files(spark, f"{tmp_path}/in/*", f"{tmp_path}/counted", f"{tmp_path}/c1", max_files=2).awaitTermination()
        totals.total(spark, f"{tmp_path}/counted", f"{tmp_path}/changes", f"{tmp_path}/c2").awaitTermination()
        return totals.totals(spark, f"{tmp_path}/changes")

    return text.limit(400).collect(), names, put, run


def same(spark, running, paths):
    """Equal to the batch figures over the files that count."""
    raw = records.read_records(spark, paths)
    assert totals.rule_counts(running).first().asDict() == cleaning.rule_counts(raw).first().asDict()
    batch = {r["YEAR"]: r.asDict() for r in quality.yearly_ingestion(cleaning.clean(raw)).collect()}
    assert {r["YEAR"]: r.asDict() for r in totals.yearly_ingestion(running).collect()} == batch


def test_late_replaced_and_emptied_files(spark, feed):
    rows, names, put, run = feed
    a = put("d1", "a.csv", rows[:100], 1000)
    b = put("d1", "b.csv", rows[100:180], 1000, names[::-1])
    c = put("d1", "c.csv.gz", rows[180:200], 1000)
    same(spark, run(), [a, b, c])
    same(spark, run(), [a, b, c])  # nothing new, nothing counted again
    a2 = put("d2", "a.csv", rows[150:300], 2000)
    d = put("d2", "d.csv", rows[300:], 2000)
    same(spark, run(), [a2, b, c, d])
    put("d3", "a.csv", rows[:50], 1500)  # arrives last, but is older
    c2 = put("d3", "c.csv", rows[:30], 3000)  # the packed file's key
    same(spark, run(), [a2, b, c2, d])
    put("d4", "d.csv", [], 4000)  # a header and no rows: takes the key's rows back
    same(spark, run(), [a2, b, c2])


def test_equal_times_and_rows_without_year(spark, feed):
    rows, names, put, run = feed
    put("d1", "a.csv", rows[:40], 1000)
    larger = put("d2", "a.csv", [{**r.asDict(), "YEAR": None} for r in rows[:5]] + rows[5:30], 1000)
    running = run()
    same(spark, running, [larger])
    assert {r["YEAR"]: r["rows_without_year"] for r in running.collect()}[None] == 5


def test_a_batch_written_again_counts_once(spark, feed, tmp_path):
    rows, names, put, run = feed
    a = put("d1", "a.csv", rows[:60], 1000)
    run()
    again = spark.read.parquet(f"{tmp_path}/counted/batch=0").collect()
    spark.createDataFrame(again, totals._COUNTED).write.parquet(f"{tmp_path}/counted/batch=1")
    same(spark, run(), [a])
