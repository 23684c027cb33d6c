"""What reaches the driver is bounded however many rows share a doc_id; repeated query rows keep all their neighbours."""

from pyspark.sql import functions as F

from tarmac.llm import ann, pii, quality


def _many(spark, rows=20_000):
    """One doc_id with 20,000 texts, and ten others."""
    texts = F.concat(F.lit("call +44 79 "), F.col("id").cast("string"), F.lit(" or mail x@y.zz "), F.md5(F.col("id").cast("string")))
    return spark.range(rows + 10).select(F.when(F.col("id") < rows, 0).otherwise(F.col("id")).alias("doc_id"), texts.alias("text"))


def test_labelled_sample_is_one_text_of_an_id(spark):
    docs = _many(spark)
    labels = spark.createDataFrame([(0, 1)] + [(20_000 + k, k % 2) for k in range(10)], "doc_id long, quality int")
    sample = quality.labelled_sample(docs, labels, "quality", F.lit(True), 5, 65_536)
    assert 0 < len(sample.rows) <= 10
    assert sample == quality.labelled_sample(docs, labels, "quality", F.lit(True), 5, 65_536)


def test_personal_data_fits_on_so_many_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit", lambda texts: seen.append(texts))
    pii.train(_many(spark), rows=7)
    pii.train(_many(spark).unionByName(_many(spark)), rows=7)
    assert len(seen[0]) == 7 and seen[0] == seen[1]


def test_repeated_query_rows(spark):
    rows = [(k, [float(k % 7), 1.0, float(k % 5), 0.5]) for k in range(60)]
    index = ann.build(spark.createDataFrame(rows, "vec_id long, vector array<double>"), dims=4)
    asked = spark.createDataFrame([rows[20], rows[20], (20, [1.0, 2.0, 0.0, 0.0]), rows[40]], "vec_id long, vector array<double>").withColumn("query_id", F.lit("kept"))
    found = ann.search(index, asked, k=20, visit=1.0).collect()
    assert len(found) == 60  # rows alike are one query, another vector under the same id is one more
    of_20 = [r for r in found if r.query_id == 20]
    assert sorted(r["rank"] for r in of_20) == sorted(list(range(1, 21)) * 2) and all(r.vec_id != r.query_id for r in found)
    one = {r.vec_id for r in found if r.query_id == 40}
    assert len(one) == 20
