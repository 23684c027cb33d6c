"""From raw CSV to cleaned tables, maps, feature sets and quality tables.

The raw text is parsed once. Every later step reads the columnar tables written on
the way, which prunes columns and years and leaves nothing to cache.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import cleaning, encoding, features, quality
from tarmac.session import apart, tuned
from tarmac.sources import mappings, records, tables


@dataclass
class Prepared:
    """Where a run's inputs and tables are."""
    spark: SparkSession
    folder: str
    inputs: Sequence[str]
    target: str
    month: int
    years: Sequence[int]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def encodings(self) -> encoding.Encodings:
        return mappings.load(self.spark, f"{self.folder}/mappings")

    def rule_counts(self) -> DataFrame:
        """Rows each rule touched, counted while the text was cleaned."""
        return self.table("rule_counts")

    def quality_tables(self, approximate_distinct: bool = False) -> dict[str, DataFrame]:
        full, operated = self.table("clean_full"), self.table("clean_operated")
        return {
            "rule_counts": self.rule_counts(),
            "yearly_ingestion": quality.yearly_ingestion(full),
            "column_quality": quality.quality_table(full, approximate_distinct),
            "clock_statistics": quality.clock_statistics(full),
            "unseen_categories": encoding.unseen_audit(operated.filter(F.col("YEAR").isin(*self.years)), self.encodings()),
            "feature_rows": self.feature_rows(),
        }

    def feature_rows(self) -> DataFrame:
        counts = [self.table(f"ml_track_{t.lower()}").groupBy("split").agg(F.count(F.lit(1)).alias("n"))
                  .select(F.lit(t).alias("track"), "split", "n") for t in schema.TRACKS]
        return counts[0].unionByName(counts[1])

    def leakage(self) -> DataFrame:
        return features.leakage_audit(
            {t: self.table(f"ml_track_{t.lower()}").drop("split") for t in schema.TRACKS}, self.target)

    def accept(self, years: Sequence[int] = schema.ALL_YEARS) -> None:
        """Raise unless every partition is there and no track has a wrong or leaking column."""
        observed = None
        for name in ("clean_full", "clean_operated"):
            part = self.table(name).select(F.lit(name).alias("dataset"), F.col("YEAR").cast("int").alias("YEAR")).distinct()
            observed = part if observed is None else observed.unionByName(part)
        absent = features.missing_partitions(self.spark, observed, years).collect()  # at most two per year
        faults = [f"missing partition {r['dataset']} YEAR={r['YEAR']}" for r in absent]
        verdicts = self.leakage().filter(F.col("verdict") != "ok").collect()  # one per column
        faults += [f"track {r['track']}: {r['verdict']} column {r['column']}" for r in verdicts]
        if faults:
            raise AssertionError("acceptance failed:\n" + "\n".join(faults))


def prepare(spark: SparkSession, inputs: str | Sequence[str], folder: str, target: str = schema.TARGET,
            train_years: Sequence[int] = schema.TRAIN_YEARS, month: int = 1,
            overwrite: bool = True, compact: bool = False) -> Prepared:
    """Run everything: clean, split off operated flights, fit maps, write feature sets.

    Maps and feature sets are of the years that these inputs hold, whatever else the
    cleaned tables keep from other runs. Rule counts and years are observed while the
    text is cleaned.
    """
    inputs = [inputs] if isinstance(inputs, str) else list(inputs)
    with tuned(spark):
        raw = records.read_records(apart(spark), inputs, target)
        seen = Observation()
        observed = raw.observe(seen, *cleaning.rule_metrics(month), F.collect_set("YEAR").alias("years"))
        tables.write_by_year(cleaning.clean(observed, target, month), f"{folder}/clean_full", overwrite, compact)
        counts = dict(seen.get)
        years = sorted(int(y) for y in counts.pop("years"))
        result = Prepared(spark, folder, inputs, target, month, years)
        tables.write_table(spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts)), f"{folder}/rule_counts")
        full = spark.read.parquet(f"{folder}/clean_full").filter(F.col("YEAR").isin(*years))
        learnt = [y for y in train_years if y in years]
        # Two independent jobs over the table just written; together they fill the cluster better.
        with ThreadPoolExecutor(max_workers=2) as pool:
            jobs = [pool.submit(tables.write_by_year, cleaning.operated(full), f"{folder}/clean_operated", overwrite, compact),
                    pool.submit(lambda: mappings.fit_if_stale(
                        encoding.train_rows(full, train_years), f"{folder}/mappings",
                        mappings.input_fingerprint(spark, inputs), target, learnt))]
            for job in jobs:
                job.result()
        write_features(result, train_years)
    return result


def write_features(run: Prepared, train_years: Sequence[int]) -> None:
    """Encoded track tables split into train and test; track A is a projection of B."""
    operated = run.table("clean_operated").filter(F.col("YEAR").isin(*run.years))
    add = encoding.encode if run.target == "ARR_DEL15" else encoding.add_frequency
    encoded = add(operated, run.encodings())
    wide = features.track_table(encoded, "B", run.target).withColumn("split", features.split_name(train_years))
    wide.write.mode("overwrite").partitionBy("split").parquet(f"{run.folder}/ml_track_b")
    stored = run.table("ml_track_b")
    narrow = stored.select(*[c for c in schema.TRACK_A if c in stored.columns], run.target, "split")
    narrow.write.mode("overwrite").partitionBy("split").parquet(f"{run.folder}/ml_track_a")
