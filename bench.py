"""Times the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``full_run`` goes from CSV text to cleaned tables, maps, feature sets and rule counts,
the work the published pipeline figure covers; ``full_run_warm`` does it again. The other entries read the stored clean table
it leaves, as a user would. Writing the CSV input is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks import frames  # noqa: E402
from tarmac import schema  # noqa: E402
from tarmac.operators import cleaning, distributions, encoding, features, inference, metrics, quality, summaries  # noqa: E402
from tarmac.plans.prepare import prepare  # noqa: E402
from tarmac.session import local_session, shared_folder  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    where = f"{shared_folder(spark)}/tarmac-bench/{uuid.uuid4().hex}"
    text = frames.text_raw(spark, folder).withColumn("_year", F.col("YEAR"))
    text.write.partitionBy("_year").option("header", True).csv(f"{where}/raw")
    inputs = [f"{where}/raw/_year={y}" for y in schema.ALL_YEARS]
    timings: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        timings[name] = round(time.perf_counter() - start, 3)
        return result

    run = timed("full_run", lambda: prepare(spark, inputs, f"{where}/out"))
    timed("full_run_warm", lambda: prepare(spark, inputs, f"{where}/again"))
    full = run.table("clean_full")
    op = run.table("clean_operated")
    rows = full.count()
    maps = run.encodings()
    scored = op.filter(F.col("ARR_DEL15").isNotNull() & F.col("DEP_DELAY").isNotNull()).select(
        "YEAR", F.col("ARR_DEL15").cast("int").alias("label"), F.col("DEP_DELAY").cast("double").alias("score"))
    timed("a08_airport_pain_index", lambda: summaries.airport_pain_index(op).collect())
    timed("a09_worst_busy_routes", lambda: summaries.worst_busy_routes(op).collect())
    timed("a10_delay_heatmap", lambda: summaries.delay_heatmap(op).collect())
    timed("a15_cancellation_by_year", lambda: summaries.cancellation_by_year(full).collect())
    timed("a23_correlations", lambda: distributions.correlation_matrix(op).collect())
    timed("a27_yearly_distribution", lambda: distributions.yearly_distribution(op).collect())
    timed("a30_yearly_ingestion", lambda: quality.yearly_ingestion(full).collect())
    timed("a32_quality_table", lambda: quality.quality_table(full).collect())
    timed("a01_a02_fit_maps", lambda: encoding.Encodings.fit(encoding.train_rows(full)))
    timed("j01_j02_encode", lambda: features.track_table(encoding.encode(op, maps), "B")
          .write.format("noop").mode("overwrite").save())
    timed("h01_chi_square", lambda: inference.chi_square(op).collect())
    timed("h03_kruskal_wallis", lambda: inference.kruskal_wallis(op).collect())
    timed("m08_m09_ranking_metrics", lambda: metrics.compute_metrics(scored).collect())
    timed("m17_drift", lambda: metrics.drift(scored).collect())
    timed("p12_operated_filter", lambda: cleaning.operated(full).count())
    print(json.dumps({
        "metric": "headline work, total wall time", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(folder).name.removeprefix("sf"), "rows": rows,
        "full_run_rows_per_sec": round(rows / timings["full_run"]),
        "cpus": spark.sparkContext.defaultParallelism, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
