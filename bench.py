"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default all)
the cores. The tables are first landed with a file per core, untimed. Each query is fully materialised into a no-op sink and timed from building
the plan to the last row. Queries run twice, the faster run counts; training runs once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from homeledger.catalog import QUERIES, inputs  # noqa: E402
from homeledger.operators import models  # noqa: E402
from homeledger.session import cut_lineage  # noqa: E402

QUICK = [
    "standardize_schema", "standardize_typed", "clean_for_model", "clean_raw_listings", "flatten_ad",
    "prepare_two_sources", "dedupe_keep_first", "duplicates_removed", "clean_rows_by_month_and_source",
    "cleaning_funnel", "coverage_report", "rows_by_month", "pivot_month_source", "target_median",
    "regression_metrics", "boxplot_by_district", "histogram_50", "error_q99_trim", "split_chronological",
    "chronological_rank", "impute_median", "category_frequency", "request_features", "clean_text", "first_per_key",
    "report_tables",
]
ONCE = ["feature_matrix", "stream_ad_ingest", "merged_run"]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def landed(spark: SparkSession, sf_dir: str, files: int) -> str:
    """A copy of the tables with a file per core: a table of one row group would be parsed by one task. Not timed."""
    folder = tempfile.mkdtemp(prefix="homeledger-tables-")
    for table in sorted(os.listdir(sf_dir)):
        if table.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir}/{table}").repartition(files).write.parquet(f"{folder}/{table}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    parallel = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="homeledger-bench-"))
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    tables, sf = landed(spark, sf_dir, parallel), sf_dir.rsplit("sf", 1)[-1]
    only = sys.argv[1:]
    seconds: dict[str, float] = {}
    for name in only or QUICK:
        if name not in QUERIES or (only and name not in QUICK):
            continue
        seconds[name] = min(timed(lambda: drain(QUERIES[name](spark, tables))) for _ in range(2))

    for name in only or ONCE:
        if name in ONCE:
            seconds[name] = timed(lambda: drain(QUERIES[name](spark, tables)))

    if not only or "models" in only:
        clean = cut_lineage(inputs.clean_listings(spark, tables), "bench")
        fitted = {}

        def fit(name, train):
            fitted[name] = train()

        seconds["fit_features"] = timed(lambda: fit("spec", lambda: models.fit_features(clean)))
        seconds["train_ridge"] = timed(lambda: fit("ridge", lambda: models.train_ridge(clean, fitted["spec"])))
        seconds["train_random_forest"] = timed(lambda: fit("forest", lambda: models.train_random_forest(
            clean, fitted["spec"], trees=20, depth=10)))
        seconds["predict_batch"] = timed(lambda: drain(fitted["forest"].predict(clean, key="row_id")))

    total = sum(seconds.values())
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()}, "sf": sf}))


if __name__ == "__main__":
    main()
