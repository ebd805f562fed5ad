"""Time the headline queries; prints one JSON line.

Each query is built and written to the no-op sink, so every row and column is computed and
nothing is collected. Times include whatever a query runs eagerly (fits, streams). The published
forests (`train_flood`, `train_fire`) take minutes: name them in BENCH_QUERIES to time them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from hazardflow.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "flood_pipeline",
    "null_profile",
    "impute_median",
    "impute_mode",
    "numeric_summary",
    "clean_fire",
    "decode_payload",
    "flood_ml_dataset",
    "zonal_totals",
    "zonal_stats",
    "fire_features",
    "high_alerts",
    "enrich_location",
    "points",
    "points_long",
    "points_dedup",
    "alert_map",
    "level_distribution",
    "windowed_mean",
    "series_legend",
    "console_summary",
    "alert_distribution",
    "top_risk",
    "latest_predictions",
    "split_three",
    "standardize",
    "classification_metrics",
    "auc",
    "gold_csv",
    "land_stream",
    "score_flood_stream",
    "windowed_mean_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hazardflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hazardflow-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # Start the engine before timing.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # report it, keep timing the rest
            failed[name] = str(error)[:200]
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
