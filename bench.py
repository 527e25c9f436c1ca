"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the threads.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

import catalog

HEADLINE = [
    "cust_quant_summ",
    "sp_vi_qu",
    "time_last_purchased",
    "seg_summary_cust",
    "seg_summary_item",
    "add_non_target",
    "training_sample",
    "normalize_min_max",
    "merge_mapping",
    "describe",
    "value_counts",
    "roc_auc",
    "classification_report",
    "merge_features",
    "recommend",
    "train_rf",
    "shap_values",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = catalog.queries()
    # One small query first, so that the start of the session is not timed.
    queries["targets"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
