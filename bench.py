"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from sievemark.catalog import QUERIES

HEADLINE = (
    "col_profile", "col_profile_gaps", "quantile_linear", "desc_stats", "skew_adj", "corr_matrix", "corr_matrix_full",
    "corr_spearman_trend", "value_counts", "nunique", "categorical_profile", "iqr_anomalies", "flag_outliers",
    "outlier_ratio_pooled", "infer_types", "dup_count", "dedup_hash", "fill_ffill", "fill_smart_log", "iqr_remove",
    "clean_table", "score_confidence", "checks_sanity", "status", "view_table_quality", "hist_bins", "box_stats",
    "group_mean_top", "features8", "features17", "split_ratio", "roc_curve", "feedback_cap", "candidate_rank",
    "src_csv", "stream_profile",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
