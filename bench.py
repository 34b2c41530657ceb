"""Headline queries at one scale; prints one JSON line.

Every query is run once to warm up and then timed; the result is consumed by Spark's noop sink, so that
all rows are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from tarnlake.plans import QUERIES
from tarnlake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "revenue_by_region", "revenue_by_part_type", "agg_report", "etl_transform", "inner_join_keep_keys",
    "sql_passthrough", "top10_customers", "running_total", "row_number", "rank_revenue", "latest_n_per_group",
    "column_stats", "duplicate_rows", "duplicate_keys", "null_report", "metric_grouped", "metric_filtered",
    "top_metrics", "distinct_rows", "unique_lookup", "run_listing", "run_stats", "run_detail", "error_rows",
    "rule_findings", "rule_scores", "op_counts", "keyword_routing", "notebook_cells", "cohort", "graph_edges",
    "anomaly_diff_rolling", "anomaly_median_distance", "anomaly_neighbours", "anomaly_spectral",
    "threshold_crossings", "upsert_orders", "partitioned_roundtrip", "stream_window_counts", "stream_to_table",
    "ml_regression_metrics",
    "running_total_chunked", "row_number_chunked", "rank_chunked", "median_chunked", "anomaly_component",
    "upsert_partitions", "incremental_copy", "entity_series", "relationship_edges", "table_profile",
    "row_number_hot_group", "upsert_key_ranges", "metric_ratio", "metric_distinct", "anomaly_spectral_advanced",
]


def scale() -> float | str:
    name = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": scale(),
    }))


if __name__ == "__main__":
    main()
