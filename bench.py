"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
Every query runs once to warm up and BENCH_RUNS (default 3) times for the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabkit.catalog import QUERIES  # noqa: E402
from tabkit.session import local_session  # noqa: E402

HEADLINE = (
    "dq_null_counts",
    "dq_duplicate_rows",
    "dq_iqr_report",
    "stat_describe_frame",
    "stat_group_median",
    "stat_group_rate",
    "stat_corr_matrix",
    "agg_distinct",
    "join_left",
    "prof_columns",
    "viz_histogram",
    "viz_box",
    "sql_guarded",
    "fe_split_stratified",
    "fe_split_time",
    "fe_standardize",
    "met_eval_best",
    "met_class_report",
    "met_element_auc",
    "syn_ks",
    "anom_topk_score",
    "anom_iforest_summary",
    "txt_bow",
    "txt_route",
    "eval_ungrounded",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores, "tabkit-bench", spark__sql__shuffle__partitions=cores)
    seconds: dict[str, float] = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(taken[1:]), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cores,
        "runs": runs,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
