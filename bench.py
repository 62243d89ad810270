"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma list or "all", BENCH_RUNS the timed runs per query (the best one counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans import catalog  # noqa: E402
from plumbline.session import build_session  # noqa: E402

HEADLINE = (
    "recon_report", "recon_hash", "recon_dup_keys", "recon_exclusive_keys", "recon_cell_diff",
    "recon_diff_counts", "recon_repeated_keys", "recon_diff_samples", "profile_distinct",
    "distinct_per_column", "distinct_rowkey", "find_keys", "dup_groups", "multi_distinct",
    "group_sums", "join_multiway", "join_pk_diff", "join_broadcast", "join_colocated",
    "sales_by_category", "buying_patterns", "stock_levels", "tail_per_key", "latest_per_key",
    "ordered_concat", "nested_rollup", "text_unique", "text_sort", "json_extract", "sink_upsert",
    "star_build", "check_fk", "type_audit", "layout_key", "html_main_text", "html_paragraphs",
    "stream_clickstream", "stream_cdc_apply",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    chosen = os.environ.get("BENCH_QUERIES", "")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    catalog.load_all()
    names = list(HEADLINE)
    if chosen == "all":
        names = list(catalog.QUERIES)
    elif chosen:
        names = chosen.split(",")
    spark = build_session(
        "plumbline-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
