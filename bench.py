"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 1; with more, the median of the warm runs counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.catalogue import ENTRIES, Tables  # noqa: E402
from lakeloom.session import build_session  # noqa: E402

HEADLINES = [
    "p05_amount_category",
    "j01_inner",
    "j08_as_of_join",
    "j11_sort_merge",
    "j13_salted_skew",
    "a01_basic_aggregates",
    "a09_rollup",
    "a12_percentiles_exact",
    "a18_word_count",
    "a20_partial_final_aggregate",
    "w01_row_number_rank_dense_rank",
    "w02_latest_per_key",
    "w07_running_total",
    "w08_rolling_rows",
    "w09_rolling_calendar_30_days",
    "w10_ntile_quartile",
    "t01_order_by_multi_key",
    "t02_global_top_k",
    "u06_hierarchy_by_level_joins",
    "f04_regular_expressions",
    "f22_higher_order_functions",
    "d01_merge_clauses",
    "d02_upsert_all",
    "d05_change_feed",
    "d07_time_travel_latest",
    "d19_z_order",
    "h02_scd2_history",
    "h07_incremental_load",
    "q04_rule_results",
    "q03_failed_rows_with_reason",
    "m03_gold_daily_summary",
    "m09_fraud_score",
    "m11_segments_last_30_rows",
    "m13_executive_dashboard",
    "g11_pii_scan",
    "r02_tumbling_window",
    "r04_session_window",
    "j15_stream_interval_join",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        ENTRIES[name].build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed: dict[str, float] = {}
    for name in HEADLINES:
        once(name)  # warm-up
        timed[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timed.values()), 4),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
