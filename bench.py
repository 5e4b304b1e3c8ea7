"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. Every query is
run into a no-op sink; the value is the median of BENCH_RUNS runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from lakestar.plans import QUERIES
from lakestar.session import build_session

HEADLINE = [
    "ssb_one_dim", "ssb_two_dim", "ssb_drill", "ssb_same_dist",
    "olap_simple_cube", "olap_slice", "olap_dice", "olap_rollup_level", "olap_drilldown_level",
    "olap_grouping_sets", "olap_cube", "olap_cube_union",
    "revenue_by_part", "revenue_by_part_two_step", "revenue_by_month_country",
    "revenue_by_part_segment_month", "top10_parts", "top10_cities", "avg_by_group_in_range",
    "sales_by_category", "sales_by_store", "customer_balance", "rewards_report",
    "in_stock_items", "film_list_like", "actor_info_like",
    "users_latest_level", "phase_running_sum_rows", "avg_songs_between_home",
    "surrogate_key", "surrogate_key_copies", "lww_by_key", "upsert_update_level",
    "fact_sales", "fact_songplays", "normalize_1nf", "normalize_2nf", "word_count",
    "pk_audit", "fk_audit", "null_audit",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="lakestar-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
