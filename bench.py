"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query
computes all its rows and columns; the rows go to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import time

from shopgrain.catalog import QUERIES
from shopgrain.session import local_session

HEADLINE = (
    "m1_stg_users",
    "m2_stg_locations",
    "m6_stg_user_events",
    "m7_stg_orders_incr",
    "m8_stg_order_items_incr",
    "m9_stg_user_events_incr",
    "m11_dim_users",
    "m12_fct_orders",
    "m13_fct_order_items",
    "m14_fct_user_events",
    "m15_snap_locations",
    "i2_anti_join_increment",
    "i3_keyed_upsert",
    "q7_line_total_integrity",
    "q9_orphan_order_items",
    "q10_check_suite",
    "r1_monthly_revenue",
    "r2_status_impact",
    "r3_customer_ltv",
    "r4_frequency_segments",
    "r5_category_performance",
    "r6_top_states",
    "r7_order_value_statistics",
    "r8_order_value_histogram",
    "r9_payment_breakdown",
    "r10_key_figures",
    "g1_transition_matrix",
    "g2_funnel",
    "t1_stream_user_events",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = local_session(cpus, shuffle_partitions=8 if cpus == "*" else int(cpus), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["m12_fct_orders"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
