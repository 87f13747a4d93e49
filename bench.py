"""Time the headline queries on one data folder and print one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Stand-in tables are written before the clock starts, as facts exist before marts read
them; the time for that is given apart, as setup.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from orderloom.session import build_session, drop_run_dir  # noqa: E402
from orderloom.workload import all_queries  # noqa: E402
from orderloom.workload.standins import STANDINS, Inputs  # noqa: E402

HEADLINES = (
    "latest_event_per_key", "latest_with_ties", "conditional_sums", "newest_values", "star_join",
    "join_orders_inner", "enrich_with_cost", "drop_orders_twice", "distinct_count_per_order",
    "pack_lines_per_order", "fan_out_keeping_parents", "union_arrays", "device_class_breakdown",
    "build_sellable_keys", "guard_stock_parts", "upsert_orders", "upsert_newer_events", "state_history",
    "type2_merge", "quality_results", "search_all_texts", "network_feed_rows", "publish_location_rows",
    "order_line_mart_rows", "tender_rows_published", "order_header_mart_rows", "consignment_mart_rows",
    "returns_mart_rows", "order_header_fact_rows", "order_line_fact_rows", "payment_line_fact_rows",
    "fulfilment_status_history", "stream_latest_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus), **{
        "spark.ui.enabled": "false", "spark.log.level": "ERROR", "spark.driver.memory": "16g"})
    began = time.time()
    inputs = Inputs(spark, sf_dir)
    for name in STANDINS:  # all of them: facts and marts read most
        inputs[name]
    setup = time.time() - began
    queries, times = all_queries(), {}
    for name in HEADLINES:
        began = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "setup": round(setup, 3), "sf": Path(sf_dir).name.removeprefix("sf")}))
    drop_run_dir(spark)
    spark.stop()


if __name__ == "__main__":
    main()
