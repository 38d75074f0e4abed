"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the cores; BENCH_KEYS (comma-separated, or "all") overrides the query list.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from larkspur.registry import callables  # noqa: E402
from larkspur.session import build_session  # noqa: E402

HEADLINE = """
bi_segment enriched_orders product_performance current_inventory fact_sales daily_sales_summary
orders_wide customer_activity daily_sales_by_brand regional_sales menu_item_performance
daily_city_metrics annual_wages_cpi bi_category_month bi_top_customers bi_restock
agg_basic agg_count_distinct agg_having agg_histogram aggf_quantile win_ranking win_running win_row_number_key
join_star_wide join_many_to_many_avg join_anti_not_exists
dq_run_all tel_error_summary tel_performance
change_log_diff change_net snapshot_as_of merge_upsert scd2_customer
dynamic_table_refresh consume_changes_once stream_daily_window
load_csv_fixed continuous_file_ingest fn_string fn_numeric json_flatten_agg udtf_split_rows chat_history_pack token_budget
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_KEYS", "")
    spark = build_session(cpus, app="larkspur-bench")
    fns = callables()
    keys = list(fns) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}
    for key in keys:
        start = time.perf_counter()
        fns[key](spark, folder).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder).removeprefix("sf")}
        )
    )


if __name__ == "__main__":
    main()
