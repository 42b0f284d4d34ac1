"""Seconds per headline query; prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES override the defaults."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "q_recent_window q_extract_transit q_extract_inter q_extract_orders q_extract_direct q_stage_union "
    "q_headers q_build_lines q_build_taxes q_rollup_amounts q_categorize "
    "q_validate_ar q_validate_mat q_amount_mismatch q_already_processed q_status_report q_error_texts_hot q_print_detail "
    "q_pack_recipients q_find_orphans q_purge_kept q_vendor_requests q_scd2_change q_assign_ids q_write_back "
    "q_extract_run_transfer q_extract_run_receivable"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerloom.catalog import QUERIES

    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()  # warm up
    seconds = {}
    for name in names:
        begin = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
