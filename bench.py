"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line with seconds per query.

Before anything is timed the raw rows are derived once and stored; that time is reported apart. Ingest is timed on the real
operators: the first four batches and then the last one are upserted into a stored table. Registered queries derive their
own rows, so their seconds contain the derivation.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "accepted_rows",
    "ingest_stats",
    "x_suite_results",
    "transform_records",
    "sla_join_best",
    "daily_agency_metrics",
    "fact_service_requests",
    "monthly_borough_performance",
    "agency_sla_scorecard",
    "t_fact_checks",
    "v_kpi_rollup",
    "m_aging_buckets",
    "requests_ytd",
    "mon_rowcount_zscore",
    "top10_complaints",
]
GROUPS = {
    "ingest": ["upsert_first_batches", "upsert_last_batch", "ingest_stats"],
    "validation": ["x_suite_results"],
    "models": ["daily_agency_metrics", "fact_service_requests", "monthly_borough_performance", "agency_sla_scorecard"],
}


def main() -> None:
    from pyspark.sql import functions as F

    from requestlens.catalog import QUERIES
    from requestlens.catalog.inputs import TIES
    from requestlens.operators.dead_letters import accepted
    from requestlens.operators.upsert import upsert_table
    from requestlens.session import build_session, fresh_path, store
    from requestlens.sources.star_requests import raw_requests

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    QUERIES["status_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's compilers
    start = time.perf_counter()
    raw = store(raw_requests(spark, folder), "raw")
    derived = round(time.perf_counter() - start, 3)
    rows = raw.count()
    fit, path = accepted(raw), fresh_path(spark, "requests")
    last = F.col("batch_id") == "batch_4"
    timed("upsert_first_batches", lambda: upsert_table(fit.where(~last), path, ties=TIES))
    timed("upsert_last_batch", lambda: upsert_table(fit.where(last), path, ties=TIES))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    found = re.search(r"sf([0-9.]+)", folder)
    upserts = seconds["upsert_first_batches"] + seconds["upsert_last_batch"]
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
        "raw_rows": rows,
        "derivation_seconds": derived,
        "upsert_rows_per_sec": round(rows / upserts),
        "group_seconds": {group: round(sum(seconds[name] for name in names), 3) for group, names in GROUPS.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
