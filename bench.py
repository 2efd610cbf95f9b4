"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
Every query is planned and run completely, its files included; its result goes to the
noop sink. One small query runs first, untimed, to start the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.catalogue.queries import QUERIES
from ordermill.session import local_session

HEADLINE = (
    "curated_usd_orders",
    "curated_usd_orders_parity",
    "fx_full_outer_join",
    "latest_file_per_day_rank",
    "latest_file_per_day_maxjoin",
    "curated_union_distinct",
    "product_dim",
    "customer_dim",
    "date_dim",
    "dim_incremental_load",
    "sales_fact",
    "fact_incremental_append",
    "surrogate_keys",
    "csv_ingest",
    "parquet_ingest",
    "json_ingest",
    "incremental_file_load",
    "fact_fk_orphans",
    "missing_rate_audit",
    "warehouse_rerun",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus)
    QUERIES["customer_sample"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
