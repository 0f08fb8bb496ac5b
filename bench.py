"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default: all)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aduana.checks.registry import queries  # noqa: E402
from aduana.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_balance", "yearly_totals", "factor_share", "product_price", "product_mom", "top10_refill",
    "country_exports", "country_imports", "bloc_trade", "state_balance", "route_exports", "route_imports",
    "class_dim", "company_fact", "companies_by_state", "size_profile", "top_classes_by_region", "class_age",
    "company_dim", "opportunities", "bridge_code_coverage", "bridge_value_coverage", "dedup_latest", "upsert_scd1",
    "archive_expand", "silver_incremental", "upsert_table_scd1", "stream_csv_facts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    registered = queries()

    def timed(name: str) -> float:
        began = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in wanted:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
