"""Times the load and the queries, warm, and prints one line of JSON.

``full_load`` builds the whole star schema in a new folder; the marts and explorations read it.
Every figure is the median of three runs after a first one that is not counted. Rows are
produced in full and dropped, so nothing is spent on fetching them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame

from bazaar.plans import explorations, marts
from bazaar.plans.registry import queries
from bazaar.plans.warehouse import Warehouse
from bazaar.session import build_session
from bazaar.sources.storage import shared_folder
from bazaar.sources.tables import raw_tables

RUNS = 3
HEADLINE = [
    "daily_revenue",
    "monthly_revenue",
    "orders_by_region",
    "seller_performance",
    "delivery_performance",
    "top_products",
    "top_sellers",
    "region_ranking",
    "quarterly_revenue",
    "yearly_growth",
    "slowest_states",
    "delivery_by_seller",
]
# Queries on the raw tables whose cost grows with them in different ways.
RAW = ["payments_rollup", "orders_payments_detail", "price_histogram", "describe_items"]


def produce(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def warm_median(run: Callable[[], object]) -> float:
    run()
    return round(statistics.median(timed(run) for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = raw_tables(spark, sf_dir)

    def load() -> Warehouse:
        root = f"{shared_folder(spark)}/bench/{uuid4().hex}"
        return Warehouse(spark, root, datetime(2024, 1, 1)).load(raw)

    times = {"full_load": warm_median(load)}
    star = load().star()
    builders = {**marts.MARTS, **{n: getattr(explorations, n) for n in HEADLINE[5:]}}
    for name in HEADLINE:
        times[name] = warm_median(lambda build=builders[name]: produce(build(star)))
    registered = queries()
    for name in RAW:
        times[name] = warm_median(lambda query=registered[name]: produce(query(spark, sf_dir)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "full load, 12 marts and explorations, 4 raw queries (warm medians)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
