"""The daily run: every step once, in order."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import SparkSession

from bazaar.operators.quality import row_counts, sample_rows
from bazaar.plans import catalog
from bazaar.plans.warehouse import Warehouse
from bazaar.sources.files import broken_lines, extract

log = logging.getLogger(__name__)


def run_daily(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    database: str = "shop",
    run_ts: datetime | None = None,
) -> dict[str, int]:
    """Create tables, extract, load, analyze, refresh the marts, and count what is there.

    A failed step raises; the run can be repeated, since loads are upserts.
    """
    shop = Warehouse(spark, root, run_ts)
    catalog.create_tables(spark, database, shop)
    shop.load(shop.land(extract(spark, raw_dir)))
    broken = shop.set_apart(broken_lines(spark, raw_dir), "lines")
    if broken:
        log.warning("%d lines are not as long as their header", broken)
    catalog.publish(spark, database, shop)
    catalog.analyze_tables(spark, database)
    shop.refresh_marts()
    shop.expire()
    counts = {row.table_name: row.n_rows for row in row_counts(shop.star()).collect()}
    log.info("loaded: %s", counts)
    for name, rows in sample_rows(shop.star()).items():
        log.info("%s: %s", name, [row.asDict() for row in rows.collect()])
    return counts
