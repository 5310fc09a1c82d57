"""Exploratory aggregates on the raw items and payments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.operators.mergeable import (
    RANK_ERROR,
    distinct_keys,
    key_bitmaps,
    quantile_sketches,
    sketched_quantiles,
)
from bazaar.operators.positions import positions
from bazaar.operators.profile import group_sizes
from bazaar.operators.quality import union_all
from bazaar.operators.quantiles import describe
from bazaar.plans.facts import clean_payments, items_rows
from bazaar.sources.storage import stage


def seller_sales(items: DataFrame) -> DataFrame:
    """Items sold, revenue and freight per seller."""
    return (
        items_rows(items)
        .where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("n_sales"),
            F.sum("price").alias("revenue"),
            F.sum("freight_value").alias("total_freight"),
        )
    )


def top_sellers_by_sales(items: DataFrame, n: int = 10) -> DataFrame:
    return seller_sales(items).orderBy(F.desc("n_sales"), "seller_id").limit(n)


def payments_by(payments: DataFrame, column: str) -> DataFrame:
    """Mean, number and sum of the payments per value of a column, to the cent."""
    value = F.col("payment_value")
    return (
        clean_payments(payments)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            # A decimal quotient: a mean that ends in half a cent is rounded as such.
            F.bround(F.sum(value).cast("decimal(28,2)") / F.count(value), 2).alias("mean_value"),
            F.count(value).alias("n_payments"),
            F.sum(value).alias("total_value"),
        )
        .orderBy(column)
    )


def price_stats(items: DataFrame) -> DataFrame:
    """Least, greatest, mean and median of price and freight."""
    return describe(items_rows(items), ["price", "freight_value"], [0.5]).select(
        "column_name", "min", "max", "mean", F.col("p50").alias("median")
    )


def order_totals_describe(payments: DataFrame) -> DataFrame:
    """The totals paid per order, described; they are written once and read by every pass."""
    totals = (
        clean_payments(payments)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.coalesce(F.sum("payment_value"), F.lit(0)).cast("decimal(28,2)").alias("order_total"))
    )
    return describe(stage(totals, "order-totals"), ["order_total"])


def items_describe(items: DataFrame) -> DataFrame:
    """Price, freight and the number of items per order, described."""
    sizes = group_sizes(items, "order_id").select(F.col("n").alias("items_per_order"))
    prices = describe(items_rows(items), ["price", "freight_value"])
    return prices.unionByName(describe(stage(sizes, "order-sizes"), ["items_per_order"]))


PERIODS = {"day": "DD", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}


def order_bitmaps(star: Mapping[str, DataFrame]) -> DataFrame:
    """Stored once: for each day and seller's state the orders that had items from there.

    Orders are numbered by day, so a day's bitmaps cover a narrow range.
    """
    days = star["dim_time"].select("date_id", F.col("date_actual").alias("day"))
    orders = star["fact_orders"].select("order_id", "date_id").join(days, "date_id").select("day", "order_id")
    numbered = positions(orders, ["day", "order_id"])
    places = star["dim_sellers"].join(star["dim_geography"], "geography_id").select("seller_id", "state")
    sold = star["fact_order_items"].select("order_id", "seller_id").join(places, "seller_id")
    rows = sold.join(numbered, "order_id").select("day", "state", "position")
    return stage(key_bitmaps(rows, ["day", "state"], "position"), "order-bitmaps")


def distinct_orders_rollup(star: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct orders for each state and day, month, quarter and year: an order with items of
    several sellers counts once. Only the stored bitmaps are merged, for each length of period."""
    bitmaps = order_bitmaps(star)
    levels = [
        distinct_keys(
            bitmaps,
            {"period": F.to_date(F.date_trunc(unit, "day")), "state": F.col("state")},
            "n_orders",
        ).select(F.lit(level).alias("level"), "period", "state", "n_orders")
        for level, unit in PERIODS.items()
    ]
    return union_all(levels)


SHARES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def price_quantiles_approx(star: Mapping[str, DataFrame]) -> DataFrame:
    """Item prices by sketches of each month, merged, and whether the share of prices up to each
    answer is as near to the share asked for as stated."""
    items = star["fact_order_items"]
    sketches = stage(quantile_sketches(items, ["purchase_month"], "price"), "price-sketches")
    answers = sketched_quantiles(sketches, [], SHARES).collect()  # a row for each share
    if not answers:
        return items.sparkSession.createDataFrame([], "p double, n long, within_bound boolean")
    price = F.col("price").cast("double")
    tests = []
    for row in answers:
        low = F.count_if(price < row.value) / F.count("price")
        high = F.count_if(price <= row.value) / F.count("price")
        off = F.greatest(low - row.p, row.p - high)
        tests.append(F.struct(F.lit(row.p).alias("p"), F.count("price").alias("n"), (off <= RANK_ERROR).alias("within_bound")))
    return items.agg(F.array(*tests).alias("tests")).select(F.inline("tests"))
