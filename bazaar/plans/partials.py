"""Marts that are kept up to date month by month.

Each month of a fact has a few stored aggregates, listed with the folder of the fact they were made
of. A load writes the months it touches to new folders, so a refresh reads those months alone,
replaces their aggregates whole (minima and maxima too) and merges the aggregates of all months.
Dimensions are looked up when they are merged: a customer who has moved needs no month again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TYPE_CHECKING, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.plans import marts
from bazaar.plans.marts import Star
from bazaar.schemas import TABLES
from bazaar.sources.storage import PartitionedTable, VersionedTable, stage, staging

if TYPE_CHECKING:
    from bazaar.plans.warehouse import Warehouse

MONTH = "purchase_month"


def _days(star: Star, orders: DataFrame) -> DataFrame:
    return orders.where(F.col("date_id").isNotNull()).groupBy(MONTH, "date_id").agg(
        F.count("order_id").alias("n"),
        F.sum("total_amount").alias("total"),
        F.count("total_amount").alias("n_amounts"),
    )


def _customers(star: Star, orders: DataFrame) -> DataFrame:
    """Orders of a customer by calendar month; orders without a day have none."""
    days = star["dim_time"].select("date_id", "year", "month")
    return orders.join(days, "date_id", "left").groupBy(MONTH, "customer_id", "year", "month").agg(
        F.count("order_id").alias("n"),
        F.sum("total_amount").alias("total"),
        *marts.delay_measures(),
    )


def _known(star: Star, items: DataFrame) -> DataFrame:
    return items.join(star["dim_products"].select("product_id"), "product_id", "left_semi")


def _seller_products(star: Star, items: DataFrame) -> DataFrame:
    return items.groupBy(MONTH, "seller_id", "product_id").agg(
        F.sum("price").alias("price"),
        F.count("price").alias("n_prices"),
        F.sum("freight_value").alias("freight"),
    )


def _seller_orders(star: Star, items: DataFrame) -> DataFrame:
    """Orders of each seller. All items of an order stand in its month, but for those that came
    before their order, in month 0: ``_early_orders`` counts them."""
    pairs = items.where(F.col(MONTH) != 0).select(MONTH, "seller_id", "order_id")
    return pairs.distinct().groupBy(MONTH, "seller_id").agg(F.count("*").alias("n"))


class Partial(NamedTuple):
    """Aggregates of each month of a fact; ``of_products`` if of items of known products alone."""

    fact: str
    build: Callable[[Star, DataFrame], DataFrame]
    of_products: bool = False


PARTIALS = {
    "days": Partial("fact_orders", _days),
    "customers": Partial("fact_orders", _customers),
    "seller_products": Partial("fact_order_items", _seller_products, True),
    "seller_orders": Partial("fact_order_items", _seller_orders, True),
}


def _root(house: Warehouse, name: str) -> str:
    return house.path(f"marts/by_month/{name}")


def _sources(house: Warehouse, name: str) -> VersionedTable:
    """For each month that has been aggregated: the folder it was made of, whether it has items
    of unknown products, and the version of the products then."""
    return VersionedTable(house.spark, f"{_root(house, name)}/sources")


def _table(house: Warehouse, name: str, star: Star) -> PartitionedTable:
    partial = PARTIALS[name]
    schema = partial.build(star, star[partial.fact]).schema
    return PartitionedTable(house.spark, _root(house, name), schema, MONTH)


def _incomplete(
    house: Warehouse, star: Star, folders: Mapping[int, str], products: int
) -> set[int]:
    """The months of items that have unknown products, in these folders.

    The partials of items share what is found for a folder, so its products are looked up once.
    Products are made distinct first: each task moves a product once, and months are looked for
    only if one is unknown.
    """
    new = {m: folder for m, folder in folders.items() if (folder, products) not in house.complete}
    if new:
        sold = house.months("fact_order_items").read(new).select(MONTH, "product_id")
        with staging(house.spark):
            known = star["dim_products"].select("product_id")
            unknown = stage(
                sold.select("product_id").distinct().join(known, "product_id", "left_anti"), "unknown"
            )
            found = set()
            if not unknown.isEmpty():
                same = sold["product_id"].eqNullSafe(unknown["product_id"])
                rows = sold.join(unknown, same, "left_semi").select(MONTH).distinct().collect()
                found = {row[0] for row in rows}
        for month, folder in new.items():
            house.complete[folder, products] = month not in found
    return {m for m, folder in folders.items() if not house.complete[folder, products]}


def refresh(house: Warehouse, name: str) -> list[int]:
    """Aggregate the months that have changed since the last refresh, and return them.

    The list of sources is written last: a refresh that fails before is repeated. Months are at
    most a few hundred, as in the commits of the facts.
    """
    partial, star, listed = PARTIALS[name], house.star(), _sources(house, name)
    fact = house.months(partial.fact)
    folders = fact.folders()
    products = 0
    if partial.of_products:
        products = max(VersionedTable(house.spark, house.path("dim_products")).versions(), default=0)
    before = listed.read()
    made = {} if before is None else {row.month: row for row in before.collect()}

    def changed(month: int) -> bool:
        row = made.get(month)
        if row is None or row.folder != folders[month]:
            return True
        return row.incomplete and row.products != products

    months = sorted(filter(changed, folders))
    if not months:
        return []
    rows = fact.read({month: folders[month] for month in months})
    incomplete = set()
    if partial.of_products:
        incomplete = _incomplete(house, star, {month: folders[month] for month in months}, products)
    if incomplete:  # of the other months all products are known, so they need no join
        part = F.col(MONTH).isin(sorted(incomplete))
        rows = rows.where(~part).unionByName(_known(star, rows.where(part)))
    _table(house, name, star).write_as_dealt(partial.build(star, rows))
    kept = [tuple(row) for month, row in made.items() if month not in months]
    new = [(month, folders[month], month in incomplete, products) for month in months]
    schema = "month int, folder string, incomplete boolean, products long"
    listed.write(house.spark.createDataFrame(kept + new, schema))
    return months


def merged(house: Warehouse, name: str) -> DataFrame:
    """The aggregates of all months, brought up to date."""
    refresh(house, name)
    table = _table(house, name, house.star())
    rows = table.read()
    return house.spark.createDataFrame([], table.schema) if rows is None else rows


def _early_orders(house: Warehouse, star: Star) -> DataFrame | None:
    """Orders of each seller by items in month 0, but for those that its month has, too.

    Only if there are such items are keys of orders read, and of the items the orders' months.
    """
    items = house.months("fact_order_items")
    folders = items.folders()
    if 0 not in folders:
        return None
    early = _known(star, items.read({0: folders[0]})).select("seller_id", "order_id").distinct()
    placed = star["fact_orders"].select("order_id", MONTH).join(
        early.select("order_id").distinct(), "order_id", "left_semi"
    )
    months = {row[0] for row in placed.select(MONTH).distinct().collect()} & set(folders) - {0}
    if months:
        others = _known(star, items.read({month: folders[month] for month in months}))
        early = early.join(others.select("seller_id", "order_id"), ["seller_id", "order_id"], "left_anti")
    return early.groupBy("seller_id").agg(F.count("*").alias("n"))


def _daily_revenue(house: Warehouse, star: Star) -> DataFrame:
    days = marts.revenue_of_days(star, merged(house, "days"), ["date_actual"])
    return days.drop("average_order_value").orderBy("date_actual")


def _monthly_revenue(house: Warehouse, star: Star) -> DataFrame:
    columns = ["year", "month"]
    return marts.revenue_of_days(star, merged(house, "days"), columns).orderBy(*columns)


def _orders_by_region(house: Warehouse, star: Star) -> DataFrame:
    per_customer = merged(house, "customers").groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    regions = marts.regions_of_customers(star, per_customer)
    return regions.orderBy(F.desc_nulls_first("number_of_orders"), "state", "city")


def _seller_performance(house: Warehouse, star: Star) -> DataFrame:
    products = merged(house, "seller_products").groupBy("seller_id", "product_id").agg(
        *(F.sum(c).alias(c) for c in ("price", "n_prices", "freight"))
    )
    orders = merged(house, "seller_orders").select("seller_id", "n")
    early = _early_orders(house, star)
    orders = orders if early is None else orders.unionByName(early)
    total = orders.groupBy("seller_id").agg(F.sum("n").alias("total_orders"))
    return marts.performance_of_sellers(star, products, total)


def _delivery_performance(house: Warehouse, star: Star) -> DataFrame:
    delays = merged(house, "customers").where("n_delays > 0 AND year IS NOT NULL")
    return marts.delays_of_customers(star, delays)


REFRESHED: dict[str, Callable[[Warehouse, Star], DataFrame]] = {
    "daily_revenue": _daily_revenue,
    "monthly_revenue": _monthly_revenue,
    "orders_by_region": _orders_by_region,
    "seller_performance": _seller_performance,
    "delivery_performance": _delivery_performance,
}


def expire(house: Warehouse, keep: int) -> None:
    """Delete aggregates that only older lists than the newest ``keep`` name."""
    for name, partial in PARTIALS.items():
        schema = TABLES[partial.fact].schema
        PartitionedTable(house.spark, _root(house, name), schema, MONTH).expire(keep)
        _sources(house, name).expire(keep)
