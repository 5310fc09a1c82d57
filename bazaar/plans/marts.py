"""The five marts.

Facts are aggregated to a dimension's key first and joined to the dimension afterwards, wherever
the result allows it: the join then sees one row per key, however hot a key is. Order and
customer counts rely on the tables' keys, which the load enforces; ``trust_keys=False`` counts
distinct values instead, for tables of other origin.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.measures import delay_micros, mean, mean_days

Star = Mapping[str, DataFrame]


def revenue_of_days(star: Star, per_day: DataFrame, columns: list[str]) -> DataFrame:
    """Revenue per group of calendar columns, from ``n``, ``total`` and ``n_amounts`` of days."""
    days = star["dim_time"].select("date_id", *columns)
    measures = per_day.join(days, "date_id").groupBy(*columns).agg(
        F.sum("n").alias("number_of_orders"),
        F.sum("total").alias("total_revenue"),
        mean(F.sum("total"), F.sum("n_amounts")).alias("average_order_value"),
    )
    return measures.select(*columns, "number_of_orders", "total_revenue", "average_order_value")


def revenue_by_time(star: Star, columns: list[str], trust_keys: bool = True) -> DataFrame:
    """Orders, revenue and mean order value per group of calendar columns."""
    orders = star["fact_orders"].where(F.col("date_id").isNotNull())
    days = star["dim_time"].select("date_id", *columns)
    if trust_keys:
        per_day = orders.groupBy("date_id").agg(
            F.count("order_id").alias("n"),
            F.sum("total_amount").alias("total"),
            F.count("total_amount").alias("n_amounts"),
        )
        return revenue_of_days(star, per_day, columns)
    else:
        measures = (
            orders.join(days, "date_id")
            .groupBy(*columns)
            .agg(
                F.count_distinct("order_id").alias("number_of_orders"),
                F.sum("total_amount").alias("total_revenue"),
                mean(F.sum("total_amount"), F.count("total_amount")).alias("average_order_value"),
            )
        )
    return measures.select(*columns, "number_of_orders", "total_revenue", "average_order_value")


def daily_revenue(star: Star, trust_keys: bool = True) -> DataFrame:
    days = revenue_by_time(star, ["date_actual"], trust_keys)
    return days.drop("average_order_value").orderBy("date_actual")


def monthly_revenue(star: Star, trust_keys: bool = True) -> DataFrame:
    return revenue_by_time(star, ["year", "month"], trust_keys).orderBy("year", "month")


def regions_of_customers(star: Star, per_customer: DataFrame) -> DataFrame:
    """Orders, customers and revenue per region, from ``n`` and ``total`` of each customer."""
    customers = star["dim_customers"].select("customer_id", "geography_id")
    places = star["dim_geography"].select("geography_id", "state", "city")
    return (
        per_customer.join(customers, "customer_id")
        .groupBy("geography_id")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("n_customers"),
            F.sum("total").alias("total"),
        )
        .join(places, "geography_id")
        .groupBy("state", "city")
        .agg(
            F.sum("n").alias("number_of_orders"),
            F.sum("n_customers").alias("number_of_customers"),
            F.sum("total").alias("total_revenue"),
        )
    )


def orders_by_region(star: Star, trust_keys: bool = True) -> DataFrame:
    """Orders, customers with an order, and revenue per state and city."""
    orders = star["fact_orders"]
    customers = star["dim_customers"].select("customer_id", "geography_id")
    places = star["dim_geography"].select("geography_id", "state", "city")
    if trust_keys:
        # One row per customer: the shuffle of this aggregate is also that of the join.
        per_customer = orders.groupBy("customer_id").agg(
            F.count("order_id").alias("n"), F.sum("total_amount").alias("total")
        )
        regions = regions_of_customers(star, per_customer)
    else:
        regions = (
            orders.join(customers, "customer_id")
            .join(places, "geography_id")
            .groupBy("state", "city")
            .agg(
                F.count_distinct("order_id").alias("number_of_orders"),
                F.count_distinct("customer_id").alias("number_of_customers"),
                F.sum("total_amount").alias("total_revenue"),
            )
        )
    return regions.orderBy(F.desc_nulls_first("number_of_orders"), "state", "city")


def seller_places(star: Star) -> DataFrame:
    """Sellers with a known place."""
    places = star["dim_geography"].select(
        "geography_id", F.col("state").alias("seller_state"), F.col("city").alias("seller_city")
    )
    sellers = star["dim_sellers"].select("seller_id", "geography_id")
    return sellers.join(places, "geography_id").drop("geography_id")


def seller_performance(star: Star) -> DataFrame:
    """Per seller with a known place, over items with a known product.

    ``average_order_value`` is the mean item price. Items are summed by (seller, product) and by
    (seller, order) before anything else, so a hot seller is many small groups, and what is
    joined by seller is a row from each of both.
    """
    known = star["dim_products"].select("product_id")
    items = star["fact_order_items"].join(known, "product_id", "left_semi")
    products = items.groupBy("seller_id", "product_id").agg(
        F.sum("price").alias("price"),
        F.count("price").alias("n_prices"),
        F.sum("freight_value").alias("freight"),
    )
    orders = (
        items.select("seller_id", "order_id").distinct()
        .groupBy("seller_id").agg(F.count("order_id").alias("total_orders"))
    )
    return performance_of_sellers(star, products, orders)


def performance_of_sellers(star: Star, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Measures of sellers, from ``price``, ``n_prices`` and ``freight`` of each seller and
    product, and ``total_orders`` of each seller."""
    products = products.groupBy("seller_id").agg(
        F.count("product_id").alias("unique_products_sold"),
        F.sum("price").alias("total_revenue"),
        mean(F.sum("price"), F.sum("n_prices")).alias("average_order_value"),
        F.sum("freight").alias("total_freight_value"),
    )
    return (
        seller_places(star).join(products, "seller_id").join(orders, "seller_id")
        .select(
            "seller_id",
            "seller_state",
            "seller_city",
            "total_orders",
            "unique_products_sold",
            "total_revenue",
            "average_order_value",
            "total_freight_value",
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "seller_id")
    )


def delivery_performance(star: Star) -> DataFrame:
    """Delays per month of purchase and customer state; over a week means more than 7 days.

    Orders are summed by customer and day first; the joins see no single order.
    """
    delayed = star["fact_orders"].where(F.col("delivery_delay").isNotNull())
    per_day = delayed.groupBy("customer_id", "date_id").agg(*delay_measures())
    return delays_of_customers(
        star, per_day.join(star["dim_time"].select("date_id", "year", "month"), "date_id")
    )


def delay_measures() -> list[Column]:
    """Sum, number, least, most and number over a week of the delays of a group."""
    delay = F.col("delivery_delay")
    return [
        F.sum(delay_micros(delay)).alias("micros"),
        F.count(delay).alias("n_delays"),
        F.min(delay).alias("least"),
        F.max(delay).alias("most"),
        F.count_if(delay > 7).alias("late"),
    ]


def delays_of_customers(star: Star, delays: DataFrame) -> DataFrame:
    """Delays per month and state, from the ``delay_measures`` of customers' days or months."""
    customers = star["dim_customers"].select("customer_id", "geography_id")
    return (
        delays.join(customers, "customer_id")
        .join(star["dim_geography"].select("geography_id", "state"), "geography_id")
        .groupBy("year", "month", "state")
        .agg(
            mean_days(F.sum("micros"), F.sum("n_delays")).alias("avg_delivery_days"),
            F.min("least").alias("min_delivery_days"),
            F.max("most").alias("max_delivery_days"),
            F.sum("late").alias("deliveries_over_week"),
        )
        .orderBy("year", "month", F.desc_nulls_first("avg_delivery_days"), "state")
    )


MARTS = {
    "daily_revenue": daily_revenue,
    "monthly_revenue": monthly_revenue,
    "orders_by_region": orders_by_region,
    "seller_performance": seller_performance,
    "delivery_performance": delivery_performance,
}


def create_analysis_views(star: Star) -> list[str]:
    """Register the marts as temporary views for SQL."""
    for name, mart in MARTS.items():
        mart(star).createOrReplaceTempView(name)
    return list(MARTS)
