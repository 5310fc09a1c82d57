"""Ranked, growth and delay questions on the star schema and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.measures import delay_micros, mean, mean_days
from bazaar.plans.marts import (
    Star,
    orders_by_region,
    revenue_by_time,
    seller_performance,
    seller_places,
)


def top_products(star: Star, n: int = 10) -> DataFrame:
    """The products with the highest revenue."""
    per_product = (
        star["fact_order_items"]
        .groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("price").alias("total_revenue"),
            mean(F.sum("price"), F.count("price")).alias("avg_order_value"),
        )
    )
    return (
        per_product.join(star["dim_products"].select("product_id", "category_name"), "product_id")
        .select("product_id", "category_name", "total_orders", "total_revenue", "avg_order_value")
        .orderBy(F.desc_nulls_first("total_revenue"), "product_id")
        .limit(n)
    )


def top_sellers(star: Star, n: int = 10) -> DataFrame:
    """The sellers with the highest revenue, from the seller mart."""
    return (
        seller_performance(star)
        .select("seller_id", "seller_state", "total_orders", "total_revenue", "average_order_value")
        .orderBy(F.desc_nulls_first("total_revenue"), "seller_id")
        .limit(n)
    )


def region_ranking(star: Star) -> DataFrame:
    """Regions by number of orders, from the region mart."""
    return (
        orders_by_region(star)
        .select("state", "city", "number_of_orders", "total_revenue")
        .orderBy(F.desc_nulls_first("number_of_orders"), "state", "city")
    )


def quarterly_revenue(star: Star) -> DataFrame:
    return (
        revenue_by_time(star, ["year", "quarter"])
        .select("year", "quarter", "total_revenue", "number_of_orders")
        .orderBy("year", "quarter")
    )


def yearly_growth(star: Star) -> DataFrame:
    """Revenue per year, with the year before and the growth in percent.

    The window has no partition, and needs none: its input is a row per year.
    """
    years = revenue_by_time(star, ["year"]).select("year", "total_revenue")
    before = F.lag("total_revenue").over(Window.orderBy("year"))
    growth = (F.col("total_revenue") - F.col("previous_year_revenue")) / F.nullif(
        F.col("previous_year_revenue"), F.lit(0)
    )
    return (
        years.withColumn("previous_year_revenue", before)
        .withColumn("growth_rate", F.round(growth * 100, 2))
        .orderBy("year")
    )


def slowest_states(star: Star, n: int = 5) -> DataFrame:
    """The customer states with the longest mean delay."""
    delay = F.col("delivery_delay")
    per_customer = (
        star["fact_orders"]
        .where(delay.isNotNull())
        .groupBy("customer_id")
        .agg(F.sum(delay_micros(delay)).alias("micros"), F.count("order_id").alias("n"))
    )
    return (
        per_customer.join(star["dim_customers"].select("customer_id", "geography_id"), "customer_id")
        .groupBy("geography_id")
        .agg(F.sum("micros").alias("micros"), F.sum("n").alias("n"))
        .join(star["dim_geography"].select("geography_id", "state"), "geography_id")
        .groupBy("state")
        .agg(
            mean_days(F.sum("micros"), F.sum("n")).alias("avg_delivery_days"),
            F.sum("n").alias("total_orders"),
        )
        .orderBy(F.desc_nulls_first("avg_delivery_days"), "state")
        .limit(n)
    )


def delivery_by_seller(star: Star) -> DataFrame:
    """Mean delay per seller, weighted by items: ``total_orders`` counts items.

    Only two narrow columns of each fact meet in the one large shuffle join; an order with very
    many items is split there by adaptive execution.
    """
    delay = F.col("delivery_delay")
    delivered = star["fact_orders"].where(delay.isNotNull()).select("order_id", "delivery_delay")
    per_seller = (
        star["fact_order_items"]
        .select("order_id", "seller_id")
        .join(delivered, "order_id")
        .groupBy("seller_id")
        .agg(
            mean_days(F.sum(delay_micros(delay)), F.count(delay)).alias("avg_delivery_days"),
            F.count("order_id").alias("total_orders"),
        )
    )
    return (
        per_seller.join(seller_places(star).drop("seller_city"), "seller_id")
        .select("seller_id", "seller_state", "avg_delivery_days", "total_orders")
        .orderBy(F.desc_nulls_first("avg_delivery_days"), "seller_id")
    )
