"""The physical plans that large tables depend on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bazaar.operators import profile
from bazaar.operators.dedup import keep_first
from bazaar.plans import catalog, explorations, marts
from bazaar.plans.facts import (
    marked_payments,
    orders_batch,
    orders_payments_detail,
    orders_rows,
    payments_delta,
    payments_rollup,
)
from bazaar.plans.registry import queries, warehouse
from bazaar.schemas import ROW_ORDER
from bazaar.sources.tables import raw_table
from conftest import TESTDATA


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def star(spark):
    return warehouse(spark, TESTDATA).star()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def skew_from_little(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_no_query_has_a_cross_join(spark):
    for name, query in queries().items():
        text = plan(query(spark, TESTDATA))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_marts_read_only_their_columns(star):
    text = plan(marts.monthly_revenue(star))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("total_amount" in s for s in schemas)
    assert not any("order_status" in s or "payment_type" in s for s in schemas)
    assert "IsNotNull(date_id)" in text


def test_delay_filter_reaches_the_scan(star):
    assert "IsNotNull(delivery_delay)" in plan(marts.delivery_performance(star))


def test_month_filter_prunes_partitions(star):
    text = plan(star["fact_orders"].where("purchase_month = 199701").select("order_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*purchase_month#\d+ = 199701", text)


def test_small_dimensions_are_broadcast_by_their_stored_size(star):
    text = plan(marts.orders_by_region(star))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_ranked_queries_keep_only_the_top(star):
    for query in (explorations.top_products, explorations.top_sellers, explorations.slowest_states):
        assert "TakeOrderedAndProject" in plan(query(star))


def test_facts_are_aggregated_before_the_customer_join(star, no_broadcast):
    text = plan(marts.orders_by_region(star))
    # One shuffle of the orders, by customer, serves both the aggregate and the join.
    assert len(re.findall(r"hashpartitioning\(customer_id#\d+, \d+\)", text)) == 2
    join = text.index("SortMergeJoin [customer_id")
    assert "partial_count(order_id" in text[join:]


def test_first_rows_are_combined_before_the_shuffle(spark):
    text = plan(keep_first(raw_table(spark, TESTDATA, "geography"), ["geolocation_zip_code_prefix"]))
    assert "partial_min_by" in text
    text = plan(payments_rollup(raw_table(spark, TESTDATA, "order_payments")))
    assert "partial_min_by" in text and "partial_sum" in text


def test_payments_are_shuffled_once_and_sorted_after_it(spark):
    payments = marked_payments(raw_table(spark, TESTDATA, "order_payments"))
    text = plan(payments_delta(payments, ""))
    assert text.count("Exchange hashpartitioning") == 1
    below = text[text.index("Exchange hashpartitioning"):]
    assert "Sort" not in below and "Aggregate" not in below


def test_payments_are_sorted_once_to_count_and_once_to_place_them(spark):
    payments = marked_payments(raw_table(spark, TESTDATA, "order_payments"))
    text = plan(payments_delta(payments, "a name"))
    assert len(re.findall(r"\bSort \[", text)) == 2 and len(re.findall(r"\bWindow \[", text)) == 1


def test_orders_that_do_not_repeat_are_not_sorted(spark):
    orders = orders_rows(raw_table(spark, TESTDATA, "orders"))
    deltas = payments_delta(marked_payments(raw_table(spark, TESTDATA, "order_payments")), "")
    time = spark.createDataFrame([], "date_actual date, date_id int")
    text = plan(orders_batch(orders, deltas.withColumn("arrival", F.lit(1)), time))
    # Only rows under a repeated hash are reduced.
    assert "LeftAnti" in text and "LeftSemi" in text
    assert text.index("partial_max_by") < text.rindex("LeftSemi")


def _stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def _hot_orders(spark, n: int):
    """Payments of which a third belong to one order."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("boleto").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("id").cast("decimal(18,2)").alias("payment_value"),
        F.struct("id").alias(ROW_ORDER),
    )


def test_an_order_with_a_third_of_the_payments_is_split(
    spark, no_broadcast, skew_from_little, tmp_path
):
    payments = _stored(_hot_orders(spark, 30_000), tmp_path / "payments")
    orders = _stored(
        payments.select("order_id").distinct().withColumn(ROW_ORDER, F.lit(1)), tmp_path / "orders"
    )
    detail = orders_payments_detail(orders, payments)
    assert "skew=true" in final_plan(detail)
    assert detail.count() == 30_000
    assert detail.where("order_id = 'hot'").count() == 10_000
    assert payments_rollup(payments).where("order_id = 'hot'").count() == 1


def test_hot_products_are_split_in_the_seller_mart(spark, no_broadcast, skew_from_little, tmp_path):
    items = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("product_id"),
        F.col("id").cast("string").alias("order_id"),
        F.lit("s").alias("seller_id"),
        F.lit(1).cast("decimal(18,2)").alias("price"),
        F.lit(0).cast("decimal(18,2)").alias("freight_value"),
    )
    items = _stored(items, tmp_path / "items")
    mart = marts.seller_performance(
        {
            "fact_order_items": items,
            "dim_products": _stored(items.select("product_id").distinct(), tmp_path / "products"),
            "dim_sellers": spark.createDataFrame([("s", 1)], "seller_id string, geography_id int"),
            "dim_geography": spark.createDataFrame(
                [(1, "SP", "x")], "geography_id int, state string, city string"
            ),
        }
    )
    assert "skew=true" in final_plan(mart)
    row = mart.first()
    assert (row.total_orders, row.unique_products_sold, int(row.total_revenue)) == (40_000, 501, 40_000)


def test_bucketed_facts_join_without_a_shuffle(spark, no_broadcast, rows):
    house = warehouse(spark, TESTDATA)
    catalog.create_tables(spark, "buckets", house)
    catalog.bucket_facts(spark, "buckets", house, 4)
    star = house.star()
    expected = rows(explorations.delivery_by_seller(star))
    assert "hashpartitioning(order_id" in plan(explorations.delivery_by_seller(star))
    for name in ("fact_orders", "fact_order_items"):
        star[name] = spark.table(f"buckets.{name}_by_order")
    bucketed = explorations.delivery_by_seller(star)
    assert "hashpartitioning(order_id" not in plan(bucketed)
    assert rows(bucketed) == expected


def test_histogram_reads_the_bounds_once(spark):
    items = raw_table(spark, TESTDATA, "order_items")
    text = final_plan(profile.histogram(items, "price"))
    scans = text.split("== Initial Plan ==")[0].count("FileScan")
    assert scans <= 2
