"""The supplied benchmark tables read as the raw marketplace tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.schemas import MONEY, ROW_ORDER


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _zip(nation: str, key: str, places: int):
    return F.lpad((F.col(nation) * 100 + F.col(key) % places).cast("string"), 5, "0")


def _customers_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 nations and 5 regions: both are fixed lists, whatever the scale of the other tables.
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = read_table(spark, sf_dir, "customer")
    return customer.join(place, customer.c_nationkey == place.n_nationkey).withColumn(
        "state",
        F.concat(F.substring("r_name", 1, 1), F.char(F.lit(97) + F.col("n_nationkey"))),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers_with_place(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        # Geography has four of the five: every fifth customer has no place.
        _zip("c_nationkey", "c_custkey", 5).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.struct("c_custkey").alias(ROW_ORDER),
    )


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _customers_with_place(spark, sf_dir)
        .select(
            _zip("c_nationkey", "c_custkey", 4).alias("geolocation_zip_code_prefix"),
            (F.col("c_acctbal") / 1000).alias("geolocation_lat"),
            (F.col("c_acctbal") / -2000).alias("geolocation_lng"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("geolocation_city"),
            F.col("state").alias("geolocation_state"),
            F.struct("c_custkey").alias(ROW_ORDER),
        )
    )


def _sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        _zip("s_nationkey", "s_suppkey", 5).alias("seller_zip_code_prefix"),
        F.struct("s_suppkey").alias(ROW_ORDER),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        # Every seventh product is of a category without a translation.
        F.when(F.col("p_partkey") % 7 == 3, "UNLISTED")
        .otherwise(F.col("p_type"))
        .alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        F.length("p_name").cast("double").alias("product_description_lenght"),
        (size % 5).cast("double").alias("product_photos_qty"),
        F.when(size % 10 != 0, size * 100).cast("double").alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 7).cast("double").alias("product_height_cm"),
        (size % 11 + 1).cast("double").alias("product_width_cm"),
        F.struct("p_partkey").alias(ROW_ORDER),
    )


def _category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "part")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
        .distinct()
        .withColumn(ROW_ORDER, F.struct("product_category_name"))
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = F.col("o_orderdate").cast("timestamp_ntz")
    key = F.col("o_orderkey")
    delivered = bought + F.make_dt_interval(
        days=(key % 30).cast("int"), hours=(key % 24).cast("int")
    )
    return read_table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        (bought + F.make_dt_interval(days=F.lit(1))).alias("order_approved_at"),
        (bought + F.make_dt_interval(days=(key % 5).cast("int"))).alias(
            "order_delivered_carrier_date"
        ),
        F.when(F.col("o_orderstatus") != "P", delivered).alias("order_delivered_customer_date"),
        (bought + F.make_dt_interval(days=F.lit(20))).alias("order_estimated_delivery_date"),
        F.struct("o_orderkey").alias(ROW_ORDER),
    )


# All columns of lineitem that reach a raw table.
LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
    "l_quantity", "l_returnflag",
]


def _line_order():
    # Lines of an order that share these columns are the same in every result.
    return F.struct(*LINE_COLUMNS[1:]).alias(ROW_ORDER)


def _list_price():
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Factors become decimals before they are multiplied: a double product rounds half cents
    # differently from engine to engine.
    value = _list_price() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    flag = F.col("l_returnflag")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .when(flag == "R", "voucher")
        .alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        value.cast(MONEY).alias("payment_value"),
        _line_order(),
    )


def _order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of_lines(read_table(spark, sf_dir, "lineitem"))


def items_of_lines(lines: DataFrame) -> DataFrame:
    """Rows of lineitem as raw order items."""
    return lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat_ws(
            "-",
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            (_list_price() * 100).cast("bigint").cast("string"),
        ).alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _list_price().cast(MONEY).alias("price"),
        (_list_price() * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("freight_value"),
        _line_order(),
    )


_RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": _customers,
    "geography": _geography,
    "orders": _orders,
    "products": _products,
    "category_translation": _category_translation,
    "sellers": _sellers,
    "order_payments": _order_payments,
    "order_items": _order_items,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _RAW[name](spark, sf_dir)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name) for name in _RAW}


SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def source_files(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the table files' paths, sizes and times; their content is not read."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    row = (
        spark.read.format("binaryFile")
        .load(paths)
        .agg(
            F.count("*"),
            F.sum("length"),
            F.sum(F.xxhash64("path", "length", "modificationTime") % 2**31),
        )
        .first()
    )
    return "-".join(str(value) for value in row)
