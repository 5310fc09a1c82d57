"""Every query by name, as a function of the session and the folder of the supplied tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.cleaning import clean_dates, clean_numbers
from bazaar.operators import profile, quality
from bazaar.operators.quantiles import box_plot, describe
from bazaar.operators.upsert import reduce_batch, upsert
from bazaar.plans import analysis, dimensions, explorations, facts, marts
from bazaar.plans.warehouse import Warehouse, with_needs
from bazaar.schemas import PRODUCT_MEASURES, ROW_ORDER, TABLES
from bazaar.sources.storage import VersionedTable, shared_folder, stage, staging
from bazaar.sources.tables import LINE_COLUMNS, items_of_lines, raw_table, raw_tables, read_table, source_files
from bazaar.streaming.incremental import upsert_new_files

Query = Callable[[SparkSession, str], DataFrame]

_RUN_TS = datetime(2024, 1, 1)
_warehouses: dict[tuple[str, str, str], tuple[Warehouse, set[str]]] = {}
_lock = Lock()


def warehouse(spark: SparkSession, sf_dir: str, tables: Sequence[str] | None = None) -> Warehouse:
    """The star schema built from the supplied tables, each table once per session and input."""
    wanted = with_needs(list(TABLES) if tables is None else tables)
    key = (spark.sparkContext.applicationId, sf_dir, source_files(spark, sf_dir))
    with _lock:
        if key not in _warehouses:
            root = f"{shared_folder(spark)}/bazaar-warehouse/{uuid4().hex}"
            _warehouses[key] = (Warehouse(spark, root, _RUN_TS), set())
        house, present = _warehouses[key]
        missing = [name for name in wanted if name not in present]
        if missing:
            house.load_only(raw_tables(spark, sf_dir), missing)
            present.update(missing)
    return house


def emit(df: DataFrame) -> DataFrame:
    """Drop technical columns and show money as doubles."""
    shown = [
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
        if f.name not in (ROW_ORDER, "created_at")
    ]
    return df.select(shown)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


_MOMENTS = {"std": 4, "p25": 6, "p50": 6, "p75": 6}


def _star(build: Callable[[dict[str, DataFrame]], DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: emit(build(warehouse(spark, sf_dir, tables).star()))


def _stored(name: str) -> Query:
    return lambda spark, sf_dir: emit(warehouse(spark, sf_dir, [name]).table(name))


def _raw(build: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: emit(build(*[raw_table(spark, sf_dir, n) for n in names]))


# Sources and cleaning


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables, of which two lack columns."""
    raw = raw_tables(spark, sf_dir)
    raw["customers"] = raw["customers"].drop("customer_state")
    raw["products"] = raw["products"].drop("product_weight_g", "product_photos_qty")
    return quality.contract_report(raw)


def dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in six ways, good and bad."""
    key, text = F.col("o_orderkey"), F.col("o_orderdate").cast("string")
    return read_table(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        F.when(key % 6 == 0, text)
        .when(key % 6 == 1, F.substring(text, 1, 10))
        .when(key % 6 == 2, "invalid_date")
        .when(key % 6 == 3, "2024")
        .when(key % 6 == 4, "01/02/2024")
        .alias("order_date"),
    )


def dirty_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes written in seven ways, good and bad."""
    key, text = F.col("p_partkey"), F.col("p_size").cast("string")
    return read_table(spark, sf_dir, "part").select(
        key.alias("part_key"),
        F.when(key % 7 == 0, text)
        .when(key % 7 == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(key % 7 == 2, F.concat(text, F.lit("e2")))
        .when(key % 7 == 3, F.concat(text, F.lit("d")))
        .when(key % 7 == 4, "x")
        .when(key % 7 == 5, "NaN")
        .alias("size"),
    )


def dirty_products(products: DataFrame) -> DataFrame:
    """Products with missing keys, overlong categories and weights that are words."""
    length = F.col("product_length_cm")
    return products.withColumns(
        {
            "product_id": F.when(length % 10 != 1, F.col("product_id")),
            "product_category_name": F.when(
                length % 10 == 3, F.repeat("product_category_name", F.lit(30))
            ).otherwise(F.col("product_category_name")),
            "product_weight_g": F.when(length % 10 == 7, "heavy").otherwise(
                F.col("product_weight_g").cast("string")
            ),
        }
    )


def quarantine_split(products: DataFrame, translation: DataFrame) -> DataFrame:
    rows = dimensions.products_batch(dirty_products(products), translation)
    rules = quality.rules_for(TABLES["dim_products"]) + dimensions.products_rules()
    return quality.bad_rows(rows, rules, "dim_products", ["product_id"])


def quarantine_facts(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Items and payments of which some have words for numbers, and payments without an order."""
    digit = F.col("order_id").cast("bigint") % 10

    def worded(df: DataFrame, column: str, at: int, word: str) -> DataFrame:
        return df.withColumn(
            column, F.when(digit == at, word).otherwise(F.col(column).cast("string"))
        )

    items = worded(worded(items, "price", 3, "bad"), "freight_value", 7, "x")
    payments = worded(worded(payments, "payment_value", 1, "1,5"), "payment_installments", 8, "two")
    payments = payments.withColumn("order_id", F.when(digit != 5, F.col("order_id")))
    rules = quality.rules_for(TABLES["fact_order_items"]) + facts.items_rules()
    return quality.bad_rows(
        facts.items_rows(items), rules, "fact_order_items", ["order_id", "order_item_id"]
    ).unionByName(
        quality.bad_rows(
            facts.marked_payments(payments), facts.payments_rules(), "order_payments", ["order_id"]
        )
    )


def geography_keys(star: dict[str, DataFrame]) -> DataFrame:
    return star["dim_geography"].select("zip_code_prefix", "geography_id")


# Upserts


def upsert_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to 1997 form the target, later ones the batch, per customer.

    Status and price are updated from a customer's last order, and the price of urgent orders is
    missing; the first order's id and date are kept.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("price"),
        F.col("o_orderkey").alias("first_order"),
        F.col("o_orderdate").alias("first_date"),
        F.struct("o_orderdate", "o_orderkey").alias(ROW_ORDER),
    )
    keys, update = ["customer_key"], ["order_status", "price"]
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    target = reduce_batch(orders.where(F.col("first_date") < cut), keys, update)
    batch = reduce_batch(orders.where(F.col("first_date") >= cut), keys, update)
    return upsert(target, batch, keys, update)


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land as files in two parts, with a run after each: the later one updates the rows
    of users that are stored."""
    events = read_table(spark, sf_dir, "events")
    root = f"{shared_folder(spark)}/bazaar-incremental/{uuid4().hex}"
    users = VersionedTable(spark, f"{root}/users", events.schema)
    first, last = events.agg(
        F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))
    ).first()
    later = F.unix_micros(F.col("ts").cast("timestamp")) > ((first or 0) + (last or 0)) // 2
    for part in (events.where(~later | later.isNull()), events.where(later)):
        part.write.mode("append").parquet(f"{root}/landing")
        found = upsert_new_files(
            spark,
            f"{root}/landing",
            events.schema,
            users,
            keys=["user_id"],
            update=["event_type", "value", "props"],
            order=["ts", "event_id"],
            checkpoint=f"{root}/checkpoint",
        )
    return found


def incremental_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded with some of their payments, to which the others are added later."""
    raw = raw_tables(spark, sf_dir)
    first = F.col("payment_installments") % 2 == 0
    house = Warehouse(spark, f"{shared_folder(spark)}/bazaar-payments/{uuid4().hex}", _RUN_TS)
    payments = raw["order_payments"]
    house.load_only(
        {"orders": raw["orders"], "order_payments": payments.where(first)},
        ["dim_time", "fact_orders"],
    )
    house.add_payments(payments.where(~first), ["later"])
    orders = house.table("fact_orders")
    return emit(orders.select("order_id", "total_amount", "payment_installments"))


def resent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after payments and orders have come in several batches and partly again.

    Finished orders are loaded with some payments, also such of other orders; the other payments
    are added; all orders are sent without any payment, then the finished ones with the first
    payments once more.
    """
    raw = raw_tables(spark, sf_dir)
    orders, payments = raw["orders"], raw["order_payments"]
    first = F.col("payment_installments") % 2 == 0
    early = orders.where(F.col("order_status") == "F")
    house = Warehouse(spark, f"{shared_folder(spark)}/bazaar-resent/{uuid4().hex}", _RUN_TS)

    def send(orders: DataFrame, payments: DataFrame) -> None:
        house.load_only({"orders": orders, "order_payments": payments}, ["dim_time", "fact_orders"])

    send(early, payments.where(first))
    house.add_payments(payments.where(~first), ["later"])
    send(orders, payments.limit(0))
    send(early, payments.where(first))
    found = house.table("fact_orders")
    return emit(found.select("order_id", "total_amount", "payment_installments"))


MART_KEYS = {
    "daily_revenue": ["date_actual"],
    "monthly_revenue": ["year", "month"],
    "orders_by_region": ["state", "city"],
    "seller_performance": ["seller_id", "seller_state", "seller_city"],
    "delivery_performance": ["year", "month", "state"],
}


def refreshed_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stored marts, a row for each measure, refreshed after each of two loads.

    Finished orders and their items come first, the others second: they touch only the later months.
    """
    raw = raw_tables(spark, sf_dir)
    orders = raw["orders"]
    finished = F.col("order_status") == "F"
    house = Warehouse(spark, f"{shared_folder(spark)}/bazaar-refreshed/{uuid4().hex}", _RUN_TS)
    house.load_only(raw, [name for name, table in TABLES.items() if table.partition is None])
    payments = raw["order_payments"]
    parts = {"_finished": finished, "_open": ~finished}
    # A load reads its items several times: their lines, which are narrower, meet their orders once,
    # for both parts, and lie apart by part.
    marks = orders.groupBy(F.col(f"{ROW_ORDER}.o_orderkey").alias("l_orderkey")).agg(
        *(F.bool_or(c).alias(mark) for mark, c in parts.items())
    )
    lines = read_table(spark, sf_dir, "lineitem").select(LINE_COLUMNS)
    with staging(spark):
        sold = stage(lines.join(marks, "l_orderkey"), "sold", [*parts])
        for mark, of_part in parts.items():
            sent = {
                "orders": orders.where(of_part),
                "order_items": items_of_lines(sold.where(mark)),
                "order_payments": payments,
            }
            house.load_only(sent, ["fact_orders", "fact_order_items"])
            house.refresh_marts()
            payments = payments.limit(0)
    shown = []
    for name, keys in MART_KEYS.items():
        mart = house.mart(name)
        measures = [c for c in mart.columns if c not in keys]
        values = F.array(
            *(F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures)
        )
        key = F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("group_key")
        shown.append(mart.select(F.lit(name).alias("mart"), key, F.inline(values)))
    return quality.union_all(shown)


# Profiles


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_all(
        profile.table_profile(df, name) for name, df in raw_tables(spark, sf_dir).items()
    )


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_all(
        profile.null_counts(df, name) for name, df in raw_tables(spark, sf_dir).items()
    )


def describe_delivery(orders: DataFrame) -> DataFrame:
    delays = describe(facts.orders_with_delay(orders), ["delivery_delay"])
    return _rounded(delays, mean=6, **_MOMENTS)


def describe_products(products: DataFrame) -> DataFrame:
    columns = [*PRODUCT_MEASURES, "density"]
    return _rounded(describe(dimensions.product_density(products), columns), mean=6, **_MOMENTS)


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of the columns whose variety matters."""
    return quality.union_all(
        profile.distinct_counts(raw_table(spark, sf_dir, table), columns).select(
            F.lit(table).alias("table_name"), "column_name", "n_distinct"
        )
        for table, columns in (
            ("products", ["product_category_name"]),
            ("order_payments", ["order_id", "payment_type"]),
            ("order_items", ["order_id", "product_id", "seller_id"]),
        )
    )


# Gates


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys of the raw tables that have one, and of all stored tables."""
    raw = [
        quality.duplicate_keys(raw_table(spark, sf_dir, table), table, key)
        for table, key in (
            ("geography", ["geolocation_zip_code_prefix"]),
            ("customers", ["customer_id"]),
            ("products", ["product_id"]),
            ("category_translation", ["product_category_name"]),
            ("sellers", ["seller_id"]),
            ("orders", ["order_id"]),
            ("order_items", ["order_id", "order_item_id"]),
        )
    ]
    star = warehouse(spark, sf_dir).star()
    stored = [quality.duplicate_keys(star[t.name], t.name, t.key) for t in TABLES.values()]
    return quality.union_all(raw + stored)


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {name: raw_table(spark, sf_dir, name) for name in raw_tables(spark, sf_dir)}
    zips = raw["geography"], "geolocation_zip_code_prefix"
    loose = [
        quality.orphan_keys(raw["customers"], "customers", "customer_zip_code_prefix", *zips),
        quality.orphan_keys(raw["sellers"], "sellers", "seller_zip_code_prefix", *zips),
        quality.orphan_keys(
            raw["products"],
            "products",
            "product_category_name",
            raw["category_translation"],
            "product_category_name",
        ),
        quality.orphan_keys(raw["orders"], "orders", "order_id", raw["order_items"], "order_id"),
    ]
    star = warehouse(spark, sf_dir).star()
    enforced = [
        quality.orphan_keys(star[name], name, column, star[parent], parent_key)
        for name, table in TABLES.items()
        for column, parent, parent_key in table.references
    ]
    return quality.union_all(loose + enforced)


def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lengths of the stored tables, and of products before bad rows are set apart."""
    star = warehouse(spark, sf_dir).star()
    rows = dirty_products(raw_table(spark, sf_dir, "products"))
    return quality.union_all(
        [
            quality.length_report(star[name], name, table.limits)
            for name, table in TABLES.items()
            if table.limits
        ]
        + [quality.length_report(rows, "dirty products", [("product_category_name", 100)])]
    )


_REVENUE = ("fact_orders", "dim_time")
_REGION = ("fact_orders", "dim_customers", "dim_geography")
_SELLER = ("fact_order_items", "dim_sellers", "dim_geography", "dim_products")
_DELIVERY = (*_REGION, "dim_time")


def queries() -> dict[str, Query]:
    return {
        # Marts
        "daily_revenue": _star(marts.daily_revenue, *_REVENUE),
        "monthly_revenue": _star(marts.monthly_revenue, *_REVENUE),
        "orders_by_region": _star(marts.orders_by_region, *_REGION),
        "seller_performance": _star(marts.seller_performance, *_SELLER),
        "delivery_performance": _star(marts.delivery_performance, *_DELIVERY),
        # Explorations
        "top_products": _star(explorations.top_products, "fact_order_items", "dim_products"),
        "top_sellers": _star(explorations.top_sellers, *_SELLER),
        "region_ranking": _star(explorations.region_ranking, *_REGION),
        "quarterly_revenue": _star(explorations.quarterly_revenue, *_REVENUE),
        "yearly_growth": _star(explorations.yearly_growth, *_REVENUE),
        "slowest_states": _star(explorations.slowest_states, *_REGION),
        "delivery_by_seller": _star(
            explorations.delivery_by_seller,
            "fact_orders",
            "fact_order_items",
            "dim_sellers",
            "dim_geography",
        ),
        # Mergeable aggregates
        "distinct_orders_rollup": _star(
            analysis.distinct_orders_rollup,
            "fact_orders",
            "fact_order_items",
            "dim_sellers",
            "dim_geography",
            "dim_time",
        ),
        "price_quantiles_approx": _star(analysis.price_quantiles_approx, "fact_order_items"),
        # Warehouse tables
        **{name: _stored(name) for name in TABLES},
        "geography_keys": _star(geography_keys, "dim_geography"),
        "row_counts": _star(quality.row_counts, *TABLES),
        # Sources, cleaning and lookups
        "schema_contract": schema_contract,
        "clean_dates": lambda spark, sf_dir: clean_dates(
            dirty_dates(spark, sf_dir), ["order_date", "no_such_column"]
        ),
        "clean_numeric": lambda spark, sf_dir: clean_numbers(
            dirty_numbers(spark, sf_dir), ["size", "no_such_column"]
        ),
        "quarantine_facts": _raw(quarantine_facts, "order_items", "order_payments"),
        "quarantine_split": _raw(quarantine_split, "products", "category_translation"),
        "geo_first_per_zip": _raw(dimensions.first_place_per_zip, "geography"),
        "geo_standardised": _raw(dimensions.standard_places, "geography"),
        "customers_standardised": _raw(dimensions.standard_customers, "customers"),
        "products_translated": _raw(
            dimensions.translated_products, "products", "category_translation"
        ),
        "products_filled": _raw(dimensions.filled_products, "products"),
        "product_density": _raw(dimensions.product_density, "products"),
        "orders_delivery_delay": _raw(facts.orders_with_delay, "orders"),
        "orders_payments_detail": _raw(facts.orders_payments_detail, "orders", "order_payments"),
        "payments_rollup": _raw(facts.payments_rollup, "order_payments"),
        # Upserts
        "upsert_semantics": upsert_semantics,
        "incremental_upsert": incremental_upsert,
        "incremental_payments": incremental_payments,
        "resent_orders": resent_orders,
        "refreshed_marts": refreshed_marts,
        # Profiles
        "table_profile": table_profile,
        "null_counts": null_counts,
        "status_distribution": _raw(
            lambda orders: profile.distribution(orders, "order_status"), "orders"
        ),
        "payment_type_distribution": _raw(
            lambda payments: _rounded(profile.distribution(payments, "payment_type"), percent=2),
            "order_payments",
        ),
        "installments_distribution": _raw(
            lambda payments: profile.group_sizes(payments, "payment_installments").orderBy(
                "payment_installments"
            ),
            "order_payments",
        ),
        "items_per_order": _raw(
            lambda items: profile.group_sizes(items, "order_id"), "order_items"
        ),
        "items_per_order_distribution": _raw(
            lambda items: profile.size_distribution(items, "order_id"), "order_items"
        ),
        "describe_delivery": _raw(describe_delivery, "orders"),
        "describe_items": _raw(
            lambda items: _rounded(analysis.items_describe(items), **_MOMENTS), "order_items"
        ),
        "describe_products": _raw(describe_products, "products"),
        "describe_payments": _raw(
            lambda payments: _rounded(describe(payments, ["payment_value"]), **_MOMENTS),
            "order_payments",
        ),
        "order_totals_describe": _raw(
            lambda payments: _rounded(analysis.order_totals_describe(payments), **_MOMENTS),
            "order_payments",
        ),
        "price_stats": _raw(
            lambda items: _rounded(analysis.price_stats(items), median=6), "order_items"
        ),
        "distinct_counts": distinct_counts,
        "price_histogram": _raw(
            lambda items: profile.histogram(facts.items_rows(items), "price"), "order_items"
        ),
        "delivery_histogram": _raw(
            lambda orders: profile.histogram(facts.orders_with_delay(orders), "delivery_delay"),
            "orders",
        ),
        "weight_histogram": _raw(
            lambda products: profile.histogram(products, "product_weight_g"), "products"
        ),
        "payment_histogram": _raw(
            lambda payments: profile.histogram(payments, "payment_value"), "order_payments"
        ),
        "volume_weight_grid": _raw(
            lambda products: profile.grid(
                dimensions.product_density(products), "volume", "product_weight_g"
            ),
            "products",
        ),
        "scatter_sample": _raw(
            lambda products: profile.grid_sample(
                dimensions.product_density(products), "volume", "product_weight_g", ["product_id"], 5
            ),
            "products",
        ),
        "installments_value_grid": _raw(
            lambda payments: profile.grid(payments, "payment_installments", "payment_value"),
            "order_payments",
        ),
        "product_boxplot": _raw(
            lambda products: _rounded(
                box_plot(products, ["product_length_cm", "product_height_cm", "product_width_cm"]),
                p25=6,
                p50=6,
                p75=6,
            ),
            "products",
        ),
        "monthly_orders_gapfilled": _raw(
            lambda orders: profile.monthly_counts(
                facts.orders_with_delay(orders), "order_purchase_timestamp"
            ),
            "orders",
        ),
        "seller_sales": _raw(analysis.seller_sales, "order_items"),
        "top_sellers_by_sales": _raw(analysis.top_sellers_by_sales, "order_items"),
        "payment_by_type": _raw(
            lambda payments: analysis.payments_by(payments, "payment_type"), "order_payments"
        ),
        "payment_by_installments": _raw(
            lambda payments: analysis.payments_by(payments, "payment_installments"),
            "order_payments",
        ),
        "top_categories": _raw(
            lambda products, translation: profile.top_values(
                dimensions.translated_products(products, translation),
                "product_category_name_english",
                20,
            ),
            "products",
            "category_translation",
        ),
        # Gates
        "duplicate_keys": duplicate_keys,
        "orphan_keys": orphan_keys,
        "length_violations": length_violations,
    }
