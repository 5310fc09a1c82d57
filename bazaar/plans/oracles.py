"""The same results in plain SQL over the supplied tables, to check the queries against."""

from __future__ import annotations

import re

from bazaar.schemas import TABLES

# Named subqueries; a query gets those it mentions, and those they mention.
_PARTS: dict[str, str] = {
    # Raw tables
    "place": """
        SELECT n_nationkey, n_name, substr(r_name, 1, 1) || chr(97 + n_nationkey) AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_nationkey * 100 + c_custkey % 5 AS VARCHAR), 5, '0')
                   AS customer_zip_code_prefix,
               n_name AS customer_city, state AS customer_state
        FROM customer JOIN place ON c_nationkey = n_nationkey""",
    "raw_geography": """
        SELECT lpad(CAST(c_nationkey * 100 + c_custkey % 4 AS VARCHAR), 5, '0')
                   AS geolocation_zip_code_prefix,
               c_acctbal / 1000 AS geolocation_lat, c_acctbal / -2000 AS geolocation_lng,
               ' ' || n_name || ' ' AS geolocation_city, state AS geolocation_state,
               c_custkey AS row_order
        FROM customer JOIN place ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_nationkey * 100 + s_suppkey % 5 AS VARCHAR), 5, '0')
                   AS seller_zip_code_prefix
        FROM supplier""",
    "raw_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 7 = 3 THEN 'UNLISTED' ELSE p_type END AS product_category_name,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               CAST(length(p_name) AS DOUBLE) AS product_description_lenght,
               CAST(p_size % 5 AS DOUBLE) AS product_photos_qty,
               CAST(CASE WHEN p_size % 10 <> 0 THEN p_size * 100 END AS DOUBLE)
                   AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size % 7 AS DOUBLE) AS product_height_cm,
               CAST(p_size % 11 + 1 AS DOUBLE) AS product_width_cm
        FROM part""",
    "raw_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part""",
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER))
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'P'
                    THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER))
                         + to_hours(CAST(o_orderkey % 24 AS INTEGER)) END
                   AS order_delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "raw_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                                 WHEN 'R' THEN 'voucher' END AS payment_type,
               CAST(l_quantity AS INTEGER) AS payment_installments,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS payment_value,
               l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               l_discount, l_tax, l_quantity, l_returnflag
        FROM lineitem""",
    "raw_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               concat_ws('-', l_linenumber, l_partkey, l_suppkey,
                         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT))
                   AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
                    AS DECIMAL(18,2)) AS freight_value
        FROM lineitem""",
    # Star schema
    "first_places": """
        SELECT * EXCLUDE (row_order, place_rank) FROM (
            SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                                         ORDER BY row_order) AS place_rank
            FROM raw_geography) WHERE place_rank = 1""",
    "geography": """
        SELECT CAST(row_number() OVER (ORDER BY geolocation_zip_code_prefix) AS INTEGER)
                   AS geography_id,
               geolocation_zip_code_prefix AS zip_code_prefix,
               trim(lower(geolocation_city)) AS city, trim(upper(geolocation_state)) AS state,
               CAST(geolocation_lat AS DECIMAL(9,6)) AS latitude,
               CAST(geolocation_lng AS DECIMAL(9,6)) AS longitude
        FROM first_places""",
    "star_customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
               geography_id
        FROM raw_customers LEFT JOIN geography ON customer_zip_code_prefix = zip_code_prefix""",
    "star_sellers": """
        SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, geography_id
        FROM raw_sellers LEFT JOIN geography ON seller_zip_code_prefix = zip_code_prefix""",
    "star_products": """
        SELECT product_id, product_category_name AS category_name,
               product_category_name_english AS category_name_english,
               CAST(coalesce(product_weight_g, 0) AS INTEGER) AS product_weight_g,
               product_length_cm, product_height_cm, product_width_cm,
               CAST(product_photos_qty AS INTEGER) AS product_photos_qty
        FROM raw_products LEFT JOIN raw_translation USING (product_category_name)""",
    "star_time": """
        SELECT CAST(row_number() OVER (ORDER BY date_actual) AS INTEGER) AS date_id, date_actual,
               CAST(year(date_actual) AS INTEGER) AS year,
               CAST(month(date_actual) AS INTEGER) AS month,
               CAST(day(date_actual) AS INTEGER) AS day,
               CAST(quarter(date_actual) AS INTEGER) AS quarter,
               CAST(weekofyear(date_actual) AS INTEGER) AS week,
               isodow(date_actual) >= 6 AS is_weekend
        FROM (SELECT CAST(order_purchase_timestamp AS DATE) AS date_actual FROM raw_orders
              UNION SELECT CAST(order_delivered_customer_date AS DATE) FROM raw_orders
              UNION SELECT CAST(order_estimated_delivery_date AS DATE) FROM raw_orders)
        WHERE date_actual IS NOT NULL""",
    "rollup_payments": """
        SELECT order_id, sum(payment_value) AS payment_value,
               max(payment_installments) AS payment_installments,
               first(payment_type ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                                           l_discount, l_tax, l_quantity, l_returnflag)
                   AS payment_type
        FROM raw_payments GROUP BY order_id""",
    "delays": """
        SELECT order_id, date_diff('microsecond', order_purchase_timestamp,
                                   order_delivered_customer_date) AS micros,
               micros / 86400e6 AS delivery_delay
        FROM raw_orders""",
    "star_orders": """
        SELECT order_id, customer_id, date_id, order_status,
               order_purchase_timestamp AS purchase_timestamp, order_approved_at AS approved_at,
               order_delivered_carrier_date AS delivered_carrier_date,
               order_delivered_customer_date AS delivered_customer_date,
               order_estimated_delivery_date AS estimated_delivery_date,
               CAST(coalesce(payment_value, 0) AS DECIMAL(18,2)) AS total_amount, payment_type,
               payment_installments, delivery_delay, micros,
               CAST(year(order_purchase_timestamp) * 100 + month(order_purchase_timestamp)
                    AS INTEGER) AS purchase_month
        FROM raw_orders JOIN delays USING (order_id) LEFT JOIN rollup_payments USING (order_id)
        LEFT JOIN star_time ON date_actual = CAST(order_purchase_timestamp AS DATE)""",
    "star_items": """
        SELECT raw_items.*, coalesce(purchase_month, 0) AS purchase_month
        FROM raw_items LEFT JOIN star_orders USING (order_id)""",
    "seller_mart": """
        SELECT seller_id, state AS seller_state, city AS seller_city,
               count(DISTINCT order_id) AS total_orders,
               count(DISTINCT product_id) AS unique_products_sold,
               CAST(sum(price) AS DOUBLE) AS total_revenue,
               CAST(sum(price) AS DOUBLE) / count(price) AS average_order_value,
               CAST(sum(freight_value) AS DOUBLE) AS total_freight_value
        FROM star_items JOIN star_sellers USING (seller_id) JOIN geography USING (geography_id)
        JOIN star_products USING (product_id)
        GROUP BY seller_id, state, city""",
    "region_mart": """
        SELECT state, city, count(DISTINCT order_id) AS number_of_orders,
               count(DISTINCT customer_id) AS number_of_customers,
               CAST(sum(total_amount) AS DOUBLE) AS total_revenue
        FROM star_orders JOIN star_customers USING (customer_id)
        JOIN geography USING (geography_id)
        GROUP BY state, city""",
    "translated": """
        SELECT * FROM raw_products LEFT JOIN raw_translation USING (product_category_name)""",
    "dense": """
        SELECT *, product_length_cm * product_height_cm * product_width_cm AS volume,
               product_weight_g / nullif(volume, 0) AS density
        FROM raw_products""",
    "dirty": """
        SELECT CASE WHEN product_length_cm % 10 <> 1 THEN product_id END AS product_id,
               CASE WHEN product_length_cm % 10 = 3 THEN repeat(product_category_name, 30)
                    ELSE product_category_name END AS product_category_name,
               product_length_cm % 10 = 7 AS heavy
        FROM raw_products""",
}


def _moments(source: str, column: str, mean: str, where: str = "TRUE") -> str:
    return f"""
        SELECT '{column}' AS column_name, count({column}) AS n, {mean} AS mean,
               round(stddev_samp(CAST({column} AS DOUBLE)), 4) AS std,
               CAST(min({column}) AS DOUBLE) AS min,
               round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS p25,
               round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS p50,
               round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS p75,
               CAST(max({column}) AS DOUBLE) AS max
        FROM {source} WHERE {where}"""


def _exact_mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def _bin(value: str, low: str, high: str, bins: int) -> str:
    guess = f"least(floor(({value} - {low}) / ({high} - {low}) * {bins}), {bins - 1})"
    width = f"(({high} - {low}) / {bins})"
    return f"""CAST(CASE WHEN {value} < {low} + {guess} * {width} THEN {guess} - 1
        WHEN {value} >= {low} + ({guess} + 1) * {width} AND {guess} < {bins - 1} THEN {guess} + 1
        ELSE {guess} END AS INTEGER)"""


def _histogram(source: str, column: str, bins: int = 50) -> str:
    return f"""
        WITH hist_values AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source}
                             WHERE {column} IS NOT NULL),
             hist_bounds AS (SELECT min(v) AS low, max(v) AS high FROM hist_values),
             hist_counts AS (SELECT {_bin('v', 'low', 'high', bins)} AS bin, count(*) AS n
                             FROM hist_values, hist_bounds GROUP BY 1)
        SELECT CAST(i AS INTEGER) AS bin, low + i * ((high - low) / {bins}) AS lower,
               CASE WHEN i = {bins - 1} THEN high
                    ELSE low + (i + 1) * ((high - low) / {bins}) END AS upper,
               coalesce(n, 0) AS n
        FROM range({bins}) AS spine(i) CROSS JOIN hist_bounds LEFT JOIN hist_counts ON bin = i
        ORDER BY 1"""


def _grid(source: str, x: str, y: str, bins: int = 20) -> str:
    return f"""
        WITH grid_values AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y
                             FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
             grid_bounds AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh
                             FROM grid_values)
        SELECT {_bin('x', 'xl', 'xh', bins)} AS x_bin, {_bin('y', 'yl', 'yh', bins)} AS y_bin,
               count(*) AS n
        FROM grid_values, grid_bounds GROUP BY 1, 2 ORDER BY 1, 2"""


def _grid_sample(source: str, x: str, y: str, key: str, n: int, bins: int = 20) -> str:
    return f"""
        WITH grid_values AS (SELECT {key}, CAST({x} AS DOUBLE) AS {x}, CAST({y} AS DOUBLE) AS {y}
                             FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
             grid_bounds AS (SELECT min({x}) AS xl, max({x}) AS xh, min({y}) AS yl, max({y}) AS yh
                             FROM grid_values),
             cells AS (SELECT {key}, {x}, {y}, {_bin(x, 'xl', 'xh', bins)} AS x_bin,
                              {_bin(y, 'yl', 'yh', bins)} AS y_bin FROM grid_values, grid_bounds)
        SELECT * FROM cells QUALIFY row_number() OVER (
            PARTITION BY x_bin, y_bin ORDER BY md5('0|' || {key}), {key}, {x}, {y}) <= {n}"""


def _box(column: str) -> str:
    return f"""
        SELECT '{column}' AS column_name, max(n) AS n,
               least(min(v) FILTER (v BETWEEN low AND high), max(p25)) AS whisker_low,
               round(max(p25), 6) AS p25, round(max(p50), 6) AS p50, round(max(p75), 6) AS p75,
               greatest(max(v) FILTER (v BETWEEN low AND high), max(p75)) AS whisker_high,
               count(*) FILTER (NOT v BETWEEN low AND high) AS n_outliers
        FROM (SELECT {column} AS v FROM raw_products) CROSS JOIN
             (SELECT count({column}) AS n, quantile_cont({column}, 0.25) AS p25,
                     quantile_cont({column}, 0.5) AS p50, quantile_cont({column}, 0.75) AS p75,
                     p25 - 1.5 * (p75 - p25) AS low, p75 + 1.5 * (p75 - p25) AS high
              FROM raw_products)"""


# Column types of the raw tables that are profiled.
_TYPES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "orders": (
        "raw_orders",
        [(c, "string") for c in ("order_id", "customer_id", "order_status")]
        + [
            (c, "timestamp_ntz")
            for c in (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
    ),
    "order_items": (
        "raw_items",
        [(c, "string") for c in ("order_id", "order_item_id", "product_id", "seller_id")]
        + [(c, "decimal(18,2)") for c in ("price", "freight_value")],
    ),
    "products": (
        "raw_products",
        [(c, "string") for c in ("product_id", "product_category_name")]
        + [
            (c, "double")
            for c in (
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            )
        ],
    ),
    "order_payments": (
        "raw_payments",
        [
            ("order_id", "string"),
            ("payment_type", "string"),
            ("payment_installments", "int"),
            ("payment_value", "decimal(18,2)"),
        ],
    ),
    "customers": (
        "raw_customers",
        [
            (c, "string")
            for c in (
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            )
        ],
    ),
    "geography": (
        "raw_geography",
        [
            ("geolocation_zip_code_prefix", "string"),
            ("geolocation_lat", "double"),
            ("geolocation_lng", "double"),
            ("geolocation_city", "string"),
            ("geolocation_state", "string"),
        ],
    ),
    "category_translation": (
        "raw_translation",
        [(c, "string") for c in ("product_category_name", "product_category_name_english")],
    ),
    "sellers": (
        "raw_sellers",
        [(c, "string") for c in ("seller_id", "seller_zip_code_prefix")],
    ),
}

# Columns that the contract query leaves out.
_DROPPED = {"customers": "customer_state", "products": "product_photos_qty,product_weight_g"}

_RAW_NAMES = {
    "customers": "raw_customers",
    "geography": "raw_geography",
    "orders": "raw_orders",
    "products": "raw_products",
    "category_translation": "raw_translation",
    "sellers": "raw_sellers",
    "order_payments": "raw_payments",
    "order_items": "raw_items",
}

_STAR_NAMES = {
    "dim_geography": "geography",
    "dim_customers": "star_customers",
    "dim_products": "star_products",
    "dim_sellers": "star_sellers",
    "dim_time": "star_time",
    "fact_orders": "star_orders",
    "fact_order_items": "star_items",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile(table: str) -> str:
    source, columns = _TYPES[table]
    rows = ", ".join(f"({i}, '{c}', '{kind}')" for i, (c, kind) in enumerate(columns, start=1))
    return f"""
        SELECT '{table}' AS table_name, CAST(i AS INTEGER) AS column_place, c AS column_name,
               k AS data_type, {len(columns)} AS n_columns,
               (SELECT count(*) FROM {source}) AS n_rows
        FROM (VALUES {rows}) AS columns(i, c, k)"""


def _duplicates(table: str, source: str, *key: str) -> str:
    keys = ", ".join(key)
    return f"""
        SELECT '{table}' AS table_name, concat_ws('|', {keys}) AS key_value, count(*) AS n_rows
        FROM {source} GROUP BY {keys} HAVING count(*) > 1"""


def _orphans(table: str, column: str, child: str, parent: str, parent_key: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{column}' AS column_name,
               CAST(c.{column} AS VARCHAR) AS key_value, count(*) AS n_rows
        FROM {child} AS c
        WHERE c.{column} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{parent_key} = c.{column})
        GROUP BY c.{column}"""


def _lengths(table: str, column: str, limit: int) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{column}' AS column_name, {limit} AS max_length,
               CAST(max(length({column})) AS INTEGER) AS longest,
               count(*) FILTER (length({column}) > {limit}) AS n_over
        FROM {_STAR_NAMES[table]}"""


def _payments_by(column: str) -> str:
    return f"""
        SELECT {column},
               CAST(round_even(sum(payment_value) / CAST(count(*) AS DOUBLE), 2) AS DOUBLE)
                   AS mean_value,
               count(payment_value) AS n_payments, CAST(sum(payment_value) AS DOUBLE) AS total_value
        FROM raw_payments GROUP BY {column} ORDER BY {column}"""


_REVENUE = """
    count(DISTINCT order_id) AS number_of_orders,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue"""
_ORDERS_IN_TIME = "star_orders JOIN star_time USING (date_id)"
_MEAN_DELAY = "CAST(sum(micros) AS DOUBLE) / count(micros) / 86400e6 AS avg_delivery_days"

_QUERIES: dict[str, str] = {
    "daily_revenue": f"""
        SELECT date_actual, {_REVENUE} FROM {_ORDERS_IN_TIME}
        GROUP BY date_actual ORDER BY date_actual""",
    "monthly_revenue": f"""
        SELECT year, month, {_REVENUE},
               CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_order_value
        FROM {_ORDERS_IN_TIME} GROUP BY year, month ORDER BY year, month""",
    "orders_by_region": "SELECT * FROM region_mart ORDER BY number_of_orders DESC, state, city",
    "seller_performance": "SELECT * FROM seller_mart ORDER BY total_revenue DESC, seller_id",
    "delivery_performance": f"""
        SELECT year, month, state, {_MEAN_DELAY}, min(delivery_delay) AS min_delivery_days,
               max(delivery_delay) AS max_delivery_days,
               count(CASE WHEN delivery_delay > 7 THEN 1 END) AS deliveries_over_week
        FROM {_ORDERS_IN_TIME} JOIN star_customers USING (customer_id)
        JOIN geography USING (geography_id)
        WHERE delivery_delay IS NOT NULL GROUP BY year, month, state""",
    "top_products": """
        SELECT product_id, category_name, count(DISTINCT order_id) AS total_orders,
               CAST(sum(price) AS DOUBLE) AS total_revenue,
               CAST(sum(price) AS DOUBLE) / count(price) AS avg_order_value
        FROM star_items JOIN star_products USING (product_id)
        GROUP BY product_id, category_name ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "top_sellers": """
        SELECT seller_id, seller_state, total_orders, total_revenue, average_order_value
        FROM seller_mart ORDER BY total_revenue DESC, seller_id LIMIT 10""",
    "region_ranking": """
        SELECT state, city, number_of_orders, total_revenue FROM region_mart
        ORDER BY number_of_orders DESC, state, city""",
    "quarterly_revenue": f"""
        SELECT year, quarter, {_REVENUE} FROM {_ORDERS_IN_TIME}
        GROUP BY year, quarter ORDER BY year, quarter""",
    "yearly_growth": f"""
        SELECT year, CAST(total AS DOUBLE) AS total_revenue,
               CAST(lag(total) OVER (ORDER BY year) AS DOUBLE) AS previous_year_revenue,
               round((total_revenue - previous_year_revenue)
                     / nullif(previous_year_revenue, 0) * 100, 2) AS growth_rate
        FROM (SELECT year, sum(total_amount) AS total FROM {_ORDERS_IN_TIME} GROUP BY year)
        ORDER BY year""",
    "slowest_states": f"""
        SELECT state, {_MEAN_DELAY}, count(order_id) AS total_orders
        FROM star_orders JOIN star_customers USING (customer_id)
        JOIN geography USING (geography_id)
        WHERE delivery_delay IS NOT NULL GROUP BY state
        ORDER BY avg_delivery_days DESC, state LIMIT 5""",
    "delivery_by_seller": f"""
        SELECT seller_id, state AS seller_state, {_MEAN_DELAY}, count(order_id) AS total_orders
        FROM star_orders JOIN raw_items USING (order_id) JOIN star_sellers USING (seller_id)
        JOIN geography USING (geography_id)
        WHERE delivery_delay IS NOT NULL GROUP BY seller_id, state""",
    "dim_geography": """
        SELECT * REPLACE (CAST(latitude AS DOUBLE) AS latitude,
                          CAST(longitude AS DOUBLE) AS longitude) FROM geography""",
    "dim_customers": "SELECT * FROM star_customers",
    "dim_products": "SELECT * FROM star_products",
    "dim_sellers": "SELECT * FROM star_sellers",
    "dim_time": "SELECT * FROM star_time",
    "fact_orders": """
        SELECT * EXCLUDE (micros) REPLACE (CAST(total_amount AS DOUBLE) AS total_amount)
        FROM star_orders""",
    "fact_order_items": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
                          CAST(freight_value AS DOUBLE) AS freight_value) FROM star_items""",
    "geography_keys": "SELECT zip_code_prefix, geography_id FROM geography",
    "row_counts": _union(
        [
            f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}"
            for name, source in _STAR_NAMES.items()
        ]
    ),
    "schema_contract": _union(
        [
            f"SELECT '{name}' AS table_name, '{_DROPPED.get(name, '')}' AS missing_columns, "
            f"count(*) AS n_rows FROM {source}"
            for name, source in _RAW_NAMES.items()
        ]
    ),
    "clean_dates": """
        SELECT o_orderkey AS order_key,
               CASE o_orderkey % 6 WHEN 0 THEN o_orderdate
                                   WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END
                   AS order_date
        FROM orders""",
    "clean_numeric": """
        SELECT p_partkey AS part_key,
               CAST(CASE WHEN p_partkey % 7 IN (0, 1) THEN p_size
                         WHEN p_partkey % 7 = 2 THEN p_size * 100 END AS DOUBLE) AS size
        FROM part""",
    "quarantine_facts": """
        SELECT 'fact_order_items' AS table_name, order_id || '|' || order_item_id AS row_key,
               'price' AS column_name, 'bad' AS raw_value, 'not a number' AS reason
        FROM raw_items WHERE CAST(order_id AS BIGINT) % 10 = 3
        UNION ALL
        SELECT 'fact_order_items', order_id || '|' || order_item_id, 'freight_value', 'x',
               'not a number'
        FROM raw_items WHERE CAST(order_id AS BIGINT) % 10 = 7
        UNION ALL
        SELECT 'order_payments', order_id, 'payment_value', '1,5', 'not a number'
        FROM raw_payments WHERE CAST(order_id AS BIGINT) % 10 = 1
        UNION ALL
        SELECT 'order_payments', order_id, 'payment_installments', 'two', 'not a number'
        FROM raw_payments WHERE CAST(order_id AS BIGINT) % 10 = 8
        UNION ALL
        SELECT 'order_payments', '', 'order_id', NULL, 'missing key'
        FROM raw_payments WHERE CAST(order_id AS BIGINT) % 10 = 5""",
    "quarantine_split": """
        SELECT 'dim_products' AS table_name, coalesce(product_id, '') AS row_key,
               'product_id' AS column_name, CAST(NULL AS VARCHAR) AS raw_value,
               'missing key' AS reason
        FROM dirty WHERE product_id IS NULL
        UNION ALL
        SELECT 'dim_products', coalesce(product_id, ''), 'category_name', product_category_name,
               'longer than 100'
        FROM dirty WHERE length(product_category_name) > 100
        UNION ALL
        SELECT 'dim_products', coalesce(product_id, ''), 'product_weight_g', 'heavy',
               'not a number'
        FROM dirty WHERE heavy""",
    "geo_first_per_zip": "SELECT * FROM first_places",
    "geo_standardised": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS latitude,
               geolocation_lng AS longitude, trim(lower(geolocation_city)) AS city,
               trim(upper(geolocation_state)) AS state
        FROM raw_geography""",
    "customers_standardised": "SELECT * FROM raw_customers",
    "products_translated": "SELECT * FROM translated",
    "products_filled": """
        SELECT * REPLACE (coalesce(product_weight_g, 0) AS product_weight_g) FROM raw_products""",
    "product_density": "SELECT * FROM dense",
    "orders_delivery_delay": """
        SELECT raw_orders.*, delivery_delay FROM raw_orders JOIN delays USING (order_id)""",
    "orders_payments_detail": """
        SELECT raw_orders.*, payment_type, payment_installments,
               CAST(payment_value AS DOUBLE) AS payment_value
        FROM raw_orders LEFT JOIN raw_payments USING (order_id)""",
    "payments_rollup": """
        SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM rollup_payments""",
    "upsert_semantics": """
        SELECT customer_key, last_row.order_status, last_row.price,
               first_row.first_order, first_row.first_date
        FROM (SELECT o_custkey AS customer_key,
                     first({'order_status': o_orderstatus,
                            'price': CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END}
                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS last_row,
                     first({'first_order': o_orderkey, 'first_date': o_orderdate}
                           ORDER BY o_orderdate, o_orderkey) AS first_row
              FROM orders GROUP BY o_custkey)""",
    "incremental_upsert": """
        SELECT first(event_id ORDER BY ts, event_id) AS event_id, min(ts) AS ts, user_id,
               first(event_type ORDER BY ts DESC, event_id DESC) AS event_type,
               first(value ORDER BY ts DESC, event_id DESC) AS value,
               first(props ORDER BY ts DESC, event_id DESC) AS props
        FROM events GROUP BY user_id""",
    "incremental_payments": """
        SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, payment_installments
        FROM star_orders""",
    "distinct_orders_rollup": _union(
        [
            f"SELECT '{level}' AS level, CAST(date_trunc('{level}', date_actual) AS DATE) AS period, "
            "state, count(DISTINCT order_id) AS n_orders "
            "FROM star_orders JOIN star_time USING (date_id) JOIN raw_items USING (order_id) "
            "JOIN star_sellers USING (seller_id) JOIN geography USING (geography_id) GROUP BY ALL"
            for level in ("day", "month", "quarter", "year")
        ]
    ),
    "price_quantiles_approx": """
        SELECT p, (SELECT count(price) FROM raw_items) AS n, TRUE AS within_bound
        FROM (SELECT unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]::DOUBLE[]) AS p)""",
    "resent_orders": """
        SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, payment_installments
        FROM star_orders""",
    "table_profile": _union([_profile(table) for table in _TYPES]),
    "null_counts": _union(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"count(*) - count({c}) AS n_missing FROM {source}"
            for table, (source, columns) in _TYPES.items()
            for c, _ in columns
        ]
    ),
    "status_distribution": """
        SELECT order_status, count(*) AS n,
               count(*) / (SELECT count(*) FROM raw_orders) * 100 AS percent
        FROM raw_orders WHERE order_status IS NOT NULL GROUP BY order_status""",
    "payment_type_distribution": """
        SELECT payment_type, count(*) AS n,
               round(count(*) / (SELECT count(*) FROM raw_payments) * 100, 2) AS percent
        FROM raw_payments WHERE payment_type IS NOT NULL GROUP BY payment_type""",
    "installments_distribution": """
        SELECT payment_installments, count(*) AS n FROM raw_payments
        WHERE payment_installments IS NOT NULL
        GROUP BY payment_installments ORDER BY payment_installments""",
    "items_per_order": "SELECT order_id, count(*) AS n FROM raw_items GROUP BY order_id",
    "items_per_order_distribution": """
        SELECT size, count(*) AS n_groups
        FROM (SELECT count(*) AS size FROM raw_items GROUP BY order_id)
        GROUP BY size ORDER BY size""",
    "describe_delivery": _moments("delays", "delivery_delay", "round(avg(delivery_delay), 6)"),
    "describe_items": _union(
        [
            _moments("raw_items", "price", _exact_mean("price")),
            _moments("raw_items", "freight_value", _exact_mean("freight_value")),
            _moments(
                "(SELECT count(*) AS items_per_order FROM raw_items GROUP BY order_id)",
                "items_per_order",
                _exact_mean("items_per_order"),
            ),
        ]
    ),
    "describe_products": _union(
        [
            _moments("dense", c, f"round(avg({c}), 6)")
            for c in (
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
                "product_photos_qty",
                "density",
            )
        ]
    ),
    "describe_payments": _moments("raw_payments", "payment_value", _exact_mean("payment_value")),
    "order_totals_describe": _moments(
        "(SELECT sum(payment_value) AS order_total FROM raw_payments GROUP BY order_id)",
        "order_total",
        _exact_mean("order_total"),
    ),
    "price_stats": _union(
        [
            f"""
        SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min,
               CAST(max({c}) AS DOUBLE) AS max, {_exact_mean(c)} AS mean,
               round(median(CAST({c} AS DOUBLE)), 6) AS median
        FROM raw_items"""
            for c in ("price", "freight_value")
        ]
    ),
    "distinct_counts": _union(
        [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"count(DISTINCT {c}) AS n_distinct FROM {_RAW_NAMES[table]}"
            for table, c in (
                ("products", "product_category_name"),
                ("order_payments", "order_id"),
                ("order_payments", "payment_type"),
                ("order_items", "order_id"),
                ("order_items", "product_id"),
                ("order_items", "seller_id"),
            )
        ]
    ),
    "price_histogram": _histogram("raw_items", "price"),
    "delivery_histogram": _histogram("delays", "delivery_delay"),
    "weight_histogram": _histogram("raw_products", "product_weight_g"),
    "payment_histogram": _histogram("raw_payments", "payment_value"),
    "volume_weight_grid": _grid("dense", "volume", "product_weight_g"),
    "scatter_sample": _grid_sample("dense", "volume", "product_weight_g", "product_id", 5),
    "installments_value_grid": _grid("raw_payments", "payment_installments", "payment_value"),
    "product_boxplot": _union(
        [_box(c) for c in ("product_length_cm", "product_height_cm", "product_width_cm")]
    ),
    "monthly_orders_gapfilled": """
        SELECT last_day(CAST(m AS DATE)) AS month_end, count(order_id) AS n
        FROM (SELECT unnest(generate_series(date_trunc('month', min(order_purchase_timestamp)),
                                            max(order_purchase_timestamp), INTERVAL 1 MONTH)) AS m
              FROM raw_orders)
        LEFT JOIN raw_orders ON date_trunc('month', order_purchase_timestamp) = m
        GROUP BY 1 ORDER BY 1""",
    "seller_sales": """
        SELECT seller_id, count(order_id) AS n_sales, CAST(sum(price) AS DOUBLE) AS revenue,
               CAST(sum(freight_value) AS DOUBLE) AS total_freight
        FROM raw_items WHERE seller_id IS NOT NULL GROUP BY seller_id""",
    "top_sellers_by_sales": """
        SELECT seller_id, count(order_id) AS n_sales, CAST(sum(price) AS DOUBLE) AS revenue,
               CAST(sum(freight_value) AS DOUBLE) AS total_freight
        FROM raw_items WHERE seller_id IS NOT NULL GROUP BY seller_id
        ORDER BY n_sales DESC, seller_id LIMIT 10""",
    "payment_by_type": _payments_by("payment_type"),
    "payment_by_installments": _payments_by("payment_installments"),
    "top_categories": """
        SELECT product_category_name_english, count(*) AS n FROM translated
        WHERE product_category_name_english IS NOT NULL
        GROUP BY product_category_name_english
        ORDER BY n DESC, product_category_name_english LIMIT 20""",
    "duplicate_keys": _union(
        [
            _duplicates("geography", "raw_geography", "geolocation_zip_code_prefix"),
            _duplicates("customers", "raw_customers", "customer_id"),
            _duplicates("products", "raw_products", "product_id"),
            _duplicates("sellers", "raw_sellers", "seller_id"),
            _duplicates("orders", "raw_orders", "order_id"),
            _duplicates("category_translation", "raw_translation", "product_category_name"),
            _duplicates("order_items", "raw_items", "order_id", "order_item_id"),
        ]
        + [_duplicates(name, _STAR_NAMES[name], *t.key) for name, t in TABLES.items()]
    ),
    "orphan_keys": _union(
        [
            _orphans(
                "customers",
                "customer_zip_code_prefix",
                "raw_customers",
                "raw_geography",
                "geolocation_zip_code_prefix",
            ),
            _orphans(
                "sellers",
                "seller_zip_code_prefix",
                "raw_sellers",
                "raw_geography",
                "geolocation_zip_code_prefix",
            ),
            _orphans(
                "products",
                "product_category_name",
                "raw_products",
                "raw_translation",
                "product_category_name",
            ),
            _orphans("orders", "order_id", "raw_orders", "raw_items", "order_id"),
            _orphans("dim_customers", "geography_id", "star_customers", "geography", "geography_id"),
            _orphans("dim_sellers", "geography_id", "star_sellers", "geography", "geography_id"),
            _orphans("fact_orders", "customer_id", "star_orders", "star_customers", "customer_id"),
            _orphans("fact_orders", "date_id", "star_orders", "star_time", "date_id"),
            _orphans("fact_order_items", "order_id", "star_items", "star_orders", "order_id"),
            _orphans("fact_order_items", "product_id", "star_items", "star_products", "product_id"),
            _orphans("fact_order_items", "seller_id", "star_items", "star_sellers", "seller_id"),
        ]
    ),
    "length_violations": _union(
        [
            _lengths(table, column, limit)
            for table, column, limit in (
                ("dim_geography", "zip_code_prefix", 5),
                ("dim_geography", "city", 100),
                ("dim_geography", "state", 2),
                ("dim_customers", "zip_code_prefix", 5),
                ("dim_products", "category_name", 100),
                ("dim_products", "category_name_english", 100),
                ("dim_sellers", "zip_code_prefix", 5),
                ("fact_orders", "order_status", 50),
            )
        ]
        + [
            """
        SELECT 'dirty products', 'product_category_name', 100,
               CAST(max(length(product_category_name)) AS INTEGER),
               count(*) FILTER (length(product_category_name) > 100)
        FROM dirty"""
        ]
    ),
}


def _mentioned(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql)) & set(_PARTS)


def _with_parts(sql: str) -> str:
    """Prefix a query with the subqueries it needs, each after those it needs itself."""
    needed, todo = set(), _mentioned(sql)
    while todo:
        needed |= todo
        todo = {inner for name in todo for inner in _mentioned(_PARTS[name])} - needed
    parts = ", ".join(f"{name} AS ({_PARTS[name]})" for name in _PARTS if name in needed)
    if not parts:
        return sql
    body = sql.strip()
    if body.startswith("WITH"):
        return f"WITH {parts}, {body[len('WITH'):]}"
    return f"WITH {parts} {body}"


def _melted(mart: str, keys: list[str], measures: list[str]) -> str:
    """A mart with a row for each measure."""
    key = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return _union(
        f"""
        SELECT '{mart}' AS mart, concat_ws('|', {key}) AS group_key, '{m}' AS measure,
               CAST({m} AS DOUBLE) AS value FROM ({_QUERIES[mart]})"""
        for m in measures
    )


_QUERIES["refreshed_marts"] = _union(
    [
        _melted("daily_revenue", ["date_actual"], ["number_of_orders", "total_revenue"]),
        _melted(
            "monthly_revenue",
            ["year", "month"],
            ["number_of_orders", "total_revenue", "average_order_value"],
        ),
        _melted(
            "orders_by_region",
            ["state", "city"],
            ["number_of_orders", "number_of_customers", "total_revenue"],
        ),
        _melted(
            "seller_performance",
            ["seller_id", "seller_state", "seller_city"],
            [
                "total_orders",
                "unique_products_sold",
                "total_revenue",
                "average_order_value",
                "total_freight_value",
            ],
        ),
        _melted(
            "delivery_performance",
            ["year", "month", "state"],
            ["avg_delivery_days", "min_delivery_days", "max_delivery_days", "deliveries_over_week"],
        ),
    ]
)


def oracle_sql() -> dict[str, str]:
    return {name: _with_parts(sql) for name, sql in _QUERIES.items()}
