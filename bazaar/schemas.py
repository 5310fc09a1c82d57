"""Raw column contracts, warehouse schemas, keys and update lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The raw column names, spelled as the source files spell them.
CONTRACTS: dict[str, list[str]] = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "geography": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "category_translation": ["product_category_name", "product_category_name_english"],
    "sellers": ["seller_id", "seller_zip_code_prefix"],
    "order_payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
    ],
}

ORDER_DATES = CONTRACTS["orders"][3:]
PRODUCT_MEASURES = [
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_photos_qty",
]

# Every raw frame carries its rows' place in the source under this name.
ROW_ORDER = "_row_order"

MONEY = T.DecimalType(18, 2)
COORDINATE = T.DecimalType(9, 6)


@dataclass(frozen=True)
class Table:
    """A warehouse table: columns, natural key, columns an upsert overwrites, text limits."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    update: tuple[str, ...]
    limits: tuple[tuple[str, int], ...] = ()
    partition: str | None = None
    references: tuple[tuple[str, str, str], ...] = ()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table(
            "dim_geography",
            _schema(
                geography_id=_I,
                zip_code_prefix=_S,
                city=_S,
                state=_S,
                latitude=COORDINATE,
                longitude=COORDINATE,
                created_at=_TS,
            ),
            key=("zip_code_prefix",),
            update=("city", "state", "latitude", "longitude"),
            limits=(("zip_code_prefix", 5), ("city", 100), ("state", 2)),
        ),
        Table(
            "dim_customers",
            _schema(
                customer_id=_S,
                customer_unique_id=_S,
                zip_code_prefix=_S,
                geography_id=_I,
                created_at=_TS,
            ),
            key=("customer_id",),
            update=("customer_unique_id", "zip_code_prefix", "geography_id"),
            limits=(("zip_code_prefix", 5),),
            references=(("geography_id", "dim_geography", "geography_id"),),
        ),
        Table(
            "dim_products",
            _schema(
                product_id=_S,
                category_name=_S,
                category_name_english=_S,
                product_weight_g=_I,
                product_length_cm=_D,
                product_height_cm=_D,
                product_width_cm=_D,
                product_photos_qty=_I,
                created_at=_TS,
            ),
            key=("product_id",),
            update=("category_name", "category_name_english", *PRODUCT_MEASURES),
            limits=(("category_name", 100), ("category_name_english", 100)),
        ),
        Table(
            "dim_sellers",
            _schema(seller_id=_S, zip_code_prefix=_S, geography_id=_I, created_at=_TS),
            key=("seller_id",),
            update=("zip_code_prefix", "geography_id"),
            limits=(("zip_code_prefix", 5),),
            references=(("geography_id", "dim_geography", "geography_id"),),
        ),
        Table(
            "dim_time",
            _schema(
                date_id=_I,
                date_actual=T.DateType(),
                year=_I,
                month=_I,
                day=_I,
                quarter=_I,
                week=_I,
                is_weekend=T.BooleanType(),
            ),
            key=("date_actual",),
            update=(),
        ),
        Table(
            "fact_orders",
            _schema(
                order_id=_S,
                customer_id=_S,
                date_id=_I,
                order_status=_S,
                purchase_timestamp=_TS,
                approved_at=_TS,
                delivered_carrier_date=_TS,
                delivered_customer_date=_TS,
                estimated_delivery_date=_TS,
                total_amount=MONEY,
                payment_type=_S,
                payment_installments=_I,
                delivery_delay=_D,
                created_at=_TS,
                purchase_month=_I,
            ),
            key=("order_id",),
            update=("customer_id", "date_id", "order_status", "total_amount", "delivery_delay"),
            limits=(("order_status", 50),),
            partition="purchase_month",
            references=(
                ("customer_id", "dim_customers", "customer_id"),
                ("date_id", "dim_time", "date_id"),
            ),
        ),
        Table(
            "fact_order_items",
            _schema(
                order_id=_S,
                order_item_id=_S,
                product_id=_S,
                seller_id=_S,
                price=MONEY,
                freight_value=MONEY,
                purchase_month=_I,
            ),
            key=("order_id", "order_item_id"),
            update=("price", "freight_value"),
            partition="purchase_month",
            references=(
                ("order_id", "fact_orders", "order_id"),
                ("product_id", "dim_products", "product_id"),
                ("seller_id", "dim_sellers", "seller_id"),
            ),
        ),
    ]
}
