"""The raw tables cleaned into dimension batches, one row per natural key where one is due."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.calendar import calendar_attributes
from bazaar.functions.cleaning import (
    clean_dates,
    clean_numbers,
    fill_zero,
    standard_city,
    standard_state,
    standard_zip,
    zip_or_none,
)
from bazaar.operators.dedup import keep_first
from bazaar.operators.quality import Rule, unparsable
from bazaar.schemas import COORDINATE, ORDER_DATES, PRODUCT_MEASURES, ROW_ORDER

# The dates that make up the calendar.
CALENDAR_DATES = [
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

_GEOGRAPHY_NAMES = {
    "geolocation_zip_code_prefix": "zip_code_prefix",
    "geolocation_city": "city",
    "geolocation_state": "state",
    "geolocation_lat": "latitude",
    "geolocation_lng": "longitude",
}


def first_place_per_zip(geography: DataFrame) -> DataFrame:
    """The first row of each zip, on the raw zip and before any cleaning."""
    return keep_first(geography, ["geolocation_zip_code_prefix"])


def standard_places(geography: DataFrame) -> DataFrame:
    """Warehouse names, lower-case cities, upper-case states, coordinates as numbers."""
    numbers = clean_numbers(geography, ["geolocation_lat", "geolocation_lng"])
    return numbers.withColumnsRenamed(_GEOGRAPHY_NAMES).withColumns(
        {
            "zip_code_prefix": standard_zip(F.col("zip_code_prefix")),
            "city": standard_city(F.col("city")),
            "state": standard_state(F.col("state")),
        }
    )


def geography_batch(geography: DataFrame) -> DataFrame:
    return standard_places(first_place_per_zip(geography))


def geography_rules() -> list[Rule]:
    """Coordinates that do not fit the column."""
    return [
        Rule(c, F.col(c), unparsable(F.col(c), F.col(c).try_cast(COORDINATE)), "out of range")
        for c in ("latitude", "longitude")
    ]


def standard_customers(customers: DataFrame) -> DataFrame:
    """The first row of each customer, with a zip that is never NULL."""
    return keep_first(customers, ["customer_id"]).withColumn(
        "customer_zip_code_prefix", zip_or_none(F.col("customer_zip_code_prefix"))
    )


def _with_place(rows: DataFrame, geography: DataFrame) -> DataFrame:
    """Look the place up by zip: NULL where the zip is unknown.

    The key is the zip and the result the id. The places are a stored table, so its size decides
    about a broadcast; in a shuffle join adaptive execution splits a hot zip's rows.
    """
    places = geography.select("zip_code_prefix", "geography_id")
    return rows.join(places, "zip_code_prefix", "left")


def customers_batch(customers: DataFrame, geography: DataFrame) -> DataFrame:
    rows = standard_customers(customers).withColumnRenamed(
        "customer_zip_code_prefix", "zip_code_prefix"
    )
    return _with_place(rows, geography).select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "geography_id", ROW_ORDER
    )


def sellers_batch(sellers: DataFrame, geography: DataFrame) -> DataFrame:
    rows = sellers.select(
        "seller_id",
        zip_or_none(F.col("seller_zip_code_prefix")).alias("zip_code_prefix"),
        ROW_ORDER,
    )
    return _with_place(rows, geography).select(
        "seller_id", "zip_code_prefix", "geography_id", ROW_ORDER
    )


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category, NULL where there is no translation."""
    names = translation.select("product_category_name", "product_category_name_english")
    return products.join(names, "product_category_name", "left")


def filled_products(products: DataFrame) -> DataFrame:
    """Measures as numbers, with 0 for a missing one."""
    return fill_zero(clean_numbers(products, PRODUCT_MEASURES), PRODUCT_MEASURES)


def products_batch(
    products: DataFrame, translation: DataFrame, fill_missing: bool = True
) -> DataFrame:
    """Product rows; a measure that is text but no number stays marked for the quarantine."""
    rows = translated_products(products, translation)
    raw = {f"_raw_{c}": F.col(c).cast("string") for c in PRODUCT_MEASURES}
    numbers = clean_numbers(rows.withColumns(raw), PRODUCT_MEASURES)
    if fill_missing:
        numbers = numbers.withColumns(
            {
                c: F.when(F.col(f"_raw_{c}").isNull(), 0.0).otherwise(F.col(c))
                for c in PRODUCT_MEASURES
            }
        )
    return numbers.withColumnsRenamed(
        {
            "product_category_name": "category_name",
            "product_category_name_english": "category_name_english",
        }
    )


def products_rules() -> list[Rule]:
    """Measures that are text but no number, or too large for a whole-number column."""
    words = [
        Rule(c, F.col(f"_raw_{c}"), unparsable(F.col(f"_raw_{c}"), F.col(c)), "not a number")
        for c in PRODUCT_MEASURES
    ]
    return words + [
        Rule(c, F.col(f"_raw_{c}"), unparsable(F.col(c), F.col(c).try_cast("int")), "out of range")
        for c in ("product_weight_g", "product_photos_qty")
    ]


def calendar_batch(orders: DataFrame) -> DataFrame:
    """Every day that occurs in one of the calendar dates, with its attributes.

    One pass over the orders, not one per column; days are made distinct before the shuffle.
    """
    dates = clean_dates(orders.select(*CALENDAR_DATES), ORDER_DATES)
    days = (
        dates.select(F.explode(F.array(*[F.to_date(c) for c in CALENDAR_DATES])).alias("date_actual"))
        .where(F.col("date_actual").isNotNull())
        .distinct()
    )
    return days.select("date_actual", *[
        column.alias(name) for name, column in calendar_attributes(F.col("date_actual")).items()
    ])


def product_density(products: DataFrame) -> DataFrame:
    """Volume in cm3 and density in g/cm3; a volume of 0 has no density."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return clean_numbers(products, PRODUCT_MEASURES).withColumn("volume", volume).withColumn(
        "density", F.col("product_weight_g") / F.nullif(F.col("volume"), F.lit(0.0))
    )

