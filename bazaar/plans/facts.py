"""Order and order-item facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.calendar import month_number
from bazaar.functions.cleaning import clean_dates, clean_money, clean_numbers, delay_days
from bazaar.operators.quality import Rule, unparsable
from bazaar.operators.upsert import one_per_key
from bazaar.schemas import MONEY, ORDER_DATES, ROW_ORDER
from bazaar.sources.storage import stage

PAYMENT_NUMBERS = ["payment_value", "payment_installments"]
ITEM_MONEY = ["price", "freight_value"]
# What a stored payment is known by.
CONTENT = ["order_id", "source", "payment_type", "payment_installments", "payment_value"]


def clean_payments(payments: DataFrame) -> DataFrame:
    numbers = clean_numbers(clean_money(payments, ["payment_value"]), ["payment_installments"])
    return numbers.withColumn("payment_installments", F.col("payment_installments").try_cast("int"))


def payments_rollup(payments: DataFrame) -> DataFrame:
    """Per order: total paid, most installments, and the type of the first payment.

    Payments without an order are left out. A first type that is missing stays missing.
    """
    return (
        clean_payments(payments)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum("payment_value"), F.lit(0)).cast(MONEY).alias("payment_value"),
            F.max("payment_installments").alias("payment_installments"),
            F.min_by("payment_type", ROW_ORDER).alias("payment_type"),
        )
    )


def marked_payments(payments: DataFrame) -> DataFrame:
    """Clean payments that keep their numbers as they came, for ``payments_rules``."""
    return clean_payments(
        payments.withColumns({f"_raw_{c}": F.col(c) for c in PAYMENT_NUMBERS})
    )


def payments_rules() -> list[Rule]:
    """A payment without an order, or whose value or installments are text but no number."""
    return [
        Rule("order_id", F.col("order_id"), F.col("order_id").isNull(), "missing key"),
        *_not_numbers(PAYMENT_NUMBERS),
    ]


def _not_numbers(columns: Sequence[str]) -> list[Rule]:
    return [
        Rule(c, F.col(f"_raw_{c}"), unparsable(F.col(f"_raw_{c}"), F.col(c)), "not a number")
        for c in columns
    ]


def payments_delta(payments: DataFrame, name: str) -> DataFrame:
    """What a batch of clean payments adds to the stored ones.

    A payment is known by its order, its source (the file it was read from, else ``name``) and its
    content, with the number of equal ones: a source that is read again, in whatever order, adds
    nothing. A row with ``lead`` sums up the batch's payments of an order and has the type of the
    first; a sum that is no ``MONEY`` stays missing.

    Rows are dealt by order once, before anything is sorted: no task sorts more than its share of
    a shuffle, however much of the source it has read.
    """
    order = payments.schema[ROW_ORDER].dataType
    in_file = isinstance(order, T.StructType) and "path" in order.names
    source = [F.col(f"{ROW_ORDER}.path").alias("source")] if in_file else []
    rows = payments.where(F.col("order_id").isNotNull()).select(
        "order_id",
        *source,
        "payment_type",
        "payment_installments",
        F.col("payment_value").cast(MONEY).alias("payment_value"),
        ROW_ORDER,
    )
    # Where it is the same for all rows, the source is no key: Spark would sort once more for it.
    known_by = [c for c in CONTENT if c in rows.columns]
    counted = rows.repartition("order_id").groupBy(*known_by).agg(
        F.count("*").alias("copies"), F.min(ROW_ORDER).alias("_first")
    )
    if not in_file:
        counted = counted.withColumn("source", F.lit(name))
    # One order of rows for all three, so that an order's rows are sorted and passed through once.
    placed = Window.partitionBy("order_id").orderBy(F.asc_nulls_last("_first"))
    whole = placed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.coalesce(F.sum(_paid(F.col("copies"))).over(whole), F.lit(0)).try_cast(MONEY)
    most = F.max("payment_installments").over(whole)
    first = F.row_number().over(placed) == 1
    shown = ["source", "payment_type", "payment_installments", "payment_value", "copies", "lead"]

    def row(*values: Column) -> Column:
        return F.struct(*(value.alias(c) for value, c in zip(values, shown, strict=True)))

    own = row(*(F.col(c) for c in shown[:-1]), F.lit(False))
    lead = row(
        F.lit(None).cast("string"), F.col("payment_type"), F.col("_most"), F.col("_total"),
        F.lit(None).cast("bigint"), F.lit(True),
    )
    marked = counted.select("*", total.alias("_total"), most.alias("_most"), first.alias("_is_first"))
    made = F.when(F.col("_is_first"), F.array(own, lead)).otherwise(F.array(own))
    return marked.select("order_id", F.inline(made))


def _paid(copies: Column) -> Column:
    return F.col("payment_value") * copies.cast("decimal(10,0)")


def stored_rollup(deltas: DataFrame, orders: DataFrame) -> DataFrame:
    """Per one of these orders, of all that has been stored for it, in whatever batches it came:
    total paid, most installments, and the type of the first payment of the first batch with any.

    An order that one batch has paid for takes that batch's sums; only those of several batches,
    which may hold the same payment, are worked out from the payments.
    """
    sums = stage(
        deltas.where("lead").join(orders, "order_id", "left_semi").groupBy("order_id").agg(
            F.count("*").alias("_batches"),
            F.first("payment_value").alias("payment_value"),
            F.max("payment_installments").alias("payment_installments"),
            F.min_by("payment_type", "arrival").alias("payment_type"),
        ),
        "paid-sums",
    )
    several = F.col("_batches") > 1
    unsure = several | F.col("payment_value").isNull()
    wanted = stage(sums.where(unsure).select("order_id"), "paid-often")
    once = (
        deltas.where("NOT lead")
        .join(wanted, "order_id", "left_semi")
        .groupBy(*CONTENT)
        .agg(F.max("copies").alias("copies"))
    )
    counted = once.groupBy("order_id").agg(
        F.coalesce(F.sum(_paid(F.col("copies"))), F.lit(0)).cast(MONEY).alias("payment_value")
    )
    others = sums.where(unsure).drop("payment_value").join(counted, "order_id")
    return sums.where(~unsure).unionByName(others).drop("_batches")


def with_totals(orders: DataFrame, paid: DataFrame) -> DataFrame:
    """Stored orders with the totals of their payments, where ``paid`` has any."""
    new = {"total_amount": "payment_value", "payment_installments": "payment_installments", "payment_type": "payment_type"}
    known = paid.select("order_id", F.lit(True).alias("_paid"), *(F.col(c).alias(f"_{c}") for c in new.values()))
    return (
        orders.join(known, "order_id", "left")
        .withColumns({c: F.when(F.col("_paid"), F.col(f"_{own}")).otherwise(F.col(c)) for c, own in new.items()})
        .select(orders.columns)
    )


def orders_payments_detail(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with each of its payments; an order without one is kept.

    A left join could not split an order with very many payments over tasks; an inner join can,
    and the orders without payments are added to it.
    """
    paid = clean_payments(payments).drop(ROW_ORDER)
    all_orders = orders.drop(ROW_ORDER)
    with_payment = paid.select("order_id").distinct()
    return all_orders.join(paid, "order_id").unionByName(
        all_orders.join(with_payment, "order_id", "left_anti"), allowMissingColumns=True
    )


def orders_with_delay(orders: DataFrame) -> DataFrame:
    """Orders with real timestamps and the delivery delay in days."""
    return clean_dates(orders, ORDER_DATES).withColumn(
        "delivery_delay",
        delay_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")),
    )


def orders_rows(orders: DataFrame) -> DataFrame:
    """Raw orders under their warehouse names, still one row per raw row."""
    raw = {f"_raw_{c}": F.col(c) for c in ORDER_DATES}
    return orders_with_delay(orders.withColumns(raw)).select(
        "order_id",
        "customer_id",
        F.to_date("order_purchase_timestamp").alias("date_actual"),
        "order_status",
        *[F.col(c).alias(c.removeprefix("order_")) for c in ORDER_DATES],
        "delivery_delay",
        month_number(F.col("order_purchase_timestamp")).alias("purchase_month"),
        *raw,
        ROW_ORDER,
    )


def orders_rules() -> list[Rule]:
    """Dates that are text but no date: the order is loaded without them."""
    return [
        Rule(
            c.removeprefix("order_"),
            F.col(f"_raw_{c}"),
            unparsable(F.col(f"_raw_{c}"), F.col(c.removeprefix("order_"))),
            "not a date",
        )
        for c in ORDER_DATES
    ]


def orders_batch(rows: DataFrame, deltas: DataFrame, time: DataFrame) -> DataFrame:
    """One row per order, with all its stored payments and its calendar day.

    Orders and payments are both brought down to one row per order before they meet, so the join
    sees no hot key. Only payments of the batch's orders are summed, whenever they came. Orders
    hardly ever repeat, so few of them are sorted.
    """
    rows = rows.drop(*(f"_raw_{c}" for c in ORDER_DATES))
    one = one_per_key(
        rows, ["order_id"], ["customer_id", "date_actual", "order_status", "delivery_delay"]
    )
    paid = stored_rollup(deltas, rows.select("order_id").distinct())
    totals = one.join(paid, "order_id", "left").withColumn(
        "total_amount", F.coalesce("payment_value", F.lit(0)).cast(MONEY)
    )
    return totals.join(time.select("date_actual", "date_id"), "date_actual", "left")


def items_rows(items: DataFrame) -> DataFrame:
    """Raw items with 0 for a missing price or freight; text that is no number stays marked."""
    raw = {f"_raw_{c}": F.col(c) for c in ITEM_MONEY}
    rows = clean_money(items.withColumns(raw), ITEM_MONEY)
    return rows.withColumns(
        {
            c: F.when(F.col(f"_raw_{c}").isNull(), F.lit(0).cast(MONEY)).otherwise(F.col(c))
            for c in ITEM_MONEY
        }
    )


def items_rules() -> list[Rule]:
    """Prices and freights that are text but no number."""
    return _not_numbers(ITEM_MONEY)


def items_batch(rows: DataFrame, orders: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per item, laid out by the month its order was bought in.

    The month is that of the stored order, which no update changes; 0 if the order is unknown.
    ``orders`` gives the part of the stored orders that may hold some; it is first brought down to
    the batch's by a semi join, whose other side is as large as the batch.
    """
    rows = rows.drop(*(f"_raw_{c}" for c in ITEM_MONEY))
    one = one_per_key(rows, ["order_id", "order_item_id"], ["price", "freight_value"])
    wanted = stage(rows.select("order_id").distinct(), "item-orders")
    stored = orders(wanted).select("order_id", "purchase_month")
    months = stored.join(wanted, "order_id", "left_semi")
    return one.join(months, "order_id", "left").withColumn(
        "purchase_month", F.coalesce("purchase_month", F.lit(0))
    )
