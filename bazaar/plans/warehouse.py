"""Building and refreshing the stored star schema."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.operators.positions import assign_keys
from bazaar.operators.quality import (
    Rule,
    any_breach,
    bad_rows,
    empty_tables,
    rules_for,
)
from bazaar.operators.upsert import reduce_batch, upsert
from bazaar.plans import dimensions as dims
from bazaar.plans import facts, partials
from bazaar.plans.marts import MARTS
from bazaar.schemas import CONTRACTS, ROW_ORDER, TABLES, Table
from bazaar.sources.storage import PartitionedTable, VersionedTable, stage, staging

log = logging.getLogger(__name__)

Raw = Mapping[str, DataFrame]

# Load order; each table with the tables it looks keys up in.
NEEDS: dict[str, tuple[str, ...]] = {
    "dim_geography": (),
    "dim_customers": ("dim_geography",),
    "dim_products": (),
    "dim_sellers": ("dim_geography",),
    "dim_time": (),
    "fact_orders": ("dim_time",),
    "fact_order_items": ("fact_orders",),
}


def with_needs(tables: Sequence[str]) -> list[str]:
    """The named tables and all they need, in load order."""
    wanted = set(tables)
    for table in reversed(NEEDS):
        if table in wanted:
            wanted.update(NEEDS[table])
    return [table for table in NEEDS if table in wanted]


def independent_groups(tables: Sequence[str]) -> list[list[str]]:
    """The tables in load order, grouped so that each needs only tables of earlier groups."""
    depth: dict[str, int] = {}
    for table in NEEDS:
        depth[table] = max((depth[need] + 1 for need in NEEDS[table]), default=0)
    levels = range(max(depth.values()) + 1)
    groups = [[t for t in NEEDS if t in tables and depth[t] == level] for level in levels]
    return [group for group in groups if group]


class Warehouse:
    """The star schema under one folder.

    Dimensions and marts are versioned snapshots. Facts are partitioned by month of purchase; a
    load writes the months it touches anew and commits them at once. Each table is committed on
    its own: a failed load raises, leaves its table and those after it as they were, and can be
    repeated, since all loads are upserts.
    """

    def __init__(self, spark: SparkSession, root: str, run_ts: datetime | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
        self.loaded_rows: dict[str, int] = {}
        # For folders of items and versions of the products: whether all products are known.
        self.complete: dict[tuple[str, int], bool] = {}
        self._frames: dict[str, DataFrame] = {}

    # Reading

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _versions(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), TABLES[name].schema)

    def months(self, name: str) -> PartitionedTable:
        """A fact's storage, by month."""
        table = TABLES[name]
        return PartitionedTable(self.spark, self.path(name), table.schema, table.partition)

    def find(self, name: str) -> DataFrame | None:
        """The current table, or None before its first load."""
        if name not in self._frames:
            table = TABLES[name]
            if table.partition is None:
                frame = self._versions(name).read()
            else:
                frame = self.months(name).read()
            if frame is None:
                return None
            self._frames[name] = frame
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        frame = self.find(name)
        if frame is None:
            raise LookupError(f"{name} has not been loaded")
        return frame

    def star(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES if self.find(name) is not None}

    def quarantine(self, name: str) -> DataFrame | None:
        """The rows that loads of the table kept out; one that is repeated notes them again."""
        return VersionedTable(self.spark, f"{self.root}/quarantine/{name}").read_all()

    def set_apart(self, rows: DataFrame, name: str) -> int:
        """Keep rows under ``quarantine/<name>``, if there are any, and return their number."""
        if rows.isEmpty():
            return 0
        store = VersionedTable(self.spark, f"{self.root}/quarantine/{name}")
        return self.spark.read.parquet(store.write(rows)).count()

    # Loading

    def load(
        self, raw: Raw, tables: Sequence[str] | None = None, require_non_empty: bool = True
    ) -> Warehouse:
        """Load the named tables, by default all, with the tables they look keys up in."""
        wanted = list(TABLES) if tables is None else with_needs(tables)
        return self.load_only(raw, wanted, require_non_empty)

    def load_only(
        self, raw: Raw, tables: Sequence[str], require_non_empty: bool = True
    ) -> Warehouse:
        """Load just the named tables into what is there already."""
        empty = empty_tables({SOURCE_OF[name]: raw[SOURCE_OF[name]] for name in tables})
        if empty and require_non_empty:
            raise ValueError(f"no rows in {', '.join(empty)}")

        def load(name: str) -> None:
            if SOURCE_OF[name] in empty:
                log.info("%s: nothing to load", name)
                return
            with staging(self.spark):
                _LOADERS[name](self, raw)

        # Tables that do not need each other load side by side: a small one does not keep the
        # cluster waiting.
        for group in independent_groups(tables):
            with ThreadPoolExecutor(len(group)) as threads:
                list(threads.map(load, group))
        return self

    def land(self, raw: Raw) -> dict[str, DataFrame]:
        """Write the raw tables as snapshots and return them as stored.

        Text files are then parsed once, however many tables are made of them, and every row
        keeps its place in its source.
        """
        landed = {}
        for name, df in raw.items():
            table = VersionedTable(self.spark, f"{self.root}/raw/{name}", df.schema)
            table.write(df)
            landed[name] = table.read()
        return landed

    def _load(
        self,
        name: str,
        rows: DataFrame,
        rules: Sequence[Rule],
        finish: Callable[[DataFrame], DataFrame],
        notes: Sequence[Rule] = (),
    ) -> None:
        """Check the rows, set bad ones apart, finish the good ones and write the table.

        ``notes`` are rules whose breaches are recorded with the bad rows', but whose rows are
        loaded. Breaches are counted while the table is written; only if there are any does a
        second pass over the source store them.
        """
        table = TABLES[name]
        rules = [*rules_for(table), *rules]
        seen = Observation()
        checked = rows.withColumn("_bad", any_breach(rules)).observe(
            seen,
            F.count("*").alias("rows"),
            F.count_if(any_breach([*rules, *notes])).alias("bad"),
        )
        batch = finish(checked.where(~F.col("_bad")).drop("_bad")).withColumn(
            "created_at", F.lit(self.run_ts).cast("timestamp_ntz")
        )
        if table.partition is None:
            self._write_dimension(table, batch)
        else:
            self._write_fact(table, batch)
        counts = seen.get
        self.loaded_rows[name] = counts.get("rows", 0)
        if counts.get("bad", 0):
            log.warning("%s: %d rows with bad values", name, counts["bad"])
            store = VersionedTable(self.spark, f"{self.root}/quarantine/{name}")
            store.write(bad_rows(rows, [*rules, *notes], name, table.key))
        log.info("%s: %d rows read", name, self.loaded_rows[name])

    def _write_dimension(self, table: Table, batch: DataFrame) -> None:
        target = self.find(table.name)
        if target is None:
            merged = _conform(batch, table)
        else:
            merged = upsert(target, batch.select(target.columns), table.key, table.update)
        self._versions(table.name).write(merged)
        self._frames.pop(table.name, None)

    def _write_fact(self, table: Table, batch: DataFrame) -> None:
        month = table.partition
        target = self.find(table.name)
        merged = _conform(batch, table)
        months = self.months(table.name)
        # The joins by order that make a batch, the upsert by key, and scans deal rows evenly.
        if target is None:
            put = months.put_as_dealt(merged)
            new = months.read(put)
        else:
            batch = stage(merged, table.name)
            # Its orders and their months are read once; what follows needs no other columns.
            new = stage(batch.select("order_id", month).distinct(), "batch-orders")
            # A stored key keeps its month, so the months to rewrite are those of the batch and
            # those where its orders are stored: at most a few hundred numbers. Only in the latter
            # can a row of the batch meet one of its key; the others get it added, unshuffled.
            met = self.months_of(table.name, new)
            touched = {row[0] for row in new.select(month).distinct().collect()}
            rows = batch
            if stored := _some(months.folders(), met):
                rows = upsert(months.read(stored), batch, table.key, table.update)
            if others := _some(months.folders(), touched - met):
                rows = rows.unionByName(months.read(others))
            put = months.put_as_dealt(rows)
        if new is not None:
            self._keep_places(table.name, new)
        months.commit(put)
        self._frames.pop(table.name, None)

    # Where orders are stored

    def places(self, name: str) -> PartitionedTable:
        """The months that hold rows of each order, by the order's hash.

        Places are committed before the rows, so they name all months that hold an order, and more
        only after a load that failed in between.
        """
        return PartitionedTable(self.spark, f"{self.path(name)}_places", PLACES, "bucket")

    def months_of(self, name: str, orders: DataFrame) -> set[int]:
        """The months of a fact that may hold rows of these orders.

        Only the buckets of these orders are read, so a small batch reads little of the places.
        """
        places = self.places(name)
        folders = places.folders()
        if not folders:
            return set(self.months(name).folders())
        stored = places.read(_some(folders, _buckets(orders)))
        if stored is None:
            return set()
        here = stored.join(orders.select("order_id"), "order_id", "left_semi")
        return {row[0] for row in here.select("purchase_month").distinct().collect()}

    def rows_of(self, name: str, orders: DataFrame) -> DataFrame:
        """The rows of a fact in the months that may hold rows of these orders."""
        months = self.months(name)
        rows = months.read(_some(months.folders(), self.months_of(name, orders)))
        return self.table(name).limit(0) if rows is None else rows

    def _keep_places(self, name: str, rows: DataFrame) -> None:
        """Add the places of rows that are about to be committed."""
        places = self.places(name)
        folders = places.folders()
        before = self.find(name)
        if not folders and before is not None:  # a fact that was stored without its places
            rows = rows.select("order_id", "purchase_month").union(
                before.select("order_id", "purchase_month")
            )
        new = rows.select("order_id", "purchase_month").distinct().select("*", _bucket())
        if folders:
            stored = places.read(_some(folders, _buckets(rows)))
            if stored is not None:
                known = stored.select("order_id", "purchase_month")
                new = new.join(known, ["order_id", "purchase_month"], "left_anti")
            new = stage(new, "places")
            touched = places.read(_some(folders, _buckets(new)))
            if touched is not None:
                new = new.select(PLACES.names).union(touched.select(PLACES.names))
            elif new.isEmpty():
                return
        places.write(new.select(PLACES.names))

    # Payments

    @property
    def _payment_store(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/payments")

    def stored_payments(self) -> DataFrame | None:
        """All payments that any batch brought, also those of orders that are not stored yet.

        Each batch is a folder of its own, and nothing rewrites those before it. What came twice is
        in two of them: ``facts.stored_rollup`` counts it once.
        """
        return self._payment_store.read_all()

    def keep_payments(self, payments: DataFrame, name: str = "") -> DataFrame:
        """Store a batch's good payments and return what it has added."""
        good = facts.marked_payments(payments).where(~any_breach(facts.payments_rules()))
        store = self._payment_store
        version = max(store.versions(), default=0) + 1
        delta = facts.payments_delta(good, name).withColumn("arrival", F.lit(version))
        return self.spark.read.parquet(store.write_as_dealt(delta, version))

    def settle(self, paid_orders: DataFrame) -> DataFrame:
        """Work out anew the totals of the stored ones of these orders, from all their payments.

        Only the months of those orders are written; their keys are returned.
        """
        month = TABLES["fact_orders"].partition
        orders = self.rows_of("fact_orders", paid_orders)
        known = stage(
            orders.select("order_id", month).join(paid_orders, "order_id", "left_semi"), "paid"
        )
        # A few hundred numbers: the months of the orders that were paid.
        touched = [row[0] for row in known.select(month).distinct().collect()]
        if touched:
            paid = facts.stored_rollup(self.stored_payments(), known.select("order_id"))
            stored = orders.where(F.col(month).isin(touched))
            self.months("fact_orders").write_as_dealt(facts.with_totals(stored, paid))
            self._frames.pop("fact_orders", None)
        return known.select("order_id")

    def add_payments(self, payments: DataFrame, names: Sequence[str] = ()) -> None:
        """Add newly arrived payments to the orders they are for.

        ``names`` says where rows come from that do not name a file themselves: rows of a source
        that were added before add nothing.

        Payments are stored first; totals then follow from all stored payments of the orders that
        were paid, so a run that fails in between is simply repeated. The totals of other orders
        stay. An order keeps the type of its first payment; payments of orders that are not stored
        are noted under ``quarantine/order_payments`` and count once their order is there.
        """
        with staging(self.spark):
            rules = facts.payments_rules()
            new = self.keep_payments(payments, ",".join(names)).select("order_id").distinct()
            new = stage(new, "payments")
            known = self.settle(new)
            apart = bad_rows(
                facts.marked_payments(payments), rules, "order_payments", ["order_id"]
            ).unionByName(
                new.join(known, "order_id", "left_anti").select(
                    F.lit("order_payments").alias("table_name"),
                    F.col("order_id").alias("row_key"),
                    F.lit("order_id").alias("column_name"),
                    F.col("order_id").alias("raw_value"),
                    F.lit("unknown order").alias("reason"),
                )
            )
            VersionedTable(self.spark, f"{self.root}/quarantine/order_payments").write(apart)

    # Precomputed marts

    def refresh_marts(self, names: Sequence[str] = tuple(MARTS)) -> None:
        """Write the marts as tables of their own; of the facts, only months that have changed
        since the last refresh are read."""
        star = self.star()
        for name in names:
            mart = partials.REFRESHED[name](self, star)
            VersionedTable(self.spark, f"{self.root}/marts/{name}").write(mart)

    def mart(self, name: str) -> DataFrame:
        frame = VersionedTable(self.spark, f"{self.root}/marts/{name}").read()
        if frame is None:
            raise LookupError(f"mart {name} has not been refreshed")
        return frame

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest snapshots of raw tables, dimensions and marts."""
        names = [t.name for t in TABLES.values() if t.partition is None]
        names += [f"raw/{source}" for source in CONTRACTS] + [f"marts/{mart}" for mart in MARTS]
        for name in names:
            VersionedTable(self.spark, self.path(name)).expire(keep)
        for table in TABLES.values():
            if table.partition:
                self.months(table.name).expire(keep)
                self.places(table.name).expire(keep)
        partials.expire(self, keep)


# Orders are told apart by hash into so many folders; fixed once places are stored.
KEY_BUCKETS = 128
PLACES = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("purchase_month", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")


def _buckets(orders: DataFrame) -> set[int]:
    """The buckets that hold these orders, at most ``KEY_BUCKETS`` numbers."""
    return {row[0] for row in orders.select(_bucket()).distinct().collect()}


def _some(folders: Mapping[int, str], values: set[int]) -> dict[int, str]:
    return {value: folder for value, folder in folders.items() if value in values}


def _conform(batch: DataFrame, table: Table) -> DataFrame:
    return batch.select([F.col(f.name).cast(f.dataType) for f in table.schema.fields])


# The raw table whose rows each table is made of.
SOURCE_OF: dict[str, str] = {
    "dim_geography": "geography",
    "dim_customers": "customers",
    "dim_products": "products",
    "dim_sellers": "sellers",
    "dim_time": "orders",
    "fact_orders": "orders",
    "fact_order_items": "order_items",
}


def _load_geography(warehouse: Warehouse, raw: Raw) -> None:
    table = TABLES["dim_geography"]

    def finish(rows: DataFrame) -> DataFrame:
        # Two raw spellings of one zip meet here: the later row wins, as in any batch.
        batch = stage(reduce_batch(rows, table.key, table.update), table.name)
        target = warehouse.find(table.name)
        if target is None:
            return assign_keys(batch, "zip_code_prefix", "geography_id")
        new = batch.select("zip_code_prefix").join(
            target.select("zip_code_prefix"), "zip_code_prefix", "left_anti"
        )
        last = target.agg(F.max("geography_id")).first()[0] or 0
        keyed = assign_keys(new, "zip_code_prefix", "geography_id", last)
        return batch.join(keyed, "zip_code_prefix", "left")

    rows = dims.geography_batch(raw["geography"])
    warehouse._load(table.name, rows, dims.geography_rules(), finish)


def _load_customers(warehouse: Warehouse, raw: Raw) -> None:
    rows = dims.customers_batch(raw["customers"], warehouse.table("dim_geography"))
    # The first row per customer is taken before the lookup: the batch has no duplicates left.
    warehouse._load("dim_customers", rows, [], lambda good: good.drop(ROW_ORDER))


def _load_products(warehouse: Warehouse, raw: Raw) -> None:
    table = TABLES["dim_products"]
    rows = dims.products_batch(raw["products"], raw["category_translation"])
    keep = [*table.key, *table.update, ROW_ORDER]
    warehouse._load(
        table.name,
        rows,
        dims.products_rules(),
        lambda good: reduce_batch(good.select(keep), table.key, table.update),
    )


def _load_sellers(warehouse: Warehouse, raw: Raw) -> None:
    table = TABLES["dim_sellers"]
    rows = dims.sellers_batch(raw["sellers"], warehouse.table("dim_geography"))
    warehouse._load(
        table.name, rows, [], lambda good: reduce_batch(good, table.key, table.update)
    )


def _load_time(warehouse: Warehouse, raw: Raw) -> None:
    def finish(rows: DataFrame) -> DataFrame:
        days = stage(rows, "dim_time")
        target = warehouse.find("dim_time")
        if target is None:
            return assign_keys(days, "date_actual", "date_id")
        new = days.join(target.select("date_actual"), "date_actual", "left_anti")
        last = target.agg(F.max("date_id")).first()[0] or 0
        return assign_keys(new, "date_actual", "date_id", last)

    warehouse._load("dim_time", dims.calendar_batch(raw["orders"]), [], finish)


def _load_orders(warehouse: Warehouse, raw: Raw) -> None:
    time = warehouse.table("dim_time")
    stored_before = warehouse.find("fact_orders") is not None
    new = warehouse.keep_payments(raw["order_payments"])
    deltas = warehouse.stored_payments()
    warehouse._load(
        "fact_orders",
        facts.orders_rows(raw["orders"]),
        [],
        lambda good: facts.orders_batch(good, deltas, time),
        notes=facts.orders_rules(),
    )
    if stored_before:  # payments of the batch may be for orders that it does not have
        others = new.select("order_id").distinct().join(
            raw["orders"].select("order_id"), "order_id", "left_anti"
        )
        warehouse.settle(stage(others, "others"))
    # What was kept says how many payments were good: only if some were not, they are looked for.
    good = new.where("NOT lead").agg(F.sum("copies")).first()[0] or 0
    if raw["order_payments"].count() != good:
        marked, rules = facts.marked_payments(raw["order_payments"]), facts.payments_rules()
        bad = bad_rows(marked, rules, "order_payments", ["order_id"])
        VersionedTable(warehouse.spark, f"{warehouse.root}/quarantine/order_payments").write(bad)


def _load_items(warehouse: Warehouse, raw: Raw) -> None:
    warehouse.table("fact_orders")  # raises if there is none
    warehouse._load(
        "fact_order_items",
        facts.items_rows(raw["order_items"]),
        facts.items_rules(),
        lambda good: facts.items_batch(good, partial(warehouse.rows_of, "fact_orders")),
    )


_LOADERS: dict[str, Callable[[Warehouse, Raw], None]] = {
    "dim_geography": _load_geography,
    "dim_customers": _load_customers,
    "dim_products": _load_products,
    "dim_sellers": _load_sellers,
    "dim_time": _load_time,
    "fact_orders": _load_orders,
    "fact_order_items": _load_items,
}
