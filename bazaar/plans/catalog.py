"""The warehouse as catalog tables, for SQL users and the optimizer's statistics."""

from __future__ import annotations

from pyspark.sql import SparkSession

from bazaar.plans.warehouse import Warehouse
from bazaar.schemas import TABLES, Table
from bazaar.sources.storage import VersionedTable


def _ddl(table: Table) -> str:
    limits = dict(table.limits)
    columns = ", ".join(
        f"{f.name} VARCHAR({limits[f.name]})"
        if f.name in limits
        else f"{f.name} {f.dataType.simpleString()}"
        for f in table.schema.fields
    )
    layout = f" PARTITIONED BY ({table.partition})" if table.partition else ""
    return f"({columns}) USING parquet{layout}"


def create_tables(spark: SparkSession, database: str, warehouse: Warehouse) -> None:
    """Create the database and the seven tables where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse.path('_database')}'")
    for table in TABLES.values():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table.name} {_ddl(table)} "
            f"LOCATION '{_location(spark, warehouse, table)}'"
        )


def _location(spark: SparkSession, warehouse: Warehouse, table: Table) -> str:
    if table.partition:
        return warehouse.path(table.name)
    versions = VersionedTable(spark, warehouse.path(table.name))
    return versions.path(max(versions.versions(), default=0))


def publish(spark: SparkSession, database: str, warehouse: Warehouse) -> None:
    """Point the catalog tables at the current snapshots and months."""
    for table in TABLES.values():
        name = f"{database}.{table.name}"
        if table.partition:
            for month, folder in warehouse.months(table.name).folders().items():
                part = f"PARTITION ({table.partition} = {month})"
                location = f"LOCATION '{warehouse.path(table.name)}/{folder}'"
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} {location}")
                spark.sql(f"ALTER TABLE {name} {part} SET {location}")
        else:
            spark.sql(
                f"ALTER TABLE {name} SET LOCATION '{_location(spark, warehouse, table)}'"
            )
        spark.sql(f"REFRESH TABLE {name}")


def analyze_tables(spark: SparkSession, database: str) -> None:
    """Compute table and column statistics for the optimizer."""
    for name in TABLES:
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")


def bucket_facts(spark: SparkSession, database: str, warehouse: Warehouse, buckets: int) -> None:
    """Copies of both facts in equal buckets of orders, as ``<fact>_by_order``.

    Orders and their items then join without a shuffle, time and again; the copies are for that
    alone and are rewritten, not updated. Choose the buckets for the data: a few hundred
    megabytes each.
    """
    for name in ("fact_orders", "fact_order_items"):
        (
            warehouse.table(name)
            .repartition(buckets, "order_id")
            .write.mode("overwrite")
            .bucketBy(buckets, "order_id")
            .sortBy("order_id")
            .option("path", warehouse.path(f"buckets/{name}"))
            .saveAsTable(f"{database}.{name}_by_order")
        )
