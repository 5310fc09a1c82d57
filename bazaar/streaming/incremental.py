"""Incremental ingestion: files that arrived since the last run are upserted, each once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.cleaning import null_missing_tokens
from bazaar.operators.upsert import reduce_batch, upsert
from bazaar.plans.warehouse import SOURCE_OF, Warehouse
from bazaar.schemas import CONTRACTS, ROW_ORDER
from bazaar.sources.files import BROKEN, file_order, is_whole, lines_apart
from bazaar.sources.storage import VersionedTable, stage, staging


def read_stream(
    spark: SparkSession, landing: str, schema: T.StructType, file_format: str, **options: str
) -> DataFrame:
    return spark.readStream.schema(schema).format(file_format).options(**options).load(landing)


def run_to_end(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand what is new since the last run to ``apply(batch, batch_id)`` and return.

    The checkpoint remembers the files taken. A run that failed is repeated with the same files
    under the same batch id, so ``apply`` must give the same result when called again.
    """
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: VersionedTable,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    **options: str,
) -> DataFrame:
    """Upsert new files into a versioned table and return its current rows.

    Each batch makes the next version of the newest one, whatever the checkpoint knows: a lost
    checkpoint reads files again but loses nothing, and a repeated batch changes nothing, since
    its rows are upserts. Rows without a key are set apart under ``<root>/rejected``.
    """
    no_key = " OR ".join(f"{k} IS NULL" for k in keys)

    def apply(batch: DataFrame, _: int) -> None:
        rejected = batch.where(no_key)
        if not rejected.isEmpty():
            VersionedTable(batch.sparkSession, f"{target.root}/rejected").write(rejected)
        rows = reduce_batch(
            batch.withColumn(ROW_ORDER, F.struct(*order)).where(f"NOT ({no_key})"), keys, update
        )
        table = VersionedTable(batch.sparkSession, target.root, target.schema)
        current = table.read()
        table.write(rows if current is None else upsert(current, rows, keys, update))

    run_to_end(read_stream(spark, landing, schema, "parquet", **options), apply, checkpoint)
    return target.read()


def ingest_raw_files(
    warehouse: Warehouse,
    source: str,
    landing: str,
    checkpoint: str,
    tables: Sequence[str],
    others: Mapping[str, DataFrame] | None = None,
    **options: str,
) -> None:
    """Load new CSV files of one raw table into the warehouse tables made of it.

    ``others`` are the raw tables that those loads join with. The loads are upserts, so a batch
    that is repeated after a failure leaves the tables as the first time would have. A table is
    made of one raw table; for payments, which only add to orders, see ``ingest_payments``.
    """
    others_made = [table for table in tables if SOURCE_OF[table] != source]
    if others_made:
        raise ValueError(f"{', '.join(others_made)} cannot be made of {source} alone")

    def apply(batch: DataFrame, batch_id: int) -> None:
        whole = _whole_lines(warehouse, batch, source)
        raw = {**(others or {}), source: null_missing_tokens(file_order(whole).drop("_metadata"))}
        warehouse.load_only(raw, tables, require_non_empty=False)

    run_to_end(_csv_stream(warehouse, source, landing, **options), apply, checkpoint)


def _csv_stream(warehouse: Warehouse, source: str, landing: str, **options: str) -> DataFrame:
    columns = [*CONTRACTS[source], BROKEN]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    csv = {
        "header": "true",
        "enforceSchema": "false",
        "escape": '"',
        "columnNameOfCorruptRecord": BROKEN,
        "columnPruning": "false",
        **options,
    }
    stream = read_stream(warehouse.spark, landing, schema, "csv", **csv)
    return stream.select("*", "_metadata")


def _whole_lines(warehouse: Warehouse, batch: DataFrame, source: str) -> DataFrame:
    """A batch without its broken lines, which are kept under ``quarantine/lines``."""
    warehouse.set_apart(lines_apart(batch, source), "lines")
    return batch.where(is_whole(batch.columns)).drop(BROKEN)


def ingest_payments(warehouse: Warehouse, landing: str, checkpoint: str, **options: str) -> None:
    """Add the payments in new CSV files to the stored orders, each file once.

    Files are noted in a table of their own once their payments are in, and files noted there are
    left out of later batches, so a lost checkpoint does not add them again. A run that fails
    before that note is repeated as a whole: payments are known by their file and content, so
    those that were stored already count once.
    """

    def apply(batch: DataFrame, _: int) -> None:
        ingested = VersionedTable(batch.sparkSession, f"{warehouse.root}/ingested/order_payments")
        with staging(batch.sparkSession):
            files = batch.select(F.col("_metadata.file_path").alias("path")).distinct()
            noted = ingested.read_all()
            if noted is not None:
                files = files.join(noted, "path", "left_anti")
            files = stage(files, "files")
            if files.isEmpty():
                return
            # Places within a file are given before the join, which may move rows.
            placed = file_order(batch)
            new = placed.join(files, F.col(f"{ROW_ORDER}.path") == files.path, "left_semi")
            whole = _whole_lines(warehouse, new, "order_payments")
            warehouse.add_payments(null_missing_tokens(whole.drop("_metadata")))
            ingested.write(files)

    run_to_end(_csv_stream(warehouse, "order_payments", landing, **options), apply, checkpoint)
