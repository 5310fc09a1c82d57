"""The raw CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.cleaning import null_missing_tokens
from bazaar.schemas import CONTRACTS, ROW_ORDER
from bazaar.sources.contracts import require_schema

# Logical name -> file, or a pattern for it, under the raw folder.
CSV_FILES: dict[str, str] = {
    "customers": "*customers_dataset.csv",
    "geography": "*geolocation_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "order_payments": "*order_payments_dataset.csv",
    "order_reviews": "*order_reviews_dataset.csv",
    "orders": "*orders_dataset.csv",
    "products": "*products_dataset.csv",
    "sellers": "*sellers_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


def file_order(df: DataFrame) -> DataFrame:
    """Add each row's place: file, split of the file, row within the split.

    Ids only have to grow within a split, which one task reads from start to end, so the order
    holds however the splits are spread over tasks.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ROW_ORDER),
    )


# Holds a line whose number of fields is not that of the header; not a name that a table would have.
BROKEN = "_broken_line"


def is_whole(columns: Sequence[str]) -> Column:
    """Whether a line has as many fields as the header.

    The reader fills ``BROKEN`` only in a query that reads another column, too, hence the second
    condition, which no text meets.
    """
    return F.col(BROKEN).isNull() | (F.length(F.col(f"`{columns[0]}`")) < 0)


def parse_csv(spark: SparkSession, path: str) -> DataFrame:
    """All lines of headed CSV files as text columns, with ``BROKEN``."""
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    names = reader.csv(path).columns  # reads the header only
    fields = [T.StructField(name, T.StringType()) for name in [*names, BROKEN]]
    # All fields are split, whatever a query asks for: their number decides.
    reader = reader.options(columnNameOfCorruptRecord=BROKEN, columnPruning=False)
    return reader.schema(T.StructType(fields)).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV file, all columns text, usual spellings of "missing" as NULL.

    Lines with more or fewer fields than the header are left out: ``broken_lines`` has them.
    """
    lines = parse_csv(spark, path)
    names = lines.columns[:-1]
    return null_missing_tokens(file_order(lines).where(is_whole(names)).drop(BROKEN))


def lines_apart(lines: DataFrame, table: str) -> DataFrame:
    """The broken ones of parsed lines: table, file and the line as it stands there."""
    return lines.where(~is_whole(lines.columns)).select(
        F.lit(table).alias("table_name"),
        F.col("_metadata.file_path").alias("path"),
        F.col(BROKEN).alias("line"),
    )


def broken_lines(
    spark: SparkSession, raw_dir: str, files: Mapping[str, str] | None = None
) -> DataFrame:
    """The lines that ``extract`` leaves out. An open quote swallows the fields behind it, so it
    is found unless it stands in the last field."""
    files = {**CSV_FILES, **(files or {})}
    parts = [lines_apart(parse_csv(spark, f"{raw_dir}/{files[t]}"), t) for t in CONTRACTS]
    return reduce(DataFrame.unionByName, parts)


def extract(
    spark: SparkSession, raw_dir: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """All raw tables that have a contract, each checked against it."""
    files = {**CSV_FILES, **(files or {})}
    return {
        table: require_schema(read_csv(spark, f"{raw_dir}/{files[table]}"), table)
        for table in CONTRACTS
    }
