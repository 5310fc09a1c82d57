"""Quality gates and bad-row quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.schemas import Table
from bazaar.sources.contracts import missing_columns


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def contract_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per raw table: contract columns that are missing, and the number of rows."""
    return union_all(
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(missing_columns(df, name))).alias("missing_columns"),
            "n_rows",
        )
        for name, df in raw.items()
    )


def empty_tables(raw: Mapping[str, DataFrame]) -> list[str]:
    """The tables without a row."""
    return [name for name, df in raw.items() if df.isEmpty()]


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    )


def sample_rows(tables: Mapping[str, DataFrame], n: int = 1) -> dict[str, DataFrame]:
    """A few rows of each table to look at."""
    return {name: df.limit(n) for name, df in tables.items()}


def duplicate_keys(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
        .select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *key).alias("key_value"),
            "n_rows",
        )
    )


def orphan_keys(
    child: DataFrame, name: str, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Foreign keys without a parent row, and how many rows carry each; NULL is allowed.

    Child rows are counted per key first, so a hot key reaches the join as one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_key).alias(column))
    return used.join(known, column, "left_anti").select(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.col(column).cast("string").alias("key_value"),
        "n_rows",
    )


def length_report(df: DataFrame, name: str, limits: Sequence[tuple[str, int]]) -> DataFrame:
    """Longest text and number of overlong texts per limited column, in one pass."""
    aggregates, rows = [], []
    for column, limit in limits:
        aggregates += [
            F.max(F.length(column)).alias(f"{column}__longest"),
            F.count_if(F.length(column) > limit).alias(f"{column}__over"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(limit).alias("max_length"),
                F.col(f"{column}__longest").alias("longest"),
                F.col(f"{column}__over").alias("n_over"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


class Rule(NamedTuple):
    """A condition that makes a row bad, with the column and raw value to report."""

    column: str
    raw: Column
    bad: Column
    reason: str


def any_breach(rules: Sequence[Rule]) -> Column:
    """Whether a row breaks a rule; a NULL condition is no breach."""
    return reduce(Column.__or__, [F.coalesce(rule.bad, F.lit(False)) for rule in rules])


def bad_rows(df: DataFrame, rules: Sequence[Rule], name: str, key: Sequence[str]) -> DataFrame:
    """The quarantine: table, row key, column, raw value and reason of every breach."""
    breaches = F.array(
        *[
            F.when(
                rule.bad,
                F.struct(
                    F.lit(rule.column).alias("column_name"),
                    rule.raw.cast("string").alias("raw_value"),
                    F.lit(rule.reason).alias("reason"),
                ),
            )
            for rule in rules
        ]
    )
    return (
        df.where(any_breach(rules))
        .select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *key).alias("row_key"),
            F.explode(breaches).alias("breach"),
        )
        .where(F.col("breach").isNotNull())
        .select("table_name", "row_key", "breach.*")
    )


def unparsable(raw: Column, parsed: Column) -> Column:
    """Text that is there but does not convert."""
    return raw.isNotNull() & parsed.isNull()


def rules_for(table: Table) -> list[Rule]:
    """Every load's rules: no NULL in the key, no text over its limit."""
    keys = [Rule(k, F.col(k), F.col(k).isNull(), "missing key") for k in table.key]
    return keys + [
        Rule(c, F.col(c), F.length(c) > limit, f"longer than {limit}") for c, limit in table.limits
    ]
