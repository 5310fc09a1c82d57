"""Names-only column contracts, checked on the header without running a job."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from bazaar.schemas import CONTRACTS

log = logging.getLogger(__name__)


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Contract columns that the frame lacks; extra columns and column order do not matter."""
    return sorted(set(CONTRACTS.get(table, [])) - set(df.columns))


def validate_schema(df: DataFrame, table: str) -> bool:
    if table not in CONTRACTS:
        log.warning("no contract for %s", table)
        return True
    missing = missing_columns(df, table)
    if missing:
        log.error("%s lacks columns %s", table, missing)
    return not missing


def require_schema(df: DataFrame, table: str) -> DataFrame:
    if not validate_schema(df, table):
        raise ValueError(f"{table}: columns {missing_columns(df, table)} are missing")
    return df
