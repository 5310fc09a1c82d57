"""Duplicate removal with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.schemas import ROW_ORDER


def keep_first(df: DataFrame, keys: Sequence[str], order: str = ROW_ORDER) -> DataFrame:
    """One row per key, the first in row order; rows with a NULL key are one group.

    An aggregate rather than a window: each task keeps one row per key before the shuffle, so a
    key with a third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*df.columns)
    )
