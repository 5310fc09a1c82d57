"""Aggregates that give the same result whatever the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MICROS = 86400e6


def mean(total: Column, n: Column) -> Column:
    """A mean from an exact decimal (or integer) total and a count."""
    return total.cast("double") / n


def delay_micros(days: Column) -> Column:
    """The whole microseconds behind a delay in days, in a type whose sum cannot overflow."""
    return F.rint(days * F.lit(_DAY_MICROS)).cast("bigint").cast("decimal(20,0)")


def mean_days(total_micros: Column, n: Column) -> Column:
    """The mean delay in days from an exact total in microseconds."""
    return mean(total_micros, n) / F.lit(_DAY_MICROS)
