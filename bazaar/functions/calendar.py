"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Calendar year, month, day and quarter; ISO week; Saturday or Sunday."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
        "week": F.weekofyear(day),
        "is_weekend": F.weekday(day) >= 5,
    }


def month_number(ts: Column) -> Column:
    """yyyymm as an integer, 0 if unknown: the layout column of the fact tables."""
    return F.coalesce(F.year(ts) * 100 + F.month(ts), F.lit(0))
