"""Cleaning expressions. All are built-in column functions; none raises on dirty input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.schemas import MONEY

# Text that a CSV reader takes for "missing".
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# A missing zip becomes this text; it must never find a place in the geography table.
NO_ZIP = "None"

_DATE = r"^\s*\d{4}-\d{2}-\d{2}"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity)\s*$"
_LEADING_BLANKS = r"(?U)^[\s\x1c-\x1f]+"
_TRAILING_BLANKS = r"(?U)[\s\x1c-\x1f]+$"


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def null_missing_tokens(df: DataFrame) -> DataFrame:
    """Turn the usual spellings of "missing" into NULL in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)) for c in text})


def parse_timestamp(text: Column) -> Column:
    """ISO text to a timestamp without zone; anything else is NULL."""
    return F.when(text.rlike(_DATE), text.try_cast("timestamp_ntz"))


def parse_number(text: Column) -> Column:
    """Decimal text to a double; anything else, and NaN, is NULL."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def clean_dates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Coerce the named columns to timestamps; absent columns are skipped."""
    return df.withColumns(
        {
            c: parse_timestamp(F.col(c)) if _is_text(df, c) else F.col(c).cast("timestamp_ntz")
            for c in _present(df, names)
        }
    )


def clean_numbers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Coerce the named columns to doubles; absent columns are skipped."""
    return df.withColumns(
        {
            c: parse_number(F.col(c)) if _is_text(df, c) else nan_to_null(F.col(c).cast("double"))
            for c in _present(df, names)
        }
    )


def clean_money(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Coerce the named columns to money; absent columns are skipped."""

    def money(name: str) -> Column:
        value = F.col(name)
        if _is_text(df, name):
            value = F.when(value.rlike(_NUMBER), F.trim(value))
        return value.try_cast(MONEY)

    return df.withColumns({c: money(c) for c in _present(df, names)})


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in _present(df, names)})


def strip(text: Column) -> Column:
    """Drop blanks, tabs and line ends on both sides (``trim`` drops blanks only)."""
    return F.regexp_replace(F.regexp_replace(text, _LEADING_BLANKS, ""), _TRAILING_BLANKS, "")


def standard_city(text: Column) -> Column:
    return strip(F.lower(text))


def standard_state(text: Column) -> Column:
    return strip(F.upper(text))


def standard_zip(zip_code: Column) -> Column:
    """Pad short digit codes to five places; other text is kept, NULL stays NULL."""
    text = strip(zip_code.cast("string"))
    return F.when(text.rlike(r"^\d{1,4}$"), F.lpad(text, 5, "0")).otherwise(text)


def zip_or_none(zip_code: Column) -> Column:
    """The zip as the customer and seller tables hold it: never NULL."""
    return F.coalesce(standard_zip(zip_code), F.lit(NO_ZIP))


def delay_days(start: Column, end: Column) -> Column:
    """Fractional days from start to end, NULL if either is, negative if end is earlier."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(86400e6)
