"""Aggregates that are stored once for small groups and merged for larger ones.

Distinct counts are bitmaps over dense keys, exact under any merge; quantiles are KLL sketches,
whose ranks are off by ``RANK_ERROR`` at most (with a probability above 99.9 %). Both are made in one
pass over the rows; later questions read the stored aggregates alone, never the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a quantile sketch: its ranks have a standard error of some 0.3 %.
SKETCH_SIZE = 400
RANK_ERROR = 0.02


def key_bitmaps(rows: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """A bitmap for each group and each range of 32,768 keys that it has: ``bucket``, ``bits``.

    ``number`` is a dense key from 0. Keys that count up in the order of the groups, such as orders
    numbered by day, keep the bitmaps few and full. A hot group is several ranges, and bits combine
    before the shuffle.
    """
    key = F.col(number)
    return rows.groupBy(*groups, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
    )


def distinct_keys(bitmaps: DataFrame, groups: Mapping[str, Column], alias: str) -> DataFrame:
    """How many keys each of the larger groups has, by merging the bitmaps of the smaller ones."""
    merged = bitmaps.groupBy(*(c.alias(name) for name, c in groups.items()), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(alias))


def quantile_sketches(
    rows: DataFrame, groups: Sequence[str], column: str, size: int = SKETCH_SIZE
) -> DataFrame:
    """A sketch of the column's values for each group; what moves is a few kilobytes a group and
    task, never the values. Missing values are left out."""
    values = rows.where(F.col(column).isNotNull())
    return values.groupBy(*groups).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), size).alias("sketch")
    )


def sketched_quantiles(
    sketches: DataFrame, groups: Sequence[str], shares: Sequence[float], size: int = SKETCH_SIZE
) -> DataFrame:
    """``p``, ``value`` and ``n`` for each of the larger groups, by merging their sketches."""
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    asked = F.array(*(F.lit(float(p)) for p in shares))
    answers = F.arrays_zip(
        asked.alias("p"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value")
    )
    return merged.where("sketch IS NOT NULL").select(
        *groups, F.inline(answers), F.kll_sketch_get_n_double("sketch").alias("n")
    )
