"""Exact quantiles of whole columns, without sorting them or holding one in a task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.cleaning import clean_numbers
from bazaar.operators.positions import running_totals

# Approximate quantiles bound the exact ones: their rank is off by a share of 1 / ACCURACY at
# most, and bounds are set twice as far to either side.
ACCURACY = 10_000


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns among the named ones as numbers, NULL where they are none."""
    return clean_numbers(df, [c for c in columns if df.schema[c].dataType == T.StringType()])


def number(name: str) -> Column:
    """A column as a double, with NaN as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): one row per value of the named columns that is not missing."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), number(c).alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


class _Wanted(NamedTuple):
    """A quantile to find: its column's size, and bounds that its neighbours lie in."""

    column: str
    probability: float
    n: int
    low: float = -math.inf
    high: float = math.inf

    @property
    def place(self) -> float:
        return (self.n - 1) * self.probability

    def of_column(self) -> Column:
        return F.col("column_name") == self.column

    def inside(self) -> Column:
        return self.of_column() & F.col("value").between(self.low, self.high)


def _margins(probability: float) -> tuple[float, float]:
    return max(probability - 2 / ACCURACY, 0.0), min(probability + 2 / ACCURACY, 1.0)


def bounds(column: str, probabilities: Sequence[float]) -> Column:
    """Aggregate: approximate quantiles to either side of each exact one, in one sketch."""
    sides = [side for p in probabilities for side in _margins(p)]
    return F.percentile_approx(number(column), sides, ACCURACY)


def _wanted(
    column: str, probabilities: Sequence[float], n: int, sides: Sequence[float] | None
) -> list[_Wanted]:
    """The quantiles of a column and what ``bounds`` found; ends of the column have no bound."""
    wanted = []
    for i, p in enumerate(probabilities):
        low, high = _margins(p)
        w = _Wanted(column, p, n)
        # Interpolation may need the next rank: the margins must be wider than that.
        if sides and n * 2 / ACCURACY >= 2:
            w = w._replace(
                low=sides[2 * i] if low > 0 else w.low, high=sides[2 * i + 1] if high < 1 else w.high
            )
        wanted.append(w)
    return wanted


def _skipped(values: DataFrame, wanted: Sequence[_Wanted]) -> list[int]:
    """How many values lie below each quantile's bounds, which must hold it."""
    counts = values.agg(
        *[
            part
            for w in wanted
            for part in (
                F.count_if(w.of_column() & (F.col("value") < w.low)),
                F.count_if(w.of_column() & (F.col("value") <= w.high)),
            )
        ]
    ).first()
    below = []
    for i, w in enumerate(wanted):
        start, end = counts[2 * i : 2 * i + 2]
        if w.n and not (start <= math.floor(w.place) and math.ceil(w.place) < end):
            raise ArithmeticError(f"{w.column}: the bounds miss quantile {w.probability}")
        below.append(start)
    return below


def _inside(values: DataFrame, wanted: Sequence[_Wanted], skipped: Sequence[int]) -> DataFrame:
    """(column_name, probability, n, value) from the values inside each quantile's bounds."""
    # Quantiles with the same bounds share the values inside.
    spans = list({(w.column, w.low, w.high): w.inside() for w in wanted}.items())
    span_of = {span: i for i, (span, _) in enumerate(spans)}
    # Equal values are counted, so a value that fills a third of the column is one row.
    counted = (
        values.where(reduce(Column.__or__, [inside for _, inside in spans]))
        .select(
            "value",
            F.explode(F.array(*[F.when(inside, i) for i, (_, inside) in enumerate(spans)])).alias(
                "span"
            ),
        )
        .where(F.col("span").isNotNull())
        .groupBy("span", "value")
        .agg(F.count("*").alias("n_value"))
    )
    ordered = running_totals(counted, ["span", "value"], "n_value")
    # A row per span: where its values start in the common order.
    starts = ordered.groupBy("span").agg(F.min("before").alias("start"))
    # A row per quantile, in the plan itself.
    asked = values.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(span_of[(w.column, w.low, w.high)]).alias("span"),
                        F.lit(w.column).alias("column_name"),
                        F.lit(w.probability).alias("probability"),
                        F.lit(w.n).cast("bigint").alias("n"),
                        F.lit(below).cast("bigint").alias("skipped"),
                    )
                    for w, below in zip(wanted, skipped, strict=True)
                ]
            )
        )
    )
    place = (F.col("n") - 1) * F.col("probability")

    def covers(rank: Column) -> Column:
        return (rank >= F.col("first")) & (rank < F.col("first") + F.col("n_value"))

    lower, upper = covers(F.floor(place)), covers(F.ceil(place))
    return (
        ordered.join(F.broadcast(asked.join(F.broadcast(starts), "span")), "span")
        .withColumn("first", F.col("before") - F.col("start") + F.col("skipped"))
        .where(lower | upper)
        .groupBy("column_name", "probability", "n")
        .agg(
            F.max(F.when(lower, F.col("value"))).alias("lower"),
            F.max(F.when(upper, F.col("value"))).alias("upper"),
        )
        .withColumn(
            "value",
            F.col("lower") + (F.col("upper") - F.col("lower")) * (place - F.floor(place)),
        )
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    found: Mapping[str, tuple[int, Sequence[float] | None]] | None = None,
) -> DataFrame:
    """One row per column: n and, for each probability, the linearly interpolated quantile.

    Text counts as the number that it is, other text and NaN as missing. Columns are read a few
    times but hardly shuffled, whatever their size: a sketch over all rows bounds each quantile,
    the values below the bounds are counted, and only those inside are put in order, by range
    partitioning. The built-in exact percentile would gather all distinct values in one task.
    ``found`` spares the first pass: each column's number of values and its ``bounds``.
    """
    df = numeric(df, columns)
    if found is None:
        parts = [part for c in columns for part in (F.count(number(c)), bounds(c, probabilities))]
        row = df.agg(*parts).first()
        found = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}
    wanted = [w for c in columns for w in _wanted(c, probabilities, *found[c])]
    values = melt(df, columns)
    skipped = _skipped(values, wanted)
    names = {p: f"p{p * 100:g}" for p in probabilities}
    return (
        _inside(values, wanted, skipped)
        .groupBy("column_name")
        .agg(
            F.max("n").alias("n"),
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in names.items()
            ],
        )
    )


QUARTILES = (0.25, 0.5, 0.75)


def describe(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """n, mean, sample deviation, min, quantiles and max of each column; NULLs are ignored.

    Moments, sizes and the bounds of all quantiles come from one pass.
    """
    exact = {c for c, kind in df.dtypes if kind.startswith(("decimal", "int", "bigint"))}
    df = numeric(df, columns)

    def moments(c: str) -> list[Column]:
        mean = F.sum(c).cast("double") / F.count(c) if c in exact else F.avg(number(c))
        return [
            F.count(number(c)),
            F.when(F.count(number(c)) > 0, mean),
            F.stddev_samp(number(c)),
            F.min(number(c)),
            F.max(number(c)),
            bounds(c, probabilities),
        ]

    row = df.agg(*[part for c in columns for part in moments(c)]).first()
    found = {c: tuple(row[6 * i : 6 * i + 6]) for i, c in enumerate(columns)}
    names = ("n", "mean", "std", "min", "max")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[
                F.lit(value).cast("bigint" if name == "n" else "double").alias(name)
                for name, value in zip(names, values[:5], strict=True)
            ],
        )
        for c, values in found.items()
    ]
    # A row per column, in the plan itself.
    table = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    asked = quantiles(df, columns, probabilities, {c: (v[0], v[5]) for c, v in found.items()})
    return table.join(F.broadcast(asked.drop("n")), "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", *[f"p{p * 100:g}" for p in probabilities], "max"
    )


def box_plot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 box lengths) and outlier counts."""
    df = numeric(df, columns)
    box = quantiles(df, columns, QUARTILES)
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    fences = box.select("*", (F.col("p25") - reach).alias("low"), (F.col("p75") + reach).alias("high"))
    inside = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    # The fences are a row per column, so the values are aggregated against them in place.
    return (
        melt(df, columns)
        .join(F.broadcast(fences), "column_name")
        .groupBy("column_name", "n", "p25", "p50", "p75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .withColumns(
            {
                "whisker_low": F.least("whisker_low", "p25"),
                "whisker_high": F.greatest("whisker_high", "p75"),
            }
        )
        .select(
            "column_name", "n", "whisker_low", "p25", "p50", "p75", "whisker_high", "n_outliers"
        )
    )
