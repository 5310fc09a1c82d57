"""Profiles of a frame: shape, missing values, distributions, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.cleaning import clean_numbers
from bazaar.schemas import ROW_ORDER


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ORDER]


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """A row per column: its place and type, with the table's row count."""
    kinds = {c: kind for c, kind in df.dtypes}
    columns = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(place).alias("column_place"),
            F.lit(c).alias("column_name"),
            F.lit(kinds[c]).alias("data_type"),
            F.lit(len(_columns(df))).alias("n_columns"),
            F.col("n_rows"),
        )
        for place, c in enumerate(_columns(df), start=1)
    ]
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*columns)))


def null_counts(df: DataFrame, name: str, only_missing: bool = False) -> DataFrame:
    """NULLs of every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _columns(df)])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(c).alias("n_missing"),
        )
        for c in _columns(df)
    ]
    result = counts.select(F.inline(F.array(*rows)))
    return result.where("n_missing > 0") if only_missing else result


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, and their share of all rows in percent.

    NULL counts in the whole only.
    """
    total = df.agg(F.count("*")).scalar()
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .withColumn("percent", F.col("n") / total * 100)
        .orderBy(F.desc("n"), column)
    )


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def size_distribution(df: DataFrame, key: str) -> DataFrame:
    """How many groups have each size."""
    return (
        group_sizes(df, key)
        .groupBy(F.col("n").alias("size"))
        .agg(F.count("*").alias("n_groups"))
        .orderBy("size")
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values; NULL is not one."""
    return group_sizes(df, column).orderBy(F.desc("n"), column).limit(n)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of each column, as its own type tells values apart.

    The values of all columns are made distinct in one shuffle over (column, value).
    """
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        # Adding 0 makes one value of both zeros, which differ as text alone.
        value = F.col(c) + F.lit(0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(c)
        return value.cast("string")

    pairs = [F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("column_name")
        .agg(F.count("value").alias("n_distinct"))
    )


def _axis(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The equal-width bin of a value; the last bin includes its upper edge.

    A value next to an edge is compared with the edge itself, since the quotient may round
    across it.
    """
    def edge(i: Column) -> Column:
        return low + i * ((high - low) / bins)

    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    return (
        F.when(value < edge(guess), guess - 1)
        .when((value >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def _range(df: DataFrame, column: str, side: str) -> DataFrame:
    """A bounds row; a constant column is widened by a half on both sides."""
    low, high = F.min(column).cast("double"), F.max(column).cast("double")
    half = F.when(low == high, 0.5).otherwise(0.0)
    return df.agg((low - half).alias(f"{side}_low"), (high + half).alias(f"{side}_high"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, lower, upper, n) for every bin, empty ones too; NULLs are dropped.

    Text counts as the number that it is; other text and NaN are dropped too.
    """
    df = clean_numbers(df.select(column), [column])
    bounds = _range(df, column, "x")
    low, high = bounds.select("x_low").scalar(), bounds.select("x_high").scalar()
    counts = (
        df.where(F.col(column).isNotNull())
        .select(_axis(F.col(column).cast("double"), low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    spine = (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high"))
        .where(F.col("low").isNotNull())
    )
    width = (F.col("high") - F.col("low")) / bins
    return (
        spine.join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("lower"),
            F.when(F.col("bin") == bins - 1, F.col("high"))
            .otherwise(F.col("low") + (F.col("bin") + 1) * width)
            .alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def _in_cells(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """The rows with two numbers, each with its cell in a grid over all of them."""
    df = clean_numbers(df, [x, y])
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounds = {side: _range(both, column, side) for side, column in (("x", x), ("y", y))}

    def axis(side: str, column: str) -> Column:
        low = bounds[side].select(f"{side}_low").scalar()
        high = bounds[side].select(f"{side}_high").scalar()
        return _axis(F.col(column).cast("double"), low, high, bins)

    return both.select("*", axis("x", x).alias("x_bin"), axis("y", y).alias("y_bin"))


def grid(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts over a grid of equal cells, in place of a scatter plot's points.

    Text counts as the number that it is; rows without two numbers are dropped.
    """
    return (
        _in_cells(df.select(x, y), x, y, bins)
        .groupBy("x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
        .orderBy("x_bin", "y_bin")
    )


def grid_sample(
    df: DataFrame, x: str, y: str, keys: Sequence[str], n: int = 20, bins: int = 20, seed: int = 0
) -> DataFrame:
    """A scatter plot's points, thinned: of each cell of a grid the ``n`` rows whose keys have the
    least hash under the seed, or all if there are fewer.

    The hash sees keys alone, so the sample is the same for any partitioning, and that of a union
    is the sample of its parts' samples. Each task keeps ``n`` rows of a cell before the shuffle
    (the planner does so up to its ``windowGroupLimitThreshold`` of 1,000), so a cell with a third
    of all rows costs no more than ``n`` for each task. Rows under one key are ordered by their numbers.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    order = Window.partitionBy("x_bin", "y_bin").orderBy("_hash", *keys, x, y)
    return (
        _in_cells(df.select(*keys, x, y), x, y, bins)
        .withColumn("_hash", F.md5(text))
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= n)
        .drop("_hash", "_place")
    )


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar month, labelled by its last day, with 0 for months without rows."""
    counts = (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.last_day(F.to_date(ts)).alias("month_end"))
        .agg(F.count("*").alias("n"))
    )
    span = df.agg(F.to_date(F.min(ts)).alias("start"), F.to_date(F.max(ts)).alias("end"))
    months = span.where(F.col("start").isNotNull()).select(
        F.explode(
            F.sequence(F.trunc("start", "MM"), F.col("end"), F.make_ym_interval(months=F.lit(1)))
        ).alias("month")
    )
    return (
        months.select(F.last_day("month").alias("month_end"))
        .join(counts, "month_end", "left")
        .select("month_end", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("month_end")
    )
