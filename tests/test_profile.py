from __future__ import annotations

import hashlib
from datetime import date, datetime

import numpy as np
import pytest

from bazaar.operators import profile


def test_table_profile_and_missing_values(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert rows(profile.table_profile(df, "t")) == [
        ("t", 1, "a", "int", 2, 3),
        ("t", 2, "b", "string", 2, 3),
    ]
    assert rows(profile.null_counts(df, "t")) == [("t", "a", 0), ("t", "b", 2)]
    assert rows(profile.null_counts(df, "t", only_missing=True)) == [("t", "b", 2)]


def test_distribution_counts_missing_in_the_whole(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert rows(profile.distribution(df, "s")) == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_group_sizes(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "s string")
    assert rows(profile.size_distribution(df, "s")) == [(1, 2), (2, 1)]
    assert [tuple(r) for r in profile.top_values(df, "s", 2).collect()] == [("a", 2), ("b", 1)]


def test_distinct_counts_leave_out_null(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "s string, n int")
    assert rows(profile.distinct_counts(df, ["s", "n"])) == [("n", 2), ("s", 1)]


@pytest.mark.parametrize(
    "values",
    [
        [0.0, 0.1, 0.3, 0.7, 1.0],
        [i / 7 for i in range(60)],
        [5.0, 5.0, 5.0],
        [-3.25, 8.5, 8.5, 0.0, 1e-9],
    ],
)
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = profile.histogram(df, "v", 10).collect()
    counts, edges = np.histogram(values, 10)
    assert [r.n for r in got] == list(counts)
    np.testing.assert_allclose([r.lower for r in got], edges[:-1], rtol=1e-12, atol=1e-15)
    assert got[-1].upper == edges[-1]


def test_histogram_of_nothing(spark):
    assert profile.histogram(spark.createDataFrame([(None,)], "v double"), "v").isEmpty()


def test_grid_equals_numpy(spark):
    points = [(i * 1.5, (i * i) % 17 + 0.25) for i in range(80)]
    df = spark.createDataFrame([*points, (None, 1.0), (1.0, None)], "x double, y double")
    got = {(r.x_bin, r.y_bin): r.n for r in profile.grid(df, "x", "y", 6).collect()}
    counts, _, _ = np.histogram2d(*zip(*points, strict=True), bins=6)
    assert got == {(i, j): n for (i, j), n in np.ndenumerate(counts) if n}


def test_sample_of_a_grid_is_the_least_hashes_of_each_cell(spark):
    points = [(str(i), float(i % 7), float(i % 3)) for i in range(500)]
    points += [("hot" + str(i), 0.0, 0.0) for i in range(400)]
    schema = "k string, x double, y double"
    df = spark.createDataFrame([*points, ("n", None, 1.0), ("m", 1.0, None)], schema)
    cells = {}
    for key, x, y in points:
        rank = hashlib.md5(f"3|{key}".encode()).hexdigest()
        cells.setdefault((min(int(x / 6 * 4), 3), min(int(y / 2 * 4), 3)), []).append((rank, key))
    want = {key for cell in cells.values() for _, key in sorted(cell)[:9]}
    for parts in (1, 7):
        sample = profile.grid_sample(df.repartition(parts), "x", "y", ["k"], 9, 4, 3)
        assert {r.k for r in sample.collect()} == want
    other = profile.grid_sample(df, "x", "y", ["k"], 9, 4, 4)
    assert {r.k for r in other.collect()} != want
    assert profile.grid_sample(df.limit(0), "x", "y", ["k"]).isEmpty()


def test_sample_keeps_few_rows_of_a_cell_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "double(id) AS x", "double(id) AS y")
    sample = profile.grid_sample(df, "x", "y", ["id"], 5)
    text = sample._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning(x_bin") < text.rindex("WindowGroupLimit")


def test_months_without_rows_are_zero(spark):
    at = [datetime(2024, 1, 31, 23), datetime(2024, 1, 2), datetime(2024, 3, 1), None]
    df = spark.createDataFrame([(t,) for t in at], "t timestamp_ntz")
    assert [tuple(r) for r in profile.monthly_counts(df, "t").collect()] == [
        (date(2024, 1, 31), 2),
        (date(2024, 2, 29), 0),
        (date(2024, 3, 31), 1),
    ]


def test_histogram_and_grid_of_text(spark):
    texts = [("9", "1"), ("10", "2"), ("55", "3"), ("100", "x"), ("bad", "4"), (None, "5"), ("NaN", "6")]
    df = spark.createDataFrame(texts, "v string, w string")
    bins = profile.histogram(df, "v", 10).collect()
    assert (bins[0].lower, bins[-1].upper, sum(b.n for b in bins)) == (9.0, 100.0, 4)
    assert sum(r.n for r in profile.grid(df, "v", "w", 4).collect()) == 3


def test_histogram_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")
    bins = profile.histogram(df, "v", 2).collect()
    assert [(b.lower, b.upper, b.n) for b in bins] == [(1.0, 1.5, 1), (1.5, 2.0, 1)]


def test_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0, "0.0"), (-0.0, "-0.0")], "v double, t string")
    got = {r.column_name: r.n_distinct for r in profile.distinct_counts(df, ["v", "t"]).collect()}
    assert got == {"v": 1, "t": 2}
