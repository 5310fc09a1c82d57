from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import bazaar.operators.quantiles as module
from bazaar.operators.dedup import keep_first
from bazaar.operators.positions import assign_keys, positions, running_totals
from bazaar.operators.quantiles import box_plot, describe, quantiles
from bazaar.operators.upsert import one_per_key, reduce_batch, upsert
from bazaar.schemas import ROW_ORDER

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_keep_first_takes_whole_rows_and_one_null_key(spark, rows):
    df = spark.createDataFrame(
        [
            ("1", "later", 2),
            ("1", None, 1),
            (None, "x", 4),
            (None, "y", 3),
        ],
        f"zip string, city string, {ROW_ORDER} int",
    )
    assert rows(keep_first(df, ["zip"]), "zip", "city") == [("1", None), (None, "y")]
    assert rows(keep_first(df.repartition(4), ["zip"])) == rows(keep_first(df, ["zip"]))


TARGET = "k string, a string, b string, c string"
BATCH = f"{TARGET}, {ROW_ORDER} int"


def test_upsert_rules(spark, rows):
    target = spark.createDataFrame(
        [("old", "a0", "b0", "c0"), ("kept", "a1", None, "c1"), ("nulled", "a2", "b2", "c2")],
        TARGET,
    )
    batch = spark.createDataFrame(
        [
            ("old", "A", "B", "C", 1),
            ("new", None, "B", None, 2),
            ("twice", "first", "first", "first", 3),
            ("twice", "last", None, "last", 4),
            ("nulled", None, "B", "C", 5),
        ],
        BATCH,
    )
    reduced = reduce_batch(batch, ["k"], ["a", "b"])
    assert rows(upsert(target, reduced, ["k"], ["a", "b"])) == sorted(
        [
            ("old", "A", "B", "c0"),
            ("kept", "a1", None, "c1"),
            ("nulled", None, "B", "c2"),
            ("new", None, "B", None),
            ("twice", "last", None, "first"),
        ],
        key=repr,
    )


def test_upsert_without_update_columns_inserts_only(spark, rows):
    target = spark.createDataFrame([("old", "a0", "b0", "c0")], TARGET)
    batch = spark.createDataFrame(
        [("old", "A", "B", "C", 1), ("new", "1", "1", "1", 2), ("new", "2", "2", "2", 3)], BATCH
    )
    assert rows(upsert(target, reduce_batch(batch, ["k"], []), ["k"], [])) == [
        ("new", "1", "1", "1"),
        ("old", "a0", "b0", "c0"),
    ]


def test_upsert_of_an_empty_batch_and_into_an_empty_target(spark, rows):
    target = spark.createDataFrame([("old", "a0", "b0", "c0")], TARGET)
    empty = target.limit(0)
    assert rows(upsert(target, empty, ["k"], ["a"])) == rows(target)
    assert rows(upsert(empty, target, ["k"], ["a"])) == rows(target)


@SLOW
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from("xyz") | st.none(), st.integers(0, 9)),
        max_size=12,
    ),
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from("xyz"), st.integers(0, 9)), max_size=3),
)
def test_upsert_equals_row_by_row(spark, batch, stored):
    state = {k: (u, r) for k, u, r in stored}
    target = spark.createDataFrame([(k, u, r) for k, (u, r) in state.items()], "k int, u string, r int")
    for k, u, r in batch:
        state[k] = (u, state[k][1]) if k in state else (u, r)
    frame = spark.createDataFrame(
        [(*row, i) for i, row in enumerate(batch)], f"k int, u string, r int, {ROW_ORDER} int"
    ).repartition(3)
    got = upsert(target, reduce_batch(frame, ["k"], ["u"]), ["k"], ["u"]).collect()
    assert {r.k: (r.u, r.r) for r in got} == state and len(got) == len(state)


def test_one_per_key_equals_reduce_batch(spark, rows):
    unique = [(str(i), "a", "b", "c", i) for i in range(50)]
    repeated = [("7", "z", "z", "z", 100), ("7", "y", "y", "y", 101), ("9", None, None, None, 99)]
    for data in (unique, unique + repeated):
        batch = spark.createDataFrame(data, BATCH).repartition(3)
        assert rows(one_per_key(batch, ["k"], ["a"])) == rows(reduce_batch(batch, ["k"], ["a"]))


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("t"))
    got = positions(df.repartition(5), ["v"]).orderBy("v").collect()
    assert [r.position for r in got] == list(range(1000))


def test_keys_continue_after_the_last(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "zip string")
    keyed = assign_keys(df, "zip", "id", last=10)
    assert dict(keyed.dtypes)["id"] == "int"
    assert {r.zip: r.id for r in keyed.collect()} == {"a": 11, "b": 12, "c": 13}


def test_running_totals(spark):
    df = spark.range(200).select(F.col("id").alias("v"), (F.col("id") % 3).alias("w"))
    got = running_totals(df.repartition(4), ["v"], "w").orderBy("v").toPandas()
    expected = got.w.cumsum() - got.w
    assert (got.before == expected).all()


def _mixed(spark, n: int):
    """A spread column, and one where a single value holds a third of the rows."""
    return spark.range(n).select(
        (F.rand(1) * 1000).alias("spread"),
        F.when(F.col("id") % 3 == 0, 5.0)
        .when(F.col("id") % 11 == 0, float("nan"))
        .when(F.col("id") % 13 != 0, F.round(F.randn(2) * 10, 1))
        .alias("hot"),
    )


@pytest.mark.parametrize("n, accuracy", [(5000, 10_000), (30_000, 10_000), (5000, 50), (7, 50)])
def test_quantiles_equal_numpy(spark, n, accuracy, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "ACCURACY", accuracy)
    _mixed(spark, n).write.parquet(str(tmp_path / "q"))
    df = spark.read.parquet(str(tmp_path / "q"))
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {
        r.column_name: list(r)[1:]
        for r in quantiles(df, ["spread", "hot"], probabilities).collect()
    }
    frame = df.toPandas()
    for column in ("spread", "hot"):
        values = frame[column].dropna()
        assert got[column][0] == len(values)
        np.testing.assert_allclose(got[column][1:], values.quantile(probabilities), rtol=1e-12)


def test_bounds_that_miss_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(module, "bounds", lambda c, p: F.array(F.lit(1.0), F.lit(2.0)))
    with pytest.raises(ArithmeticError):
        quantiles(_mixed(spark, 20_000), ["spread"], [0.5])


def test_quantiles_of_text(spark):
    texts = ["9", "10", "55", "100", "bad", None, " 7 ", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    row = describe(df, ["v"]).first()
    assert (row.n, row["min"], row.p50, row["max"]) == (5, 7.0, 10.0, 100.0)
    assert box_plot(df, ["v"]).first().n == 5


def test_quantiles_of_tiny_columns(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None)], "a double, b double")
    got = {r.column_name: tuple(r) for r in quantiles(df, ["a", "b"], [0.25, 0.5]).collect()}
    assert got == {"a": ("a", 2, 1.75, 2.5)}


def test_describe_equals_pandas(spark):
    df = _mixed(spark, 500)
    df = spark.createDataFrame(df.toPandas())
    got = describe(df, ["spread", "hot"]).toPandas().set_index("column_name")
    expected = df.toPandas().describe().T
    expected.columns = ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]
    pd.testing.assert_frame_equal(
        got.loc[["spread", "hot"]].astype(float),
        expected.loc[["spread", "hot"]],
        check_names=False,
        rtol=1e-9,
    )


def test_box_plot(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, 6, 7, 100, -50)], "v double")
    row = box_plot(df, ["v"]).first()
    assert (row.p25, row.p50, row.p75) == (2.0, 4.0, 6.0)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 7.0, 2)


def test_merged_bitmaps_count_each_key_once(spark):
    from bazaar.operators.mergeable import distinct_keys, key_bitmaps

    # Keys of two ranges, in several groups and repeated; one group has none.
    rows = [(day, key) for day, keys in ((1, (0, 5, 40_000)), (2, (5, 40_000, 40_001)), (3, (7,))) for key in keys]
    df = spark.createDataFrame(rows * 3, "day int, key long").repartition(5)
    bitmaps = key_bitmaps(df, ["day"], "key")
    by_day = distinct_keys(bitmaps, {"day": F.col("day")}, "n")
    assert {r.day: r.n for r in by_day.collect()} == {1: 3, 2: 3, 3: 1}
    odd = distinct_keys(bitmaps, {"odd": F.col("day") % 2}, "n")
    assert {r.odd: r.n for r in odd.collect()} == {0: 3, 1: 4}
    assert "distinct" not in odd._jdf.queryExecution().optimizedPlan().toString().lower()
    assert distinct_keys(key_bitmaps(df.limit(0), ["day"], "key"), {"day": F.col("day")}, "n").count() == 0


def test_merged_sketches_keep_their_bound(spark):
    from bazaar.operators.mergeable import RANK_ERROR, quantile_sketches, sketched_quantiles

    shares = [0.01, 0.5, 0.9]
    df = spark.range(60_000).select((F.col("id") % 7).alias("month"), F.when(F.col("id") % 11 > 0, F.col("id")).alias("x"))
    sketches = quantile_sketches(df.repartition(6), ["month"], "x")
    whole = sketched_quantiles(sketches, [], shares).collect()
    assert [r.p for r in whole] == shares and {r.n for r in whole} == {df.where("x IS NOT NULL").count()}
    assert all(abs(r.value / 60_000 - r.p) <= RANK_ERROR for r in whole)
    assert sketched_quantiles(sketches, ["month"], shares).count() == 21
    assert sketched_quantiles(quantile_sketches(df.limit(0), ["month"], "x"), ["month"], shares).count() == 0
