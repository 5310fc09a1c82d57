from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.operators import quality
from bazaar.schemas import TABLES


def test_duplicate_and_orphan_keys(spark, rows):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", None)], "k string, fk int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.duplicate_keys(child, "t", ["k", "fk"])) == [("t", "a|1", 2)]
    assert rows(quality.orphan_keys(child, "t", "fk", parent, "id")) == [("t", "fk", "1", 2)]


def test_length_report(spark, rows):
    df = spark.createDataFrame([("123456", "SP"), ("1", "SPX"), (None, "S")], "z string, s string")
    assert rows(quality.length_report(df, "t", [("z", 5), ("s", 2)])) == [
        ("t", "s", 2, 3, 1),
        ("t", "z", 5, 6, 1),
    ]


def test_every_breach_is_reported_and_null_conditions_are_none(spark, rows):
    df = spark.createDataFrame(
        [("k1", "123456", "SP"), (None, "1234567", "SPX"), ("k3", None, None)],
        "zip_code_prefix string, city string, state string",
    )
    rules = [
        quality.Rule("city", F.col("city"), F.length("city") > 5, "long"),
        quality.Rule("state", F.col("state"), F.length("state") > 2, "long"),
        *quality.rules_for(TABLES["dim_sellers"])[1:],
    ]
    assert rows(quality.bad_rows(df, rules, "t", ["zip_code_prefix"])) == sorted(
        [
            ("t", "k1", "city", "123456", "long"),
            ("t", "", "city", "1234567", "long"),
            ("t", "", "state", "SPX", "long"),
        ],
        key=repr,
    )
    assert df.where(~quality.any_breach(rules)).count() == 1


def test_empty_tables(spark):
    full = spark.range(1)
    assert quality.empty_tables({"a": full, "b": full.limit(0)}) == ["b"]
