"""Texts move for a list of hashes only where a table of bits cannot tell them apart from it."""

import re

import pytest
from pyspark.sql import functions as F

from bazaar.llm import common
from bazaar.llm import ngram_join as nj


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_split_by_bits(spark):
    edges = [0, 1, -1, 32767, 32768, 32769, (1 << 24) - 1, 1 << 24, 2**63 - 1, -(2**63)]
    rows = spark.createDataFrame([(i,) for i in [*edges, *range(-500, 500)]], "h long")
    listed = [h for h in [*edges, *range(-500, 500)] if h % 7 == 1 or h in edges]
    bits = common.hash_bits(spark.createDataFrame([(h,) for h in [*listed, *listed]], "h long"))
    out, maybe = (
        sorted(r.h for r in part.collect()) for part in common.split_by_bits(rows, F.col("h"), bits)
    )
    assert sorted(out + maybe) == sorted([*edges, *range(-500, 500)])
    assert set(listed) <= set(maybe)
    # What passes besides the listed ones has the place of one of them.
    places = {h % 2**24 for h in listed}
    assert all(h % 2**24 in places for h in maybe) and not any(h % 2**24 in places for h in out)


def test_split_by_no_bits(spark):
    rows = spark.range(5)
    bits = common.hash_bits(spark.createDataFrame([], "h long"))
    out, maybe = common.split_by_bits(rows, F.col("id"), bits)
    assert out.count() == 5 and maybe.count() == 0


def test_one_of_each_moves_few_texts(spark, documents, prose, no_broadcast):
    texts = [prose(40, f"own {i}", 5000) for i in range(200)]
    kept = nj.one_of_each(documents([*texts, texts[3], texts[3].upper()]))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200))
    # The texts that surely stay meet the table of bits where they are, and no list.
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter.*__hb_row.*rightHint=\(strategy=broadcast\)", plan), plan
    for anti in re.findall(r"\n( *)[^\n]*Join LeftAnti[^\n]*\n((?:[^\n]*\n)*)", plan):
        assert "__hb_bits" in anti[1]
