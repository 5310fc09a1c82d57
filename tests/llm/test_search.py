from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from bazaar.llm import search as sr


def brute(rows, queries, top=10):
    """(query, rank, id, score), each score as the sum of rounded postings."""
    bags = [(i, sr.terms((t or "").encode())) for i, t in rows]
    n, mean = len(bags), sum(len(b) for _, b in bags) / len(bags)
    df = Counter(t for _, b in bags for t in set(b))
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    out = []
    for query, text in queries:
        weights = Counter(sr.terms((text or "").encode()))
        scored = []
        for i, bag in bags:
            tf = Counter(bag)
            norm = sr.K1 * (1 - sr.B + sr.B * len(bag) / mean)
            score = sum(
                w * int(np.rint(sr.STEPS * idf[t] * tf[t] * (sr.K1 + 1) / (tf[t] + norm)))
                for t, w in weights.items() if tf[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [
            (query, rank, None if none else i, -score)
            for rank, (score, none, i) in enumerate(sorted(scored)[:top], 1)
        ]
    return sorted(out, key=str)


def found(docs, queries, **more):
    rows = sr.search(docs, queries, **more).select("query_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.fixture(scope="module")
def asked(spark):
    return lambda rows: spark.createDataFrame(rows, "query_id long, text string")


@pytest.fixture
def rows(prose):
    # Words of very different frequency, ties, and lengths from one word on.
    return [(i, f"{prose(1 + i % 70, i, 30)} {prose(1 + i % 9, -i, 3000)}") for i in range(700)] + [
        (1000 + i, "w1 w2 same") for i in range(15)
    ]


def test_equals_brute_force(documents, asked, rows, prose):
    queries = [(i, prose(4 + i, f"q{i}", 60)) for i in range(12)] + [(50, "W1 w1 w2"), (51, "same")]
    docs = documents(rows, rank=F.lit(1), term=F.lit("clash"))
    assert found(docs, asked(queries)) == brute(rows, queries)


def test_shards_and_blocks_give_the_same(documents, asked, rows, prose, monkeypatch):
    monkeypatch.setattr(sr, "SHARD_BYTES", 2000)
    monkeypatch.setattr(sr, "BLOCK", 8)
    queries = [(i, prose(4 + i, f"q{i}", 60)) for i in range(6)]
    assert found(documents(rows), asked(queries), query_bytes=60, top=3) == brute(rows, queries, 3)


def test_odd_rows(documents, asked):
    rows = [*enumerate(ODD), (None, "one two"), (None, "word"), (3, "one two")]
    queries = [(0, None), (1, ""), (2, "one two é 日本語"), (3, "absent"), (4, "word"), (None, "x")]
    assert found(documents(rows), asked(queries)) == brute(rows, queries)


def test_empty_tables(documents, asked):
    assert found(documents([]), asked([(1, "a")])) == []
    assert found(documents(["a"]), asked([])) == []
    assert found(documents([None, ""]), asked([(1, "a")])) == []


def test_blocks_are_skipped():
    """Dynamic pruning leaves out blocks that cannot hold a result."""
    shard = sr.Shard(np.full(20 * sr.BLOCK, 50), 50.0)
    shard.add(b"often", np.arange(shard.size), np.ones(shard.size, np.int64), 0.1)
    shard.add(b"rare", np.array([5, 900]), np.array([3, 3]), 5.0)
    touched = []
    often = shard.lists[b"often"]

    class Scores(np.ndarray):
        def __getitem__(self, key):
            touched.append(key)
            return super().__getitem__(key)

    shard.lists[b"often"] = (often[0], often[1].view(Scores), *often[2:])
    best = shard.search({b"often": 1, b"rare": 1}, 2)
    # Up to the block of the second result; none of the twelve behind it.
    assert [text for _, text in best] == [5, 900] and len(touched) == 900 // sr.BLOCK + 1
