from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from bazaar.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, queries, top=20):
    """(query, rank, id, score): every text scored for every query."""
    bags = [(i, Counter(words(t))) for i, t in rows]
    sizes = [sum(bag.values()) for _, bag in bags]
    n, total = sum(size > 0 for size in sizes), sum(sizes)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for query, text in queries:
        scored = []
        for (i, bag), size in zip(bags, sizes, strict=True):
            score = 0
            for term in words(text):
                if tf := bag[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + (25 * size * n) // total
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [
            (query, rank, None if none else i, -score)
            for rank, (score, none, i) in enumerate(sorted(scored)[:top], 1)
        ]
    return sorted(out, key=str)


def found(docs, queries, **more):
    rows = ranked.ranked_search(docs, queries, **more).select("query_id", "rank", "doc_id", "score")
    return sorted(map(tuple, rows.collect()), key=str)


def asked(spark, pairs):
    return spark.createDataFrame(pairs, "query_id long, text string")


@pytest.fixture(scope="module")
def corpus(prose):
    rng = np.random.default_rng(4)
    texts = [prose(int(rng.integers(1, 120)), f"t{i}", 60) for i in range(300)]
    return [*ODD, *texts, texts[7], texts[7], texts[7].upper(), "tie one", "one tie"]


def test_equals_brute_force(spark, documents, corpus, prose):
    queries = [(i, prose(3 + i, f"q{i}", 70)) for i in range(8)] + [(90, "ONE tie"), (91, "one one word")]
    rows = list(enumerate(corpus))
    assert found(documents(corpus), asked(spark, queries)) == brute(rows, queries)
    assert found(documents(corpus), asked(spark, queries), top=3) == brute(rows, queries, top=3)


def test_many_shards_blocks_and_depths(spark, documents, corpus, prose, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_BYTES", 4096)
    monkeypatch.setattr(ranked, "FIRST", 2)
    queries = [(i, prose(5, f"q{i}", 70)) for i in range(12)]
    rows = list(enumerate(corpus))
    got = found(documents(corpus).repartition(5), asked(spark, queries), query_bytes=64)
    assert got == brute(rows, queries)


def test_ties_by_id_and_rows_without_one(spark, documents):
    docs = documents([(5, "alpha beta"), (3, "beta alpha"), (None, "alpha beta"), (9, "gamma")])
    queries = [(1, "alpha")]
    assert found(docs, asked(spark, queries), top=2) == brute([(5, "alpha beta"), (3, "beta alpha"),
        (None, "alpha beta"), (9, "gamma")], queries, top=2)
    assert [r[2] for r in found(docs, asked(spark, queries))] == [3, 5, None]


def test_odd_queries_repeated_rows_and_empty_tables(spark, documents, corpus):
    queries = [(1, None), (2, ""), (3, "..."), (None, "word"), (4, "word"), (4, "word"), (5, "absent9")]
    docs = documents(corpus)
    got = found(docs, asked(spark, queries))
    assert got == brute(list(enumerate(corpus)), queries)
    assert sum(r[0] == 4 for r in got) == 2 * sum(r[0] is None for r in got) > 0
    assert found(docs.limit(0), asked(spark, queries)) == []
    assert found(docs, asked(spark, queries).limit(0)) == []
    assert found(documents([None, "", "..."]), asked(spark, queries)) == []


def test_clashing_columns(spark, documents):
    docs = documents(["a b", "b c"], rank=F.lit(1), score=F.lit("x"), shard=F.lit(2), query_id=F.lit(3))
    queries = asked(spark, [(1, "a b")]).withColumn("score", F.lit(0)).withColumn("doc_id", F.lit(9))
    assert [r[2] for r in found(docs, queries)] == [0, 1]


def test_reading_stops_before_the_end_of_the_lists():
    """A text that no other can reach is settled without reading all that is common."""
    size = 4000
    common = np.arange(size), np.full(size, 5)
    rare = np.array([17]), np.array([900])

    class Watched(np.ndarray):
        deepest = 0

        def __getitem__(self, item):
            if isinstance(item, slice) and item.stop and len(self) == size:
                Watched.deepest = max(Watched.deepest, item.stop)
            return super().__getitem__(item)

    lists = [(1, common[0].view(Watched), common[1]), (3, *rare)]
    texts, scores = ranked.no_random_access(lists, size, 1, 1)
    assert (texts.tolist(), scores.tolist()) == ([17], [2705])
    assert Watched.deepest < size
    # A warm start from earlier shards leaves out everything that cannot reach it.
    texts, _ = ranked.no_random_access([(1, *common)], size, 1, 6)
    assert texts.tolist() == []


def test_very_long_text(spark, documents):
    text = "alpha " * 700_000 + "omega"
    docs = documents([text, "omega", "alpha"])
    queries = [(1, "omega alpha")]
    assert found(docs, asked(spark, queries)) == brute([(0, text), (1, "omega"), (2, "alpha")], queries)
