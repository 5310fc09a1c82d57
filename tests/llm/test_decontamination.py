from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import decontamination as dc
from bazaar.llm import queries
from bazaar.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    """(words, hit words, ids) of each text."""
    of = {}
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            of.setdefault(tuple(own[i : i + size]), set()).add(item)
    found = []
    for text in texts:
        own = words(text)
        hit, ids = [False] * len(own), set()
        for size in {len(w) for w in of}:
            for i in range(len(own) - size + 1):
                match = of.get(tuple(own[i : i + size]))
                if match:
                    ids |= match
                    hit[i : i + size] = [True] * size
        found.append((len(own), sum(hit), sorted(map(str, ids - {None}))))
    return found


@pytest.fixture(scope="module")
def benchmark(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


def found(docs, items, **more):
    rows = dc.find_contamination(docs, items, **more).withColumn("hit", dc.hit_words()).collect()
    return [(r[dc.WORDS], r.hit, r[dc.ITEMS]) for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("size,alphabet", [(1, 1), (60, 2), (500, 4), (2000, 1)])
def test_index_finds_every_occurrence(size, alphabet):
    rng = np.random.default_rng(size)
    text = rng.integers(0, alphabet + 1, size)
    index = FMIndex(text, alphabet + 1)
    phrases = [text[i : i + n] for n in (1, 2, 7) for i in range(0, size - n + 1, max(1, size // 5))]
    phrases.append(np.full(9, alphabet))
    table, lengths = np.zeros((len(phrases), 9), np.int64), np.array([len(p) for p in phrases])
    for row, phrase in zip(table, phrases, strict=True):
        row[9 - len(phrase) :] = phrase
    for phrase, low, high in zip(phrases, *index.ranges(table, lengths), strict=True):
        n = len(phrase)
        want = [i for i in range(size - n + 1) if (text[i : i + n] == phrase).all()]
        assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_equals_brute_force(documents, benchmark, prose):
    items = [(i, prose(10 + 3 * i, f"item {i}", 60)) for i in range(6)]
    items += [(7, "w1 w2"), (8, items[0][1]), (9, None), (10, "--"), (None, prose(12, "lost", 60))]
    texts = [prose(300, f"doc {i}", 60) for i in range(20)]
    texts += [f"{prose(9, 1)} {items[i % 6][1].upper()}, {prose(30, i)}" for i in range(12)]
    texts += [None, "", " \n", items[3][1] * 400, items[10][1], texts[25], texts[25]]
    docs = documents(texts, __extra=F.lit(1), n_words=F.lit("clash"))
    assert found(docs, benchmark(items)) == brute(texts, items)


def test_blocks_give_the_same(documents, benchmark, prose):
    items = [(i, prose(40, f"b{i}")) for i in range(12)]
    texts = [f"{prose(20, i)} {items[i][1]} {items[i - 1][1]}" for i in range(12)]
    docs = documents(texts)
    assert found(docs, benchmark(items), block_bytes=500) == brute(texts, items)
    with pytest.raises(ValueError, match="does not fit"):
        found(docs, benchmark(items), block_bytes=10)


def test_empty_tables(documents, benchmark):
    assert found(documents([]), benchmark([(1, "a b c")])) == []
    assert found(documents(["a b c", None]), benchmark([])) == [(3, 0, []), (0, 0, [])]


def test_removal_keeps_clean_documents(documents, benchmark, prose):
    item = prose(30, "item")
    clean = ["clean text, as it was.\n", None, "", prose(2000, 1)]
    docs = documents([*clean, f"Before it: {item.upper()}. After!", item])
    rows = dc.remove_contamination(docs, benchmark([(1, item)])).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [*clean, "Before it: . After!"]
    assert rows[0].asDict().keys() == set(docs.columns)


def test_query(spark):
    docs = queries.table(spark, TESTDATA, "documents").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in queries.table(spark, TESTDATA, "benchmark").collect()]
    want = [
        (n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)
        for n, hit, ids in brute([d.text for d in docs], items)
    ]
    rows = queries.op6_decontamination(spark, TESTDATA).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == want and any(r.contaminated for r in rows)
