from __future__ import annotations

import re

import numpy as np
import pytest
from conftest import ODD, TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import ngram_join as nj
from bazaar.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    own = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def brute(rows, percent=75):
    """id -> (size, smallest id) of rows (id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df, **more):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nj.jaccard_components(df, **more).collect()}


def changed(text, places, mark):
    own = text.split()
    for p in places:
        own[p % len(own)] = f"{mark}{p}"
    return " ".join(own)


@pytest.fixture(scope="module")
def near(prose):
    """Texts of 2 to 900 words with near copies on both sides of the threshold."""
    rng = np.random.default_rng(1)
    texts = []
    for i, size in enumerate([2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 70, 100, 200, 400, 900]):
        base = prose(size, f"base {i}", 5000)
        texts += [base, base.upper(), f"{base} tail{i}", f"head{i} {base}"]
        for k in range(6):
            changes = rng.integers(0, size, max(1, size * k // 100))
            texts.append(changed(base, changes, f"c{i}x{k}y"))
            texts.append(" ".join(base.split()[: size - size * k // 20]))
    return texts


def test_equals_brute_force(documents, near):
    rows = list(enumerate(near))
    assert found(documents(near, n=F.lit(1), set=F.lit("clash"))) == brute(rows)


def test_other_thresholds(documents, near):
    some = near[40:140]
    assert found(documents(some), percent=60) == brute(list(enumerate(some)), 60)
    with pytest.raises(ValueError):
        found(documents(some), percent=10)


def test_chains_and_large_groups(documents, prose):
    base = prose(60, "chain", 5000).split()
    chain = [" ".join([*base[i:], *(f"n{j}" for j in range(i))]) for i in range(0, 30)]
    copies = [chain[0]] * 40 + [changed(chain[0], [i], "v") for i in range(60)]
    texts = [*chain, *copies, prose(60, "other", 5000)]
    assert found(documents(texts)) == brute(list(enumerate(texts)))


def test_common_passages_link_nothing(documents, prose):
    passage = prose(50, "passage", 5000)
    texts = [f"{prose(100, f'a{i}', 9000)} {passage} {prose(100, f'b{i}', 9000)}" for i in range(80)]
    assert found(documents(texts)) == brute(list(enumerate(texts)))


def test_odd_rows(documents):
    assert found(documents(ODD)) == brute(list(enumerate(ODD)))
    assert found(documents([])) == {}
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "lonely words"), (None, "")]
    got = nj.jaccard_components(documents(rows)).collect()
    assert sorted((r.n_shingles, r.component_id or -1) for r in got) == [(0, -1), (1, -1), (2, 7), (2, 7)]


def test_few_segments_keys_are_complete():
    """With all shingles of a set in one segment, sets that differ little still share a key."""
    rng = np.random.default_rng(2)
    top = np.uint64(1) << np.uint64(63)
    for size in (4, 7, 12, 30):
        for _ in range(40):
            base = top + rng.integers(0, 1 << 20, size * 2).astype(np.uint64)
            base = np.unique(base)[:size]
            for less in range(1, size):
                if 100 * (size - less) < 75 * size:
                    break
                part = np.sort(rng.choice(base, size - less, replace=False))
                flat, bounds = np.concatenate([base, part]), np.array([0, size, size + len(part)])
                keys, number = nj.chosen_keys(flat, bounds, 75, lambda k: np.zeros(len(k), np.uint64))
                assert set(keys[number == 0]) & set(keys[number == 1]), (size, less)


def test_one_of_each(documents):
    rows = [
        (1, "a b c d e f"), (2, "a b c d e f"), (3, ""), (3, ""), (4, None), (5, "other words here"),
        (5, "other words here"), (6, "Other words HERE"), (None, "a b c d e f"), (None, "alone alone"),
        (None, "alone alone"), (5, "and a third text"),
    ]
    docs = documents(rows, __own=F.lit(1))
    kept = nj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [
            (1, "a b c d e f"), (3, ""), (3, ""), (4, None), (5, "other words here"),
            (None, "alone alone"), (5, "and a third text"),
        ],
        key=str,
    )


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, TESTDATA, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_ngram_join(spark, TESTDATA).collect()}
    assert got == brute(rows)
