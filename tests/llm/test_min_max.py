from __future__ import annotations

import re

import numpy as np
import pytest
from conftest import ODD, TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import min_max as mm
from bazaar.llm import queries, set_links

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=2):
    own = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(own) < width:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1))


def brute(rows, percent=80):
    """id -> (size, smallest id of the component, kept) of rows (id, text) with distinct ids."""
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
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def found(df, **more):
    return {
        r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in mm.near_duplicates(df, **more).collect()
    }


def changed(text, places, mark):
    own = text.split()
    for p in places:
        own[p % len(own)] = f"{mark}{p}"
    return " ".join(own)


@pytest.fixture(scope="module")
def near(prose):
    """Texts of 1 to 900 words with near copies on both sides of the threshold."""
    rng = np.random.default_rng(1)
    texts = []
    for i, size in enumerate([1, 2, 3, 4, 5, 6, 8, 10, 12, 15, 20, 30, 45, 70, 100, 200, 400, 900]):
        base = prose(size, f"base {i}", 5000)
        texts += [base, base.upper(), f"{base} tail{i}", f"head{i} {base}"]
        for k in range(8):
            texts.append(changed(base, rng.integers(0, size, max(1, size * k // 60)), f"c{i}x{k}y"))
            texts.append(" ".join(base.split()[: size - size * k // 30]))
    return texts


def test_equals_brute_force(documents, near):
    rows = list(enumerate(near))
    assert found(documents(near, n=F.lit(1), set=F.lit("clash"), key=F.lit(2))) == brute(rows)


def test_many_partitions_and_a_higher_threshold(documents, near):
    some = near[60:200]
    assert found(documents(some).repartition(9), percent=90) == brute(list(enumerate(some)), 90)


def test_chains_and_large_groups(documents, prose):
    base = prose(60, "chain", 5000).split()
    chain = [" ".join([*base[i:], *(f"n{j}" for j in range(i))]) for i in range(0, 30, 2)]
    copies = [chain[0]] * 40 + [changed(chain[0], [i], "v") for i in range(60)]
    # Alike, but each of them too far from the others: one candidate group, many components.
    apart = [changed(chain[0], range(k, 60, 8), f"a{k}") for k in range(8)]
    texts = [*chain, *copies, *apart, prose(60, "other", 5000)]
    assert found(documents(texts)) == brute(list(enumerate(texts)))


def test_pairs_that_the_pivot_does_not_settle(spark, documents, prose):
    """All texts as one group of candidates: what stars leave open is settled exactly."""
    base = prose(50, "pivot", 5000)
    texts = [base] + [changed(base, range(0, 14 + k % 3, 2), f"far{k // 3}") for k in range(12)]
    docs = documents(texts)
    texts_ = set_links.texts_of(docs, "doc_id", "text")
    signed = texts_.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
        mm._signed(2), f"id long, {mm.SIGNED}"
    )
    one = set_links.distinct_sets(signed)
    pivot = one.agg(F.min("set")).first()[0]
    stars = mm.stage(one.where(F.col("set") != pivot).select(F.lit(pivot).alias("pivot"), "set", F.lit(1).alias("met")), "stars")
    root = set_links.linked_sets(stars, one, texts_, 2, 80)
    names = {r.set: r.least for r in set_links.component_names(one, root).collect()}
    got = {r.id: names[r.set] for r in signed.collect()}
    assert got == {i: least for i, (_, least, _) in brute(list(enumerate(texts))).items()}


def test_odd_rows(documents):
    assert found(documents(ODD)) == brute(list(enumerate(ODD)))
    assert found(documents([])) == {}
    rows = [(None, "a b c"), (7, "a b c"), (None, "lonely"), (None, ""), (9, "d e"), (9, "d e")]
    got = mm.near_duplicates(documents(rows)).collect()
    assert sorted((r.n_shingles, r.component_id or -1, r.kept) for r in got) == [
        (0, -1, True), (1, -1, True), (1, 9, True), (1, 9, True), (2, 7, False), (2, 7, True)
    ]


def test_values_agree_as_often_as_sets_are_similar():
    """Shares of equal values near the similarity, and less varied than minima alone."""
    rng = np.random.default_rng(3)
    shares, minima = [], []
    for _ in range(150):
        x = rng.integers(0, 1 << 63, 100).astype(np.uint64) << np.uint64(1)
        flat, bounds = np.concatenate([x[:90], x[10:]]), np.array([0, 90, 180])  # similarity 0.8
        low, high = mm.min_max(flat, bounds)
        equal = low[0] == low[1], high[0] == high[1]
        shares.append(np.concatenate(equal).mean())
        minima.append(np.concatenate([equal[0], np.roll(equal[0], 1)]).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01
    assert np.var(shares) < np.var(minima)


@pytest.mark.parametrize("common, each", [(4, 0), (8, 1), (40, 5), (400, 50)])
def test_bands_miss_no_pair_at_the_threshold(common, each):
    """Pairs of similarity 0.8 (4 of 5, 8 of 10, 40 of 50, 400 of 500) share a band."""
    rng = np.random.default_rng(common)
    for _ in range(400):
        x = rng.integers(0, 1 << 63, common + 2 * each + 1).astype(np.uint64) << np.uint64(1)
        a = x[: common + each] if each else x[: common + 1]
        b = np.concatenate([x[:common], x[common + each : common + 2 * each]])
        keys = mm.band_keys(*mm.min_max(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        assert (keys[0] == keys[1]).any()


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, TESTDATA, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op12_min_max(spark, TESTDATA).collect()}
    assert got == brute(rows)
