from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import ODD
from pyspark.sql import functions as F

from bazaar.llm import phrases as ph


def brute(rows, least, edge=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            own = counts.setdefault(lang, Counter())
            for size in range(1, edge + 1):
                own.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, own in counts.items():
        often = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in often.items():
            if any(
                len(o) > len(g) and b >= a and any(o[i : i + len(g)] == g for i in range(len(o)))
                for o, b in often.items()
            ):
                continue
            n = total[lang]
            score, _, l, r = min(
                (1000 * a * n // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]])
                for k in range(1, len(g))
            )
            scored.append((-score, -a, " ".join(g).encode(), l, r, n))
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(df, **more):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in columns) for r in ph.collocations(df, **more).collect())


@pytest.fixture(scope="module")
def corpus():
    """Texts of few words in three languages and none, some passages in many of them."""
    rng = random.Random(5)
    passages = [" ".join(f"p{k}w{i}" for i in range(30 + 40 * k)) for k in range(3)]
    rows = []
    for i in range(260):
        words = [f"W{min(rng.randrange(12), rng.randrange(12))}" for _ in range(rng.randrange(0, 60))]
        for place in range(5, len(words), 9):
            words[place] += rng.choice([".", ",", ";", "\n", " \t", "!?", ":", "\x0b"])
        if i % 4 == 0:
            words.insert(len(words) // 2, passages[i % 3])
        if i % 9 == 0:
            words += ["loop"] * rng.randrange(12)
        rows.append((["en", "de", None, "en", ""][i % 5], " ".join(words)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize("least", [3, 12])
def test_equals_brute_force(spark, corpus, least):
    got = found(frame(spark, corpus).repartition(5), least=least)
    assert got == brute(corpus, least) and len(got) > 50


def test_other_lengths_and_limits(spark, corpus):
    df = frame(spark, corpus)
    assert found(df, least=6, edge=3, top=7) == brute(corpus, 6, edge=3, top=7)


def test_a_full_table_of_pairs_changes_nothing(spark, corpus, monkeypatch):
    """Where every pair seems frequent, whole pieces are counted: the same phrases."""
    monkeypatch.setattr(ph, "frequent_pairs", lambda pairs, least: b"\xff" * ((1 << ph.PAIR_BITS) // 8))
    monkeypatch.setattr(ph, "PIECE", 512)
    assert found(frame(spark, corpus), least=8) == brute(corpus, 8)


def test_paths_are_compacted(spark, monkeypatch):
    """A long passage of many texts is one row, or several of a bounded size; a ring stays apart."""
    passage = " ".join(f"w{i}" for i in range(100))
    ring = " ".join(["a b c d e f"] * 3)
    df = frame(spark, [("en", f"{passage}. {ring}")] * 6)
    edges, ends, _ = ph.phrase_graph(df, least=2)
    found_ = {" ".join(r["words"]): r["n"] for r in ph.compact(edges, ends).collect()}
    assert found_[passage] == 6
    assert sum(len(p.split()) - 4 for p in found_) == edges.count()
    monkeypatch.setattr(ph, "SPAN", 10)
    short = [" ".join(r["words"]) for r in ph.compact(edges, ends).collect()]
    assert max(len(p.split()) for p in short) == 14
    assert sum(len(p.split()) - 4 for p in short) == edges.count()


def test_odd_rows(spark):
    rows = [("en", t) for t in ODD] + [(None, None), ("de", ""), ("en", "a b\x0cc d"), ("x", "?!")] * 3
    assert found(frame(spark, rows), least=2) == brute(rows, 2)
    assert found(frame(spark, []), least=2) == []
    clashing = frame(spark, [("en", "a b a b")]).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x"))
    assert found(clashing, least=2) == brute([("en", "a b a b")], 2)


def test_products_beyond_64_bits(spark):
    kept = spark.range(1).select(F.lit(9 * 10**12).alias("a"), F.lit(8 * 10**14).alias("n"))
    exact = "decimal(19,0)"
    got = kept.select(F.expr(
        f"(cast(1000 as decimal(4,0)) * cast(a as {exact}) * cast(n as {exact}))"
        f" div (cast(a as {exact}) * cast(a as {exact}))"
    )).first()[0]
    assert got == 1000 * 8 * 10**14 // (9 * 10**12)
