from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaar.llm import licenses as lc
from bazaar.llm.license_templates import FILES

APACHE = "Licensed under the Apache License, Version 2.0."


@pytest.fixture(scope="module")
def scan(spark):
    def run(rows):
        files = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))
        return {r.path: (r.license, r.basis) for r in lc.scan_licenses(files).collect()}

    return run


def cosine(text, number):
    templates = lc.DEFAULT_TEMPLATES
    idf, entries = templates.weights(), templates.entries()[number]
    own = {
        t: round(idf.get(t, templates.unknown()) * (1 + math.log(n)))
        for t, n in Counter(lc.tokens_of(text)).items()
    }
    dot = sum(w * entries[t] for t, w in own.items() if t in entries)
    square = sum(w * w for w in own.values())
    return dot / math.sqrt(square * templates.norms()[number]) if square else 0.0


def test_cosines_equal_brute_force(spark):
    lines = [APACHE, "licensed under Apache 2.0", "The MIT License, released", "use of this code", "Version 3 of the GNU GPL"]
    files = spark.createDataFrame([(f"f{i}", f"x\n{line}\ny") for i, line in enumerate(lines)], "path string, text string")
    got = {r.path: (r.license, r.cosine) for r in lc.own_licenses(files, "path", "text", lc.DEFAULT_TEMPLATES, 0.5).collect()}
    for i, line in enumerate(lines):
        best = min((-cosine(line, n), licence) for n, licence, whole, _ in lc.DEFAULT_TEMPLATES.rows() if not whole)
        if -best[0] >= 0.5:
            assert got[f"f{i}"] == (best[1], pytest.approx(-best[0]))
        else:
            assert f"f{i}" not in got


def test_every_template_finds_itself(scan):
    rows = [(f"{i}", f"code\n{text}\nmore code") for i, (_, text) in enumerate(lc.HEADERS)]
    rows += [(f"file{i}", text.replace(". ", ".\n")) for i, (_, text) in enumerate(FILES)]
    got = scan(rows)
    assert [got[p][0] for p, _ in rows] == [licence for licence, _ in [*lc.HEADERS, *FILES]]


def test_no_match_without_an_anchor():
    for threshold in (0.5, 0.75, 0.9):
        for number, _, whole, counts in lc.DEFAULT_TEMPLATES.rows():
            anchors = set(lc.DEFAULT_TEMPLATES.anchors(threshold, whole))
            left = Counter({t: n for t, n in counts.items() if t not in anchors})
            assert cosine(" ".join(left.elements()), number) < threshold


def test_nearest_ancestor(scan):
    got = scan([
        ("LICENSE", "Released under the MIT License."), ("a/COPYING.txt", APACHE), ("a/b/c/x.py", "code"),
        ("a/b/y.py", f"# {APACHE}"), ("ab/z.py", "code"), ("top.py", None), ("a/b/licensed.py", "code"),
        ("a/b/d/LICENCE", "unknown terms"), ("a/b/d/w", ""),
    ])
    assert got == {
        "LICENSE": ("MIT", "own"), "a/COPYING.txt": ("Apache-2.0", "own"), "a/b/c/x.py": ("Apache-2.0", "inherited"),
        "a/b/y.py": ("Apache-2.0", "own"), "ab/z.py": ("MIT", "inherited"), "top.py": ("MIT", "inherited"),
        "a/b/licensed.py": ("Apache-2.0", "inherited"), "a/b/d/LICENCE": ("Apache-2.0", "inherited"),
        "a/b/d/w": ("Apache-2.0", "inherited"),
    }


def test_odd_rows(spark, scan):
    assert scan([]) == {}
    got = scan([(None, APACHE), ("a/f", "word " * 50_000 + APACHE), ("a/g", "x\n" * 20_000 + APACHE)])
    assert got == {None: ("Apache-2.0", "own"), "a/f": (None, None), "a/g": ("Apache-2.0", "own")}
    rows = [("a/LICENSE", APACHE)] * 3 + [("a/f", "same")] * 2 + [("a/LICENSE", "Released under the MIT License.")]
    files = spark.createDataFrame(rows, "path string, text string")
    found = sorted((r.path, r.license) for r in lc.scan_licenses(files).collect())
    assert found == [("a/LICENSE", "Apache-2.0")] * 3 + [("a/LICENSE", "MIT")] + [("a/f", "Apache-2.0")] * 2
