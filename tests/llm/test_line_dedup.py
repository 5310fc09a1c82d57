from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.llm.line_dedup import drop_boilerplate


def texts(df):
    return [r.text for r in df.orderBy("doc_id").collect()]


def test_furniture_goes_and_content_stays(documents):
    pages = [f"Home | About\nstory {i}\n\nline {i}\n  Home | About " for i in range(20)]
    found = drop_boilerplate(documents(pages), dropped="n_dropped")
    assert texts(found) == [f"story {i}\n\nline {i}" for i in range(20)]
    assert {r.n_dropped for r in found.collect()} == {2}


def test_share_is_of_the_own_host(documents):
    # 6 of 100 pages of one host, 6 of 20 of the other.
    a = documents([("shared\n" if i < 6 else "") + f"a {i}" for i in range(100)], source="a")
    b = documents([(200 + i, ("shared\n" if i < 6 else "") + f"b {i}") for i in range(20)], source="b")
    kept = texts(drop_boilerplate(a.unionByName(b)))
    assert sum("shared" in t for t in kept[:100]) == 6 and not any("shared" in t for t in kept[100:])


def test_few_pages_have_no_furniture(documents):
    pages = ["top\nx"] * 4
    assert texts(drop_boilerplate(documents(pages))) == pages


def test_pages_of_furniture_alone_keep_an_empty_row(documents):
    pages = ["all the same\nhere"] * 30 + ["all the same\nother", "all the same\n\n"]
    found = drop_boilerplate(documents(pages), dropped="n_dropped")
    assert texts(found) == [""] * 30 + ["other", "\n"]
    assert [r.n_dropped for r in found.orderBy("doc_id").collect()] == [2] * 30 + [1, 1]


def test_odd_rows(documents):
    pages = [None, "", "\n\n", "x" * 200_000] + [f"nav\ntext {i}" for i in range(20)]
    given = documents(pages, source=None, line=F.lit(1), n=F.lit(2), __ld=F.lit(3))
    found = drop_boilerplate(given)
    assert found.columns == given.columns
    assert texts(found) == pages[:4] + [f"text {i}" for i in range(20)]
    assert drop_boilerplate(documents([])).count() == 0


def test_null_host_is_not_the_text_null(documents):
    a = documents([f"nav\nx {i}" for i in range(9)], source=None)
    b = documents([(100 + i, f"y {i}\nz") for i in range(3)], source="null")
    assert texts(drop_boilerplate(a.unionByName(b)))[-3:] == ["y 0\nz", "y 1\nz", "y 2\nz"]
