from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import ODD, TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [
        ("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))
    ]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for alphabet in ("a1.@+- (2)9%éA0-", "0123456789 -", "1.2.", "a@b.c "):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "+1", "1 ", "@"])
def test_long_runs_take_no_time(unit):
    pii.base_spans(unit * 200_000)


def spans(df):
    return {(r.doc_id): [tuple(s) for s in r.spans] for r in df.collect()}


def test_terms_that_disclose(documents, prose):
    mail = "zoe@example.org"
    texts = [f"{prose(30, i)} write to {mail} Quellburg {prose(30, -i)}" for i in range(6)]
    texts += [prose(200, f"b{i}") + " write to others" for i in range(40)]
    docs = documents(texts, entity=F.lit(1), spans=F.lit("clash"))
    got = spans(pii.find_personal_data(docs))
    for i, text in enumerate(texts):
        at = text.find("Quellburg")
        want = brute(text) + ([("removed", at, at + 9)] if at >= 0 else [])
        assert got[i] == want, i
    clean = {r.doc_id: r.text for r in pii.sanitise_texts(docs).collect()}
    assert clean[0] == texts[0].replace(mail, "[EMAIL]").replace("Quellburg", "")
    assert clean[20] == texts[20]


def test_thresholds(spark):
    near = spark.createDataFrame(
        [("e", t, d) for t, n in (("only", 4), ("mostly", 4), ("common", 4)) for d in range(n)]
        + [("e", "once", 1), ("e", "onedoc", 9), ("e", "onedoc", 9), ("e", "onedoc", 9)],
        "entity string, term string, doc long",
    )
    corpus = spark.createDataFrame(
        [("only", 4), ("mostly", 8), ("common", 500), ("once", 1), ("onedoc", 3), ("rest", 10_000)],
        "term string, n long",
    )
    got = {r.term: r.action for r in pii.disclosing_terms(near, corpus).collect()}
    assert got == {"only": "removed", "mostly": "generalised"}


def test_sanitised():
    found = [("email", 0, 3), ("generalised", 4, 7), ("removed", 8, 9), ("phone", 2, 5)]
    assert pii.sanitised("a@b Foo x end", found) == "[EMAIL]  end"


def test_odd_rows(documents):
    rows = [*enumerate(ODD), (None, "mail a@b.cd"), (3, "mail a@b.cd"), (3, "mail a@b.cd")]
    docs = documents(rows)
    got = sorted(((r.doc_id, sum(s.kind == "email" for s in r.spans)) for r in pii.find_personal_data(docs).collect()), key=str)
    assert got == sorted([(i, int("@" in (t or ""))) for i, t in rows], key=str)
    clean = pii.sanitise_texts(docs).collect()
    # The word before the address stands nowhere else: it discloses it, and goes.
    assert sorted((str(r.text)[:99] for r in clean)) == sorted(
        str(t).replace("mail a@b.cd", " [EMAIL]")[:99] for _, t in rows
    )
    assert pii.find_personal_data(documents([])).count() == 0


def test_query(spark):
    rows = {r.doc_id: r for r in queries.op3_personal_data(spark, TESTDATA).collect()}
    for doc in queries.table(spark, TESTDATA, "documents").collect():
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(doc.text or ""))
        row = rows.pop(doc.doc_id)
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert row.spans.startswith(want)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]
    assert not rows
