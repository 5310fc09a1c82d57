from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import ODD, TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import queries, toxicity


@pytest.fixture(scope="module")
def labelled(spark, documents, prose):
    texts = [prose(80 + i % 50, i) + (" scoundrel knave" * 2 if i % 5 == 0 else "") for i in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    return documents(texts), labels


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_accuracy_on_held_out_rows(labelled):
    docs, labels = labelled
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels)).collect()
    held = [r for r in scored if is_held_out(r.doc_id)]
    assert len(held) > 50 and all((r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in held)


def test_held_out_labels_are_not_used(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.weights == b.weights).all() and a.intercept == b.intercept


def test_held_out(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long")
    got = {r.doc_id: r.h for r in rows.select("doc_id", toxicity.held_out("doc_id").alias("h")).collect()}
    assert got == {**{i: is_held_out(i) for i in range(50)}, None: False}


def test_bounds_of_the_sample(labelled, monkeypatch):
    docs, labels = labelled
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: taken.append((len(texts), sum(map(len, texts)))))
    toxicity.train(docs, labels, rows=20)
    toxicity.train(docs, labels, size=5000)
    assert taken[0][0] == 20 and 0 < taken[1][1] <= 5000


def test_odd_rows(documents, labelled):
    classifier = toxicity.train(*labelled)
    given = documents(ODD, score=F.lit("clash"), __x=F.lit(1))
    rows = toxicity.score_texts(given, classifier).orderBy("doc_id").collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score and rows[-1].score == rows[-2].score
    assert toxicity.drop_toxic(given, classifier).columns == given.columns
    assert toxicity.score_texts(documents([]), classifier).count() == 0


def test_labels_that_teach_nothing(spark, documents):
    docs = documents(["a", "b"])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 7)], "doc_id long, toxic int")
    for labels in (none, odd):
        assert {r.score < 1e-9 for r in toxicity.score_texts(docs, toxicity.train(docs, labels)).collect()} == {True}


def test_scores_do_not_depend_on_batches(labelled, monkeypatch):
    docs, labels = labelled
    classifier = toxicity.train(docs, labels)
    a = {r.doc_id: r.score for r in toxicity.score_texts(docs, classifier).collect()}
    monkeypatch.setattr(toxicity, "PIECE", 100)
    b = {r.doc_id: r.score for r in toxicity.score_texts(docs.repartition(7), classifier).collect()}
    assert a == b


def test_query_on_held_out_labels(spark):
    sf = TESTDATA.replace("0.001", "0.01")
    truth = {r.doc_id: r.toxic for r in queries.table(spark, sf, "labels").collect()}
    rows = [r for r in queries.op7_toxicity(spark, sf).collect() if r.held_out and r.doc_id in truth]
    score, y = np.array([r.score for r in rows]), np.array([truth[r.doc_id] for r in rows])
    ranks = np.argsort(np.argsort(score))
    auc = (ranks[y == 1].sum() - (n := y.sum()) * (n - 1) / 2) / (n * (len(y) - n))
    assert auc > 0.9 and all(r.predicted == (r.score >= 0.7) for r in rows)
