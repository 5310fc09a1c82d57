from __future__ import annotations

import hashlib
import struct

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from conftest import TESTDATA
from test_decontamination import brute as contaminated
from test_ngram_join import brute as components

from bazaar.llm import byte_bpe, line_dedup, queries, toxicity


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The documents before each stage, and what the last one returns."""
    docs = queries.table(spark, TESTDATA, "documents")
    out = [docs]
    for name, work in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        work(spark, out[-1], TESTDATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_return_documents(kept):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]
    for df in kept[1:-1]:
        assert df.dtypes == kept[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_toxic_documents_go(spark, kept):
    scored = rows(queries.op7_toxicity(spark, TESTDATA))
    assert set(rows(kept[1])) == {i for i, r in scored.items() if r.score < toxicity.THRESHOLD}


def test_lines(kept):
    before, after = rows(kept[1]), rows(kept[2])
    pages, on = {}, {}
    for r in before.values():
        pages[r.source] = pages.get(r.source, 0) + 1
        for line in {x.strip(" ") for x in r.text.split("\n")} - {""}:
            on[r.source, line] = on.get((r.source, line), 0) + 1
    for i, r in before.items():
        lines = r.text.split("\n")
        left = [
            x for x in lines
            if not x.strip(" ") or not (n := on[r.source, x.strip(" ")]) >= 5
            or n <= line_dedup.BOILERPLATE_RATIO * pages[r.source]
        ]
        assert after[i].text == "\n".join(left)
    assert before.keys() == after.keys()


def test_one_of_each_group(kept):
    found = components([(i, r.text) for i, r in rows(kept[2]).items()])
    assert set(rows(kept[3])) == {i for i, (_, component) in found.items() if i == component}


def test_no_passages_of_the_benchmark(spark, kept):
    items = [(r.item_id, r.text) for r in queries.table(spark, TESTDATA, "benchmark").collect()]
    before, after = rows(kept[3]), rows(kept[4])
    for (i, r), (n, hit, _) in zip(before.items(), contaminated([r.text for r in before.values()], items), strict=True):
        if hit and hit == n:
            assert i not in after
        elif not hit:
            assert after[i] == r
        else:
            assert contaminated([after[i].text], items)[0][0] == n - hit


def test_last_stage(kept):
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(public_tokenizers.path(queries.BYTE_RANKS)))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = rows(kept[5])
    for i, r in rows(kept[4]).items():
        ids = encoding.encode_ordinary(r.text)
        assert last[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert last[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_gives_the_same(spark, kept):
    assert sorted(corpus_pipeline.run(spark, TESTDATA).collect()) == sorted(kept[5].collect())
