from __future__ import annotations

import struct

import public_tokenizers
import pytest
import tiktoken
from conftest import TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import byte_bpe, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", "  \n\t ", "a" * 3000, "日本語 🙂🙂 é́", "\x00\x01 don't I'll", "x " * 5000, "same", "same"]


@pytest.fixture(scope="module")
def reference():
    tokens = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={token: rank for rank, token in enumerate(tokens)},
    )


def encoded(df):
    return byte_bpe.encode_texts(df, RANKS, public_tokenizers.PATTERN)


def test_ids_are_those_of_the_reference_library(documents, reference):
    given = documents(ODD, token_ids=F.lit("clash"))
    rows = encoded(given).orderBy("doc_id").collect()
    assert len(rows) == len(ODD)
    for row, text in zip(rows, ODD, strict=True):
        ids = reference.encode_ordinary(text or "")
        assert bytes(row.token_ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row.text == text


def test_round_trip(documents):
    rows = byte_bpe.decode_ids(encoded(documents(ODD)), RANKS).orderBy("doc_id").collect()
    assert [bytes(row.decoded) for row in rows] == [(t or "").encode() for t in ODD]


def test_one_pass_gives_the_same(documents):
    given = documents(ODD, decoded=F.lit("clash"))
    both = byte_bpe.round_trip(given, RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    apart = byte_bpe.decode_ids(encoded(documents(ODD)), RANKS).orderBy("doc_id").collect()
    assert [(r.token_ids, r.decoded) for r in both] == [(r.token_ids, r.decoded) for r in apart]


def test_query_on_whole_texts(spark, reference):
    found = {r.doc_id: r for r in queries.op4_byte_bpe(spark, TESTDATA).collect()}
    docs = queries.table(spark, TESTDATA, "documents").collect()
    assert len(found) == len(docs)
    assert all(found[d.doc_id].n_tokens == len(reference.encode_ordinary(d.text or "")) for d in docs)


def test_empty_table(documents):
    assert encoded(documents([])).count() == 0


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.model_proto([b"a", b"b"])


def test_a_full_store_is_emptied(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(50)).encode()
    assert encoder.encode(text) == encoder.encode(text) and len(encoder) <= 3
