"""Strings of added tokens, against a tokenizer as the library loads it."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import ODD
from test_token_files import STRANGE, WORDS, brute, found
from tokenizers import Tokenizer

import public_tokenizers
from bazaar.llm import queries
from bazaar.llm import token_files as tf

TEXTS = ["hello <|endoftext|> world", "<|ENDOFTEXT|> x", "a<|startoftext|>b <|endoftext", "plain < | > text"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_unmodified_library(name, prose):
    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), tf.TextEncoder(path, 2, added=True)
    texts = [*TEXTS, *STRANGE, *(t for t in ODD if t), prose(50, 1)]
    got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_matches_added_tokens(spark, documents, tmp_path):
    rows = list(enumerate([*TEXTS, *STRANGE]))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op10_token_files(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == brute(rows, Tokenizer.from_file(WORDS))
    assert found(tf.write_token_files(documents(rows), WORDS, 1)) != brute(rows, Tokenizer.from_file(WORDS))
