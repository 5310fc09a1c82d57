from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaar.llm import token_files as tf

WORDS = public_tokenizers.path("word_bpe_49k.json")
STRANGE = [
    "  á b \x1c x\x85y z q", "ΣΑΣ ΟΔΟΣ", "<|endoftext|> hi <|startoftext|>", "don't  we'll\x0bx",
    "é́ ́a", "İstanbul ŉ", "日本 語　テ", "A" * 20_000,
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(WORDS)
    found.encode_special_tokens = True
    return found


def brute(rows, tokenizer):
    out, start = [], 0
    key = lambda r: (r[0] is not None, r[0] or 0)
    for i, text in sorted(rows, key=key):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def found(files):
    return sorted((tuple(r) for r in tf.read_token_files(files).collect()), key=lambda r: r[1])


def test_equals_the_library(documents, tokenizer):
    rows = [(3 * i - 9, t) for i, t in enumerate([*ODD, *STRANGE])]
    docs = documents(rows, id=F.lit("clash"), start=F.lit(1))
    assert found(tf.write_token_files(docs, WORDS, 1)) == brute(rows, tokenizer)


def test_many_files(documents, tokenizer, prose, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_IDS", 50)
    rows = [(i, prose(1 + i % 40, i)) for i in range(200)]
    files = tf.write_token_files(documents(rows), WORDS, 1)
    assert files.count() > 20 and found(files) == brute(rows, tokenizer)


def test_rows_of_one_id_and_of_none(documents, tokenizer):
    rows = [(5, "a b c"), (5, "a b c"), (5, "other"), (None, "no id"), (None, ""), (2, "x")]
    got = found(tf.write_token_files(documents(rows), WORDS, 1))
    assert [r[0] for r in got] == [None, None, 2, 5, 5, 5]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows, tokenizer))
    assert [r[1] for r in got] == [sum(n for *_, n, _ in got[:i]) for i in range(6)]


def test_empty_table(documents):
    assert found(tf.write_token_files(documents([]), WORDS, 1)) == []


def test_keyed_access(documents, tokenizer, prose):
    rows = [(i * 7, prose(5, i)) for i in range(300)]
    (path,) = [r.path for r in tf.write_token_files(documents(rows).coalesce(1), WORDS, 1).collect()][:1]
    shard = tf.open_shard(path)
    reads = []
    shard.read = lambda start, size, read=shard.read: (reads.append(size), read(start, size))[1]
    keys = tf.open_shard(path)
    known = [i for i, _ in rows if keys.get(i) is not None]
    assert known
    assert shard.get(known[0]).tolist() == [*tokenizer.encode(dict(rows)[known[0]], add_special_tokens=False).ids, 1]
    assert sum(reads) < 200  # two numbers, two offsets and the ids, not the file
    assert all(shard.get(k) is None for k in (1, 2, 10**15, -7))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.uint64)
    number = tf.PerfectHash.build(keys)
    assert sorted(number(keys)) == list(range(n))
    assert len(number.words) * 64 <= 8 * n + 64 * 30
    with pytest.raises(ValueError):
        tf.PerfectHash.build(np.array([1, 1], np.uint64))


def test_not_a_token_file():
    with pytest.raises(ValueError):
        tf.ShardFile(lambda start, size: b"x" * size)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name, prose, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_ENTRIES", 20)
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = tf.TextEncoder(path, 2)
    texts = [*STRANGE, "...'s 'LL rock'n'roll x9y_z!? A.B", *(t for t in ODD if t), *(prose(50, i) for i in range(30))]
    for _ in range(2):
        for text in texts:
            ids = np.frombuffer(encoder.encode([text.encode()])[0], "<u2").tolist()
            assert ids == plain.encode(text, add_special_tokens=False).ids
