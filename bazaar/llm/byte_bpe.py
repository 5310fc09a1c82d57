"""Byte-level BPE by sentencepiece: the model is written straight from the vocabulary."""

import base64
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import lean_memory, pieces, text_bytes

# Pre-tokens kept with their ids in a worker; the store is emptied when it is full.
CACHE_ENTRIES = 1 << 18
# Each byte is one character of the model: a block of letters without spaces or controls.
FIRST_CHARACTER = 0x100
CHARACTERS = [chr(FIRST_CHARACTER + byte) for byte in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file (base64 and rank in a line), by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes(out + bytes([value]))


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def mapped(token: bytes) -> str:
    """Bytes as the model's characters."""
    return "".join(map(CHARACTERS.__getitem__, token))


def model_proto(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks.

    Pieces are the tokens' bytes as characters, scored by negative rank, so the merge with the
    lowest rank comes first; normalisation is the identity. The unknown piece that a model must
    have takes the id behind the last rank; no text uses it, as every byte is a piece.
    """
    missing = {bytes([b]) for b in range(256)} - set(tokens)
    if missing:
        raise ValueError(f"{len(missing)} single bytes are not in the vocabulary")
    # Field numbers of sentencepiece's public model format.
    piece, trainer, normalizer = 1, 2, 3
    parts = [
        _bytes(piece, _bytes(1, mapped(t).encode()) + b"\x15" + struct.pack("<f", -rank))
        for rank, t in enumerate(tokens)
    ]
    parts.append(_bytes(piece, _bytes(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + _number(3, 2)))
    off = 2**64 - 1  # -1: no such piece
    parts.append(
        _bytes(
            trainer,
            _number(3, 2)
            + _number(4, len(tokens) + 1)
            + _number(40, len(tokens))
            + b"".join(_number(field, off) for field in (41, 42, 43)),
        )
    )
    parts.append(_bytes(normalizer, _bytes(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))))
    return b"".join(parts)


class Encoder(dict):
    """Pre-token to its ids, as little-endian unsigned 32-bit integers; fills itself."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        super().__init__()
        self.split = regex.compile(pattern).findall
        self.whole = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))

    def __missing__(self, pretoken: str) -> bytes:
        raw = pretoken.encode()
        ids = self.whole.get(raw)  # a token as a whole is not merged
        if ids is None:
            found = self.pieces.encode(mapped(raw))
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(pretoken) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[pretoken] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text.decode("utf-8", "replace"))))


def _mapped(
    docs: DataFrame,
    column: str,
    out: list[str],
    keep: list[str] | None,
    worker: Callable[[], Callable[[bytes], tuple[bytes, ...]]],
) -> DataFrame:
    """The kept columns, and in ``out`` what ``worker()`` makes of each row's bytes.

    Arrow batches are cut into pieces of some megabytes, so a task's memory is that of a piece,
    the worker's own store, and the batch that Spark hands over.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in out]
    given = docs.select(
        *(F.col(f"`{c}`") for c in keep), text_bytes(F.col(f"`{column}`")).alias(out[0])
    )
    made = [T.StructField(name, T.BinaryType()) for name in out]
    schema = T.StructType([*(docs.schema[c] for c in keep), *made])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = worker()
        for batch in pieces(batches):
            values = zip(*(make(value.as_py()) for value in batch.column(-1)), strict=True)
            columns = [pa.array(list(v), pa.binary()) for v in values]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *out]
            )
        del make
        lean_memory()

    return given.mapInArrow(work, schema)


def _decoder(tokens: list[bytes]) -> Callable[[bytes], bytes]:
    return lambda ids: b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


def encode_texts(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    out: str = "token_ids",
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` (or those in ``keep``), and the ids of each text in
    ``out``, as binary: little-endian unsigned 32-bit integers, without special tokens.

    ``vocabulary`` is the path of a rank file, ``pattern`` splits a text into pre-tokens, which
    are merged separately. Null and empty texts have no ids. Texts of any length are encoded
    whole; bytes that are not UTF-8 count as U+FFFD. A column already named ``out`` is replaced.
    Repeated rows are encoded each; an empty table gives an empty one. One pass, no shuffle.
    """

    def worker() -> Callable[[bytes], tuple[bytes]]:
        encode = Encoder(read_ranks(vocabulary), pattern).encode
        return lambda value: (encode(value),)

    return _mapped(docs, text, [out], keep, worker)


def decode_ids(
    docs: DataFrame,
    vocabulary: str,
    ids: str = "token_ids",
    out: str = "decoded",
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` (or those in ``keep``), and the bytes that each row's ids
    stand for in ``out``, by the inverse mapping; none for null ids."""

    def worker() -> Callable[[bytes], tuple[bytes]]:
        decode = _decoder(read_ranks(vocabulary))
        return lambda payload: (decode(payload),)

    return _mapped(docs, ids, [out], keep, worker)


def round_trip(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    out: str = "token_ids",
    decoded: str = "decoded",
    keep: list[str] | None = None,
) -> DataFrame:
    """``encode_texts`` and ``decode_ids`` of its ids, in one pass of the same Python workers."""

    def worker() -> Callable[[bytes], tuple[bytes, bytes]]:
        tokens = read_ranks(vocabulary)
        encode, decode = Encoder(tokens, pattern).encode, _decoder(tokens)

        def both(value: bytes) -> tuple[bytes, bytes]:
            ids = encode(value)
            return ids, decode(ids)

        return both

    return _mapped(docs, text, [out, decoded], keep, worker)
