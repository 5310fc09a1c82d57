"""Files of token ids with keyed access: a minimal perfect hash leads from a key to its ids.

A file holds one shard, in the order of its documents:

    magic, version, bytes for each id, number of rows, ids, keys, and words of the index (header)
    for each level of the hash: its size and seed (index)
    the levels' bit strings, one after the other
    for each key, in the order of the hash: fingerprint, and first row
    for each row, and behind the last one: where its ids start
    the ids

All numbers are little-endian. The hash is built in levels: a key that falls on a bit alone takes
it, the others go on to the next level; a key's number is the count of bits before its own. A
lookup reads a few words whatever the shard's size, and the fingerprint tells keys that the shard
does not have, but for one in 2**32.
"""

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import mix, new_dir, pieces, stage, text_bytes, worker_store

MAGIC = b"TOKFILE1"
HEADER = "<8sIIQQQI"
HEADER_BYTES = struct.calcsize(HEADER)
# Bits of a level for each key that comes to it.
ROOM = 2.0
# A task closes a file when it holds so many ids and goes on with the next one.
SHARD_IDS = 16 << 20
# Chunks of text that a worker meets before it forgets those that it met before them.
CACHE_ENTRIES = 3 << 17
# Characters below this one are in a normal form and lower-case one by one.
LATIN = "\u0180"
# Marks behind a word that the pattern leaves to themselves.
MARKS = ".,;:!?"
PIECE = 4 << 20


class PerfectHash:
    """Numbers from 0 to n-1 for n distinct 64-bit keys."""

    def __init__(self, levels: list[tuple[int, int]], words: np.ndarray):
        self.levels, self.words = levels, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys must be distinct")
        levels, words, seed = [], [], 0
        while len(keys):
            size = (int(len(keys) * ROOM) // 64 + 1) * 64
            place = (mix(keys, seed) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append((size, seed))
            keys, seed = keys[~alone[place]], seed + 1
        return cls(levels, np.concatenate(words) if words else np.zeros(0, "<u8"))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for some of those that it was not built from."""
        out, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for size, seed in self.levels:
            place = (mix(keys[open_], seed) % np.uint64(size)).astype(np.int64) + start
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) != 0
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (self.before[word] + below)[hit]
            open_, start = open_[~hit], start + size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def shard_bytes(keys: np.ndarray, ids: list[bytes], width: int) -> bytes:
    """A shard's file. ``keys``: the documents' 64-bit keys in their order, equal keys side by
    side; rows of no key come first, so there may be fewer keys than payloads."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    distinct = keys[first]
    number = PerfectHash.build(distinct)
    slot = number(distinct)
    marks, rows = np.empty(len(distinct), "<u4"), np.empty(len(distinct), "<u8")
    marks[slot], rows[slot] = fingerprints(distinct), first + (len(ids) - len(keys))
    starts = np.concatenate([[0], np.cumsum([len(i) // width for i in ids])]).astype("<u8")
    levels = np.array(number.levels, "<u8").reshape(-1, 2)
    head = struct.pack(
        HEADER,
        MAGIC, 1, width, len(ids), int(starts[-1]), len(distinct), len(levels)
    )
    parts = (levels, number.words, marks, rows, starts)
    return b"".join([head, *(p.tobytes() for p in parts), *ids])


class ShardFile:
    """Reads one file: ``open(start, length)`` gives bytes of it."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, version, self.width, self.rows, self.ids, self.keys, levels = struct.unpack(
            HEADER,
            read(0, HEADER_BYTES)
        )
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        at = HEADER_BYTES
        table = np.frombuffer(read(at, 16 * levels), "<u8").reshape(-1, 2)
        at += 16 * levels
        words = int(table[:, 0].sum()) // 64
        self.number = PerfectHash(
            [(int(size), int(seed)) for size, seed in table],
            np.frombuffer(read(at, 8 * words), "<u8"),
        )
        self.marks_at = at + 8 * words
        self.rows_at = self.marks_at + 4 * self.keys
        self.starts_at = self.rows_at + 8 * self.keys
        self.ids_at = self.starts_at + 8 * (self.rows + 1)

    def row_of(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 where the shard has no such key."""
        slot = self.number(keys)
        marks = np.frombuffer(self.read(self.marks_at, 4 * self.keys), "<u4")
        rows = np.frombuffer(self.read(self.rows_at, 8 * self.keys), "<u8").astype(np.int64)
        known = slot >= 0
        known[known] = marks[slot[known]] == fingerprints(keys[known])
        return np.where(known, rows[np.where(known, slot, 0)] if len(rows) else -1, -1)

    def starts(self) -> np.ndarray:
        return np.frombuffer(self.read(self.starts_at, 8 * (self.rows + 1)), "<u8").astype(np.int64)

    def get(self, key: int) -> np.ndarray | None:
        """The ids of one document: the index, two numbers and the ids are all that is read."""
        keys = np.array([key]).astype(np.int64).view(np.uint64)
        slot = int(self.number(keys)[0])
        if slot < 0:
            return None
        if np.frombuffer(self.read(self.marks_at + 4 * slot, 4), "<u4")[0] != fingerprints(keys)[0]:
            return None
        row = struct.unpack("<Q", self.read(self.rows_at + 8 * slot, 8))[0]
        a, b = struct.unpack("<QQ", self.read(self.starts_at + 8 * row, 16))
        return np.frombuffer(
            self.read(self.ids_at + a * self.width, (b - a) * self.width), f"<u{self.width}"
        )


def open_shard(path: str) -> ShardFile:
    """A file at a path or URI, read in place: nothing but what is asked for."""
    store, name = fs.FileSystem.from_uri(path)
    file = store.open_input_file(name)
    return ShardFile(lambda start, length: file.read_at(length, start))


class TextEncoder:
    """Ids of whole texts by a tokenizer of the tokenizers library.

    A tokenizer that drops white space and splits by one pattern gives each match of the pattern
    its ids by itself. For such a one, texts are cut at spaces and ASCII controls; chunks of
    Latin letters are cut by the file's own pattern, and each distinct piece goes to the library
    once, as long as the worker remembers it: many in one text, told apart by the ids that end a
    word. Any other tokenizer gets whole texts.

    Strings of added tokens (such as control strings) in a text are encoded as plain text; with
    ``added``, the library matches them as it does by default. A text that may hold one goes to
    it whole then.
    """

    def __init__(self, path: str, width: int, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = _may_hold(tokens, self.tokenizer.normalizer) if added and tokens else None
        self.width = width
        self.split, suffix = splitter(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # Chunks met lately, and those met before them.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(own.ids, f"<u{self.width}").tobytes() for own in found]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of pieces that are one match of the pattern each."""
        found: list[bytes] = []
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            joined = self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids
            ids = np.array(joined, f"<u{self.width}")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(some):  # a word without an end: the library sees it alone
                found += self.ids(some)
                continue
            data, w = ids.tobytes(), self.width
            found += [data[a * w : b * w] for a, b in zip([0, *ends], ends, strict=False)]
        return found

    def learn(self, chunks: set[bytes]) -> None:
        """Store the ids of chunks that are not known yet."""
        older, known = self.older.get, self.known
        word_of: dict[bytes, str] = {}  # chunks of letters
        parts_of: dict[bytes, list[str]] = {}
        whole: list[bytes] = []
        for chunk in chunks:
            ids = older(chunk)
            if ids is not None:
                known[chunk] = ids
                continue
            text = chunk.decode("utf-8", "replace")
            if not text.isascii() and max(text) >= LATIN:
                whole.append(chunk)
            elif (text := text.lower()).isalpha():
                word_of[chunk] = text
            elif text[-1] in MARKS and text[:-1].isalpha():
                parts_of[chunk] = [text[:-1], text[-1]]
            else:
                parts_of[chunk] = self.split(text)
        plain: dict[str, bytes | None] = dict.fromkeys(word_of.values())
        for own in parts_of.values():
            plain.update(dict.fromkeys(own))
        for piece in plain:
            key = piece.encode()
            plain[piece] = known.get(key) or older(key)
        new = [piece for piece, ids in plain.items() if ids is None]
        for piece, ids in zip(new, self.word_ids(new), strict=True):
            plain[piece] = known[piece.encode()] = ids
        known.update((chunk, plain[word]) for chunk, word in word_of.items())
        known.update((chunk, b"".join([plain[p] for p in own])) for chunk, own in parts_of.items())
        known.update(zip(whole, self.ids([c.decode("utf-8", "replace") for c in whole]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.split is None:
            return self.ids([text.decode("utf-8", "replace") for text in texts])
        if self.added is None:
            return self._by_pieces(texts)
        whole = [i for i, text in enumerate(texts) if self.added(text)]
        if not whole:
            return self._by_pieces(texts)
        held = set(whole)
        others = iter(self._by_pieces([t for i, t in enumerate(texts) if i not in held]))
        found = iter(self.ids([texts[i].decode("utf-8", "replace") for i in whole]))
        return [next(found if i in held else others) for i in range(len(texts))]

    def _by_pieces(self, texts: list[bytes]) -> list[bytes]:
        chunks = [text.split() for text in texts]
        if len(self.known) >= CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        self.learn(set().union(*chunks) - self.known.keys())
        return [b"".join(map(self.known.__getitem__, own)) for own in chunks]


def _may_hold(tokens: list, normalizer) -> Callable[[bytes], bool]:
    """Whether a text holds one of some added tokens: as it stands or, for those that are matched
    so, behind the normalizer."""
    plain = [t.content.encode() for t in tokens]
    shown = [normalizer.normalize_str(t.content) for t in tokens if normalizer and t.normalized]

    def holds(text: bytes) -> bool:
        if any(name in text for name in plain):
            return True
        if not shown:
            return False
        value = normalizer.normalize_str(text.decode("utf-8", "replace"))
        return any(name in value for name in shown)

    return holds


def splitter(path: str) -> tuple[Callable[[str], list[str]] | None, str | None]:
    """What cuts a lower-case Latin text into the pieces that the tokenizer of this file encodes
    each by itself, and how tokens end that end a word; None if the file does not say so."""
    import regex

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    normal = [step["type"] for step in (parts.get("normalizer") or {}).get("normalizers") or []]
    first = steps[0]
    plain = (
        normal == ["NFC", "Replace", "Lowercase"]
        and first.get("pattern", {}).get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and (first.get("type"), first.get("behavior"), first.get("invert")) == ("Split", "Removed", True)
        and [step["type"] for step in steps[1:]] == ["ByteLevel"]
        and not steps[1]["add_prefix_space"]
        and not steps[1]["use_regex"]
        and parts.get("post_processor") is None
    )
    suffix = parts["model"].get("end_of_word_suffix")
    return (regex.compile(first["pattern"]["Regex"]).findall, suffix) if plain else (None, suffix)


def text_encoder(path: str, width: int, added: bool = False) -> TextEncoder:
    """The encoder that this worker keeps from task to task."""
    kept = worker_store("text encoders")
    if (path, width, added) not in kept:
        kept[path, width, added] = TextEncoder(path, width, added)
    return kept[path, width, added]


def id_width(tokenizer: str, end: int) -> int:
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end + 1) <= 1 << 16 else 4


FILES = "part int, seq int, path string, n_rows bigint, n_ids bigint, keys array<bigint>"


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    doc: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    added: bool = False,
) -> DataFrame:
    """Encode all texts and write them as token files in ascending order of ``doc``.

    ``tokenizer`` is the path of a tokenizers file; each document's ids end with ``end``. With
    ``added``, strings of added tokens get those tokens' ids, as by the library's default. Returns
    the stored list of files: ``part`` and ``seq`` (their order), ``path``, ``n_rows``,
    ``n_ids``, the ``keys`` of their rows, and ``first_id`` (ids in all files before it).

    ``folder`` is a new folder that all executors reach; by default one below the shared folder.
    Tasks sort by range, so a task writes consecutive documents, a file for each SHARD_IDS ids;
    it holds one file's ids at a time. A repeated task writes files of its own, and the list
    names those of the task that Spark has taken.

    Ids must be integers. Rows without an id come first and have no key. Rows of one id, also
    equal ones, stand side by side in the order of a hash of their texts, and the key leads to
    the first of them. A null or empty text has the end id alone. An empty table has no files.
    """
    spark = docs.sparkSession
    folder = folder or new_dir(spark, "token-files")
    width = id_width(tokenizer, end)
    closing = int(end).to_bytes(width, "little")
    ordered = (
        docs.select(F.col(f"`{doc}`").cast("long").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seq = text_encoder(tokenizer, width, added), TaskContext.get(), 0
        keys: list = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/part-{task.partitionId():06d}-{seq:06d}-{task.taskAttemptId()}.tok"
            own = np.array([k for k in keys if k is not None], np.int64).view(np.uint64)
            store, name = fs.FileSystem.from_uri(path)
            store.create_dir(name.rpartition("/")[0], recursive=True)
            with store.open_output_stream(name) as out:
                out.write(shard_bytes(own, ids, width))
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": task.partitionId(), "seq": seq, "path": path, "n_rows": len(ids),
                        "n_ids": held, "keys": keys,
                    }
                ],
                schema=FILE_SCHEMA,
            )

        for batch in pieces(batches, 1, PIECE):
            for key, own in zip(
                batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True
            ):
                if held >= SHARD_IDS:
                    yield close()
                    keys, ids, held, seq = [], [], 0, seq + 1
                keys.append(key)
                ids.append(own + closing)
                held += len(own) // width + 1
        if ids:
            yield close()

    files = stage(ordered.mapInArrow(write, FILES), "token-file-list")
    # One row for each file: their running sum is the only step that sees all of them.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select(
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id")
    )
    return files.join(first, "path")


FILE_SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_rows", pa.int64()),
        ("n_ids", pa.int64()), ("keys", pa.list_(pa.int64())),
    ]
)
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(files: DataFrame) -> DataFrame:
    """A row for each document in the files: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens``, and ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers.

    ``files`` is what ``write_token_files`` returns. Each key is looked up in its file's index,
    and its ids are read from where that leads; rows of one key follow each other, those without
    a key stand before all others.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = open_shard(path)
                if shard.rows != len(keys):
                    raise ValueError(f"{path}: {shard.rows} rows, {len(keys)} expected")
                known = np.array([k for k in keys if k is not None], np.int64)
                head = shard.row_of(known.view(np.uint64))
                if (head < 0).any():
                    raise ValueError(f"{path}: a key is not in the index")
                run = np.concatenate([[True], known[1:] != known[:-1]])
                place = np.arange(len(known))
                since = head
                if len(known):
                    since = place - np.maximum.accumulate(np.where(run, place, 0))
                row = np.concatenate([np.arange(len(keys) - len(known)), head + since])
                starts = shard.starts()
                ids = np.frombuffer(
                    shard.read(shard.ids_at, shard.ids * shard.width), f"<u{shard.width}"
                ).astype("<u4")
                data = memoryview(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(first + starts[row]),
                        pa.array(starts[row + 1] - starts[row]),
                        pa.array([zlib.crc32(data[4 * starts[r] : 4 * starts[r + 1]]) for r in row], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.select("path", "first_id", "keys").repartition("path").mapInArrow(read, ROWS)
