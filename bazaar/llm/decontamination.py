"""Benchmark decontamination: an FM-index of each training shard, searched for test phrases."""

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import byte_data, pieces, stage, text_bytes
from bazaar.llm.fm_index import FMIndex

WINDOW = 10
# Benchmark text that is broadcast at once; a larger benchmark is worked off in blocks.
BLOCK_BYTES = 8 << 20

# Words are runs of digits, ASCII letters and anything beyond ASCII; A-Z count as a-z.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

# Columns that the search adds, named unlike any a table has.
WORDS, FIRST, LAST, ITEMS = "__dc_words", "__dc_first", "__dc_last", "__dc_items"
FOUND = (FIRST, LAST, ITEMS)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols of its vocabulary."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        of: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                of.setdefault(tuple(ids[i : i + size]), set()).update([item] if item else [])
        self.items = [sorted(found) for found in of.values()]
        self.lengths = np.array([len(phrase) for phrase in of], np.int64)
        width = max(self.lengths, default=1)
        self.symbols = np.zeros((len(of), width), np.int64)
        for row, phrase in enumerate(of):
            self.symbols[row, width - len(phrase) :] = phrase


def shard_hits(
    phrases: Phrases, texts: pa.Array
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index one shard and search it: words of each text; occurrences as text number, place of
    the first word in the text, and phrase.

    The index holds the runs of benchmark words that are as long as the shortest phrase, each
    behind a separator: a word that no test phrase has ends every occurrence, so no other part
    of the shard can hold one. Runs never cross texts.
    """
    data, offsets = byte_data(texts)
    flat = data.tobytes().translate(_WORD)
    get = phrases.vocabulary.get
    symbols, counts = [], np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        own = flat[offsets[i] : offsets[i + 1]].split()
        counts[i] = len(own)
        symbols.append(np.fromiter((get(w, 0) for w in own), np.int64, len(own)))
    ends = np.cumsum(counts)
    # A separator before each text: place p of the text becomes p + (number of texts up to it).
    flow = np.concatenate([np.append(0, s) for s in symbols] or [np.zeros(1, np.int64)])
    known = flow > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
    starts, stops = edges[::2], edges[1::2]
    none = np.zeros(0, np.int64)
    if len(phrases.lengths):
        long = stops - starts >= phrases.lengths.min()
        starts, stops = starts[long], stops[long]
    if not len(starts) or not len(phrases.lengths):
        return counts, none, none, none
    # Kept runs with the separator before each: where they stand in the shard.
    sizes = stops - starts + 1
    shift = np.repeat(starts - 1 - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    kept = shift + np.arange(sizes.sum())
    text = flow[kept]
    text[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = 0
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    low, high = index.ranges(phrases.symbols, phrases.lengths)
    times = high - low
    phrase = np.repeat(np.arange(len(times)), times)
    rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - low, times)
    at = kept[index.locate(rows)]
    heads = np.concatenate([[0], ends[:-1]]) + np.arange(len(texts))  # the separators
    number = np.searchsorted(heads, at, "right") - 1
    return counts, number, at - heads[number] - 1, phrase


def merged_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inclusive word spans, those that overlap or touch made one, in their order."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > reach[:-1] + 1])
    ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])
    return first[new], reach[ends]


def without_spans(text: bytes, first: list[int], last: list[int]) -> bytes:
    """A text without the words of some spans and what stands between those words."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD))]
    kept, done = [], 0
    for a, b in zip(first, last, strict=True):
        kept.append(text[done : places[a][0]])
        done = places[b][1]
    return b"".join([*kept, text[done:]])


def _searcher(
    phrases: Broadcast, text: str, position: int, more: bool, cut: bool, names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds what one block of phrases hits to what the blocks before it have found."""
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = phrases.value
        for shard in pieces(batches, position):
            columns = dict(zip(shard.schema.names, shard.columns, strict=True))
            texts = columns[text]
            counts, number, place, phrase = shard_hits(block, texts)
            firsts, lasts, items = (columns[name].to_pylist() for name in FOUND)
            order = np.argsort(number, kind="stable")
            number, place, phrase = number[order], place[order], phrase[order]
            cuts = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                i, begin = int(number[lo]), place[lo:hi]
                a, b = merged_spans(
                    np.concatenate([np.array(firsts[i], np.int64), begin]),
                    np.concatenate(
                        [np.array(lasts[i], np.int64), begin + block.lengths[phrase[lo:hi]] - 1]
                    ),
                )
                firsts[i], lasts[i] = a.tolist(), b.tolist()
                new = {x for p in np.unique(phrase[lo:hi]).tolist() for x in block.items[p]}
                items[i] = sorted(new.union(items[i]))
            columns |= {
                WORDS: pa.array(counts),
                FIRST: pa.array(firsts, longs),
                LAST: pa.array(lasts, longs),
                ITEMS: pa.array(items, strings),
            }
            if cut and not more and any(firsts):
                values = texts.cast(pa.binary()).to_pylist()
                for i in (i for i, found in enumerate(firsts) if found):
                    values[i] = without_spans(values[i], firsts[i], lasts[i])
                columns[text] = pa.array(values, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names=names)

    return search


def item_blocks(
    benchmark: DataFrame, item: str, text: str, block_bytes: int
) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in blocks of about ``block_bytes``: the driver holds one at a time."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), text_bytes(text).alias("text"))
    total, longest = items.agg(F.sum(F.length("text")), F.max(F.length("text"))).first()
    if (longest or 0) > block_bytes:
        raise ValueError(f"a benchmark item of {longest} bytes does not fit a block")
    blocks = max(1, math.ceil((total or 0) / block_bytes))
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block
        yield [(row.item, bytes(row.text)) for row in items.where(own).collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    cut: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` with what benchmark items they hold.

    Further columns: ``__dc_words`` (number of words), ``__dc_first`` and ``__dc_last`` (the
    merged spans of words inside an occurrence of any window, ends included) and ``__dc_items``
    (the ids, as sorted strings, of items with an occurring window). A window is ``window``
    consecutive words of an item; an item of fewer words is one window, an item of none has
    none. ``keep`` names the columns of ``docs`` to return (all by default); with ``cut``, texts
    come back without their spans.

    A shard is a piece of a partition, some megabytes of text: it is indexed and searched where
    it is read, nothing is shuffled, and a task holds one shard at a time. Copies and hot
    passages cost no more than their occurrences. The benchmark is broadcast in blocks of
    ``block_bytes``; behind each block but the last the frame is staged.

    Null and empty texts have no words and no hits; an item without an id is searched for but
    cannot be listed; repeated items and rows count each as they stand. Empty tables on either
    side give no hits.
    """
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    carried = list(dict.fromkeys([*keep, text]))
    found = docs.select(
        *(F.col(f"`{name}`") for name in carried),
        F.lit(0).cast("long").alias(WORDS),
        *(F.array().cast("array<bigint>").alias(name) for name in (FIRST, LAST)),
        F.array().cast("array<string>").alias(ITEMS),
    )
    blocks = item_blocks(benchmark, item, item_text, block_bytes)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        names = found.columns if following is not None or text in keep else [
            name for name in found.columns if name != text
        ]
        work = _searcher(
            spark.sparkContext.broadcast(Phrases(block, window)),
            text, found.columns.index(text), following is not None, cut, names,
        )
        found = found.mapInArrow(work, T.StructType([found.schema[name] for name in names]))
        if following is not None:
            found = stage(found, "decontaminated")
        block = following
    return found


def hit_words(first: str = FIRST, last: str = LAST) -> Column:
    """The number of words in the merged spans."""
    return F.aggregate(
        F.zip_with(first, last, lambda a, b: b - a + 1), F.lit(0).cast("long"), lambda x, y: x + y
    )


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW
) -> DataFrame:
    """All rows and columns of ``docs``, their texts without the spans that benchmark items share;
    a document that has no other words goes. Clean documents come back as they are."""
    found = find_contamination(docs, benchmark, text=text, window=window, cut=True)
    hit = hit_words()
    return found.where((hit == 0) | (hit < F.col(WORDS))).select(docs.columns)
