"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are split into pieces and those into words. The nodes of the graph are runs of four words, its
edges runs of five, and an edge weighs as often as its run stands in the texts. Only these longest
runs are counted, and the ends of pieces; everything shorter follows from the graph:

* paths of edges whose inner nodes have one edge in, one of the same weight out, and no end of a
  piece, are compacted to one row each, a run of words with one weight. Passages that many texts
  share become a few rows, whatever their length;
* a run of four words stands as often as its node's edges leave it, and once for each piece that it
  ends; inside a path that is the path's weight. In the same way a run of three follows from those
  of four that it begins, and so on: each shorter run is the flow of the next longer ones, corrected
  by the ends of pieces.

Phrases of interest stand ``LEAST`` times at least, so all pairs of words in them do. A first pass
counts pairs of words, and pieces are cut where a pair is too rare, which changes the count of no
phrase of interest. Which pairs are frequent is sent as a table of bits by hash, of a fixed size:
pairs that share a bit with a frequent one cost work, never results.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import byte_data, discard, mix, pieces, stage, text_bytes
from bazaar.llm.set_links import word_hashes

# Words of the longest phrases: those of an edge.
EDGE = 5
# How often a phrase stands at least.
LEAST = 100
TOP = 2000
# Bits of the table of frequent pairs, 8 MB.
PAIR_BITS = 26
# Bits of one row of a table that Spark's bitmap functions make.
BUCKET = 32768
# Bytes of text that a task works on at once.
PIECE = 3 << 20
# Pairs of words that a task holds before it counts them.
HELD = 6 << 20
NO_LANGUAGE = "und"
# Edges of one row of a compacted path: a longer path takes several rows.
SPAN = 512

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True


def _words(texts: pa.Array, langs: list[int]):
    """The words of all texts, in order: a buffer that holds each word and a space, where each word
    starts and ends there, a hash of each word with its language, each word's text, and whether the
    word after it stands in the same piece."""
    data, offsets = byte_data(texts)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    inside = ~(_BREAK[data] | (data == 32) | (data == 9))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    letters = np.flatnonzero(inside)
    word = np.cumsum(first)[letters] - 1
    sizes = np.bincount(word, minlength=len(starts))
    begin = np.cumsum(sizes + 1) - sizes - 1
    buffer = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    buffer[np.arange(len(letters)) + word] = data[letters]
    text = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    same = np.zeros(len(starts), bool)
    if len(starts) > 1:
        same[:-1] = (breaks[starts[1:]] == breaks[starts[:-1]]) & (text[1:] == text[:-1])
    runs = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts),
        [None, pa.py_buffer(np.append(begin, len(buffer)).astype(np.int32)), pa.py_buffer(buffer)],
    )
    hashes = word_hashes(runs)[0] if len(starts) else np.zeros(0, np.uint64)
    hashes = mix(hashes + np.array(langs, np.uint64)[text] if len(starts) else hashes, 21)
    return buffer, begin, begin + sizes, hashes, text, same


def _language_codes(batch: pa.RecordBatch) -> tuple[list[str], list[int]]:
    """The languages of a batch and for each text a number that depends on the language's name."""
    names = batch.column(0).to_pylist()
    codes = {name: hash_of(name) for name in set(names)}
    return names, [codes[name] for name in names]


def hash_of(name: str) -> int:
    """A 64-bit number of a name, the same in every worker."""
    data = np.frombuffer(name.encode() or b"\0", np.uint8)
    return int(mix(np.array([mix(data + np.arange(len(data)) * 256, 22).sum(dtype=np.uint64)]), 23)[0])


def _pair_keys(hashes: np.ndarray) -> np.ndarray:
    """A hash of each word and the one after it."""
    return mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:], 24)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (lang, text): (pair, n), each pair once for some millions of words."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs.view(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"]
        )

    for batch in pieces(batches, 1, PIECE):
        *_, hashes, _, same = _words(batch.column(1), _language_codes(batch)[1])
        if len(hashes):
            held.append(_pair_keys(hashes)[same[:-1]])
            size += len(held[-1])
        if size >= HELD:
            yield counted()
            held, size = [], 0
    yield counted()


def _first_of_equal(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, and how often it comes."""
    order = np.argsort(key)
    new = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    return order[new], np.diff(np.append(new, len(key)))


def _runs(frequent: Broadcast, edge: int):
    """From (lang, text): (lang, phrase, n, is_end), the runs of ``edge`` words and the ends of
    pieces, of ``edge`` - 1 words or all that there are; each once for some texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(frequent.value, np.uint8)
        for batch in pieces(batches, 1, PIECE):
            names, codes = _language_codes(batch)
            buffer, begin, end, hashes, text, same = _words(batch.column(1), codes)
            size = len(hashes)
            if not size:
                continue
            cell = (_pair_keys(hashes) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            kept = (table[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
            joined = same.copy()
            joined[:-1] &= kept.astype(bool)
            # The last word of each word's run, and how many words of the run come before it.
            last = np.flatnonzero(~joined)
            run = np.concatenate([[0], np.cumsum(~joined)[:-1]])
            head = np.concatenate([[0], last[:-1] + 1])
            edges = np.flatnonzero(np.arange(size) + edge - 1 <= last[run])
            tails = np.maximum(head, last - edge + 2)
            for first, final, is_end in ((edges, edges + edge - 1, False), (tails, last, True)):
                if not len(first):
                    continue
                key = np.zeros(len(first), np.uint64)
                for j in range(edge):
                    here = first + j <= final
                    key = np.where(here, mix(key + hashes[np.minimum(first + j, size - 1)], 25), key)
                at, n = _first_of_equal(key)
                a, b = begin[first[at]], end[final[at]]
                ends = np.concatenate([[0], np.cumsum(b - a)])
                bytes_ = buffer[np.arange(ends[-1]) + np.repeat(a - ends[:-1], b - a)]
                phrases = pa.StringArray.from_buffers(
                    len(at), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(bytes_)
                )
                lang = pa.array(names, pa.string()).take(pa.array(text[first[at]]))
                yield pa.RecordBatch.from_arrays(
                    [lang, phrases, pa.array(n.astype(np.int64)), pa.array(np.full(len(at), is_end))],
                    names=["lang", "phrase", "n", "is_end"],
                )

    return work


def frequent_pairs(pairs: DataFrame, least: int) -> bytes:
    """The table of bits: a bit for the hash of each pair that stands ``least`` times. Its size is
    fixed, so the driver may hold it."""
    cell = F.shiftrightunsigned("pair", 64 - PAIR_BITS)
    often = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = (
        often.select(cell.alias("cell"))
        .groupBy((F.col("cell") / BUCKET).cast("long").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("cell") % BUCKET).alias("bits"))
    )
    table = bytearray((1 << PAIR_BITS) // 8)
    for row in rows.collect():
        table[row.bucket * (BUCKET // 8) : (row.bucket + 1) * (BUCKET // 8)] = row.bits
    return bytes(table)


def phrase_graph(
    docs: DataFrame, lang: str = "lang", text: str = "text", edge: int = EDGE, least: int = LEAST
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The graph of all texts: ``edges`` (lang, phrase, n), ``ends`` (lang, phrase, n) and ``words``
    (lang, n), the number of words of each language, all staged. Each word of a piece begins an
    edge or stands in its end, so their weights give the number of words."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        text_bytes(F.col(f"`{text}`")).alias("text"),
    )
    pairs = texts.mapInArrow(_pairs, "pair long, n long")
    table = frequent_pairs(pairs, least)
    sent = spark.sparkContext.broadcast(table)
    runs = texts.mapInArrow(_runs(sent, edge), "lang string, phrase string, n long, is_end boolean")
    counts = stage(runs.groupBy("lang", "phrase", "is_end").agg(F.sum("n").alias("n")), "runs")
    sent.destroy()
    own = F.when(F.col("is_end"), F.size(F.split("phrase", " "))).otherwise(1)
    return (
        counts.where("not is_end").select("lang", "phrase", "n"),
        counts.where("is_end").select("lang", "phrase", "n"),
        stage(counts.groupBy("lang").agg(F.sum(F.col("n") * own).alias("n")), "words"),
    )


def _cut(phrase: str, first: int, last: int | None = None) -> Column:
    """Words ``first`` to ``last``, from 0, of a phrase; to its end without ``last``."""
    words = F.split(phrase, " ")
    size = F.size(words) - first if last is None else F.lit(last - first)
    return F.array_join(F.slice(words, F.lit(first + 1), size), " ")


def compact(edges: DataFrame, ends: DataFrame, edge: int = EDGE) -> DataFrame:
    """``lang``, ``words`` and ``n``: all edges, those of unary paths in one row, ``SPAN`` at most.

    An inner node of a path has one edge in, one out, both of one weight, and no piece ends there;
    so every occurrence of the path's start runs on to its end, and no path is longer than a text.
    Each edge finds its path's first one by doubling: rounds of one join each, their number the
    logarithm of the longest path. Rings have no first edge; they stay as single edges.
    """
    numbered = stage(edges.withColumn("edge", F.monotonically_increasing_id()), "edges")
    node = numbered.select(
        "lang", "edge", "n", F.explode(
            F.array(
                F.struct(_cut("phrase", 0, edge - 1).alias("node"), F.lit(True).alias("out")),
                F.struct(_cut("phrase", 1).alias("node"), F.lit(False).alias("out")),
            )
        ).alias("at"),
    ).select("lang", "at.node", "at.out", "edge", "n")
    stops = ends.where(F.size(F.split("phrase", " ")) == edge - 1).select("lang", F.col("phrase").alias("node"), F.lit(None).cast("boolean").alias("out"),
                        F.lit(None).cast("long").alias("edge"), "n")
    unary = (
        node.unionByName(stops).groupBy("lang", "node").agg(
            F.count_if(F.col("out")).alias("outs"),
            F.count_if(~F.col("out")).alias("ins"),
            F.count_if(F.col("out").isNull()).alias("stops"),
            F.max(F.when(F.col("out"), F.col("edge"))).alias("edge"),
            F.max(F.when(~F.col("out"), F.col("edge"))).alias("before"),
            F.max(F.when(F.col("out"), F.col("n"))).alias("n_out"),
            F.max(F.when(~F.col("out"), F.col("n"))).alias("n_in"),
        )
        .where("outs = 1 and ins = 1 and stops = 0 and n_in = n_out and edge <> before")
    )
    # Each edge that continues a path, an edge before it, how far back that is.
    links = stage(unary.select("edge", "before", F.lit(1).cast("long").alias("far")), "links")
    left, found = -1, None
    while True:
        back = links.select(F.col("edge").alias("before"), F.col("before").alias("further"), F.col("far").alias("more"))
        stepped = stage(
            links.join(back, "before", "left").select(
                "edge", F.coalesce("further", "before").alias("before"),
                (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                F.col("further").isNotNull().alias("open"),
            ),
            "links",
        )
        discard(links)
        links, now = stepped, stepped.where("open").count()
        if now == 0 or now == left:  # settled, or nothing but rings left
            break
        left = now
    # An edge and its place in a path meet in an aggregate; edges without a link begin a path.
    place = links.where("not open").select(
        "edge", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("phrase"),
        F.lit(None).cast("long").alias("n"), "before", "far",
    )
    own = numbered.select(
        "edge", "lang", "phrase", "n", F.lit(None).cast("long").alias("before"), F.lit(None).cast("long").alias("far")
    )
    whole = [F.first(c, ignorenulls=True).alias(c) for c in ("lang", "phrase", "n", "before", "far")]
    placed = own.unionByName(place).groupBy("edge").agg(*whole).select(
        "lang", "phrase", "n", F.coalesce("before", "edge").alias("head"), F.coalesce("far", F.lit(0)).alias("far")
    )
    last_word = F.element_at(F.split("phrase", " "), -1)
    paths = (
        placed.groupBy("head", (F.col("far") / SPAN).cast("long").alias("span"))
        .agg(
            F.first("lang").alias("lang"),
            F.first("n").alias("n"),
            F.min_by("phrase", "far").alias("start"),
            F.array_sort(F.collect_list(F.struct("far", last_word.alias("word")))).alias("steps"),
        )
        .select(
            "lang",
            F.concat(
                F.split("start", " "),
                F.transform(F.slice("steps", F.lit(2), F.size("steps")), lambda s: s["word"]),
            ).alias("words"),
            "n",
        )
    )
    found = stage(paths, "paths")
    discard(numbered, links)
    return found


def phrase_counts(paths: DataFrame, ends: DataFrame, edge: int = EDGE, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``size``, ``a``: all phrases of 1 to ``edge`` words that stand ``least``
    times, staged. Edges are read off the paths; each shorter phrase is the flow of the next longer
    ones that it begins, and of the pieces that end with it."""
    spread = paths.select("lang", "n", F.posexplode(
        F.transform(
            F.sequence(F.lit(1), F.size("words") - (edge - 1)),
            lambda i: F.array_join(F.slice("words", i, F.lit(edge)), " "),
        )
    ).alias("pos", "phrase")).select("lang", "phrase", F.col("n").alias("a"))
    out, level = None, spread
    for size in range(edge, 0, -1):
        if size < edge:
            shorter = level.select("lang", _cut("phrase", 0, size).alias("phrase"), "a")
            over = ends.where(F.size(F.split("phrase", " ")) >= size).select(
                "lang", F.array_join(F.slice(F.split("phrase", " "), F.lit(-size), F.lit(size)), " ").alias("phrase"),
                F.col("n").alias("a"),
            )
            level = stage(
                shorter.unionByName(over).groupBy("lang", "phrase").agg(F.sum("a").alias("a")), f"runs-{size}"
            )
        found = level.where(F.col("a") >= least).select("lang", "phrase", F.lit(size).alias("size"), "a")
        out = found if out is None else out.unionByName(found)
    return stage(out, "phrases")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    edge: int = EDGE,
    least: int = LEAST,
    top: int = TOP,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases
    of each language by falling score and count, then by their bytes.

    Texts are split into pieces at ``.,;:!?`` and the controls from line feed to carriage return,
    pieces into words at spaces and tabs; A-Z count as a-z. A phrase is 2 to ``edge`` words that
    stand side by side in a piece, ``least`` times in the language's texts. Cut in two, its score is
    the whole part of 1000 a n / (l r), with the counts a of the phrase, l and r of its parts and n
    of all words; of all cuts the lowest score counts, then the shortest first part. A phrase inside
    a longer one that stands as often is left out.

    A null language is ``und``. Null and empty texts have no words, repeated rows count each, an
    empty table gives an empty one, and a text of any length is taken whole. Only the two named
    columns are read, so others may have any name. Products have up to 38 digits.
    """
    edges, ends, words = phrase_graph(docs, lang, text, edge, least)
    counts = phrase_counts(compact(edges, ends, edge), ends, edge, least)
    candidates = counts.where("size > 1")
    # A phrase inside a longer one of the same count is so inside one that has one word more.
    inside = candidates.where("size > 2").select(
        "lang", F.col("a").alias("covers"),
        F.explode(F.array(_words_but("phrase", last=True), _words_but("phrase", last=False))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("covers").alias("covers"))
    kept = stage(
        candidates.join(inside, ["lang", "phrase"], "left")
        .where(F.coalesce("covers", F.lit(0)) < F.col("a")).select("lang", "phrase", "size", "a"),
        "kept",
    )
    split = F.split("phrase", " ")
    cuts = kept.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(split, F.col("k") + 1, F.size(split)), " ").alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    exact = "decimal(19,0)"
    score = F.expr(
        f"(cast(1000 as decimal(4,0)) * cast(a as {exact}) * cast(n as {exact}))"
        f" div (cast(l as {exact}) * cast(r as {exact}))"
    )
    scored = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(words, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase").agg(
            F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
        )
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _words_but(phrase: str, last: bool) -> Column:
    """A phrase without its last or its first word."""
    words = F.split(phrase, " ")
    return F.array_join(F.slice(words, F.lit(1 if last else 2), F.size(words) - 1), " ")
