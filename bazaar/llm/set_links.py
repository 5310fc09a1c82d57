"""Exact links between sets of word shingles: sets, bounds, verification and components.

What joins by Jaccard similarity share, however they find candidates. Candidates come as groups:
the sets of a key. All pairs of a group that can be close enough are settled exactly, without comparing all of them:

* the pivot of a group is the set that meets most others in all its groups, so the original of many
  altered copies rather than any copy. Each set is first verified against the best of its pivots,
  and links become components;
* then sets of one group in different components meet, unless the triangle inequality over the
  pivot, their sizes or their parity strings tell them apart. The string has a bit for each cell of
  a hash, the parity of a set's shingles there: two strings differ in at most as many bits as their
  sets do in shingles. What remains is verified on whole sets.

Groups whose sets are many, alike and yet in different components cost their pairs of bounds in
that join; its output is what the bounds leave open.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import byte_data, discard, hash_bits, mix, pieces, split_by_bits, stage, text_bytes
from bazaar.llm.components import components

# Bits of a set's parity string for each of its shingles, before rounding up to a power of two. The
# more there are, the fewer shingles share a bit and hide a difference, and the more bytes travel.
PARITY = 2
# Bytes of text that a task works on at once: its arrays take some 50 times as much.
PIECE = 2 << 20
# Sets that a task remembers to have sent.
SEEN = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C55
_PLACE = 0xD6E8FEB86659FD93


def _factors(n: int, base: int) -> np.ndarray:
    """The powers of an odd number modulo 2**64, from the power 0."""
    factors = np.full(max(n, 1), base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, and where each text's words start and end.

    Words are runs of anything but space and the five controls from tab to carriage return;
    A-Z count as a-z.
    """
    data, offsets = byte_data(texts)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    letters = data[inside]
    starts = np.flatnonzero(first[inside])
    sizes = np.diff(np.append(starts, len(letters)))
    places = np.arange(len(letters)) - np.repeat(starts, sizes)
    terms = (letters.astype(np.uint64) + np.uint64(1)) * _factors(int(sizes.max(initial=1)), _BASE)[places]
    sums = np.add.reduceat(terms, starts) if len(starts) else terms[:0]
    bounds = np.searchsorted(np.flatnonzero(first), offsets)
    return mix(sums + sizes.astype(np.uint64), 1), bounds


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes one text after the other, and
    where each text's start and end. A text of fewer words than ``width`` has one shingle."""
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    factors = _factors(width + 1, _PLACE)[1:]
    whole = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        whole += words[j : j + len(whole)] * factors[j]
    whole = mix(whole, 2)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for i, n in enumerate(counts):
        start = bounds[i]
        if n >= width:
            found = np.sort(whole[start : start + n - width + 1])
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif n:
            short = (words[start : start + n] * factors[:n]).sum(dtype=np.uint64)
            found = mix(np.array([short + np.uint64(n)], np.uint64), 3)
        else:
            continue
        sets.append(found)
        sizes[i] = len(found)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def set_ids(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, the same for equal sets; 0 for empty ones."""
    ids = np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        sums = np.add.reduceat(mix(flat, 4), bounds[:-1][full])
        ids[full] = mix(sums + np.diff(bounds)[full].astype(np.uint64), 5)
    return ids.view(np.int64)


def parities(flat: np.ndarray, bounds: np.ndarray, each: int = PARITY) -> pa.Array:
    """The parity string of each set as 64-bit words: some bits for each shingle, a power of two
    in all."""
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        size = max(64, 1 << int(each * (b - a) - 1).bit_length()) if b > a else 64
        cell = (flat[a:b] & np.uint64(size - 1)).astype(np.int64)
        bits = (np.bincount(cell, minlength=size) & 1).astype(np.uint8)
        found.append(np.packbits(bits, bitorder="little").view("<i8"))
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found or [np.zeros(0, np.int64)])))


def least_difference(a: Column, b: Column) -> Column:
    """How many shingles two sets differ in at least, by their parity strings.

    The longer string is folded to half, which adds up the parities of its cells; strings whose
    lengths differ more are of sets that their sizes tell apart, and say nothing here.
    """
    words = F.least(F.size(a), F.size(b))

    def folded(p: Column) -> Column:
        halves = F.slice(p, F.lit(1), words), F.slice(p, words + 1, words)
        half = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(p) == words, p).when(F.size(p) == 2 * words, half)

    bits = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda total, n: total + n), F.lit(0))


def unseen(flat: np.ndarray, bounds: np.ndarray, seen: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """The sets that are not among ``seen``, each once; adds them there."""
    if len(seen) > SEEN:
        seen.clear()
    kept = []
    for i, own in enumerate(set_ids(flat, bounds).tolist()):
        if own not in seen and bounds[i + 1] > bounds[i]:
            seen.add(own)
            kept.append(i)
    kept = np.array(kept, np.int64)
    sizes = (bounds[1:] - bounds[:-1])[kept]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.arange(ends[-1]) + np.repeat(bounds[kept] - ends[:-1], sizes)], ends


def set_rows(width: int):
    """Rows of (set, shingles), a set once for each task that remembers it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, 0, PIECE):
            flat, bounds = unseen(*shingle_sets(batch.column(0), width), seen)
            shingles = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_ids(flat, bounds)), shingles], names=["set", "shingles"]
            )

    return work


def within(difference: Column, percent: int) -> Column:
    """Whether sets of ``nu`` and ``nv`` shingles that differ so much are similar enough."""
    return (100 + percent) * difference <= (100 - percent) * (F.col("nu") + F.col("nv"))


def texts_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``id`` and ``text``, as bytes, of all rows."""
    return docs.select(F.col(f"`{doc}`").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))


def distinct_sets(members: DataFrame) -> DataFrame:
    """One row for each set of ``members`` (id, hash, n, set, parity) that has shingles: its size
    and string, the hash of one of its texts, and the smallest id, with ``first``, which orders
    rows without an id last and those with the same id by hash."""
    rows = members.where("n > 0").groupBy("set").agg(
        F.first("n").alias("n"),
        F.first("parity").alias("parity"),
        F.min("hash").alias("hash"),
        F.min("id").alias("least"),
        F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("hash"))).alias("first"),
    )
    return stage(rows, "distinct-sets")


def _measured(pairs: DataFrame, one: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """All pairs (u, v) with their sets' sizes and ``low`` and ``high``, between which the number
    of shingles lies in which they differ: one number where they may be close enough.

    The parity strings of all pairs travel, some bytes each; whole sets only for pairs that pass.
    Their texts are found by hash, without a Python step for the others; those that a table of bits
    tells apart from the wanted ones do not move for it.
    """
    u = one.select(F.col("set").alias("u"), F.col("n").alias("nu"), F.col("parity").alias("pu"))
    v = one.select(F.col("set").alias("v"), F.col("n").alias("nv"), F.col("parity").alias("pv"))
    low = F.greatest(least_difference(F.col("pu"), F.col("pv")), F.abs(F.col("nu") - F.col("nv")))
    bounded = stage(
        pairs.join(v, "v").join(u, "u").select("u", "v", "nu", "nv", low.cast("long").alias("low")), "pairs"
    )
    close = within(F.col("low"), percent)
    wanted = stage(
        one.join(bounded.where(close).select(F.explode(F.array("u", "v")).alias("set")).distinct(), "set")
        .select(F.col("hash").alias("wanted")).distinct(),
        "wanted",
    )
    likely = split_by_bits(texts.select("text"), F.xxhash64("text"), hash_bits(wanted))[1]
    sets = stage(
        likely.join(wanted, F.xxhash64("text") == F.col("wanted"), "left_semi")
        .mapInArrow(set_rows(width), "set long, shingles array<bigint>")
        .dropDuplicates(["set"]),
        "candidates",
    )
    a = sets.select(F.col("set").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("set").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    diff = (F.col("nu") + F.col("nv") - 2 * both).cast("long")
    columns = ["u", "v", "nu", "nv", "low", "high"]
    measured = stage(
        bounded.where(close).join(b, "v").join(a, "u").withColumn("low", diff)
        .withColumn("high", F.col("low")).select(columns)
        .unionByName(bounded.where(~close).withColumn("high", F.col("nu") + F.col("nv")).select(columns)),
        "measured",
    )
    discard(bounded, wanted, sets)
    return measured


def _links(measured: DataFrame, percent: int) -> DataFrame:
    return measured.where((F.col("low") == F.col("high")) & within(F.col("high"), percent)).select("u", "v")


def _rooted(rows: DataFrame, root: DataFrame, column: str, out: str) -> DataFrame:
    named = root.select(F.col("u").alias(column), F.col("root").alias(out))
    return rows.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def _open_pairs(
    stars: DataFrame, measured: DataFrame, one: DataFrame, root: DataFrame, percent: int
) -> DataFrame:
    """Pairs of sets of one group, in different components, that may be close enough.

    The difference of sets is a metric: two sets differ by what their distances to the pivot differ
    at least. Those are known in full for sets near their pivot, and from below for others. One side
    of each pair is outside the component of the pivot: a group that the pivot has joined is not
    compared within itself.
    """
    sizes = one.select("set", "n", "parity")
    known = measured.select(F.col("u").alias("pivot"), F.col("v").alias("set"), "low", "high")
    rooted = stage(_rooted(_rooted(stars.select("pivot", "set"), root, "set", "r"), root, "pivot", "rp"), "rooted")
    # Only groups of several components are looked at any further.
    several = rooted.where("r <> rp").select("pivot").distinct()
    rows = rooted.join(several, "pivot", "left_semi").join(known, ["pivot", "set"], "left")
    own = several.select(
        "pivot", F.col("pivot").alias("set"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")
    )
    own = _rooted(own, root, "pivot", "rp").withColumn("r", F.col("rp"))
    rows = stage(
        rows.unionByName(own.select(rows.columns)).join(sizes, "set").select(
            "pivot", "set", "r", "rp", "n", "parity",
            F.coalesce("low", F.lit(0)).alias("low"),
            F.coalesce("high", F.lit(2**62)).alias("high"),
        ),
        "groups",
    )
    outside = rows.where("r <> rp").select(
        "pivot", F.col("set").alias("x"), F.col("n").alias("nu"), F.col("r").alias("rx"),
        F.col("low").alias("lx"), F.col("high").alias("hx"), F.col("parity").alias("px"),
    )
    others = rows.select(
        "pivot", F.col("set").alias("y"), F.col("n").alias("nv"), F.col("r").alias("ry"),
        F.col("rp").alias("home"), F.col("low").alias("ly"), F.col("high").alias("hy"),
        F.col("parity").alias("py"),
    )
    least = F.greatest(
        F.col("lx") - F.col("hy"), F.col("ly") - F.col("hx"), F.abs(F.col("nu") - F.col("nv"))
    )
    # Two sets that are both outside meet once.
    once = (F.col("ry") == F.col("home")) | (F.col("x") < F.col("y"))
    cheap = (F.col("rx") != F.col("ry")) & once & within(least, percent)
    # Nested, so that strings are compared only where nothing else tells sets apart.
    open_ = F.when(cheap, within(least_difference(F.col("px"), F.col("py")), percent)).otherwise(False)
    pairs = (
        outside.join(others, "pivot")
        .where(open_)
        .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
        .distinct()
    )
    # What has been measured is settled.
    done = measured.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    left = stage(pairs.join(done, ["u", "v"], "left_anti"), "open")
    discard(rooted, rows)
    return left


def stars_of(shared: DataFrame) -> DataFrame:
    """``pivot``, ``set`` and ``met``, how often the pivot meets others, for each pair once: of rows
    (key, set) whose key has several sets, each row once.

    Sizes, sums and pivots are aggregates that combine before the shuffle; the joins between them
    take plain tables, so that the rows of one key or set can be split.
    """
    sizes = stage(shared.groupBy("key").agg(F.count("*").alias("size")), "sizes")
    met = stage(shared.join(sizes, "key").groupBy("set").agg(F.sum("size").alias("met")), "met")
    best = F.max(F.struct("met", "set")).alias("best")
    pivots = stage(shared.join(met, "set").groupBy("key").agg(best), "pivots")
    stars = (
        shared.join(pivots, "key").where(F.col("set") != F.col("best.set"))
        .select(F.col("best.set").alias("pivot"), "set", F.col("best.met").alias("met")).distinct()
    )
    stars = stage(stars, "stars")
    discard(sizes, met, pivots)
    return stars


def linked_sets(
    stars: DataFrame, one: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """``u`` and ``root`` for each set that is not the smallest of its component.

    ``stars`` are staged rows (pivot, set, met), each once; sets that share a pivot, and the pivot, are
    candidates. ``one`` is ``distinct_sets``; ``texts`` are read again for the sets to verify.
    """
    first = stars.groupBy("set").agg(F.max(F.struct("met", "pivot")).alias("best"))
    first = first.select(F.col("best.pivot").alias("u"), F.col("set").alias("v"))
    measured = _measured(first, one, texts, width, percent)
    root = components(_links(measured, percent))
    rest = _open_pairs(stars, measured, one, root, percent)
    discard(measured)
    if rest.isEmpty():
        return root
    more = _measured(rest, one, texts, width, percent)
    links = _links(more, percent).unionByName(root.select("u", F.col("root").alias("v")))
    joined = components(links)
    discard(rest, more, root)
    return joined


def component_names(one: DataFrame, root: DataFrame) -> DataFrame:
    """``set`` with ``least``, the smallest id of its component, and ``first``, its first row.

    Sets are joined, not rows; the names of components are written first, so that the join takes
    plain tables and a component of many sets can be split.
    """
    nodes = one.join(root.withColumnRenamed("u", "set"), "set", "left").select(
        "set", F.coalesce("root", "set").alias("node"), "least", "first"
    )
    nodes = stage(nodes, "nodes")
    names = stage(nodes.groupBy("node").agg(F.min("least").alias("least"), F.min("first").alias("first")), "names")
    return nodes.select("set", "node").join(names, "node").select("set", "least", "first")
