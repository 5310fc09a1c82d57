"""Exact Jaccard join of word shingles by universe partition and the pigeonhole principle.

After Deng, Li, Wen and Feng, "An Efficient Partition Based Method for Exact Set Similarity
Joins" (2015). Sets are put into bands by size. A band cuts the universe of shingles into
segments by hash; the key of a set's segment is a hash of the shingles that it has there. Two
sets of x and y shingles with a Jaccard similarity of t differ in (1-t)/(1+t) (x+y) shingles at
most, H say, so in H segments at most:

* a set with more than H non-empty segments shares a key with its partner among any H+1 of them.
  Both sides choose their H+1 cheapest by one order of all keys, frequent keys last; by the
  argument of prefix filters they then still share one;
* a set with H non-empty segments or fewer keeps all keys and adds the keys of its segments with
  one shingle deleted: a segment of two shingles or more counts double in the pigeonhole;
* where even that does not exceed H, the set adds each shingle as a key of its own.

So no pair is lost. Sets with a common key are candidates; ``set_links`` settles exactly which of
them are linked, by bounds and on whole sets.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import discard, hash_bits, mix, pieces, split_by_bits, stage, text_bytes
from bazaar.llm.set_links import (
    PIECE,
    component_names,
    distinct_sets,
    linked_sets,
    parities,
    set_ids,
    shingle_sets,
    stars_of,
    texts_of,
    unseen,
)

SHINGLE = 5
PERCENT = 75
# A band's sizes go up to this many times its smallest.
BAND = 4
# Segments of a band for each shingle of its largest set.
SEGMENTS = 0.5
# Cells of the sketch of key frequencies: of fixed size, whatever the corpus. The more there are,
# the less frequent passages it tells from others; it decides costs, never results.
SKETCH_BITS = 22
SKETCH_PARTS = 64


def roles(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bands in which sets of these sizes look for partners: set number, largest size of the
    band, and H, the most shingles in which the set and a partner there can differ.

    A set is in the band of its size, and in the next one if a partner there can be large enough.
    """
    number = np.flatnonzero(sizes)
    x = sizes[number]
    low = BAND ** np.floor(np.log(x) / np.log(BAND) + 1e-9).astype(np.int64)
    low = np.where(x >= low * BAND, low * BAND, np.where(x < low, low // BAND, low))
    high = low * BAND
    partner = x * 100 // percent
    up = partner >= high
    number = np.concatenate([number, number[up]])
    largest = np.concatenate([np.minimum(partner, high - 1), partner[up]])
    top = np.concatenate([high, high[up] * BAND])
    x = np.concatenate([x, x[up]])
    return number, top, (100 - percent) * (x + largest) // (100 + percent)


def segment_keys(
    flat: np.ndarray, bounds: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """The keys of all non-empty segments, in each band that a set is in.

    Returns the keys, where each role's keys start and end, each role's set and H, and what the
    rarer kinds of keys are made of. Roles whose H is 0 are left out: only an equal set is close
    enough, and equal sets have one id.
    """
    number, top, most = roles(np.diff(bounds), percent)
    live = most > 0
    number, top, most = number[live], top[live], most[live]
    sizes = (bounds[1:] - bounds[:-1])[number]
    total = int(sizes.sum())
    start = np.cumsum(sizes) - sizes
    role = np.repeat(np.arange(len(number)), sizes)
    shingles = flat[np.arange(total) - np.repeat(start - bounds[number], sizes)]
    segments = np.maximum((top * SEGMENTS).astype(np.uint64), np.uint64(2))
    segment = ((shingles >> np.uint64(32)) * segments[role]) >> np.uint64(32)
    new = np.ones(total, bool)
    new[1:] = (segment[1:] != segment[:-1]) | (role[1:] != role[:-1])
    heads = np.flatnonzero(new)
    spread = mix(shingles, 6)
    sums = np.add.reduceat(spread, heads) if total else spread
    salt = mix(segment[heads] + (top[role[heads]].astype(np.uint64) << np.uint64(32)), 7)
    keys = mix(sums + salt, 8)
    ends = np.searchsorted(role[heads], np.arange(len(number) + 1))
    return keys, ends, number, most, (heads, np.append(heads[1:], total), sums, salt, spread, shingles, top)


def chosen_keys(
    flat: np.ndarray, bounds: np.ndarray, percent: int, cost: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """The keys by which sets look for partners, and the number of the set of each."""
    keys, ends, number, most, (heads, tails, sums, salt, spread, shingles, top) = segment_keys(
        flat, bounds, percent
    )
    # Cost in the upper bits, the key's own in the lower ones: one order for all sets.
    order = (cost(keys) << np.uint64(58)) | (keys >> np.uint64(6))
    out, sizes = [], np.zeros(len(number), np.int64)
    for i, h in enumerate(most):
        a, b = ends[i], ends[i + 1]
        if b - a > h + 1:
            found = keys[a + np.argpartition(order[a:b], h)[: h + 1]]
        elif b - a == h + 1:
            found = keys[a:b]
        else:
            found = _few_segments(
                keys[a:b], heads[a:b], tails[a:b], sums[a:b], salt[a:b], spread, shingles, int(h),
                int(top[i]),
            )
        out.append(found)
        sizes[i] = len(found)
    return (np.concatenate(out) if out else keys[:0]), np.repeat(number, sizes)


def _few_segments(keys, heads, tails, sums, salt, spread, shingles, h, top):
    """All keys of a set with H non-empty segments or fewer, and those of its segments with one
    shingle deleted; if those don't do either, each of its shingles."""
    several = np.flatnonzero(tails - heads > 1)
    found = [keys]
    for i in several:
        found.append(mix(sums[i] - spread[heads[i] : tails[i]] + salt[i], 8))
    if len(keys) + len(several) <= h:
        found.append(mix(shingles[heads[0] : tails[-1]] + np.uint64(top), 9))
    return np.unique(np.concatenate(found))


SEEN_COLUMNS = ["id", "hash", "n", "set", "parity", "part", "counts"]


def _sets_and_sketch(width: int, percent: int):
    """From (id, hash, text): rows of (id, hash, size, set, parity, null, null), and at a task's
    end its share of the sketch, in parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        kind, held = None, []
        for batch in pieces(batches, 2, PIECE):
            flat, bounds = shingle_sets(batch.column(2), width)
            keys = segment_keys(flat, bounds, percent)[0]
            held.append((keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
            if sum(map(len, held)) > len(sketch) // 2:
                sketch += np.bincount(np.concatenate(held), minlength=len(sketch))
                held = []
            n, kind = batch.num_rows, batch.column(0).type
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(bounds)),
                    pa.array(set_ids(flat, bounds)),
                    parities(flat, bounds),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names=SEEN_COLUMNS,
            )
        if kind is None:
            return
        sketch += np.bincount(np.concatenate(held or [sketch[:0]]), minlength=len(sketch))
        # A cell's count in one task ends at 65,535: a key as frequent as that costs enough.
        parts = np.split(np.minimum(sketch, 65535).astype("<u2"), SKETCH_PARTS)
        for i, part in enumerate(parts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, kind),
                    *(pa.nulls(1, pa.int64()) for _ in range(3)),
                    pa.nulls(1, pa.list_(pa.int64())),
                    pa.array([i], pa.int32()),
                    pa.array([part.tobytes()], pa.binary()),
                ],
                names=SEEN_COLUMNS,
            )

    return work


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs of each part's cells: the logarithm of their counts' sum over all tasks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(*batch.columns, strict=True):
            own = np.frombuffer(counts.as_py(), "<u2").astype(np.int64)
            i = part.as_py()
            sums[i] = sums[i] + own if i in sums else own
    costs = [np.log2(s + 1).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(costs, pa.binary())], names=["part", "costs"]
    )


def _key_rows(width: int, percent: int, costs: Broadcast):
    """Rows of (key, set), a set once for each task that remembers it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = costs.value

        def cost(keys: np.ndarray) -> np.ndarray:
            return table[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)

        seen: set[int] = set()
        for batch in pieces(batches, 0, PIECE):
            flat, bounds = unseen(*shingle_sets(batch.column(0), width), seen)
            keys, number = chosen_keys(flat, bounds, percent, cost)
            ids = set_ids(flat, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(ids[number])], names=["key", "set"]
            )

    return work


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of (key, set): those whose key has another set, with the key's
    first set. Holds one batch and the row before it, however many sets a key has."""
    key = last = pivot = None
    sent = False  # whether the open key's first set has been given out
    for batch in batches:
        keys, sets = (c.to_numpy() for c in batch.columns)
        if not len(keys):
            continue
        same = np.empty(len(keys), bool)  # the key of the row before
        same[1:] = keys[1:] == keys[:-1]
        same[0] = key is not None and keys[0] == key
        again = np.empty(len(keys), bool)  # the row before once more
        again[1:] = same[1:] & (sets[1:] == sets[:-1])
        again[0] = same[0] and sets[0] == last
        head = np.maximum.accumulate(np.where(same, -1, np.arange(len(keys))))
        first = np.where(head >= 0, sets[np.maximum(head, 0)], pivot if pivot is not None else 0)
        member = same & ~again & (sets != first)
        out_keys, out_sets, out_first = [keys[member]], [sets[member]], [first[member]]
        # The first sets themselves, once a second one has come.
        heads = np.unique(head[member & (head >= 0)])
        out_keys.append(keys[heads]), out_sets.append(sets[heads]), out_first.append(sets[heads])
        if not sent and (member & (head < 0)).any():
            for out, value in ((out_keys, key), (out_sets, pivot), (out_first, pivot)):
                out.append(np.array([value], np.int64))
            sent = True
        if head[-1] >= 0:
            pivot, sent = sets[head[-1]], bool(member[head[-1] :].any())
        key, last = keys[-1], sets[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (out_keys, out_sets, out_first)],
            names=["key", "set", "pivot"],
        )


def _members(
    docs: DataFrame, doc: str, text: str, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """``id``, ``hash`` (of the text), ``n`` (size of the set) and ``set`` of each row; and of each
    set that has shingles ``least`` and ``first``, the smallest id and the first row of its
    component."""
    if percent * BAND < 100:
        raise ValueError(f"partners of less than 1/{BAND} of a set's size are not looked for")
    spark = docs.sparkSession
    texts = texts_of(docs, doc, text)
    kind = texts.schema["id"].dataType.simpleString()
    seen = stage(
        texts.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
            _sets_and_sketch(width, percent),
            f"id {kind}, hash long, n long, set long, parity array<bigint>, part int, counts binary",
        ),
        "sets",
    )
    costs = np.zeros(1 << SKETCH_BITS, np.uint8)
    parts = seen.where("part is not null").select("part", "counts").repartition(SKETCH_PARTS, "part")
    for row in parts.mapInArrow(_costs, "part int, costs binary").collect():
        costs.reshape(SKETCH_PARTS, -1)[row.part] = np.frombuffer(row.costs, np.uint8)
    members = seen.where("part is null").drop("part", "counts")

    sent = spark.sparkContext.broadcast(costs)
    del costs
    keys = texts.select("text").mapInArrow(_key_rows(width, percent, sent), "key long, set long")
    shared = stage(
        keys.repartition("key")
        .sortWithinPartitions("key", "set")
        .mapInArrow(_shared, "key long, set long, pivot long"),
        "shared",
    )
    sent.destroy()
    stars = stars_of(shared.select("key", "set"))
    discard(shared)
    one = distinct_sets(members)
    names = component_names(one, linked_sets(stars, one, texts, width, percent))
    discard(stars)
    return members.select("id", "hash", "n", "set"), names


def jaccard_components(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    A text's set is its distinct shingles of ``width`` words; a text of fewer words is one
    shingle, one without words has none and is linked with nothing. Two rows are linked when
    100 * intersection >= ``percent`` * union; a component is what links reach, named by its
    smallest id. Equal sets, so exact copies and repeated rows too, are one node throughout. A
    null text is empty; a row without an id belongs to its component, and names it only if no
    row of it has an id. An empty table gives an empty one.

    Shingles and sets are compared as 64-bit hashes.

    Two passes make sets of all texts: for key frequencies, and for keys. Two more find the texts
    of candidates by their hash. Keys are shuffled, parity strings of the sets that share one, and
    the whole sets of candidates that remain. Only the two named columns are read, so others may
    have any name; a text of any length is taken whole.
    """
    members, names = _members(docs, doc, text, width, percent)
    columns = (F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
    return (
        members.where("n > 0").join(names, "set")
        .select(*columns, F.col("least").alias("component_id"))
        .unionByName(members.where("n = 0").select(*columns, F.col("id").alias("component_id")))
    )


def one_of_each(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of ``docs`` for each component, with its columns: the one with the smallest id,
    rows without an id last, then the smallest hash of the text; of repeated rows one.

    Documents without words are linked with nothing and stay, all of them. What goes is a list of
    ids and hashes; only texts that a table of bits cannot tell apart from it are joined to it.
    """
    members, names = _members(docs, doc, text, width, percent)
    rows = members.where("n > 0").groupBy("set", "id", "hash").agg(F.count("*").alias("copies"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    judged = stage(
        rows.join(names.select("set", "first"), "set")
        .where(~same | (F.col("copies") > 1))
        .select(F.col("id").alias("__nj_id"), F.col("hash").alias("__nj_hash"), same.alias("__nj_stays")),
        "near-duplicates",
    )
    own = F.xxhash64(text_bytes(F.col(f"`{text}`")))
    this = F.col(f"`{doc}`").eqNullSafe(F.col("__nj_id")) & (own == F.col("__nj_hash"))
    row, listed = F.xxhash64(F.col(f"`{doc}`"), own), F.xxhash64("__nj_id", "__nj_hash")
    stays, maybe = split_by_bits(docs, row, hash_bits(judged.select(listed)))
    repeated = maybe.join(judged.where("__nj_stays"), this, "left_semi")
    return stays.unionByName(maybe.join(judged, this, "left_anti")).unionByName(
        repeated.withColumn("__nj_own", own).dropDuplicates([doc, "__nj_own"]).drop("__nj_own")
    )
