"""Near-duplicate documents by min-max hashing, confirmed on whole sets.

After Ji, Li, Yan, Tian and Zhang, "Min-max hash for Jaccard similarity" (2013). Each permutation
gives two values of a set, its smallest and its largest image; either is the same for two sets with
the probability of their Jaccard similarity. So half as many images are worked out as with minima
alone, and as both cannot go wrong by the same shingle, the share of equal values varies less.

Values are put into bands of ``ROWS``, of smallest or of largest images only, so that the two values
of a permutation never count in one band. Sets with an equal band are candidates. A pair at the
threshold of 0.8 has no equal band with a probability of (1 - 0.8^6)^48, less than one in two
million, and a closer pair of far less. Candidates are verified on their whole sets, see
``set_links``: no estimate decides a link.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import discard, mix, pieces, stage
from bazaar.llm.set_links import (
    PIECE,
    SEEN,
    component_names,
    distinct_sets,
    linked_sets,
    parities,
    set_ids,
    shingle_sets,
    stars_of,
    texts_of,
)

SHINGLE = 2
PERCENT = 80
ROWS = 6
# Half of the bands are of smallest images, half of largest ones.
BANDS = 48
PERMUTATIONS = BANDS // 2 * ROWS
# Bits of a parity string for each shingle: altered copies have similarities close below the
# threshold here, which shorter strings do not tell from those above it.
PARITY = 8
# Shingles of a set that are permuted at once.
CHUNK = 2048


def permutations(n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """A number to add by exclusive or and an odd factor for each permutation of 32-bit hashes."""
    seeds = mix(np.arange(2 * n), 11)
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32), (seeds[n:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def min_max(flat: np.ndarray, bounds: np.ndarray, n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest image of each set under each permutation; of an empty set the
    largest and the smallest number."""
    toggle, factor = (x[:, None] for x in permutations(n))
    hashes = (flat >> np.uint64(32)).astype(np.uint32)
    low = np.full((len(bounds) - 1, n), 0xFFFFFFFF, np.uint32)
    high = np.zeros((len(bounds) - 1, n), np.uint32)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        for at in range(a, b, CHUNK):
            images = (hashes[None, at : min(at + CHUNK, b)] ^ toggle) * factor
            np.minimum(low[i], images.min(axis=1), out=low[i])
            np.maximum(high[i], images.max(axis=1), out=high[i])
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each set, the bands of smallest images first."""
    values = np.concatenate([low, high], axis=1).astype(np.uint64)
    values = values.reshape(len(low), values.shape[1] // rows, rows)
    factors = mix(np.arange(rows), 12) | np.uint64(1)
    sums = (mix(values, 13) * factors).sum(axis=2, dtype=np.uint64)
    return mix(sums + mix(np.arange(values.shape[1]), 14)[None, :], 15)


SIGNED = "hash long, n long, set long, parity array<bigint>, keys array<bigint>"


def _signed(width: int, kind: pa.DataType | None = None):
    """From (id, hash, text): (id, hash, size, set, parity, keys); keys only where the task does not
    remember the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, 2, PIECE):
            flat, bounds = shingle_sets(batch.column(2), width)
            sizes, ids = np.diff(bounds), set_ids(flat, bounds)
            if len(seen) > SEEN:
                seen.clear()
            new = np.zeros(len(ids), bool)
            for i, own in enumerate(ids.tolist()):
                if sizes[i] and own not in seen:
                    seen.add(own)
                    new[i] = True
            kept = np.flatnonzero(new)
            ends = np.concatenate([[0], np.cumsum(sizes[kept])])
            own = flat[np.arange(ends[-1]) + np.repeat(bounds[kept] - ends[:-1], sizes[kept])]
            keys = band_keys(*min_max(own, ends))
            starts = np.concatenate([[0], np.cumsum(new * BANDS)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(starts, mask=np.append(~new, False)), pa.array(keys.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(ids), parities(flat, bounds, PARITY), lists],
                names=["id", "hash", "n", "set", "parity", "keys"],
            )

    return work


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    A text's set is its distinct shingles of ``width`` words, A-Z as a-z; a text of fewer words is
    one shingle, one without words has none and is linked with nothing. Two rows are linked when
    100 * intersection >= ``percent`` * union; a component is what links reach, named by its
    smallest id, and the row of that id is kept. Equal sets, so exact copies and repeated rows too,
    are one node throughout; repeated rows of the smallest id are all kept. A null text is empty; a
    row without an id belongs to its component, names it only if no row of it has an id, and is kept
    only then. An empty table gives an empty one. A text of any length is taken whole. Only the two
    named columns are read, so others may have any name.

    Bands are for a ``percent`` of 80 or more; with a smaller one pairs near it may be missed.
    Shingles and sets are compared as 64-bit hashes.

    One pass over the texts makes sets and keys. Keys of several sets are found by an aggregate and
    joined to their sets; neither needs the sets of a key in one place, so a key of any number of
    sets is combined before the shuffle or split after it.
    """
    texts = texts_of(docs, doc, text)
    kind = texts.schema["id"].dataType.simpleString()
    signed = stage(
        texts.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
            _signed(width), f"id {kind}, {SIGNED}"
        ),
        "signed",
    )
    keys = signed.where("keys is not null").select(F.explode("keys").alias("key"), "set")
    several = stage(
        keys.groupBy("key").agg(F.min("set").alias("first"), F.max("set").alias("last"))
        .where("first < last").select("key"),
        "several",
    )
    shared = stage(keys.join(several, "key", "left_semi").distinct(), "shared")
    stars = stars_of(shared)
    one = distinct_sets(signed)
    root = linked_sets(stars, one, texts, width, percent)
    discard(several, shared, stars)
    columns = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles")]
    members = signed.select("id", "n", "set")
    found = members.where("n > 0").join(component_names(one, root), "set").select(
        *columns, F.col("least").alias("component_id")
    )
    alone = members.where("n = 0").select(*columns, F.col("id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
