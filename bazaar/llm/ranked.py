"""Ranked lexical search with no random access (NRA) over lists in the order of their impact.

After Fagin, Lotem and Naor, "Optimal aggregation algorithms for middleware" (2003). A shard keeps
for each term the texts that have it, the one with the highest impact first. A search reads the
lists of its terms from the front, all to about the same depth, and looks up no text elsewhere. At
each depth a text's score lies in an interval: its lower end is the sum of what has been read of
it, its upper end adds the next impact of each list in which it has not been met. Reading goes on
until every text whose upper end reaches the ``top``-th highest lower end has an interval of one
point: then membership, ties and scores are all final.

Scores are whole numbers (see ``search``), so intervals close exactly and equal scores are ties.
Statistics are those of the whole corpus: lengths are counted before the index is written, and the
document frequencies of the terms asked for are summed over all shards, so the best of the shards'
best are the best of all. A task carries the score that a result needs from shard to shard.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bazaar.llm.common import byte_data, pieces, stage, text_bytes
from bazaar.llm.search import terms

TOP = 20
# Bytes of text in a shard.
SHARD_BYTES = 12 << 20
# Bytes of queries that are broadcast at once; more queries are worked off in blocks.
QUERY_BYTES = 4 << 20
# Entries that are first read of each list; the depth then grows by this factor.
FIRST, GROWTH = 128, 4
# Shards that a search task works on, one after the other, while there are enough tasks for all
# cores many times over.
SHARDS_A_TASK = 4

_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

INDEX = "shard string, term binary, texts array<int>, counts array<int>, scale array<long>, ids array<{kind}>"


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of texts that have a term, and of all terms, in the batches of a task."""
    texts = total = 0
    for batch in pieces(batches, 0):
        data, offsets = byte_data(batch.column(0))
        inside = _IN_TERM[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        first[heads] = inside[heads]
        own = np.diff(np.searchsorted(np.flatnonzero(first), offsets))
        texts += int((own > 0).sum())
        total += int(own.sum())
    yield pa.RecordBatch.from_arrays([pa.array([texts]), pa.array([total])], names=["n", "total"])


def scale_of(length: int, n: int, total: int) -> int:
    """What a text's length makes of the count at which a term's impact is half its most, in
    hundredths: 75 and 25 times the length over the mean one."""
    return 100 - 25 + (25 * length * n) // total


def impacts(counts: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """What a term adds to a text's score for each of its weight, by its count in the text."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * scale)


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class _Numbers(dict):
    """Numbers for terms in the order of their coming."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _index(kind: pa.DataType, n: int, total: int):
    """From (id, text): for each shard a row for each term, with its texts by falling impact and
    their counts, and one row without a term, with the texts' scales and ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for seq, batch in enumerate(pieces(batches, 1, SHARD_BYTES)):
            numbers = _Numbers()
            size = batch.num_rows
            flat, lengths = [], []
            for text in batch.column(1):
                own = terms(text.as_py())
                lengths.append(len(own))
                flat.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
            key = np.concatenate(flat) * size + np.repeat(np.arange(size), lengths)
            del flat
            posting, counts = np.unique(key, return_counts=True)
            del key
            term, text = np.divmod(posting, size)
            scale = np.array([scale_of(length, n, total) if total else 0 for length in lengths], np.int64)
            order = np.lexsort((text, -impacts(counts, scale[text]), term))
            starts = np.searchsorted(term, np.arange(len(numbers) + 1)).astype(np.int32)
            ids = batch.column(0).to_pylist()

            def lists(values: np.ndarray, starts=starts) -> pa.Array:
                own = pa.ListArray.from_arrays(pa.array(starts), pa.array(values, pa.int32()))
                return pa.concat_arrays([own, pa.nulls(1, own.type)])

            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{seq}"] * (len(numbers) + 1)),
                    pa.array([*numbers, None], pa.binary()),
                    lists(text[order]),
                    lists(counts[order]),
                    pa.array([None] * len(numbers) + [scale.tolist()], pa.list_(pa.int64())),
                    pa.array([None] * len(numbers) + [ids], pa.list_(kind)),
                ],
                names=["shard", "term", "texts", "counts", "scale", "ids"],
            )

    return work


def build_index(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """The stored index in order of impact, the number of texts that have a term, and of all terms.

    One pass counts terms, since the order of a list depends on the mean length; a second one
    makes a shard of each few megabytes of text, in the task that reads them. Nothing is shuffled.
    """
    texts = docs.select(F.col(f"`{doc}`").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))
    counted = texts.select("text").mapInArrow(_lengths, "n long, total long")
    n, total = counted.agg(F.sum("n"), F.sum("total")).first()
    kind = texts.schema["id"].dataType
    rows = texts.mapInArrow(
        _index(to_arrow_type(kind), n or 0, total or 0), INDEX.format(kind=kind.simpleString())
    )
    return stage(rows, "impacts"), n or 0, total or 0


def no_random_access(
    lists: list[tuple[int, np.ndarray, np.ndarray]], size: int, top: int, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a shard, of ``size`` in all, that can be among the ``top`` best, and their
    scores: all that reach both ``least`` and the ``top``-th best score, ties included.

    Each list is a weight, texts and impacts, the highest impact first.
    """
    lower = np.zeros(size, np.int64)
    place = 0
    step = FIRST
    while True:
        end = place + step
        missing = 0
        known = np.zeros(size, np.int64)
        for weight, texts, impact in lists:
            if place < len(texts):
                lower[texts[place:end]] += weight * impact[place:end]
            if end < len(texts):
                bound = weight * int(impact[end])
                missing += bound
                known[texts[:end]] += bound
        needed = least
        if size > top:
            needed = max(least, int(np.partition(lower, size - top)[size - top]))
        if not missing:
            found = np.flatnonzero(lower >= needed)
            return found, lower[found]
        upper = lower + (missing - known)
        able = np.flatnonzero(upper >= needed)
        if (upper[able] == lower[able]).all():
            return able, lower[able]
        place, step = end, end * (GROWTH - 1)


def _searched(queries: Broadcast, top: int, kind: pa.DataType):
    """Rows of one shard after the other, the one without a term first; at the end the task's
    best (query, score, id)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = queries.value
        best: list[list[tuple]] = [[] for _ in asked]
        shard = name = scale = ids = None

        def settle() -> None:
            for number, (_, own) in enumerate(asked):
                lists = [(times * weights[t], *shard[t]) for t, times in own.items() if t in shard]
                if not lists:
                    continue
                held = best[number]
                least = held[top - 1][0] if len(held) >= top else 1
                found, scores = no_random_access(lists, len(scale), top, least)
                rows = [(s, ids[t]) for t, s in zip(found.tolist(), scores.tolist(), strict=True)]
                if rows:
                    held += rows
                    held.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                    del held[top:]

        for batch in batches:
            for i in range(batch.num_rows):
                own, term, texts, counts, scales, all_ids = (c[i] for c in batch.columns)
                if own.as_py() != name:
                    if name is not None:
                        settle()
                    name, shard = own.as_py(), {}
                    scale, ids = scales.values.to_numpy(), all_ids.as_py()
                else:
                    at = texts.values.to_numpy()
                    n = counts.values.to_numpy().astype(np.int64)
                    if weights[term.as_py()]:
                        shard[term.as_py()] = at, impacts(n, scale[at])
        if name is not None:
            settle()
        rows = [(asked[q][0], s, i) for q, held in enumerate(best) for s, i in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), kind))],
            names=["query", "score", "id"],
        )

    return work


def _blocks(queries: DataFrame, query: str, text: str, size: int) -> Iterator[tuple[int, DataFrame]]:
    """The queries with a number for each, in blocks of about ``size`` bytes."""
    rows = queries.select(F.col(f"`{query}`").alias("name"), text_bytes(F.col(f"`{text}`")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / size))
    for block in range(blocks):
        yield block, rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)


def _answers(
    spark: SparkSession, index: DataFrame, n: int, kind, block: DataFrame, top: int, shards: int
) -> DataFrame | None:
    """``name``, ``rank``, ``id``, ``score`` of the queries of one block, or nothing to answer."""
    rows = block.collect()
    asked, wanted = [], set()
    for number, row in enumerate(rows):
        own: dict[bytes, int] = {}
        for term in terms(bytes(row.text)):
            own[term] = own.get(term, 0) + 1
        asked.append((number, own))
        wanted.update(own)
    if not wanted:
        return None
    listed = spark.createDataFrame(pa.table({"term": pa.array(sorted(wanted), pa.binary())}))
    postings = index.join(F.broadcast(listed), "term")  # bounded by the bytes of a block
    counted = postings.groupBy("term").agg(F.sum(F.size("texts")).alias("df")).toArrow()
    weights = {
        term: term_weight(n, df)
        for term, df in zip(counted["term"].to_pylist(), counted["df"].to_pylist(), strict=True)
    }
    shared = spark.sparkContext.broadcast((asked, weights))
    columns = ["shard", "term", "texts", "counts", "scale", "ids"]
    tasks = max(1, min(math.ceil(shards / SHARDS_A_TASK), 16 * spark.sparkContext.defaultParallelism))
    results = (
        postings.select(columns).unionByName(index.where("term is null").select(columns))
        .repartition(tasks, "shard")
        .sortWithinPartitions("shard", F.col("term").asc_nulls_first())
        .mapInArrow(
            _searched(shared, top, to_arrow_type(kind)), f"query long, score long, id {kind.simpleString()}"
        )
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    names = spark.createDataFrame(
        [(i, row.name) for i, row in enumerate(rows)],
        f"query long, name {block.schema['name'].dataType.simpleString()}",
    )
    answers = stage(
        results.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .join(F.broadcast(names), "query")
        .select("name", "rank", "id", "score"),
        "answers",
    )
    shared.destroy()
    return answers


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    query: str = "query_id",
    query_text: str = "text",
    top: int = TOP,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query``, ``rank``, ``doc_id``, ``score``: the ``top`` texts with the highest scores above 0.

    Terms are runs of digits, letters and anything beyond ASCII, A-Z as a-z. With N texts that have
    a term, L terms in all and df texts that have the term, its weight is the whole part of
    1000 ln((2N + 2) / (2 df + 1)). A text of n terms has the scale m = 75 + 25 n N div L, and a term
    that stands tf times in it adds its weight times 10^9 tf div (1000 tf + 12 m), as often as the
    query has it.

    Of equal scores the smaller id comes first, rows without an id last. Repeated rows are results
    of their own, and so are repeated queries. Null and empty texts are results of no query and do
    not count in N; null and empty queries, and such as share no term with a text, have no results.
    An empty table on either side gives an empty result. Texts and queries of any length are taken
    whole: a longer text is a shard of its own. Only the named columns are read, so further ones
    may have any name; ``query`` must not be named as ``doc``.
    """
    spark = docs.sparkSession
    index, n, total = build_index(docs, doc, text)
    kind = docs.schema[doc].dataType
    shards = index.where("term is null").count() if total else 0
    out = None
    for _, block in _blocks(queries, query, query_text, query_bytes) if total else ():
        found = _answers(spark, index, n, kind, block, top, shards)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        nothing = f"name {queries.schema[query].dataType.simpleString()}, rank int, id {kind.simpleString()}, score long"
        out = spark.createDataFrame([], nothing)
    return out.select(F.col("name").alias(query), "rank", F.col("id").alias(doc), "score")
