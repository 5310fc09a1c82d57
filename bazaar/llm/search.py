"""Exact top-k search: an inverted index of each shard, block-max WAND, and an exact merge.

BM25 scores are sums of whole numbers: each posting's score is rounded to a step once, so a sum
does not depend on its order, ties are true ties, and every shard scores alike. Shards store
counts and lengths only; the statistics of the whole corpus (number of texts, mean length,
document frequency of each query term) come with the queries, so a shard's scores are those that
one index of everything would give, and the best of the shards' best are the best of all.

Blocks of long queries, such as whole documents, are scored term by term for many queries at once:
for hundreds of common words there is little that pruning could leave out.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bazaar.llm.common import pieces, stage, text_bytes

TOP = 10
K1 = 1.2
B = 0.75
# Postings of so many neighbouring texts are a block, with its own bound.
BLOCK = 128
# Bytes of text in a shard.
SHARD_BYTES = 8 << 20
# A score of 1 in steps.
STEPS = 1_000_000
# Bytes of queries that are broadcast at once; more queries are worked off in blocks.
QUERY_BYTES = 4 << 20
# From so many distinct terms in a mean query on, a block's queries are scored together:
LONG = 64
# as many queries as make so many scores with a shard's texts.
CELLS = 4 << 20

# Terms are runs of digits, ASCII letters and anything beyond ASCII; A-Z count as a-z.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


INDEX = "shard string, term binary, texts array<int>, counts array<int>, ids array<{kind}>"


class _Numbers(dict):
    """Numbers for terms in the order of their coming."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _index(kind: pa.DataType):
    """From (id, text): for each shard a row for each term, with the texts that have it and how
    often, and one row without a term, with all lengths and ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for seq, batch in enumerate(pieces(batches, 1, SHARD_BYTES)):
            numbers = _Numbers()
            own = [terms(t.as_py()) for t in batch.column(1)]
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.concatenate(
                [np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in own]
            )
            # Postings in the order of term and text, equal ones side by side.
            flat = np.sort(flat * len(own) + np.repeat(np.arange(len(own)), lengths))
            head = np.flatnonzero(np.diff(flat, prepend=-1))
            posting = flat[head]
            count = np.diff(np.append(head, len(flat)))
            start = np.searchsorted(posting // len(own), np.arange(len(numbers) + 1))
            lists = pa.int32()
            offsets = pa.array(start, lists)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{seq}"] * (len(numbers) + 1)),
                    pa.array([*numbers, None], pa.binary()),
                    _lists(posting % len(own), offsets, None),
                    _lists(count, offsets, lengths),
                    pa.array([None] * len(numbers) + [batch.column(0).to_pylist()], pa.list_(kind)),
                ],
                names=["shard", "term", "texts", "counts", "ids"],
            )

    return work


def _lists(values: np.ndarray, offsets: pa.Array, last: np.ndarray | None) -> pa.Array:
    lists = pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
    end = pa.array([None if last is None else last.tolist()], pa.list_(pa.int32()))
    return pa.concat_arrays([lists, end])


def build_index(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all texts: for each shard a row for each term with its postings, and
    one without a term, with the texts' lengths and ids.

    A shard is some megabytes of text, indexed by the task that reads it; nothing is shuffled.
    """
    texts = docs.select(F.col(f"`{doc}`").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))
    kind = texts.schema["id"].dataType
    rows = texts.mapInArrow(_index(to_arrow_type(kind)), INDEX.format(kind=kind.simpleString()))
    return stage(rows, "index")


class Shard:
    """One shard's postings of the query terms, with their scores and the blocks' bounds."""

    def __init__(self, lengths: np.ndarray, mean: float):
        self.norm = K1 * (1 - B + B * lengths / mean)
        self.size = len(lengths)
        self.lists: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, term: bytes, texts: np.ndarray, counts: np.ndarray, idf: float) -> None:
        """``term`` stands ``counts`` times in ``texts``; each posting's score is rounded."""
        scores = np.rint(STEPS * idf * counts * (K1 + 1) / (counts + self.norm[texts])).astype(np.int64)
        heads = np.flatnonzero(np.diff(texts // BLOCK, prepend=-1))
        self.lists[term] = texts, scores, texts[heads] // BLOCK, np.maximum.reduceat(scores, heads)

    def search(self, query: dict[bytes, int], top: int) -> list[tuple[int, int]]:
        """The best (score, text) by block-max WAND, each term weighed by its count in the query.

        Lists stand in the order of their current text. The pivot is the first text that the
        lists up to its own could lift above the worst result so far by their highest scores; if
        the scores of the pivot's block could too, the rest of that block is scored, else it is
        skipped, and so is every text before the pivot. Texts with equal scores stay in the
        order of their ids: of the worst score, none is left out before the caller's merge.
        """
        lists = [(weight, *self.lists[term]) for term, weight in query.items() if term in self.lists]
        if not lists:
            return []
        highest = np.array([w * int(bounds.max()) for w, _, _, _, bounds in lists])
        place = [0] * len(lists)
        current = np.array([texts[0] for _, texts, _, _, _ in lists])
        end = self.size
        found: list[tuple[int, int]] = []
        least = 1  # what a result needs at least
        while True:
            order = np.argsort(current, kind="stable")
            reach = np.cumsum(highest[order])
            pivot = int(np.searchsorted(reach, least))
            if pivot == len(order) or current[order[pivot]] >= end:
                return found
            text = int(current[order[pivot]])
            block = text // BLOCK
            after = (block + 1) * BLOCK
            bound = 0
            near = [i for i in range(len(lists)) if current[i] < after]
            for i in near:
                weight, _, _, blocks, bounds = lists[i]
                at = int(np.searchsorted(blocks, block))
                if at < len(blocks) and blocks[at] == block:
                    bound += weight * int(bounds[at])
            sums = np.zeros(BLOCK, np.int64)
            for i in near:
                weight, texts, scores, _, _ = lists[i]
                lo = place[i] + int(np.searchsorted(texts[place[i] :], text))
                hi = lo + int(np.searchsorted(texts[lo:], after))
                if bound >= least:
                    sums[texts[lo:hi] - block * BLOCK] += weight * scores[lo:hi]
                place[i] = hi
                current[i] = texts[hi] if hi < len(texts) else end
            if bound >= least:
                for t in np.flatnonzero(sums >= least).tolist():
                    found.append((int(sums[t]), block * BLOCK + t))
                if len(found) > top:
                    found.sort(key=lambda r: -r[0])
                    least = found[top - 1][0]
                    found = [r for r in found if r[0] >= least]


def _searched(batches: Iterator[pa.RecordBatch], queries, mean: float, top: int, kind: pa.DataType):
    """Rows of one shard after the other, the one without a term first: (query, score, id)."""
    shard = name = ids = None

    def results() -> pa.RecordBatch:
        rows = [
            (query, score, ids[text])
            for query, weights in queries.value[0]
            for score, text in shard.search(weights, top)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], kind),
            ],
            names=["query", "score", "id"],
        )

    for batch in batches:
        for i in range(batch.num_rows):
            own, term, texts, counts, all_ids = (c[i] for c in batch.columns)
            if own.as_py() != name:
                if shard is not None:
                    yield results()
                name, ids = own.as_py(), all_ids.as_py()
                shard = Shard(counts.values.to_numpy(), mean)
            else:
                word = term.as_py()
                shard.add(word, texts.values.to_numpy(), counts.values.to_numpy(), queries.value[1][word])
    if shard is not None:
        yield results()


class Together:
    """The terms of a block of long queries, by term: ``weights`` are (number, term counts)."""

    def __init__(self, weights: list[tuple[int, dict[bytes, int]]], number: dict[bytes, int]):
        sizes = [len(own) for _, own in weights]
        self.term = np.fromiter((number[t] for _, own in weights for t in own), np.int32, sum(sizes))
        self.weight = np.fromiter((w for _, own in weights for w in own.values()), np.int32, sum(sizes))
        self.query = np.repeat(np.array([i for i, _ in weights], np.int32), sizes)
        order = np.argsort(self.term, kind="stable")
        self.term, self.query, self.weight = self.term[order], self.query[order], self.weight[order]
        self.idf = np.zeros(len(number))

    def best(self, numbers, sizes, texts, counts, lengths, ids, mean: float, top: int) -> pa.Table:
        """(query, score, id): the ``top`` texts of one shard for each query. Term ``numbers[j]``
        has the next ``sizes[j]`` of the postings ``texts`` and ``counts``.

        Scores are sums of whole numbers below 2^53, exact as floats in any order.
        """
        norm = K1 * (1 - B + B * lengths / mean)
        idf = np.repeat(self.idf[numbers], sizes)
        scores = np.rint(STEPS * idf * counts * (K1 + 1) / (counts + norm[texts]))
        # Texts in the order of their ids, which settles ties.
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        texts, starts = place[texts], np.cumsum(sizes) - sizes
        row = np.full(len(self.idf), -1)
        row[numbers] = np.arange(len(numbers))
        here = row[self.term] >= 0
        term, query, weight = row[self.term[here]], self.query[here], self.weight[here]
        step = max(1, CELLS // len(order))
        found = []
        for low in range(0, int(query.max(initial=-1)) + 1, step):
            own = (query >= low) & (query < low + step)
            sums = self._sums(
                term[own], query[own] - low, weight[own], starts, sizes, texts, scores,
                (int(query[own].max(initial=low)) - low + 1, len(order)),
            )
            least = np.ones(len(sums))
            if len(order) > top:
                least = np.maximum(least, np.partition(sums, -top, axis=1)[:, -top])
            q, text = np.nonzero(sums >= least[:, None])
            score = sums[q, text]
            q, text, score = (x[np.lexsort((text, -score, q))] for x in (q, text, score))
            kept = np.arange(len(q)) - np.searchsorted(q, q) < top
            found.append((q[kept] + low, score[kept].astype(np.int64), order[text[kept]]))
        q, score, text = (
            np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]).astype(np.int64)
            for i in range(3)
        )
        return pa.table({"query": q, "score": score, "id": ids.take(pa.array(text))})

    @staticmethod
    def _sums(term, query, weight, starts, sizes, texts, scores, shape) -> np.ndarray:
        """The scores of some queries (rows) and all texts: terms that many of both have by a
        matrix product, the others by their postings."""
        sums = np.zeros(shape)
        heads = np.flatnonzero(np.diff(term, prepend=-1))
        cells = np.diff(np.append(heads, len(term))) * sizes[term[heads]]
        many = term[heads[cells >= 0.01 * sums.size]]
        if len(many):
            column = np.full(len(sizes), -1)
            column[many] = np.arange(len(many))
            dense = column[term] >= 0
            left, right = np.zeros((shape[0], len(many))), np.zeros((len(many), shape[1]))
            left[query[dense], column[term[dense]]] = weight[dense]
            for i, t in enumerate(many.tolist()):
                own = slice(starts[t], starts[t] + sizes[t])
                right[i, texts[own]] = scores[own]
            sums += left @ right
            term, query, weight = term[~dense], query[~dense], weight[~dense]
            heads = np.flatnonzero(np.diff(term, prepend=-1))
            cells = np.diff(np.append(heads, len(term))) * sizes[term[heads]]
        flat = sums.reshape(-1)
        base = query.astype(np.int64) * shape[1]
        ends = np.append(heads, len(term))
        some = cells >= 256
        for i in np.flatnonzero(some).tolist():
            a, b, t = ends[i], ends[i + 1], term[ends[i]]
            own = slice(starts[t], starts[t] + sizes[t])
            flat[base[a:b, None] + texts[own]] += weight[a:b, None] * scores[own]
        few = np.flatnonzero(~np.repeat(some, np.diff(ends)))
        times = sizes[term[few]]
        before = np.cumsum(times) - times
        # Every posting of every such term of a query, a bounded number at a time.
        cuts = np.searchsorted(before, np.arange(0, int(times.sum()) + 1, CELLS))
        for a, b in zip(cuts, [*cuts[1:], len(few)], strict=True):
            n = times[a:b]
            if not n.sum():
                continue
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[term[few[a:b]]], n)
            np.add.at(
                flat, np.repeat(base[few[a:b]], n) + texts[at], np.repeat(weight[few[a:b]], n) * scores[at]
            )
        return sums


def _searched_together(batches: Iterator[pa.RecordBatch], state, mean: float, top: int, kind: pa.DataType):
    """Rows of one shard after the other, the one without a term first; the task's best of all its
    shards (query, score, id) come at its end."""
    block = state.value
    best = pa.table({"query": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "id": pa.array([], kind)})

    def merged(best: pa.Table, rows: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(rows).combine_chunks()
        head, lists = table.slice(0, 1), table.slice(1)
        if not len(lists):
            return best
        texts, counts = (lists.column(c).combine_chunks() for c in ("texts", "counts"))
        new = block.best(
            lists.column("number").to_numpy(),
            pc.list_value_length(texts).to_numpy().astype(np.int64),
            texts.flatten().to_numpy(),
            counts.flatten().to_numpy(),
            head.column("counts").combine_chunks().flatten().to_numpy(),
            head.column("ids").combine_chunks().flatten(),
            mean, top,
        )
        both = pa.concat_tables([best, new.cast(best.schema)])
        keys = [("query", "ascending"), ("score", "descending"), ("id", "ascending")]
        both = both.take(pc.sort_indices(both, keys, null_placement="at_end"))
        query = both.column("query").to_numpy()
        return both.filter(pa.array(np.arange(len(query)) - np.searchsorted(query, query) < top))

    rows: list[pa.RecordBatch] = []
    for batch in batches:
        heads = np.flatnonzero(batch.column("number").is_null().to_numpy(zero_copy_only=False)).tolist()
        for a, b in zip([0, *heads], [*heads, batch.num_rows], strict=True):
            if a in heads and rows:
                best, rows = merged(best, rows), []
            if b > a:
                rows.append(batch.slice(a, b - a))
    if rows:
        best = merged(best, rows)
    yield from best.combine_chunks().to_batches()


def _query_blocks(
    queries: DataFrame, query: str, text: str, size: int
) -> Iterator[list[tuple[int, object, bytes]]]:
    """The queries in blocks of about ``size`` bytes; the driver holds one at a time."""
    rows = queries.select(F.col(f"`{query}`").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / size))
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        if own:
            yield [(i, row.id, bytes(row.text)) for i, row in enumerate(own)]


def search(
    docs: DataFrame,
    queries: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    query: str = "query_id",
    query_text: str = "text",
    top: int = TOP,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query``, ``rank``, ``doc_id``, ``score`` (in steps of a millionth): the ``top`` texts
    with the highest BM25 scores above 0 for each query.

    idf is ln(1 + (N - df + 0.5) / (df + 0.5)); a term counts as often as the query has it. Of
    equal scores the smaller id comes first, rows without an id last; repeated rows are results
    of their own, and so are repeated queries. Null and empty texts are results of no query, but
    count as texts of length 0; null and empty queries have no results. Empty tables on either
    side give an empty result.

    All texts are indexed in one pass. Each block of queries then reads the postings of its own
    terms, a task a few whole shards; what meets for a query is ``top`` rows of each shard, of
    which each task keeps its best before the shuffle. Blocks of long queries meet a shard
    together: their work is the number of postings of their terms, so it grows with the queries
    times the texts.
    """
    spark = docs.sparkSession
    index = build_index(docs, doc, text)
    id_type = docs.schema[doc].dataType
    kind = to_arrow_type(id_type)
    lengths = index.where("term is null").agg(
        F.sum(F.size("ids")), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c))
    )
    n, total = lengths.first()
    out = None
    for block in _query_blocks(queries, query, query_text, query_bytes) if total else ():
        weights = [(i, _counted(terms(body))) for i, _, body in block]
        number = _Numbers()
        for _, own in weights:
            for term in own:
                number[term]
        together = len(number) and sum(len(own) for _, own in weights) > LONG * len(weights)
        wanted = spark.createDataFrame(
            pa.table({"term": pa.array(number, pa.binary()), "number": pa.array(range(len(number)), pa.int32())})
        )
        # The index in terms of this block: bounded by its queries.
        postings = index.join(F.broadcast(wanted), "term")
        frequency = postings.groupBy("number").agg(F.sum(F.size("texts")).alias("df")).toArrow()
        df = dict(zip(frequency["number"].to_pylist(), frequency["df"].to_pylist(), strict=True))
        idf = {i: math.log(1 + (n - d + 0.5) / (d + 0.5)) for i, d in df.items()}
        key = "number" if together else "term"
        if together:
            state = Together(weights, number)
            state.idf[list(idf)] = list(idf.values())
        else:
            state = weights, {term: idf[i] for term, i in number.items() if i in idf}
        shared = spark.sparkContext.broadcast(state)
        del weights, number, frequency, df, idf, state
        columns = ["shard", key, "texts", "counts", "ids"]
        heads = index.where("term is null").withColumn("number", F.lit(None).cast("int"))
        work = _searched_together if together else _searched
        rows = (
            postings.select(columns).unionByName(heads.select(columns))
            .repartition("shard")
            .sortWithinPartitions("shard", F.col(key).asc_nulls_first())
            .mapInArrow(
                _work(work, shared, total / n, top, kind),
                f"query long, score long, id {id_type.simpleString()}",
            )
        )
        names = spark.createDataFrame(
            [(i, value) for i, value, _ in block], f"query long, name {queries.schema[query].dataType.simpleString()}"
        )
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        found = (
            rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(F.broadcast(names), "query")
            .select(
                F.col("name").alias(query), F.col("rank").cast("long").alias("rank"),
                F.col("id").alias(doc), "score",
            )
        )
        if together:  # large blocks: the driver holds the terms of one
            found = stage(found, "found")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = queries.limit(0).select(F.col(f"`{query}`").alias(query))
        return empty.select(
            query, F.lit(None).cast("long").alias("rank"), F.lit(None).cast(id_type).alias(doc),
            F.lit(None).cast("long").alias("score"),
        )
    return out


def _work(work, state, mean: float, top: int, kind: pa.DataType):
    return lambda batches: work(batches, state, mean, top, kind)


def _counted(words: list[bytes]) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return counts
