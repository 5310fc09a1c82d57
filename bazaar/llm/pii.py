"""Personal data: patterns, and terms that reveal by co-occurrence whom a text is about.

After Sanchez and Batet, "C-sanitized" (2016). What the base patterns find are the protected
entities. The information that a term t gives about an entity e is their pointwise mutual
information over the corpus; t discloses e to the degree PMI(t, e) / IC(e), which is 1 for a term
that stands only near e. Probabilities are shares of the corpus's words:

    c(e)     words in the contexts of e: WINDOW words on either side of each occurrence
    n(t, e)  occurrences of t among them
    n(t)     occurrences of t in the corpus, N words in the corpus
    IC(e)  = log(N / c(e)),  PMI(t, e) = log(n(t, e) N / (c(e) n(t)))

Terms that disclose more than GENERALISE give way to what kind of word they are, those above
REMOVE go: wherever they stand, also far from the entity and in texts without it.
"""

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import pieces, stage, text_bytes

WINDOW = 10
GENERALISE = 0.8
REMOVE = 0.95
# A term discloses an entity only if they stand together so often, and in so many documents.
MIN_TOGETHER = 3
MIN_DOCS = 2
# Words whose counts a task holds before it hands them on.
COUNTED = 1 << 18
# Bytes of disclosing terms that are broadcast at once; more of them are worked off in blocks.
TERM_BYTES = 8 << 20

# Patterns of the base kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that began inside a run of digits would begin at the run's start as well, so runs are
# tried once: long ones cost no more than their length.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]+")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each at
    sign outwards, so that a long run without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All base matches (kind, start, end) in code points, by kind and start. Matches are
    leftmost and do not overlap within a kind; one that fails its check is dropped."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text) is None:
        return spans
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def entity_key(kind: str, value: str) -> str:
    """An entity under a digest: no table that the operator writes holds it in clear."""
    value = value.lower() if kind == "email" else re.sub(r"[^0-9.]", "", value)
    return hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=12).hexdigest()


def contexts(text: str, spans: list[Span], window: int) -> list[tuple[str, str]]:
    """(entity, term) of each word near an entity; words of entities are no terms."""
    words = [m.span() for m in _WORD.finditer(text)]
    inside, edges = _covered(words, spans)
    found = []
    for (kind, a, b), (first, last) in zip(spans, edges, strict=True):
        key = entity_key(kind, text[a:b])
        for i in [*range(max(first - window, 0), first), *range(last, min(last + window, len(words)))]:
            if not inside[i]:
                start, end = words[i]
                found.append((key, text[start:end].lower()))
    return found


def _covered(words: list[tuple[int, int]], spans: list[Span]) -> tuple[bytearray, list[tuple[int, int]]]:
    """Which words are inside spans, and the words (first, behind the last) of each span."""
    inside = bytearray(len(words))
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    edges = []
    for _, a, b in spans:
        first, last = bisect_left(ends, a + 1), bisect_left(starts, b)
        inside[first:last] = b"\x01" * (last - first)
        edges.append((first, last))
    return inside, edges


def terms_of(text: str) -> list[str]:
    """The words of a text in lower case, each by itself as in a context."""
    if text.isascii():
        return _WORD.findall(text.lower())
    return [word.lower() for word in _WORD.findall(text)]


def term_spans(text: str, spans: list[Span], actions: dict[str, str]) -> list[Span]:
    """Every occurrence of the terms of ``actions`` outside the base spans, in order."""
    if not actions or actions.keys().isdisjoint(terms_of(text)):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    inside, _ = _covered(words, spans)
    found = []
    for (a, b), covered in zip(words, inside, strict=True):
        action = None if covered else actions.get(text[a:b].lower())
        if action:
            found.append((action, a, b))
    return found


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(window: int):
    """From (text hash with id, text): (entity, term, doc) for each word in a context."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py().decode("utf-8", "replace")
                own = base_spans(text)
                rows += [(*c, doc) for c in (contexts(text, own, window) if own else ())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                names=["entity", "term", "doc"],
            )

    return work


def _marker(actions: Broadcast, last: bool):
    """From (id, text hash, added spans, text): the occurrences of one block of terms added; the
    last block puts the base spans before them and leaves the text out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            spans = []
            for added, value in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = value.as_py().decode("utf-8", "replace")
                base = base_spans(text)
                more = [tuple(s.values()) for s in added] + term_spans(text, base, actions.value)
                own = [*(base if last else ()), *sorted(more)]
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
            columns = [batch.column(0), batch.column(1), pa.array(spans, _ARROW_SPAN), batch.column(3)]
            names = ["id", "hash", "spans", "text"]
            yield pa.RecordBatch.from_arrays(columns[: 4 - last], names=names[: 4 - last])

    return work


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): sums over what a task has read, handed on whenever there are many terms."""
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        rows = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(rows, names=["term", "n"])

    for batch in pieces(batches):
        for value in batch.column(0):
            counts.update(terms_of(value.as_py().decode("utf-8", "replace")))
        if len(counts) >= COUNTED:
            yield out()
    yield out()


def disclosing_terms(
    near: DataFrame,
    corpus: DataFrame,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    min_together: int = MIN_TOGETHER,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``entity``, ``term`` and ``action`` of the pairs above a threshold.

    ``near`` has a row (``entity``, ``term``, ``doc``) for each word in a context, ``corpus`` the
    counts (``term``, ``n``) of all words. Every count is a sum that combines before its shuffle;
    the corpus's counts are joined only for terms that could disclose something.
    """
    total = F.lit(corpus.agg(F.sum("n")).first()[0] or 0)
    size = near.groupBy("entity").agg(F.count("*").alias("c"))
    together = (
        near.groupBy("entity", "term", "doc").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count("*").alias("docs"))
        .where((F.col("together") >= min_together) & (F.col("docs") >= min_docs))
    )
    content = F.log(total / F.col("c"))
    shared = F.log(F.col("together") * total / (F.col("c") * F.col("n")))
    degree = F.when(content > 0, shared / content)
    return (
        together.join(size, "entity")
        .join(corpus, "term")
        .withColumn("degree", degree)
        .where(F.col("degree") >= generalise)
        .select(
            "entity", "term", "degree",
            F.when(F.col("degree") >= remove, "removed").otherwise("generalised").alias("action"),
        )
    )


def find_personal_data(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row for each row of ``docs``: its id, ``text_hash`` (xxhash64 of the text) and
    ``spans``, an array of (kind, start, end) in code points.

    The base kinds come first, each by start, then ``generalised`` and ``removed``: every
    occurrence, in all texts, of the terms that disclose an entity of the corpus, but for those
    inside an entity. A term that discloses several gets the strongest action. Whole texts are
    searched; a null or empty one has no spans. Repeated rows each get their spans, and count as
    documents of their own; rows without an id are searched too. An empty table gives an empty
    one.

    Three passes read the texts: contexts of entities, counts of all words, which are summed in
    each task first, and the occurrences of the disclosing terms. These are broadcast in blocks
    of ``TERM_BYTES``; behind each block but the last the frame is staged. Nothing but counts and
    contexts is shuffled; a frequent entity or word is a few rows of a task in both.
    """
    texts = docs.select(F.col(f"`{doc}`").alias("id"), text_bytes(F.col(f"`{text}`")).alias("text"))
    pairs = stage(
        texts.select(F.xxhash64("id", F.xxhash64("text")).alias("doc"), "text").mapInArrow(
            _scan(window), "entity string, term string, doc long"
        ),
        "personal-data",
    )
    corpus = stage(
        texts.select("text").mapInArrow(_word_counts, "term string, n long")
        .groupBy("term").agg(F.sum("n").alias("n")),
        "words",
    )
    actions = stage(
        disclosing_terms(pairs, corpus).groupBy("term")
        .agg(F.max("action").alias("action")),  # removed comes behind generalised
        "disclosing-terms",
    )
    size = actions.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, math.ceil(size / TERM_BYTES))
    found = texts.select(
        "id", F.xxhash64("text").alias("hash"), F.array().cast(T.ArrayType(SPAN)).alias("spans"), "text"
    )
    for block in range(blocks):
        own = actions.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == block).collect()
        last = block == blocks - 1
        work = _marker(docs.sparkSession.sparkContext.broadcast({r.term: r.action for r in own}), last)
        found = found.mapInArrow(work, T.StructType(found.schema.fields[: 4 - last]))
        if not last:
            found = stage(found, "marked")
    return found.select(F.col("id").alias(doc), F.col("hash").alias("text_hash"), "spans")


def sanitised(text: str, spans: list[Span]) -> str:
    """A text in which base spans and generalised terms give way to their kind, and removed
    terms to nothing. Of spans that overlap, the first one names both."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= done:
            out += [text[done:a], _instead(kind, text[a:b])]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _instead(kind: str, value: str) -> str:
    if kind == "removed":
        return ""
    if kind == "generalised":
        return "[NUMBER]" if value.isdigit() else "[NAME]" if value[:1].isupper() else "[WORD]"
    return f"[{kind.upper()}]"


def sanitise_texts(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, their texts without what ``find_personal_data`` finds;
    null texts stay null."""
    mark = "__pii_spans"
    found = find_personal_data(docs, doc, text).dropDuplicates([doc, "text_hash"]).select(
        F.col(doc).alias("__pii_id"), F.col("text_hash").alias("__pii_hash"), F.col("spans").alias(mark)
    )
    value = F.col(f"`{text}`")
    joined = docs.join(
        found,
        F.col(f"`{doc}`").eqNullSafe(F.col("__pii_id")) & (F.xxhash64(text_bytes(value)) == F.col("__pii_hash")),
        "left",
    ).drop("__pii_id", "__pii_hash")
    position = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, position):
            values = [
                own if own is None or not spans
                else sanitised(own, [(s["kind"], s["start"], s["end"]) for s in spans])
                for own, spans in zip(
                    batch.column(position).to_pylist(), batch.column(-1).to_pylist(), strict=True
                )
            ]
            columns = list(batch.columns[:-1])
            columns[position] = pa.array(values, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(work, docs.schema)
