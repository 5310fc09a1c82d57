"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

After Wang and Manning, "Baselines and Bigrams" (2012): a feature's count is multiplied by the
logarithm of how much more often it stands in texts of the one class than of the other, and a
logistic regression is fitted on those products.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import byte_data, lean_memory, pieces, text_bytes

# Orders of the n-grams, in bytes of the lower-cased text, and cells that they are hashed to.
ORDERS = (3, 4, 5)
CELL_BITS = 18
# At most so many labelled texts are fitted on, and so many bytes of them.
TRAINING_ROWS = 6000
TRAINING_BYTES = 48 << 20
# A text's sums are divided by this power of its number of n-grams.
POWER = 0.75
# Log ratios nearer to zero than this count as zero.
LEAST_RATIO = 1.0
# A text counts as toxic from this score on.
THRESHOLD = 0.7
# Bytes of text that a task works on at once.
PIECE = 2 << 20
# Weights are whole multiples of this, so sums do not depend on how texts are batched.
STEP = 2.0**-20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def cells(data: np.ndarray, order: int) -> np.ndarray:
    """The cell of the n-gram at each byte, for all n-grams that end inside ``data``."""
    n = max(len(data) - order + 1, 0)
    code = np.full(n, order, np.uint64)
    for j in range(order):
        code = (code << np.uint64(8)) | data[j : j + n].astype(np.uint64)
    code ^= code >> np.uint64(29)
    return ((code * _MULTIPLIER) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def lower(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(b" " + data.tobytes().lower() + b" ", np.uint8)


def shares(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's features: its cells, and the number of its n-grams in each of them by POWER of
    their number in all: long texts with some toxic words and short ones with few come out alike."""
    data = lower(np.frombuffer(text, np.uint8))
    found = np.concatenate([cells(data, order) for order in ORDERS])
    cell, count = np.unique(found, return_counts=True)
    return cell, count / max(len(found), 1) ** POWER


@dataclass(frozen=True)
class Classifier:
    """Weight of each cell in steps, and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """From 0 to 1 for each text, by the weights of all of its n-grams."""
        data, offsets = byte_data(texts)
        out = np.empty(len(texts))
        for i in range(len(texts)):
            own = lower(data[offsets[i] : offsets[i + 1]])
            total = number = 0
            for order in ORDERS:
                found = cells(own, order)
                total += int(self.weights[found].sum())
                number += len(found)
            out[i] = self.intercept + (total / number**POWER * STEP if number else 0.0)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(texts: list[bytes], labels: list[int], rounds: int = 300, penalty: float = 1e-6) -> Classifier:
    """Log-count ratios, then logistic regression on the scaled features by Nesterov's method.

    Both classes weigh the same. Without texts of both classes there is nothing to tell apart:
    every score is the share of toxic texts then, 0 without any.
    """
    y = np.array(labels, float)
    size = 1 << CELL_BITS
    if not len(y) or y.min() == y.max():
        prior = float(y.mean()) if len(y) else 0.0
        return Classifier(np.zeros(size, np.int64), 40.0 if prior == 1 else -40.0)
    # In how many texts of either class a cell occurs, smoothed.
    counts = np.ones((2, size))
    for text, label in zip(texts, labels, strict=True):
        counts[label, shares(text)[0]] += 1
    ratio = np.log(counts[1] / (y.sum() + 1)) - np.log(counts[0] / ((1 - y).sum() + 1))
    # Cells that both classes have alike would be scaled to nothing: they are left out.
    ratio[np.abs(ratio) < LEAST_RATIO] = 0
    cell, x, ends = [], [], []
    for text in texts:
        own, share = shares(text)
        own, share = own[ratio[own] != 0], share[ratio[own] != 0]
        cell.append(np.append(own, 0).astype(np.int32))
        x.append(np.append(share * ratio[own], 0.0).astype(np.float32))
        ends.append(len(own) + 1)
    starts = np.cumsum(ends) - ends
    row = np.repeat(np.arange(len(y), dtype=np.int32), ends)
    cell, x = np.concatenate(cell), np.concatenate(x)
    # Steps are as long as the largest text vector allows.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    scale = np.float32(1 / np.sqrt(max(np.add.reduceat(x * x, starts).mean(), 1e-12)))
    x *= scale
    reach = (weight * np.add.reduceat(x * x, starts)).sum() / 4 + 0.25
    w, b = np.zeros(size), 0.0
    ahead_w, ahead_b, momentum = w, b, 1.0
    for _ in range(rounds):
        margin = np.add.reduceat(x * ahead_w[cell], starts) + ahead_b
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y)
        gradient = np.bincount(cell, x * error[row], size) + penalty * ahead_w
        new_w, new_b = ahead_w - gradient / reach, ahead_b - error.sum() / reach
        following = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead_w = new_w + (momentum - 1) / following * (new_w - w)
        ahead_b = new_b + (momentum - 1) / following * (new_b - b)
        w, b, momentum = new_w, new_b, following
    return Classifier(np.rint(w * ratio * scale / STEP).astype(np.int64), float(b))


def held_out(doc: str | Column) -> Column:
    """Rows kept from training: crc32 of the id as text has remainder 1 by 3; no id is not."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = TRAINING_ROWS,
    size: int = TRAINING_BYTES,
) -> Classifier:
    """Fit on a sample of the labelled texts that are not held out.

    The sample is the ``rows`` texts with the smallest hashes of their ids, as long as they take
    ``size`` bytes in all: the driver holds no more, however many texts have labels. Rows
    without an id, a label or with a label other than 0 and 1 teach nothing. An id with several
    labels counts by the largest one; repeated documents count each.
    """
    known = (
        labels.where(F.col(doc).isNotNull() & F.col(label).isin(0, 1) & ~held_out(doc))
        .groupBy(F.col(doc).alias("__tox_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("__tox_id"), "__tox_id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{doc}`").alias("__tox_id"), text_bytes(F.col(f"`{text}`")).alias("text"))
    order = F.xxhash64("__tox_id"), F.xxhash64("text")
    sample = texts.join(F.broadcast(known), "__tox_id").select(
        "label", "text", order[0].alias("a"), order[1].alias("b")
    )
    chosen, taken = [], 0
    bound = _byte_bound(sample, size)
    for row in sample.where(F.col("a") <= bound).orderBy("a", "b").limit(rows).toLocalIterator():
        taken += len(row.text)
        if taken > size and chosen:
            break
        chosen.append((bytes(row.text), row.label))
    fitted = fit([c[0] for c in chosen], [c[1] for c in chosen])
    del chosen
    lean_memory()  # the driver works on for as long as the session lasts
    return fitted


def _byte_bound(sample: DataFrame, size: int) -> int:
    """The largest hash up to which the sample's texts surely fit the size, from sums over 256
    ranges of the hash; the first range always counts."""
    ranges = (
        sample.select(F.shiftright("a", 56).alias("part"), F.length("text").alias("bytes"))
        .groupBy("part").agg(F.sum("bytes").alias("bytes")).orderBy("part").collect()
    )
    bound, total = -(2**63), 0
    for i, row in enumerate(ranges):
        total += row.bytes
        if i and total > size:
            break
        bound = ((row.part + 1) << 56) - 1
    return bound


def score_texts(
    docs: DataFrame,
    classifier: Classifier,
    text: str = "text",
    out: str = "score",
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` (or those in ``keep``), and in ``out`` how likely each
    text is toxic, from 0 to 1.

    Every whole text is scored, of any length; null and empty ones by the classifier's intercept
    and the spaces that stand for a text's ends. One pass, no shuffle; the classifier is a
    broadcast of fixed size. A column already named ``out`` is replaced. Equal texts have equal
    scores; an empty table gives an empty one.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    carried = list(dict.fromkeys([*keep, text]))
    given = docs.select(*(F.col(f"`{c}`") for c in carried))
    schema = T.StructType([*(given.schema[c] for c in keep), T.StructField(out, T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(classifier)
    position = carried.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, position, PIECE):
            scores = pa.array(model.value.scores(batch.column(position)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], scores], names=[*keep, out])

    return given.mapInArrow(work, schema)


def drop_toxic(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, with their columns."""
    mark = "__tox_score"
    return score_texts(docs, classifier, text, mark).where(F.col(mark) < THRESHOLD).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
