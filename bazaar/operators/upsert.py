"""Insert-or-update with an explicit list of the columns an update may change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.schemas import ROW_ORDER
from bazaar.sources.storage import stage


def reduce_batch(
    batch: DataFrame, keys: Sequence[str], update: Sequence[str], order: str = ROW_ORDER
) -> DataFrame:
    """One row per key, as if the batch's rows were applied one by one.

    The update columns come from the key's last row, the others from its first. Both are plain
    aggregates, so rows of a hot key are combined before the shuffle; NULLs count as values.
    """
    rest = [c for c in batch.columns if c not in (*keys, *update, order)]
    picks = []
    if update:
        picks.append(F.max_by(F.struct(*update), F.col(order)).alias("_last"))
    if rest:
        picks.append(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    if not picks:
        return batch.select(*keys).distinct()
    parts = (["_last.*"] if update else []) + (["_first.*"] if rest else [])
    columns = [c for c in batch.columns if c != order]
    return batch.groupBy(*keys).agg(*picks).select(*keys, *parts).select(*columns)


def one_per_key(
    batch: DataFrame, keys: Sequence[str], update: Sequence[str], order: str = ROW_ORDER
) -> DataFrame:
    """``reduce_batch`` for large batches whose keys hardly ever repeat.

    A first pass over the keys alone finds the hashes that occur more than once; only rows under
    those are sorted and combined, all others go through untouched and unshuffled. A key whose
    hash it shares with another is combined too, by its real value, so the result is the same.
    """
    key_hash = F.xxhash64(*keys)
    repeated = stage(
        batch.groupBy(key_hash.alias("_hash"))
        .agg(F.count("*").alias("_rows"))
        .where("_rows > 1")
        .select("_hash"),
        "repeated",
    )
    hashed = batch.withColumn("_hash", key_hash)
    once = hashed.join(repeated, "_hash", "left_anti").drop("_hash", order)
    many = hashed.join(repeated, "_hash", "left_semi").drop("_hash")
    return once.unionByName(reduce_batch(many, keys, update, order))


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """The target after the batch, which holds one row per key.

    A new key is inserted with all its columns. For a key the target has, only the update
    columns change, also to NULL; with no update columns the target's row stays as it is.
    Whether a key is present is told by markers, never by values. Columns and types are the
    target's; keys must not be NULL.
    """
    old = target.select("*", F.lit(True).alias("_old"))
    new = batch.select(
        *[F.col(c).cast(target.schema[c].dataType).alias(f"_new_{c}") for c in target.columns],
        F.lit(True).alias("_new"),
    )
    same_key = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    columns = []
    for c in target.columns:
        if c in keys:
            value = F.coalesce(F.col(c), F.col(f"_new_{c}"))
        elif c in update:
            value = F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c))
        else:
            value = F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}"))
        columns.append(value.alias(c))
    return old.join(new, same_key, "full_outer").select(*columns)
