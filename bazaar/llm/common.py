"""What several operators share: staged tables, text columns and Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import platform
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of one Arrow batch are worked on in pieces of about this size, whatever a batch holds.
PIECE_BYTES = 8 << 20
# Bits of a table of hashes: 2 MB at most, whatever the corpus. In a fuller table more rows pass that
# are not listed; it decides costs, never results.
HASH_BITS = 24


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir``, set here where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        named = tempfile.mkdtemp(prefix="bazaar-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, not created yet."""
    return f"{shared_dir(spark)}/bazaar-llm/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is worked out once, and the loss
    of an executor costs nothing that was done before."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete the files of staged frames that nothing will read again."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _place(hash_: Column) -> Column:
    return hash_.bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def hash_bits(hashes: DataFrame) -> DataFrame:
    """A table with a bit for each place that a 64-bit hash of a frame of one column takes, in rows
    of 32,768 bits: a small frame of bounded size. Places are shuffled, not bitmaps of each task."""
    places = hashes.select(_place(F.col(f"`{hashes.columns[0]}`")).alias("place"))
    row = F.bitmap_bucket_number("place").alias("__hb_row")
    places = places.select(row, "place").repartition("__hb_row")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__hb_bits")
    return places.groupBy("__hb_row").agg(bits)


def split_by_bits(df: DataFrame, hash_: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose hash is surely not among those of ``hash_bits``, and all others.

    The table is broadcast, so no row moves. A join to the list of hashes itself, which grows with
    the input, then meets few rows besides the listed ones.
    """
    marked = df.withColumn("__hb_place", _place(hash_)).join(
        F.broadcast(bits), F.bitmap_bucket_number("__hb_place") == F.col("__hb_row"), "left"
    )
    at = "bitmap_bit_position(__hb_place)"
    byte = f"cast(conv(hex(substring(__hb_bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.coalesce(F.expr(f"({byte} & shiftleft(1, cast({at} % 8 as int))) <> 0"), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.where(~held).select(columns), marked.where(held).select(columns)


def worker_store(name: str) -> dict:
    """A dictionary that a Python worker keeps from task to task; its users bound its size."""
    module = sys.modules.setdefault("bazaar_llm_store", types.ModuleType("bazaar_llm_store"))
    return module.__dict__.setdefault(name, {})


def lean_memory() -> None:
    """Give back what a Python worker has freed, and map large blocks so that they go back when
    they are freed: workers outlive their tasks, several to an executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and platform.libc_ver()[0] == "glibc":
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.malloc_trim(0)


def text_bytes(column: str | Column = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("binary"), F.lit(b""))


def pieces(
    batches: Iterator[pa.RecordBatch], text: int = -1, size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts in column ``text`` take ``size`` bytes at most; a
    longer text is a piece of its own."""
    lean_memory()
    batch = None
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = byte_offsets(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    del batch
    lean_memory()


def byte_offsets(texts: pa.Array) -> np.ndarray:
    """Start of each text in the array's data, and the end of the last one."""
    large = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1 + texts.offset)
    return offsets[texts.offset :].astype(np.int64)


def byte_data(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts and the last ends."""
    offsets = byte_offsets(texts)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8, int(offsets[-1]))[int(offsets[0]) :]
    return data, offsets - offsets[0]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
