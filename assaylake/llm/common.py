"""What the corpus operators share: reading tables, storing intermediates, Arrow columns as arrays of bytes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_folder

#: Bytes of one Arrow batch that is handed to Python. Texts may be long, so rows alone do not bound a batch.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the bytes that one Arrow batch hands to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def release_memory() -> None:
    """Give freed memory back to the system: a worker is used again, for work that knows nothing of what this one held."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cut off from its lineage, safe against lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sort_merged(df: DataFrame) -> DataFrame:
    """``df`` for a join that no side of is broadcast, whatever size Spark guesses. It knows files by their compressed size, and not
    how many rows an explode or a function in Arrow makes of one; what it takes for small would go through the driver whole."""
    return df.hint("merge")


def text_parts(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column one after another, and the byte at which each ends. A null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at[1:] - at[0]


def as_bytes(texts: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8, null as empty."""
    data, ends = text_parts(texts)
    whole, start = data.tobytes(), 0
    for end in ends.tolist():
        yield whole[start:end]
        start = end


def crc_remainder(key, modulus: int):
    """crc32 of a key's decimal text, modulo ``modulus``; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))
