"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playmart.session import ensure_checkpoint_dir
from playmart.sources.tables import read_table

#: Fixed value: a word is a run of characters outside ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Shuffle files of an intermediate table are dropped as soon as the table is written.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of an Arrow batch that goes to a Python task, so that its memory does not grow with the rows of a file.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def bound_batches(spark: SparkSession) -> None:
    """Cut Arrow batches of this session by bytes as well (10,000 rows of long texts are 60 MB and more); plans that
    are run later read the setting too, so it stays. No row is split or left out."""
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table read back.

    The lineage is cut at a table that every executor sees, so a lost executor costs a
    re-read, and the shuffle files behind the table are released once it is written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


# ---- hashing of byte sequences inside tasks -------------------------------------------------

M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xBF58476D1CE4E5B9)
M3 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (returns a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= M2
    x ^= x >> np.uint64(27)
    x *= M3
    x ^= x >> np.uint64(31)
    return x


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of the ordered pair (a, b): equal pairs get equal names everywhere."""
    x = a * M1
    x += b
    x ^= x >> np.uint64(29)
    x *= M2
    x ^= x >> np.uint64(32)
    return x


def string_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (starting at 0) of an Arrow string/binary array; null reads as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]] if len(off) else data[:0], off - (off[0] if len(off) else 0)


def slices(batch, max_bytes: int = 4 << 20, column: str = "text"):
    """Cut an Arrow batch into runs of rows of about ``max_bytes`` of text (one long text may exceed it)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, s in enumerate(size):
        if total and total + s > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(s)
    if start < batch.num_rows:
        yield batch.slice(start)
