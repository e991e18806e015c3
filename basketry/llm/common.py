"""Shared helpers: scratch tables in the cluster's shared folder, Arrow
batches cut to a bounded size, and vectorised byte hashing."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..session import shared_dir

#: A task holds arrays for about this many text bytes at a time (one row at
#: least; a longer text is a block of its own).
BLOCK_BYTES = 2 << 20


#: Arrow batches between Spark and Python workers, by bytes: the default of
#: 10,000 rows says nothing about their size where texts are long.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def bounded(fn):
    """A query or stage (spark, ...) that runs with bounded Arrow batches,
    unless the application sets their size itself."""
    @functools.wraps(fn)
    def run(spark, *args):
        if not spark.sparkContext.getConf().contains(BATCH_KEY):
            spark.conf.set(BATCH_KEY, BATCH_BYTES)
        return fn(spark, *args)
    return run


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, and a lost executor takes nothing with it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark, paths: list[str]) -> None:
    """Delete folders of the shared folder that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with a number if ``df`` has a column of that name (in
    either case): what an operator calls the column that it adds last."""
    taken, k = {c.lower() for c in df.columns}, 2
    while (name if k == 2 else f"{name}_{k - 1}").lower() in taken:
        k += 1
    return name if k == 2 else f"{name}_{k - 1}"


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None and len(col) else \
        np.empty(0, np.uint8)
    return data, off - off[0] if len(col) else np.zeros(1, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.binary_length(col).fill_null(0)).astype(np.int64)
        cut = np.flatnonzero(np.diff((np.cumsum(size) - size) // limit)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * _MUL
    return x ^ (x >> np.uint64(32))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)


class RollingHash:
    """Hashes of byte ranges of one buffer in constant time each: prefix sums
    of scrambled byte values times powers of an odd base, modulo 2**64."""

    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, down = self._scale(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[:n], out=self.prefix[1:])
        self.down = down

    @classmethod
    def _scale(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers[0]) < n:
            size = max(n, 1 << 16)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            cls._powers = np.cumprod(up), np.cumprod(down)
        return cls._powers

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unsigned 64-bit hash of data[start:end] for arrays of ranges."""
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))
