"""Shared helpers: reading tables, scratch tables, Arrow batches, texts as bytes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.session import scratch_path

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, most: int = 2 * SLICE_BYTES) -> Iterator[None]:
    """Jobs inside hand Python at most about ``most`` bytes at a time (one row at least); the setting is put back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each (one row at least), so memory stays bounded."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after another, and the n + 1 offsets; NULL counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


# --- hashes of byte ranges: sum of m[byte] * B^(position in the range), modulo 2^64 ---------

BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i for i < n."""
    def row(b: int) -> np.ndarray:
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64, out=steps)

    return row(BASE), row(_BASE_INVERSE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers; only those of a full slice are kept, longer rows of them live as long as their text."""
    return _powers(2 * SLICE_BYTES) if n <= 2 * SLICE_BYTES else _powers.__wrapped__(n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class RangeHash:
    """Hash of any byte range of a buffer in constant time; equal bytes give equal hashes."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        self.up, down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.up[: len(data)], dtype=np.uint64, out=self.sums[1:])
        self.down = down

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(found + (end - start).astype(np.uint64) * np.uint64(BASE))


# --- words ---------------------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: digits, letters, and all bytes of characters beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; none crosses a row."""
    n = len(member)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], member[:-1]))[:n]
    starts = np.flatnonzero(member & (~before | first[:n]))
    after = np.concatenate((member[1:], [False]))[:n]
    ends = np.flatnonzero(member & (~after | first[1:])) + 1
    return starts, ends


class Words:
    """Lower-cased words of all rows of a column: byte ranges, hashes and row numbers."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        self.lower = LOWER[self.data]
        self.starts, self.ends = runs(IS_WORD[self.data], self.offsets)
        self.hashes = RangeHash(self.lower)(self.starts, self.ends)
        #: Number of the first word of each row, and one more.
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of ``size`` words; a row of fewer words has one, of all it has."""
        take = np.where(self.counts >= size, self.counts - size + 1, np.minimum(self.counts, 1))
        rows = np.repeat(np.arange(len(take)), take)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take) + self.first[rows]
        value = np.zeros(len(rows), np.uint64)
        last = self.first[rows + 1]
        for j in range(size):
            inside = at + j < last
            word = self.hashes[np.minimum(at + j, max(len(self.hashes) - 1, 0))] if len(rows) else value
            value = value * np.uint64(BASE) + np.where(inside, word, np.uint64(0x51ED270B))
        return rows, mix(value)


def int_lists(rows: list, kind: pa.DataType = pa.int64()) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def schema_of(df: DataFrame, *names: str) -> str:
    """DDL of columns as they are in a frame."""
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def unit_hash(*columns: str):
    """A number in (0, 1) that is a function of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
