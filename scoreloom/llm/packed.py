"""Texts as flat byte arrays, for tasks that work on words or windows by the million.

The functions here run inside tasks, on one block of rows at a time (`blocks`), so their
memory is bounded by the block and its longest text. Nothing loops over words in Python.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_size(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text in the whole table; sizes shuffles, never changes a result."""
    return docs.agg(F.sum(F.octet_length(text)).cast("long")).first()[0] or 0


def parts(size: int, each: int, least: int = 12) -> int:
    """A number of partitions that grows with the data."""
    return max(least, -(-size // each))


def staged(frame: DataFrame, path: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back.

    The shuffles that made it are dropped once it is written, as nothing reads them again.
    """
    spark = frame.sparkSession
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def blocks(batches, text: str, limit: int):
    """(block id, rows) with at most `limit` bytes of text, or one longer text.

    The id is unique in the job and the same when a lost task runs again.
    """
    number = 0
    base = TaskContext.get().partitionId() << 32
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0)
        for rows in slices(batch, lengths.to_numpy(zero_copy_only=False).astype(np.int64), limit):
            yield base + number, rows
            number += 1
    pa.default_memory_pool().release_unused()  # workers stay alive and wait for other tasks


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column, and where each row starts (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, item = len(column), (np.int64 if wide else np.int32)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, item)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes other than space and tab to carriage return."""
    inside = ~_SPACE[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    rows = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[rows] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[rows[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C55


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _U(_BASE))
    down = np.full(n, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def value_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which `span_hash` takes the hash of any span of these 64-bit numbers."""
    n = 1 << max(16, int(len(values)).bit_length())
    up, down = _powers(n)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which `span_hash` takes the hash of any span of the bytes."""
    return value_sums(_VALUES[data])


def span_hash(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes wherever they stand."""
    total, down = sums
    raw = (total[ends] - total[starts]) * down[starts]
    return mix(raw + mix((ends - starts).astype(np.uint64)))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and the word ranges of the rows (one more at the end)."""
    data, offsets = text_bytes(column)
    starts, ends, row = word_bounds(data, offsets)
    hashes = span_hash(byte_sums(_LOWER[data]), starts, ends)
    return hashes, np.searchsorted(row, np.arange(len(offsets)))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i], ..., starts[i] + lengths[i] - 1, for all i in turn."""
    total = int(lengths.sum())
    shift = np.cumsum(lengths) - lengths
    return np.repeat(starts - shift, lengths) + np.arange(total)


def slices(batch: pa.RecordBatch, lengths: np.ndarray, limit: int):
    """The rows of a batch in parts whose lengths add up to at most `limit`, or one longer row."""
    ends, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def pack(values: np.ndarray, dtype=None) -> bytes:
    """Numbers as one compressed value, for arrays that only tasks of this package read.

    Bytes of equal weight stand together, as small numbers differ in their low bytes only.
    """
    values = np.ascontiguousarray(values, dtype)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(value: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as steps."""
    return pack(np.diff(keys, prepend=_U(0)))


def unpack_sorted(value: bytes) -> np.ndarray:
    return np.cumsum(unpack(value, np.uint64), dtype=np.uint64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key; ascending with the key."""
    return (((keys >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def bucket_ranges(keys: np.ndarray, buckets: int):
    """(bucket, slice) for the buckets that these ascending keys fall into."""
    own = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.diff(own, prepend=-1)) if len(own) else np.zeros(0, np.int64)
    for start, end in zip(cuts, np.append(cuts[1:], len(own))):
        yield int(own[start]), slice(int(start), int(end))
