"""Arrow batches cut into small slices, and words and shingles hashed without loops.

Words are runs of bytes other than space and the five ASCII controls 0x09-0x0D. A word's
hash is a polynomial over its bytes taken from prefix sums, so a slice of texts is hashed
with a fixed number of array operations. Hashes have 64 bits and are the same on every
machine.
"""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.session import scratch_path

SLICE_BYTES = 1 << 20  # text bytes that are worked on at once
BATCH_BYTES = 4 << 20  # of a batch that Spark hands to a Python worker
SETTLE = 0.5  # seconds until a step that ended is told to all its listeners

_RANDOM = np.random.default_rng(20240917)
_BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C17)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C17, -1, 2**64))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back.

    It is computed once, its lineage ends there, and a lost executor costs no
    recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done.

    It does so once the driver's collectors find a step's plan unused. A long operator that
    waits for that by itself holds the files of all its steps at once. When a step has just
    ended, its listeners still hold its plan, so a single collection would miss the files that
    count most.
    """
    gc.collect()
    collect = spark.sparkContext._jvm.System.gc
    collect()
    time.sleep(SETTLE)
    collect()


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python workers by a few MB, whatever the length of the texts.

    By default a batch has 10,000 rows. With texts that is tens of MB, which the executor's JVM
    holds beside its heap, several times for each running task, and the worker once more. What
    is worked on at once are slices of such a batch, so rows and results stay the same.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def freeing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, which gives the memory it freed back when its task ends.

    Workers wait for further tasks, several beside an executor's heap, and their allocators
    would keep the largest task's memory all the while.
    """

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return freed


def give_back() -> None:
    """Hand freed memory of Arrow and of the C library back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_bitmap(keys: DataFrame, column: str, most_bits: int = 1 << 28) -> tuple:
    """A broadcast bitmap of the hashes of ``keys``, and the place of a row's ``column`` in it.

    One bit per hash, about eight bits a key, at most ``most_bits`` (32 MB); the bitmap is
    built on the executors, gathered and broadcast. It marks every key and few other values;
    more keys than it can tell apart only make it mark more. It may thin out the input of a
    join, never its result.
    """
    bits = min(most_bits, max(1 << 15, 1 << int(8 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    blocks = (
        keys.select((place + 1).alias("place"))  # bitmap places count from one
        .groupBy(F.bitmap_bucket_number("place").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator(prefetchPartitions=True):
        begin = (row["block"] - 1) * 4096
        bitmap[begin : begin + 4096] = np.frombuffer(row["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap), place


def marked(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def in_bitmap(shared, place: Column) -> Column:
    @F.pandas_udf("boolean")
    def known(places: pd.Series) -> pd.Series:
        return pd.Series(marked(shared.value, places.to_numpy()))

    return known(place)


def key_filter(keys: DataFrame, column: str) -> Column:
    """A test on ``column`` that is true for every value in ``keys`` and for few others."""
    return in_bitmap(*key_bitmap(keys, column))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of ``column``.

    A text longer than the limit is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.asarray(_offsets(batch.column(column)), np.int64)
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def _offsets(array: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(array.buffers()[1], kind, len(array) + 1, array.offset * kind().nbytes)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and each text's start (one more at the end).

    A null is an empty text.
    """
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) else "")
    offsets = _offsets(array).astype(np.int64)
    data = array.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all their bits."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def _power(direction: str, count: int) -> np.ndarray:
    known = _powers[direction]
    if len(known) < count:
        step = _BASE if direction == "up" else _BASE_INVERSE
        known = np.full(max(count, SLICE_BYTES + 1), step)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if count <= 4 * SLICE_BYTES:  # those of a giant text are not kept
            _powers[direction] = known
    return known[:count]


@dataclass
class Words:
    """Words of a slice of texts: byte spans, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_CODE[self.data] * _power("up", len(self.data)), out=sums[1:])
        words = sums[self.ends] - sums[self.starts]
        words *= _power("down", len(self.data) + 1)[self.starts]
        return mix(words)


def words(array: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_bytes(array)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]  # a word ends where its text ends
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[1 + edges]
    closes[edges - 1] = inside[edges]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash every run of ``size`` words of one text.

    Returns the hashes in order and each text's first one (one more at the end).
    """
    lengths = np.diff(first)
    counts = np.maximum(lengths - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    rolled = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        rolled *= _STEP
        rolled += hashes[k : k + len(rolled)]
    inside = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], counts)
    return mix(rolled[inside]), bounds


def shingles(found: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes by text, with repeats; fewer than ``size`` words make one shingle."""
    hashes = found.hashes()
    full, full_bounds = windows(hashes, found.first, size)
    lengths = np.diff(found.first)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if not len(short):
        return full, full_bounds
    counts = np.diff(full_bounds)
    counts[short] = 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    values = np.empty(bounds[-1], np.uint64)
    single = np.zeros(bounds[-1], bool)
    single[bounds[short]] = True
    values[~single] = full
    whole = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        here = lengths[short] > k
        whole[here] = whole[here] * _STEP + hashes[found.first[short[here]] + k]
    values[single] = mix(whole + lengths[short].astype(np.uint64) * _BASE)
    return values, bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[fresh], minlength=len(bounds) - 1)
    return values[fresh], np.concatenate([[0], np.cumsum(counts)])


def binary_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of fixed-width values as one binary each."""
    width = values.dtype.itemsize
    ends = pa.py_buffer((bounds * width).astype(np.int32))
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, ends, data])
