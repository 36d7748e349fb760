"""Helpers the corpus operators share: stored intermediates, Arrow text, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.xxh64 import xxh64
from loadstar.sources.session import new_folder

#: A word is a run of bytes other than space and the five ASCII controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True

#: Any odd number with well spread bits serves as base of the prefix sums.
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written below the shared folder and read back, which cuts its lineage.

    A lost executor then costs a re-read of these files, not the work before them.
    The shuffles that led to the files are deleted as soon as they are written. ``by`` names
    a column of few values whose rows are kept apart.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as a long; null counts as no word."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def word_list(text: Column) -> Column:
    """The words in order; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets between them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def portions(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, one row at least."""
    for b in batches:
        for low, high in slices(strings(b.column(column))[1], size):
            yield b.slice(low, high - low)


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` units each, one row at least."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_GAP[data], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        factors = np.full(size, _BASE)
        factors[0] = 1
        _powers = np.multiply.accumulate(factors)
        factors = np.full(size, _INVERSE)
        factors[0] = 1
        _inverses = np.multiply.accumulate(factors)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the 64 over all others; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(tokens: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` gets the hash of any range."""
    out = np.empty(len(tokens) + 1, np.uint64)
    out[0] = 0
    np.cumsum(tokens * _grown(len(tokens))[0][: len(tokens)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Hashes of token ranges; equal ranges have equal hashes wherever they stand."""
    return mix((prefix[end] - prefix[start]) * _grown(len(prefix))[1][: len(prefix)][start])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of each word or line. The sums above take single bytes or whole words as tokens;
    over bytes, long texts of two values could be made to collide."""
    return xxh64(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
