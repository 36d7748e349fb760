"""Embedding whitening from a weighted covariance of distinct vectors.

Equal vectors are one row: each distinct vector is fitted once, with its number of rows or
one as weight, and whitened once; the rows join it back. An entry c stands for the integer
``floor(64 * c)``; a constant added to all of them would drop out of every result, so none
is. Vectors travel packed, in the fewest bytes that hold their integers, so equal vectors
are equal bytes and a vector of 64 entries near zero takes 65 bytes.

Steps: the sums of each dimension, exact; each task's weighted centred product
(one GEMM a batch) for the covariance; eigenvectors of that one matrix on the driver, which
is as large as the vectors are long, whatever the rows; the projections of each distinct
vector; their covariance once more, centred again, as the error against the identity.

Defined results: a row is left out if its vector is null, empty, or holds a null or an
entry that is not finite, or if it is not as long as most distinct vectors (of equally
frequent lengths the longest counts). ``floor(64 * entry)`` is held within plus and minus
2^52. A component without variance (its eigenvalue is zero to double precision) cannot be
whitened and has no rows, so neither has a table of fewer than two distinct vectors. Null
ids and repeated rows are returned each. ``deviation`` is null where it is over 2^63 - 1.
Columns other than ``vec_id, embedding`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import stored, table

SCALE = 64  # units in which entries are rounded down
COMPONENTS = 16
_MOST = 1 << 52
_HALF = 26  # bits of the lower part in exact sums


def _packed(vectors: pa.Array) -> list[tuple[np.ndarray, pa.Array]]:
    """For rows of one length and width each: their places and packed vectors."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.asarray(vectors.value_lengths().fill_null(0)).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (lengths > 0) & (bad[begin[1:]] == bad[begin[:-1]])
    out = []
    for length in np.unique(lengths[good]).tolist():
        rows = np.flatnonzero(good & (lengths == length))
        with np.errstate(over="ignore"):
            x = np.floor(SCALE * values[begin[rows][:, None] + np.arange(length)])
        x = np.clip(x, -_MOST, _MOST).astype(np.int64)
        size = np.abs(x).max(axis=1)
        width = np.select([size < 1 << 7, size < 1 << 15, size < 1 << 31], [1, 2, 4], 8)
        for w in np.unique(width).tolist():
            of = np.flatnonzero(width == w)
            packed = np.empty((len(of), 1 + length * w), np.uint8)
            packed[:, 0] = w
            packed[:, 1:] = x[of].astype(f"<i{w}").view(np.uint8)
            offsets = np.arange(len(of) + 1, dtype=np.int32) * packed.shape[1]
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed.tobytes())])
            out.append((rows[of], blobs))
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for low in range(0, len(b), 1 << 13):
            part = b.slice(low, 1 << 13)
            for rows, blobs in _packed(part.column(1)):
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), blobs], names=["vec_id", "packed"])


def _unpacked(packed: pa.Array) -> np.ndarray:
    """Integers, one row a vector; the vectors may differ in width, not length."""
    blobs = packed.to_pylist()
    widths = np.array([b[0] for b in blobs], np.int64)
    length = (len(blobs[0]) - 1) // blobs[0][0]
    x = np.empty((len(blobs), length), np.int64)
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        x[rows] = np.frombuffer(b"".join(blobs[r][1:] for r in rows.tolist()), f"<i{w}").reshape(len(rows), length)
    return x


_SUMS = "dim int, n long, high decimal(38,0), low decimal(38,0)"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight and weighted sums of each dimension, the sums in two exact parts."""
    n, high, low = 0, None, None
    for b in batches:
        if not len(b):
            continue
        x, w = _unpacked(b.column(0)), np.asarray(b.column(1))
        parts = x >> _HALF, x & ((1 << _HALF) - 1)
        if (w != 1).any():  # products with large weights need more than 64 bits
            parts = tuple(w.astype(object)[:, None] * p.astype(object) for p in parts)
        n += int(w.sum())
        high, low = (p.sum(axis=0).astype(object) + (0 if t is None else t) for p, t in zip(parts, (high, low), strict=True))
    if high is not None:
        kind = pa.decimal128(38, 0)
        columns = [pa.array(range(len(high)), pa.int32()), pa.array([n] * len(high), pa.int64())]
        columns += [pa.array([int(v) for v in part], kind) for part in (high, low)]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "high", "low"])


_CELLS = "i int, j int, value double"


def _cells(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "value"])


@dataclass(frozen=True)
class Centre:
    """Weight ``n`` and exact sums; the mean is ``whole + part / n`` in each dimension."""

    n: int
    sums: list[int]

    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def part(self) -> np.ndarray:
        return np.array([s % self.n / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` minus the mean; integers are subtracted first, which loses nothing."""
        return (x - self.whole()).astype(np.float64) - self.part()


def _products(batches: Iterator[pa.RecordBatch], centre: Centre) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        if len(b):
            d = centre.centred(_unpacked(b.column(0)))
            now = d.T @ (d * np.asarray(b.column(1)).astype(np.float64)[:, None])
            total = now if total is None else total + now
    yield from _cells(total)


def _white_products(batches: Iterator[pa.RecordBatch], mean: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        if len(b):
            d = np.asarray(b.column(0).flatten()).reshape(len(b), -1) - mean
            now = d.T @ (d * np.asarray(b.column(1)).astype(np.float64)[:, None])
            total = now if total is None else total + now
    yield from _cells(total)


def _matrix(cells: DataFrame, size: int) -> np.ndarray:
    """The symmetric matrix of summed upper cells; as large as the vectors are long, squared."""
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


def _deviations(x: np.ndarray, centre: Centre) -> list[int | None]:
    """Sums of squares of ``n * x - S``, exact: in 64-bit integers where no sum can leave them."""
    offset = x - centre.whole()
    rest = [s % centre.n for s in centre.sums]
    if (centre.n * (int(np.abs(offset).max(initial=0)) + 1)) ** 2 * x.shape[1] < 1 << 63:
        d = offset * np.int64(centre.n) - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = offset.astype(object) * centre.n - np.array(rest, object)
    return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


_WHITE = "packed binary, weight long, deviation long, whitened array<double>"


def _whiten(batches: Iterator[pa.RecordBatch], centre: Centre, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if len(b):
            x = _unpacked(b.column(0))
            y = centre.centred(x) @ axes
            offsets = pa.array(np.arange(len(b) + 1, dtype=np.int32) * axes.shape[1])
            columns = [b.column(0), b.column(1), pa.array(_deviations(x, centre), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["packed", "weight", "deviation", "whitened"])


def principal_axes(covariance: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding error, falling, and eigenvectors as columns, up to ``number``.

    The largest entry of an eigenvector is positive, so a sign does not depend on the run.
    """
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:number], vectors[:, ::-1][:, :number]
    real = values > max(values.max(initial=0.0), 0.0) * len(covariance) * np.finfo(float).eps * 4
    values, vectors = values[real], vectors[:, real]
    most = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[most, np.arange(len(values))])


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = COMPONENTS, by_count: bool = False) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of all rows.

    ``by_count`` weighs a distinct vector by its number of rows; without it each counts once.
    ``n`` is the sum of the weights.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.mapInArrow(_pack, "vec_id long, packed binary"), "white-rows")
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    length = F.floor((F.octet_length("packed") - 1) / F.conv(F.hex(F.substring("packed", 1, 1)), 16, 10).cast("int"))
    distinct = rows.groupBy("packed").agg(weight.alias("weight")).withColumn("length", length)
    distinct = stored(distinct, "white-distinct")
    usual = distinct.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    if usual is None:
        return spark.createDataFrame([], _RESULT)
    fit = distinct.where(F.col("length") == usual.length).select("packed", "weight")

    summed = fit.mapInArrow(_sums, _SUMS).groupBy("dim").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).orderBy("dim").collect()
    centre = Centre(summed[0].n, [(int(r.high) << _HALF) + int(r.low) for r in summed])
    covariance = _matrix(fit.mapInArrow(lambda b: _products(b, centre), _CELLS), len(summed)) / centre.n
    values, vectors = principal_axes(covariance, components)
    if not len(values):
        return spark.createDataFrame([], _RESULT)
    axes = vectors / np.sqrt(values)
    white = stored(fit.mapInArrow(lambda b: _whiten(b, centre, axes), _WHITE), "white-vectors")

    each = white.select("weight", F.posexplode("whitened").alias("dim", "value"))
    means = each.groupBy("dim").agg((F.sum(F.col("value") * F.col("weight")) / centre.n).alias("mean")).orderBy("dim").collect()
    mean = np.array([r["mean"] for r in means])
    again = white.select("whitened", "weight").mapInArrow(lambda b: _white_products(b, mean), _CELLS)
    error = float(np.abs(_matrix(again, len(values)) / centre.n - np.eye(len(values))).max())

    explained = F.array(*(F.lit(float(v)) for v in values / np.trace(covariance)))
    joined = rows.join(white.select("packed", "deviation", "whitened"), "packed")
    each = joined.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of all embeddings, each distinct vector fitted once."""
    return whitened(table(spark, sf_dir, "embeddings"))
