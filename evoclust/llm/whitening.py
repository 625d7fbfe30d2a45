"""Embedding whitening from exact integer cross-products by bit-sliced scatter.

Method: an entry c becomes the integer x = floor(scale * c) + offset.  Less the
smallest x of its dimension it is a small y >= 0, written as bit planes: plane b
of a dimension holds bit b of every row, packed 64 rows to a word.  The words of
two planes, ANDed, have as many bits set as rows hold both, so
``sum of 2^(a+b) * popcount(plane a of i & plane b of j)`` is the exact sum of
y_i * y_j.  On the driver the sums are centred as integers,
``n * sum(y_i y_j) - S_i S_j`` (the shift drops out), and only their quotient
by n^2, the covariance V, is a double that goes to ``eigh``.  A vector's
coordinate on component j is ``(x - S / n) . u_j / sqrt(e_j)``, with x - S / n
from the integer n * y - S_y.

Distribution: one aggregate finds each dimension's bounds and the number of
rows; one pass makes a row of sums for each task, and rows of that width meet
``FAN`` at a time, level by level, until one is left; its d (d + 1) / 2 numbers
(d: dimensions) and the d x d transform are all that the driver holds.  Sums
are two 64-bit limbs, so they are exact for some 2^40 rows.  A last narrow pass
whitens.

Defined cases: vectors that are null or hold null, NaN or infinite entries are
dropped, empty vectors too; a null key stays a row; repeated rows count each;
components whose eigenvalue is not above ``LEAST`` of the trace have no unit
variance and are left out (so a table of one distinct vector, or an empty one,
gives no rows); vectors of several lengths, or with entries beyond 2^30 /
scale, raise ValueError.  Columns besides key and vector are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Rows packed at a time, task rows that meet in one, the least share of the trace.
PACKED, FAN, LEAST = 8192, 64, 1e-12
LIMB = 32
_SUMS = "n long, s array<long>, lo array<long>, hi array<long>"


def finite(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, no null, NaN or infinite entry."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(
        c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry, as double; the offset is left out as it cancels."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("double"))


def _matrix(batch: pa.RecordBatch, low: np.ndarray) -> np.ndarray:
    """y of a batch: (rows, dimensions)."""
    return batch.column("z").flatten().to_numpy().reshape(batch.num_rows, len(low)).astype(np.int64) - low


def planes(y: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the bit planes of y (rows, dimensions), rows packed 64 to a word."""
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.arange(len(dim)) - np.repeat(np.cumsum(bits) - bits, bits)
    pad = -len(y) % 64
    words = np.empty((len(dim), (len(y) + pad) // 64), np.uint64)
    for p, (i, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        plane = np.pad((y[:, i] >> b & 1).astype(np.uint8), (0, pad))
        words[p] = np.packbits(plane).view(np.uint64)
    return words, dim, bit


def scatter(y: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums of y_i * y_j over the rows as limbs (lo, hi), dimensions squared; lo < 2^32."""
    words, dim, bit = planes(y, bits)
    d = len(bits)
    lo, hi = np.zeros((2, d, d), np.int64)
    for p in range(len(dim)):
        both = np.bitwise_count(words[p] & words[p:]).sum(1, dtype=np.int64)
        shift = bit[p] + bit[p:]
        i, j = dim[p], dim[p:]
        low = shift < LIMB
        # Planes of one dimension meet twice unless they are the same.
        both = np.where((j == i) & (np.arange(len(j)) > 0), 2 * both, both)
        np.add.at(lo[i], j[low], both[low] << shift[low])
        np.add.at(hi[i], j[~low], both[~low] << (shift[~low] - LIMB))
    return lo & 0xFFFFFFFF, hi + (lo >> LIMB)


def _carry(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return lo & 0xFFFFFFFF, hi + (lo >> LIMB)


def _row(n: int, s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    many = lambda x: pa.array([x], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), many(s), many(lo), many(hi)], names=["n", "s", "lo", "hi"])


def _sums(batches: Iterator[pa.RecordBatch], low: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row of sums for the task."""
    d, n, rest = len(bits), 0, []
    upper = np.triu_indices(d)
    s, (lo, hi) = np.zeros(d, np.int64), np.zeros((2, d, d), np.int64)

    def add(y: np.ndarray) -> None:
        nonlocal n, lo, hi
        for at in range(0, len(y), PACKED):
            some = y[at:at + PACKED]
            a, b = scatter(some, bits)
            lo, hi = _carry(lo + a, hi + b)
            s[:] += some.sum(0)
            n += len(some)

    for batch in batches:
        rest.append(_matrix(batch, low))
        if sum(map(len, rest)) >= PACKED:
            y = np.concatenate(rest)
            full = len(y) // PACKED * PACKED
            add(y[:full])
            rest = [y[full:]]
    if rest:
        add(np.concatenate(rest))
    if n:
        yield _row(n, s, lo[upper], hi[upper])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task summed to one."""
    total = None
    for batch in batches:
        for i in range(batch.num_rows):
            own = [batch.column(0)[i].as_py(), *(batch.column(k)[i].values.to_numpy() for k in (1, 2, 3))]
            total = own if total is None else [a + b for a, b in zip(total, own)]
            total[2], total[3] = _carry(total[2], total[3])
    if total is not None:
        yield _row(*total)


def tree_sums(parts: DataFrame, fan: int = FAN) -> DataFrame:
    """Rows of sums merged ``fan`` at a time, level by level, until one is left."""
    parts = stored(parts)
    rows = parts.count()
    while rows > 1:
        # A count and a range of the rows' partitions: nothing but the sums travels.
        parts = stored(parts.repartition(-(-rows // fan)).mapInArrow(_merge, _SUMS))
        rows = parts.count()
    return parts


class Whitening:
    """The exact sums of a table of vectors and the transform they give."""

    def __init__(self, n: int, low: np.ndarray, s: list[int], cross: list[int], components: int = COMPONENTS) -> None:
        d = len(low)
        self.n, self.low, self.s = n, low, s
        upper = np.triu_indices(d)
        exact = [n * c - s[i] * s[j] for c, i, j in zip(cross, upper[0].tolist(), upper[1].tolist())]
        self.covariance = np.zeros((d, d))
        self.covariance[upper] = [c / (n * n) for c in exact]  # of Python's integers: rounded once
        self.covariance += np.triu(self.covariance, 1).T
        e, u = np.linalg.eigh(self.covariance)
        keep = np.flatnonzero(e > LEAST * max(np.trace(self.covariance), 0.0))[::-1][:components]
        u = u[:, keep] * np.where(np.take_along_axis(u[:, keep], np.abs(u[:, keep]).argmax(0)[None], 0) < 0, -1.0, 1.0)
        self.eigenvalues, self.components, self.transform = e[keep], u, u / np.sqrt(e[keep])
        self.explained = e[keep] / np.trace(self.covariance) if len(keep) else e[keep]
        # The covariance of the whitened fit list is W' V W, as whitening is linear.
        gap = self.transform.T @ self.covariance @ self.transform - np.eye(len(keep))
        self.identity_error = float(np.abs(gap).max()) if len(keep) else 0.0

    def apply(self, y: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(sum over dimensions of (n x - S)^2, exact; whitened coordinates) of rows y."""
        s = np.array(self.s, object)
        small = self.n * int(np.abs(y).max(initial=1)) < 2 ** 62
        off = y * self.n - s.astype(np.int64) if small else y.astype(object) * self.n - s
        most = int(np.abs(off).max(initial=0))
        square = off if len(self.s) * most * most < 2 ** 63 else off.astype(object)
        return (square * square).sum(1).tolist(), (off / self.n).astype(np.float64) @ self.transform


def fit(vectors: DataFrame, vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of vectors; None if no vector takes part."""
    z = vectors.where(finite(F.col(vector_col))).select(integers(F.col(vector_col), scale).alias("z"))
    bounds = z.select(F.posexplode("z").alias("dim", "v")).groupBy("dim").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    if not bounds:
        return None
    if len({r["n"] for r in bounds}) > 1:
        raise ValueError("vectors of several lengths")
    if any(max(abs(r["low"]), abs(r["high"])) >= 2 ** 30 for r in bounds):
        raise ValueError(f"entries beyond {2 ** 30 // scale}")
    low = np.array([r["low"] for r in bounds]).astype(np.int64)
    bits = np.array([max(1, int(r["high"] - r["low"]).bit_length()) for r in bounds])
    few = tree_sums(z.mapInArrow(partial(_sums, low=low, bits=bits), _SUMS)).collect()
    n = sum(r["n"] for r in few)
    s = [sum(v) for v in zip(*(r["s"] for r in few))]
    cross = [sum(v) for v in zip(*([a + (b << LIMB) for a, b in zip(r["lo"], r["hi"])] for r in few))]
    return Whitening(n, low, s, cross, components)


def _whiten(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    k = len(model.explained)
    for whole in batches:
        for at in range(0, whole.num_rows if k else 0, 1024):
            batch = whole.slice(at, 1024)
            m = batch.num_rows
            deviation, white = model.apply(_matrix(batch, model.low))
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array(deviation, pa.decimal128(38)).take(pa.array(each)),
                pa.array(white.ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector that takes part."""
    kind = dict(vectors.dtypes)[id_col]
    schema = (f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    z = vectors.where(finite(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), integers(F.col(vector_col), scale).alias("z"))
    return z.mapInArrow(partial(_whiten, model=vectors.sparkSession.sparkContext.broadcast(model)), schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened coordinates of every vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitened(vectors, fit(vectors)).withColumn("deviation", F.col("deviation").cast("long"))
