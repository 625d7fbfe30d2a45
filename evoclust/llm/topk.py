"""Exact top-k search by columnar branch-and-bound.

Method: vectors lie in vertical layout (a row of the matrix is a dimension).
For each query, partial scores are accumulated one block of dimensions at a
time over the candidates that are still alive.  The mass left in the other
dimensions bounds what a candidate can gain or lose (Cauchy-Schwarz), the
k-th best lower bound is the mark to reach, and candidates whose upper bound
lies below it are compacted away.  Scores are whole-number inner products, so
the result is exact; ties go to the smaller id.

Distribution: candidates are dealt over ``parts`` parts by a hash, in the query
one for each ``PART_ROWS`` rows (or of less, down to ``LEAST_ROWS``, while there are
fewer parts than shuffle partitions), and each part gets a copy of the queries behind its
candidates.  A task holds its candidates and an Arrow batch of queries; nothing passes
through the driver and nothing is broadcast.  Each part yields k rows a query;
a partial top-k per salt and then the last one keep any task's share small.

Components are floor(scale * x), x as double.  Defined cases: a vector that is
null, or holds a null or a component that is not finite, and a row with a
null id take no part; shorter vectors count as padded with zeros; rows with
the query's id are no candidates of it; repeated ids are candidates each;
empty tables and queries without candidates give no rows; extra columns are
ignored.  Components beyond 2^53 in size are outside a double's whole numbers
and sums beyond a long wrap, as in Spark's own arithmetic without ANSI checks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, table

SCALE, K = 1024, 10
PART_ROWS, LEAST_ROWS, DIMENSIONS = 65_536, 4096, 8
#: Above this size of a component, rounding could spoil the bounds: nothing is pruned.
SAFE = 2.0 ** 24


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) as longs, for the rows that take part."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).where(~bad).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Dimensions x rows; short vectors are padded with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    width = int(size.max(initial=0))
    if (size == width).all():
        return np.ascontiguousarray(flat[offsets[0]:offsets[-1]].reshape(-1, width).T)
    out = np.zeros((width, len(size)), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], size), row] = flat[offsets[0]:offsets[-1]]
    return out


def _tall(m: np.ndarray, dims: int) -> np.ndarray:
    return m if len(m) == dims else np.vstack([m, np.zeros((dims - len(m), m.shape[1]), np.int64)])


class _Part:
    """The candidates of a part in vertical layout, with the mass behind each block of dimensions."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, step: int) -> None:
        self.ids, self.v, self.step = ids, vectors, step
        self.tails = self._tails(vectors)
        self.safe = not vectors.size or np.abs(vectors.astype(np.float64)).max() < SAFE

    def _tails(self, m: np.ndarray) -> np.ndarray:
        """Per block of dimensions, the length of what lies behind it, rounded up."""
        square = m.astype(np.float64) ** 2
        cuts = range(self.step, len(m) + self.step, self.step)
        return np.sqrt(np.array([square[c:].sum(0) for c in cuts])) * (1 + 1e-9)

    def best(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best for one query, ties included up to k by the smaller id."""
        dims = max(len(q), len(self.v))
        if dims != len(self.v):
            self.v = _tall(self.v, dims)
            self.tails = self._tails(self.v)
        q = np.r_[q, np.zeros(dims - len(q), np.int64)]
        alive = np.flatnonzero(self.ids != query)
        score = np.zeros(len(alive), np.int64)
        tail = self._tails(q[:, None])[:, 0] if dims else np.zeros(0)
        prune = self.safe and (not len(q) or np.abs(q.astype(np.float64)).max() < SAFE)
        for n, at in enumerate(range(0, dims, self.step)):
            block = self.v[at:at + self.step]
            block = block if len(alive) == block.shape[1] else block[:, alive]
            for d, x in enumerate(q[at:at + self.step].tolist()):
                score += x * block[d]
            if prune and len(alive) > k and at + self.step < dims:
                reach = np.ceil(self.tails[n][alive] * tail[n] + 1).astype(np.int64)
                mark = np.partition(score - reach, len(alive) - k)[len(alive) - k]
                stay = score + reach >= mark
                if not stay.all():
                    alive, score = alive[stay], score[stay]
        if len(alive) > k:
            mark = np.partition(score, len(score) - k)[len(score) - k]
            stay = score >= mark
            alive, score = alive[stay], score[stay]
        order = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[order]], score[order]


def _search(batches: Iterator[pa.RecordBatch], k: int, step: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, kind, id, v) sorted by part and kind: candidates first, then queries."""
    names = ("part", "kind", "id", "v")
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    now, part = None, None  # the part that is passing by; its candidates, once its queries come
    for arrow in batches:
        parts, kinds, every, column = (arrow.column(arrow.schema.get_field_index(n)) for n in names)
        parts, kinds, every = (c.to_numpy(zero_copy_only=False) for c in (parts, kinds, every))
        cuts = np.flatnonzero(np.r_[True, (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1]), True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if parts[a] != now:
                now, part, ids, vectors = parts[a], None, [], []
            m = _matrix(column.slice(a, b - a))
            if kinds[a] == 0:
                ids.append(every[a:b])
                vectors.append(m)
                continue
            if not ids:
                continue
            if part is None:
                dims = max(len(x) for x in vectors)
                part = _Part(np.concatenate(ids), np.concatenate([_tall(x, dims) for x in vectors], axis=1), step)
                ids, vectors = [part.ids], []
            found = [part.best(int(every[a + j]), m[:, j], k) for j in range(b - a)]
            size = [len(f[0]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(every[a:b], size)), pa.array(np.concatenate([f[0] for f in found])),
                 pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"])


def search(candidates: DataFrame, queries: DataFrame, k: int = K, parts: int = 1, step: int = DIMENSIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``candidates`` for each row of ``queries``; both (id, v)."""
    lanes = F.sequence(F.lit(0), F.lit(parts - 1))
    dealt = candidates.select(F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias("part"),
                              F.lit(0).alias("kind"), "id", "v")
    asked = queries.select(F.explode(lanes).alias("part"), F.lit(1).alias("kind"), "id", "v")
    found = (
        dealt.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "kind")
        .mapInArrow(partial(_search, k=k, step=step), "query_id long, vec_id long, score long")
    )
    return _top(_top(found.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16))), k, "query_id", "salt"), k, "query_id")


def _top(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order: list[Column] = [F.col("score").desc(), F.col("vec_id").asc()]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *[c for c in by if c == "salt"])


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: ten best of all rows for each row whose vec_id is divisible by 100."""
    rows = whole_numbers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    n = rows.count()
    parts = max(1, -(-n // PART_ROWS), min(shuffle_partitions(spark), -(-n // LEAST_ROWS)))
    found = search(rows, rows.where(F.col("id") % 100 == 0), K, parts=parts)
    return found.select("query_id", "rank", "vec_id", "score")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(range(1, len(v) + 1)) AS d, unnest(v) AS x FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
