"""Internal quality indices.

* ``silhouette_squared`` (E6): closed form from per-cluster statistics,
  O(n k d), two passes; equals Spark ML's ``ClusteringEvaluator``.
* ``silhouette_exact`` (E5): Euclidean, O(n^2) by nature.  Bounds from the
  cluster means skip the clusters that cannot be a point's nearest
  (:mod:`evoclust.operators.pruned`); in the plane the others' sums take n log n
  steps (:mod:`evoclust.operators.farfield`).  Where they leave half of the pairs or more, points are hashed
  into B balanced blocks of up to ``DEFAULT_BLOCK_ROWS`` rows; every unordered
  pair of blocks is one task that tiles its distances, multiplies them with
  one-hot labels and emits distance sums per point and cluster for both
  blocks, never the pairs.
* ``davies_bouldin`` (E7): centroids and scatter per cluster, then the cluster-pair
  ratios: all of them on the driver for few clusters, a search under ball
  bounds dealt over tasks for many.
* ``sse`` / ``cluster_scatter`` (A5, A10): statistics passes, no join, so a hot
  cluster never concentrates rows in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evoclust.operators import kernels as K
from evoclust.operators.kmeans import Stats, run_stats, run_sums
from evoclust.operators.pruned import DEFAULT_BLOCK_ROWS, need_counts, pruned_silhouettes

TILE = 1024


def labelled(df: DataFrame, cluster: str) -> DataFrame:
    return df.select("row_id", "x", F.array(F.col(cluster).cast("int")).alias("sol"))


def _shape(df: DataFrame, cluster: str) -> tuple[int, int]:
    """k (largest id + 1) and d, in one small job."""
    r = df.agg(F.min(cluster).alias("lo"), F.max(cluster).alias("hi"), F.first(F.size("x")).alias("d")).first()
    if r["lo"] is None or r["lo"] < 0:
        raise ValueError("cluster ids must be non-negative integers")
    return int(r["hi"]) + 1, int(r["d"])


def dense_clusters(df: DataFrame, cluster: str) -> DataFrame:
    """``df`` with the ids of ``cluster`` numbered 0..k-1 in order where they are sparse
    (hashes, keys), so that statistics of k clusters take k places."""
    ids = df.select(F.col(cluster).cast("long").alias("_id")).distinct()
    r = ids.agg(F.count("_id").alias("k"), F.max("_id").alias("hi"), F.min("_id").alias("lo")).first()
    if not r["k"] or r["lo"] < 0 or r["hi"] < 2 * r["k"] + 64:
        return df
    # one row per cluster, of which the driver holds k x d statistics later
    K.check_broadcast(np.zeros((0, 1)), limit=K.MAX_CLOSURE_BYTES - 16 * r["k"])
    numbered = df.sparkSession.createDataFrame(
        [(x["_id"], i) for i, x in enumerate(ids.where("_id is not null").orderBy("_id").collect())], "_id long, _dense int")
    return df.join(F.broadcast(numbered), F.col(cluster) == F.col("_id")).withColumn(cluster, F.col("_dense")).drop("_id", "_dense")


def label_stats(df: DataFrame, cluster: str = "cluster") -> tuple[Stats, int, int]:
    """One pass: per-cluster count, mean and squared distances to it; (stats, k, d)."""
    k, d = _shape(df, cluster)
    return run_stats(labelled(df, cluster), K.KernelSpec(1, k, d, sol_col="sol")), k, d


def sse(df: DataFrame, cluster: str = "cluster", centers=None) -> DataFrame:
    """A5: total squared distance to the assigned centre.

    Without centres the member means are used, whose squared distances one
    statistics pass gives; with centres (``(k, d)`` array) one pass sums the
    distances.  No join, so a cluster holding a third of the rows costs
    nothing extra.
    """
    spark = df.sparkSession
    if centers is None:
        st, _, _ = label_stats(dense_clusters(df, cluster), cluster)
        value = float(st.sse_to_means()[0])
    else:
        C = np.asarray(centers, dtype=np.float64)
        K.check_broadcast(C)
        spec = K.KernelSpec(1, C.shape[0], C.shape[1], own_centers=C[None], sol_col="sol")
        value = float(run_stats(labelled(df, cluster), spec).E.sum())
    return spark.createDataFrame([(value,)], "sse double")


def scatter_stats(df: DataFrame, cluster: str = "cluster") -> tuple[Stats, np.ndarray]:
    """A10 on the driver: stats and scatter ``(k,)`` (mean Euclidean distance of
    members to their centroid): two passes."""
    st, k, d = label_stats(df, cluster)
    spec = K.KernelSpec(1, k, d, own_centers=st.M, sol_col="sol", root_e=True)
    root = run_stats(labelled(df, cluster), spec)
    return st, root.E[0] / np.maximum(st.n[0], 1)


def cluster_scatter(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """A10: ``(c, n, center, scatter)`` for the non-empty clusters."""
    st, scatter = scatter_stats(df, cluster)
    rows = [(int(c), int(st.n[0, c]), [float(v) for v in st.M[0, c]], float(scatter[c]))
            for c in range(len(scatter)) if st.n[0, c] > 0]
    return df.sparkSession.createDataFrame(rows, "c int, n bigint, center array<double>, scatter double")


#: Clusters up to which the driver compares all pairs itself; rows of a block of clusters beyond it.
FEW_CLUSTERS, RATIO_BLOCK = 2048, 256


def davies_bouldin(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of max_j (S_i + S_j) / d(c_i, c_j)."""
    st, scatter = scatter_stats(dense_clusters(df, cluster), cluster)
    value = davies_bouldin_value(st.M[0], scatter, st.n[0], df.sparkSession)
    return df.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def worst_ratios(C: np.ndarray, S: np.ndarray, D: np.ndarray, T: np.ndarray) -> np.ndarray:
    """Per row of ``C`` the largest ``(S_i + T_j) / |C_i - D_j|``; coincident centroids give no ratio (0)."""
    gap = np.sqrt(np.maximum(K.centre_distances(C, D), 0.0))
    return np.where(gap > 0, (S[:, None] + T[None, :]) / np.where(gap > 0, gap, 1.0), 0.0).max(axis=1)


def near_blocks(C: np.ndarray, rows: int) -> np.ndarray:
    """The rows of ``C`` in an order whose runs of ``rows`` lie close together: halved at
    the median of the widest dimension, again and again."""
    todo, out = [np.arange(len(C))], []
    while todo:
        part = todo.pop()
        if len(part) <= rows:
            out.append(part)
            continue
        wide = int(np.ptp(C[part], axis=0).argmax())
        half = -(-len(part) // (2 * rows)) * rows  # whole blocks on the one side
        order = part[np.argpartition(C[part, wide], half - 1)]
        todo += [order[half:], order[:half]]
    return np.concatenate(out) if out else np.zeros(0, dtype=int)


def _ratio_fn(C: np.ndarray, S: np.ndarray, rows: int):
    """Rows (block) -> (block, s, computed): the sum of the worst ratios of a block of
    centroids and the block pairs computed for it.

    A block has a ball around its mean; the ratio of two blocks is at most their
    largest scatters over the gap between their balls.  Blocks are met from the
    largest such bound down, until it is below what every row has found.
    """
    cut = np.arange(0, len(C), rows)
    size = np.diff(np.r_[cut, len(C)])
    mid = np.add.reduceat(C, cut) / size[:, None]
    off = C - np.repeat(mid, size, axis=0)
    ball = np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", off, off), cut))
    top = np.maximum.reduceat(S, cut)

    def run(batches):
        for b in batches:
            ids, total, computed = b.column(0).to_pylist(), [], []
            for a in ids:
                mine = slice(cut[a], cut[a] + size[a])
                gap = np.sqrt(np.maximum(K.centre_distances(mid[a][None], mid)[0], 0.0)) - ball[a] - ball
                with np.errstate(divide="ignore"):
                    bound = np.where(gap > 0, (top[a] + top) / np.where(gap > 0, gap, 1.0), np.inf) * (1 + 1e-9)
                best, met = np.zeros(size[a]), 0
                for j in np.argsort(-bound, kind="stable"):
                    if bound[j] < best.min():
                        break
                    met += 1
                    other = slice(cut[j], cut[j] + size[j])
                    best = np.maximum(best, worst_ratios(C[mine], S[mine], C[other], S[other]))
                total.append(float(best.sum()))
                computed.append(met)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total, pa.float64()), pa.array(computed, pa.int64())],
                                             names=["block", "s", "computed"])

    return run


def pruned_ratios(spark, C: np.ndarray, S: np.ndarray, rows: int = RATIO_BLOCK) -> tuple[float, int, int]:
    """(sum of the worst ratios, block pairs computed, all block pairs), blocks dealt over tasks."""
    K.check_broadcast(C, S)
    order = near_blocks(C, rows)
    blocks = -(-len(C) // rows)
    tasks = max(1, min(blocks, 4 * spark.sparkContext.defaultParallelism))
    found = spark.range(0, blocks, 1, tasks).mapInArrow(_ratio_fn(C[order], S[order], rows), "block bigint, s double, computed bigint")
    r = found.agg(F.sum("s").alias("s"), F.sum("computed").alias("c")).first()
    return float(r["s"]), int(r["c"]), blocks * blocks


def davies_bouldin_value(cen: np.ndarray, scatter: np.ndarray, n: np.ndarray, spark=None) -> float:
    """E7 from centroids and scatters.  Up to ``FEW_CLUSTERS`` (or without a session) the
    driver, which holds them anyway, compares blocks of clusters with all; beyond,
    tasks search the pairs under bounds.  A single cluster gives 0."""
    used = np.nonzero(n > 0)[0]
    C, S = cen[used], scatter[used]
    if not len(used):
        return 0.0
    if spark is not None and len(used) > FEW_CLUSTERS:
        return pruned_ratios(spark, C, S)[0] / len(used)
    return float(np.mean(np.concatenate([worst_ratios(C[i:i + RATIO_BLOCK], S[i:i + RATIO_BLOCK], C, S)
                                         for i in range(0, len(C), RATIO_BLOCK)])))


def silhouette_squared(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance (closed form)."""
    df = dense_clusters(df, cluster)
    st, k, d = label_stats(df, cluster)
    if (st.n[0] > 0).sum() < 2:
        raise ValueError("silhouette needs at least 2 non-empty clusters")
    fn = K.silhouette_partial_fn(K.KernelSpec(1, k, d, sol_col="sol"), st.n, st.M, st.W)
    s, m = run_sums(labelled(df, cluster), fn)[0]
    return df.sparkSession.createDataFrame([(s / m,)], "silhouette_squared double")


# ---------------------------------------------------------------- exact (E5)


def _pair_sums_fn(P: int, k: int, d: int):
    """One unordered pair of blocks: rows (side, row_id, x, sol) of block ``lo`` (side 0)
    and block ``hi`` (side 1, none when they are the same block)."""

    def onehot(sol: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sol), P * k))
        for p in range(P):
            out[np.arange(len(sol)), p * k + sol[:, p]] = 1.0
        return out

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        side = t.column("side").to_numpy()
        batch = t.to_batches()[0]
        X, sol = K.matrix(batch, "x", d), K.matrix(batch, "sol", P, np.int64)
        H = onehot(sol)
        a, b = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
        S = np.zeros((len(X), P * k))
        one = t.column("bi")[0].as_py() == t.column("bj")[0].as_py()
        right = a if one else b
        for i in range(0, len(a), TILE):
            r = a[i:i + TILE]
            for j in range(i if one else 0, len(right), TILE):
                q = right[j:j + TILE]
                D = np.sqrt(np.maximum(K.centre_distances(X[r], X[q]), 0.0))
                S[r] += D @ H[q]
                if not one or j > i:
                    S[q] += D.T @ H[r]
        lists = [K.list_array(S, pa.float64())]
        return pa.table([t.column("row_id"), t.column("sol"), *lists], names=["row_id", "sol", "s"])

    return run


def exact_distance_sums(pts: DataFrame, P: int, k: int, d: int, n: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """J2 without materialising pairs: ``(row_id, sol, s)`` where ``s[p*k + c]`` is the
    sum of Euclidean distances from the point to the members of cluster c of slot p.

    B blocks give B(B+1)/2 tasks; each point is sent to the B pairs of its
    block and comes back with its sums, n x B rows either way.  A task holds
    two blocks with their sums: the block shrinks with the width of a row.
    """
    rows = max(256, min(block_rows, (64 << 20) // (8 * (d + 2 * P * k))))
    B = max(1, math.ceil(n / rows), min(pts.sparkSession.sparkContext.defaultParallelism, n // 512))
    base = pts.select("row_id", "x", "sol", F.pmod(F.xxhash64("row_id"), F.lit(B)).cast("int").alias("b"))
    pairs = base.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(B - 1)))).select(
        F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"),
        F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "row_id", "x", "sol")
    sums = pairs.groupBy("bi", "bj").applyInArrow(_pair_sums_fn(P, k, d), "row_id bigint, sol array<int>, s array<double>")
    # every copy of a point carries the same labels: max() just keeps them; the sums are added as vectors
    added = sums.groupBy("row_id").agg(
        F.max("sol").alias("sol"), Summarizer.metrics("sum").summary(array_to_vector("s")).alias("s"))
    return added.select("row_id", "sol", vector_to_array("s.sum").alias("s"))


def _exact_partial_fn(P: int, k: int, n: np.ndarray):
    def run(batches):
        tot = np.zeros(P)
        cnt = np.zeros(P, dtype=np.int64)
        for b in batches:
            if b.num_rows == 0:
                continue
            s = K.matrix(b, "s", P * k).reshape(b.num_rows, P, k)
            lab = K.matrix(b, "sol", P, np.int64)
            rows = np.arange(b.num_rows)
            for p in range(P):
                sp = s[:, p, :]
                n_own = n[p][lab[:, p]]
                a = np.where(n_own > 1, sp[rows, lab[:, p]] / np.maximum(n_own - 1, 1), 0.0)
                with np.errstate(invalid="ignore", divide="ignore"):
                    mean_other = np.where(n[p][None, :] > 0, sp / np.where(n[p] > 0, n[p], 1)[None, :], np.inf)
                mean_other[rows, lab[:, p]] = np.inf
                bb = mean_other.min(axis=1)
                den = np.maximum(a, bb)
                with np.errstate(invalid="ignore", divide="ignore"):
                    sil = np.where((n_own > 1) & np.isfinite(bb) & (den > 0), (bb - a) / den, 0.0)
                tot[p] += sil.sum()
                cnt[p] += b.num_rows
        yield K.sil_part(cnt, tot).batch()

    return run


def pair_shares(P: int, st: Stats, counts: np.ndarray) -> tuple[int, int]:
    """(pairs that the bounds leave, all pairs) of a point with a member of a cluster."""
    n = st.n.astype(object)
    return int((counts.astype(object) * n).sum()), int((n.sum(axis=1) ** 2).sum())


def exact_silhouettes(pts: DataFrame, P: int, k: int, d: int, st: Stats,
                      block_rows: int = DEFAULT_BLOCK_ROWS) -> dict[int, tuple[float, int]]:
    """``{slot: (sum, points)}`` of the exact silhouette.

    Where the bounds of :mod:`evoclust.operators.pruned` leave less than half of all
    pairs, only those are computed; else all unordered block pairs, each of
    which serves both sides.  The values are the same.
    """
    total = int(st.n[0].sum())
    if pts.select(F.col("row_id")).distinct().count() != total:
        raise ValueError("row_id must be unique: points that share one would be merged")
    counts = need_counts(pts, P, k, d, st)
    left, every = pair_shares(P, st, counts)
    if 2 * left < every:
        return pruned_silhouettes(pts, P, k, d, st, counts, block_rows)
    sums = exact_distance_sums(pts, P, k, d, total, block_rows)
    return run_sums(sums, _exact_partial_fn(P, k, st.n))


def silhouette_pairs(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(pairs, computed, skipped)``: all ordered pairs of points, those that the exact
    silhouette has to compute, and the share that its bounds skip."""
    df = dense_clusters(df, cluster)
    st, k, d = label_stats(df, cluster)
    left, every = pair_shares(1, st, need_counts(labelled(df, cluster), 1, k, d, st))
    return df.sparkSession.createDataFrame([(float(every), float(left), 1 - left / every if every else 0.0)],
                                           "pairs double, computed double, skipped double")


def silhouette_exact(df: DataFrame, cluster: str = "cluster", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """E5: exact mean silhouette with Euclidean distance over the whole table.

    Raises unless 2 <= number of distinct labels <= n - 1 (library rule), and
    when ``row_id`` repeats.
    """
    df = dense_clusters(df, cluster)
    st, k, d = label_stats(df, cluster)
    used = int((st.n[0] > 0).sum())
    if used < 2 or used > st.n.sum() - 1:
        raise ValueError(f"silhouette needs 2 <= distinct labels <= n-1, got {used}")
    s, m = exact_silhouettes(labelled(df, cluster), 1, k, d, st, block_rows)[0]
    return df.sparkSession.createDataFrame([(s / m,)], "silhouette_exact double")
