"""Lloyd k-means as a driver loop of distributed passes.

Per iteration one job: the kernel assigns every point to its nearest centre
and sends a row (count, mean vector, squared distances to the mean, SSE) for
each cluster and task (map-side combine); a tree of exchanges of fan-in
``FAN_IN`` merges these ``tasks x k`` rows until few enough are left for the
driver.  The point table is persisted once; centres travel in the task closure
after a size check.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evoclust.functions.vector import sq_dist
from evoclust.operators import kernels as K
from evoclust.operators.sampling import centers_array, sample_centers


# copies of the centre table in a shuffle join on the cluster id
SALTS = 16


def dimension(points: DataFrame) -> int:
    """Vector length (read from one row)."""
    row = points.select(F.size("x").alias("d")).first()
    if row is None:
        raise ValueError("empty point table")
    return int(row["d"])


@dataclass
class Stats:
    """Per (chrom, c) statistics on the driver: P*k*(d+3) numbers."""

    n: np.ndarray  # (P, k) int
    M: np.ndarray  # (P, k, d) member means
    W: np.ndarray  # (P, k) sums of squared distances to the member mean
    E: np.ndarray  # (P, k) sums of squared distance to the reference centres

    @staticmethod
    def empty(P: int, k: int, d: int) -> "Stats":
        return Stats(np.zeros((P, k), dtype=np.int64), np.zeros((P, k, d)), np.zeros((P, k)), np.zeros((P, k)))

    def means(self, fallback: np.ndarray) -> np.ndarray:
        """A2: mean per cluster; an empty cluster keeps its previous centre (Q1)."""
        return np.where(self.n[:, :, None] > 0, self.M, fallback)

    def sse_to_means(self) -> np.ndarray:
        """A5: SSE of each chromosome against its own cluster means."""
        return self.W.sum(axis=1)

    def take(self, src) -> "Stats":
        src = np.asarray(src)
        return Stats(self.n[src], self.M[src], self.W[src], self.E[src])

    @staticmethod
    def join(parts: list["Stats"]) -> "Stats":
        return Stats(*(np.concatenate([getattr(s, f) for s in parts]) for f in ("n", "M", "W", "E")))


#: Bytes of partial rows that may reach the driver; above them the tree goes down to a row for each (chrom, c).
DRIVER_BYTES = 16 << 20
#: Bytes of partial rows a merging task reads.
MERGE_BYTES = 64 << 20


def merge_levels(tasks: int, rows: int, d: int) -> list[int]:
    """Numbers of rows a key has after each level of the tree, for ``rows`` rows a task.

    Levels of fan-in ``FAN_IN`` follow until ``FAN_IN`` rows a key are left and
    all of them are small enough for the driver, which merges the last ones.
    """
    out = []
    while tasks > 1 and (tasks > K.FAN_IN or tasks * rows * 8 * (d + 6) > DRIVER_BYTES):
        tasks = -(-tasks // K.FAN_IN)
        out.append(tasks)
    return out


def merge_parts(parts: DataFrame, tasks: int, rows: int, d: int) -> DataFrame:
    """Partial rows of ``K.PART_SCHEMA`` merged over tasks, level by level.

    A level is one exchange on (kind, chrom, c, group of ``FAN_IN`` tasks), so
    no task meets more than ``FAN_IN`` rows of a key and its rows fit ``MERGE_BYTES``.
    """
    for after in merge_levels(tasks, rows, d):
        wide = -(-after * rows * K.FAN_IN * 8 * (d + 6) // MERGE_BYTES)
        parts = parts.repartition(max(1, min(wide, after * rows)), "kind", "chrom", "c",
                                  F.floor(F.col("part") / K.FAN_IN)).mapInArrow(K.merge_parts_fn(d, K.FAN_IN), K.PART_SCHEMA)
    return parts


def run_parts(df: DataFrame, fn, P: int, k: int, d: int, tasks: int | None = None) -> tuple[Stats, dict[int, tuple[float, int]]]:
    """One pass: statistics and silhouette sums ``{slot: (sum, points)}``.

    ``df`` is a narrow plan over a scan or a cached table.  Each task sends P*k
    rows at most; the driver gets P*k rows, or as many from each of at most
    ``FAN_IN`` tasks while they are under ``DRIVER_BYTES``.  ``tasks``: the
    partitions of ``df``, where the caller knows them.
    """
    parts = merge_parts(df.mapInArrow(fn, K.PART_SCHEMA), tasks or df.rdd.getNumPartitions(), P * k + P, d)
    return read_parts(parts.toArrow(), P, k, d)


def read_parts(tbl, P: int, k: int, d: int) -> tuple[Stats, dict[int, tuple[float, int]]]:
    """The last merge, on the driver."""
    col = K.Parts.read(tbl, d).merged()
    st = Stats.empty(P, k, d)
    sel = col.kind == K.STATS
    p, c = col.chrom[sel], col.c[sel]
    st.n[p, c], st.M[p, c], st.W[p, c], st.E[p, c] = col.n[sel], col.mean[sel], col.w[sel], col.e[sel]
    return st, {int(a): (float(v), int(n)) for a, v, n in zip(col.chrom[~sel], col.w[~sel], col.n[~sel])}


def run_sums(df: DataFrame, fn) -> dict[int, tuple[float, int]]:
    """A pass that emits SIL rows only: ``{slot: (sum, points)}`` by Spark's own aggregate."""
    rows = df.mapInArrow(fn, K.PART_SCHEMA).groupBy("chrom").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect()
    return {r["chrom"]: (r["w"], r["n"]) for r in rows}


def _chunks(spec: K.KernelSpec, per_slot_bytes: int) -> list[tuple[int, int]]:
    """Slot ranges whose closure data stays under the broadcast bound."""
    if per_slot_bytes > K.MAX_CLOSURE_BYTES:
        K.check_broadcast(np.zeros(per_slot_bytes // 8 + 1))  # raises with the explanation
    step = max(1, K.MAX_CLOSURE_BYTES // max(per_slot_bytes, 1))
    return [(lo, min(lo + step, spec.P)) for lo in range(0, spec.P, step)]


def _slice_sol(points: DataFrame, spec: K.KernelSpec, lo: int, hi: int) -> tuple[DataFrame, K.KernelSpec]:
    if spec.sol_col is None or (lo == 0 and hi == spec.P):
        return points, spec.chunk(lo, hi)
    cols = [c for c in points.columns if c != spec.sol_col]
    sliced = points.select(*cols, F.slice(spec.sol_col, lo + 1, hi - lo).alias(spec.sol_col))
    return sliced, spec.chunk(lo, hi)


def run_stats(points: DataFrame, spec: K.KernelSpec) -> Stats:
    """One distributed pass: kernel partials, one merge, P*k*(d+1) rows collected.

    Centres travel in the task closure; when P*k*d exceeds the bound the
    slots are split over several passes, each under it.
    """
    per_slot = spec.k * spec.d * 8 * sum(a is not None for a in (spec.centers, spec.own_centers))
    parts = []
    for lo, hi in _chunks(spec, per_slot):
        pts, sub = _slice_sol(points, spec, lo, hi)
        parts.append(run_parts(pts, K.partial_stats_fn(sub), sub.P, sub.k, sub.d, spec.tasks)[0])
    return parts[0] if len(parts) == 1 else Stats.join(parts)


def run_silhouette(points: DataFrame, spec: K.KernelSpec, stats: Stats) -> np.ndarray:
    """E6 for every chromosome slot in one pass; -1 where fewer than 2 clusters are used (Q13)."""
    per_slot = spec.k * spec.d * 8 * (1 + (spec.centers is not None))
    fit = np.full(spec.P, -1.0)
    for lo, hi in _chunks(spec, per_slot):
        pts, sub = _slice_sol(points, spec, lo, hi)
        fn = K.silhouette_partial_fn(sub, stats.n[lo:hi], stats.M[lo:hi], stats.W[lo:hi])
        for p, (s, m) in run_sums(pts, fn).items():
            if m:
                fit[lo + p] = s / m
    used = (stats.n > 0).sum(axis=1)
    return np.where(used >= 2, fit, -1.0)


def relabel(points: DataFrame, centers: np.ndarray, keep: list[str], sol_col: str | None = "sol",
            reassign: np.ndarray | None = None) -> DataFrame:
    """``keep`` columns plus ``sol ARRAY<INT>[P]``: nearest-centre labels for the
    slots in ``reassign`` (all when None), held labels elsewhere.  Slots are
    split into chained narrow passes when the centres exceed the bound."""
    P, k, d = centers.shape
    chunks = _chunks(K.KernelSpec(P, k, d), k * d * 8)
    out = points
    for lo, hi in chunks:
        src_sol = sol_col if lo == 0 else "sol"
        held = keep if hi == P or "x" in keep else [*keep, "x"]  # a later chunk needs x
        cols = list(dict.fromkeys([*keep, "x"])) + ([src_sol] if src_sol and src_sol in out.columns and src_sol not in keep else [])
        fields = [points.schema[c] for c in held] + [T.StructField("sol", T.ArrayType(T.IntegerType()))]
        out = out.select(*cols).mapInArrow(
            K.relabel_fn(P, k, d, centers[lo:hi], lo, reassign, held, src_sol), T.StructType(fields)
        )
    return out


def block_nearest(points: DataFrame, C: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` + ``(_bc, _bd)``: nearest of centres too many to ship at once.

    The centres are cut into blocks under the broadcast bound; each block is
    one chained narrow pass that holds only its block and keeps the running
    best, so the labels equal a single pass over all centres.
    """
    k, d = C.shape
    per_block = max(1, K.MAX_CLOSURE_BYTES // (d * 8))
    fields = [points.schema[c] for c in keep] + [
        T.StructField("_bc", T.IntegerType()), T.StructField("_bd", T.DoubleType())]
    out = points.select(*keep)
    for lo in range(0, k, per_block):
        src = out if lo == 0 else out.select(*keep, "_bc", "_bd")
        out = src.mapInArrow(K.block_nearest_fn(C[lo:lo + per_block], lo, d, keep, lo == 0), T.StructType(fields))
    return out


def run_many_stats(labelled: DataFrame, spec: K.KernelSpec) -> Stats:
    """Statistics of one labelling by more clusters than a task can keep an array of.

    Tasks hold the clusters they meet, the tree merges rows of single clusters,
    and the driver, which holds the k centres anyway, reads the merged rows in
    blocks of clusters, each under the broadcast bound.
    """
    tasks = labelled.rdd.getNumPartitions()
    parts = labelled.mapInArrow(K.sparse_stats_fn(spec), K.PART_SCHEMA)
    while tasks > 1:
        # Rows of a key by groups of tasks; the number of keys sizes the exchange.
        tasks = -(-tasks // K.FAN_IN)
        wide = max(1, min(tasks * spec.k, -(-tasks * spec.k * 8 * (spec.d + 6) * 2 // MERGE_BYTES)))
        parts = parts.repartition(wide, "kind", "chrom", "c", F.floor(F.col("part") / K.FAN_IN)
                                  ).mapInArrow(K.merge_parts_fn(spec.d, K.FAN_IN), K.PART_SCHEMA)
    parts = parts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        st = Stats.empty(1, spec.k, spec.d)
        step = max(1, K.MAX_CLOSURE_BYTES // (8 * (spec.d + 6)))
        for lo in range(0, spec.k, step):
            one = read_parts(parts.where((F.col("c") >= lo) & (F.col("c") < lo + step)).toArrow(), 1, spec.k, spec.d)[0]
            for f in ("n", "M", "W", "E"):
                getattr(st, f)[:, lo:lo + step] = getattr(one, f)[:, lo:lo + step]
        return st
    finally:
        parts.unpersist()


def stats_by_centres(points: DataFrame, C: np.ndarray, tasks: int | None = None) -> Stats:
    """A1/A5 of the nearest-centre labels of one chromosome: one pass, or
    centre blocks plus one statistics pass when the centres exceed the bound."""
    k, d = C.shape
    if C.nbytes <= K.MAX_CLOSURE_BYTES:
        return run_stats(points, K.KernelSpec(1, k, d, centers=C[None], tasks=tasks))
    lab = block_nearest(points.select("row_id", "x"), C, ["row_id", "x"])
    framed = lab.select("row_id", "x", F.array("_bc").alias("sol"), "_bd")
    return run_many_stats(framed, K.KernelSpec(1, k, d, sol_col="sol", e_col="_bd"))


def assign(points: DataFrame, centers, keep: list[str] | None = None) -> DataFrame:
    """Nearest centre ``cluster`` (ties to the lowest id) and its ``d2``.

    ``centers`` is a ``(k, d)`` array or a ``(c, cx)`` DataFrame of k rows.
    """
    if isinstance(centers, DataFrame):
        rows = centers.select("c", "cx").orderBy("c").toArrow()
        centers = np.concatenate([x.flatten().to_numpy() for x in rows.column("cx").chunks]).reshape(rows.num_rows, -1)
    C = np.asarray(centers, dtype=np.float64)
    keep = keep or [c for c in points.columns if c not in ("cluster", "d2")]
    if C.nbytes > K.MAX_CLOSURE_BYTES:
        out = block_nearest(points, C, keep)
        return out.select(*keep, F.col("_bc").alias("cluster"), F.col("_bd").alias("d2"))
    schema = T.StructType(points.select(*keep).schema.fields + [T.StructField("cluster", T.IntegerType()), T.StructField("d2", T.DoubleType())])
    return points.mapInArrow(K.predict_fn(C, C.shape[1], keep), schema)


def own_center_distance(assigned: DataFrame, centers: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Squared distance of each point to its own centre, by an equi-join on the
    cluster id against the k-row centre table: broadcast when its size is under
    the bound; else a shuffle join on (cluster, salt), the salt taken from the
    row and the centres copied to each salt, so a cluster with many rows is spread."""
    k = centers.count()
    d = len(centers.select("cx").first()["cx"]) if k else 0
    cen = centers.select(F.col("c").alias(cluster), "cx")
    if k * d * 8 <= K.MAX_CLOSURE_BYTES:
        joined = assigned.join(F.broadcast(cen), cluster)
    else:
        salted = assigned.withColumn("_salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
        copies = cen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, [cluster, "_salt"]).drop("_salt")
    return joined.withColumn("d2", sq_dist("x", "cx")).drop("cx")


def array_means(df: DataFrame, key: str, x: str = "x") -> DataFrame:
    """``(key, n, center, sumsq)``: rows, mean vector and summed squared length of each group.

    The vectors are averaged by Spark ML's array aggregate, whose partial result
    is one vector a group and task: the plan does not grow with the dimension.
    """
    each = df.select(F.col(key).alias("key"), array_to_vector(x).alias("v"))
    found = each.groupBy("key").agg(Summarizer.metrics("count", "mean", "normL2").summary(F.col("v")).alias("s"))
    return found.select("key", F.col("s.count").alias("n"), vector_to_array("s.mean").alias("center"),
                        F.aggregate(vector_to_array("s.normL2"), F.lit(0.0), lambda s, v: s + v * v).alias("sumsq"))


def cluster_stats(df: DataFrame, cluster: str = "cluster", x: str = "x") -> DataFrame:
    """A1/A2/A12 with built-in aggregates: ``(c, n, center, sumsq)`` per cluster."""
    return array_means(df, cluster, x).withColumnRenamed("key", "c")


def center_shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Total squared movement of centres between two iterations (join on c)."""
    o = old.select("c", F.col("cx").alias("old"))
    n = new.select("c", F.col("cx").alias("new"))
    return o.join(n, "c").agg(F.sum(sq_dist("old", "new")).alias("shift"))


def _centers_df(spark: SparkSession, C: np.ndarray, it: int | None = None) -> DataFrame:
    rows = [(int(c), [float(v) for v in C[c]]) for c in range(C.shape[0])]
    df = spark.createDataFrame(rows, "c int, cx array<double>")
    return df if it is None else df.select(F.lit(it).alias("iter"), "c", "cx")


@dataclass
class KMeansModel:
    centers: np.ndarray  # (k, d) final centres
    initial_centers: np.ndarray
    sse_history: list[float]  # K3: SSE of iteration t against the centres before its update
    shift_history: list[float]  # A11
    center_history: list[np.ndarray] = field(default_factory=list)  # K5: 0 = initial .. T = final
    spark: SparkSession | None = None
    distances: list[int] = field(default_factory=list)  # computed in each iteration of a fit with bounds

    @property
    def k(self) -> int:
        return self.centers.shape[0]

    def transform(self, points: DataFrame) -> DataFrame:
        """K8/Q3: labels by the final centres."""
        return assign(points, self.centers)

    def centers_df(self) -> DataFrame:
        return _centers_df(self.spark, self.centers)

    def history(self) -> DataFrame:
        rows = [(i + 1, float(s), float(m)) for i, (s, m) in enumerate(zip(self.sse_history, self.shift_history))]
        return self.spark.createDataFrame(rows, "iter int, sse double, shift double")

    def center_history_df(self) -> DataFrame:
        rows = [
            (it, int(c), [float(v) for v in C[c]])
            for it, C in enumerate(self.center_history)
            for c in range(C.shape[0])
        ]
        return self.spark.createDataFrame(rows, "iter int, c int, cx array<double>")

    def sse(self, points: DataFrame) -> float:
        """Q2: SSE of labels redrawn with the final centres."""
        return float(stats_by_centres(points.select("row_id", "x"), self.centers).E.sum())


@dataclass
class KMeansLloyd:
    """K6/K7: ``KMeansLloyd(k=3, n_iter=10, seed=0, tol=None).fit(points)``.

    ``bounds=True`` carries triangle bounds from pass to pass
    (:mod:`evoclust.operators.bounded`): equal results, most of the n x k
    distances are skipped, for a table of 20 bytes a row written each pass.  It pays
    where k x d is large; centres above the broadcast bound take full passes.
    """

    k: int = 3
    n_iter: int = 10
    seed: int = 0
    tol: float | None = None
    init_centers: np.ndarray | None = None
    bounds: bool = False

    def fit(self, points: DataFrame) -> KMeansModel:
        spark = points.sparkSession
        held = points.is_cached  # the caller keeps the points: no second copy
        pts, carried = points.select("row_id", "x"), None
        if self.bounds:
            from evoclust.operators.bounded import BoundedLloyd

            carried = BoundedLloyd(pts)
            pts = carried.store.points
        elif not held:
            pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            d = dimension(pts)
            if self.init_centers is not None:
                C = np.asarray(self.init_centers, dtype=np.float64).copy()
            else:
                C = centers_array(sample_centers(pts, self.k, self.seed), 1, self.k, d)[0]
            init = C.copy()
            sse_hist, shift_hist, cen_hist, computed = [], [], [C.copy()], []
            tasks = pts.rdd.getNumPartitions()
            for _ in range(self.n_iter):
                if carried is not None and C.nbytes <= K.MAX_CLOSURE_BYTES:
                    st, count = carried.step(C)
                    computed.append(count)
                else:
                    st = stats_by_centres(pts, C, tasks)
                new = st.means(C[None])[0]
                moved = float(((new - C) ** 2).sum())
                sse_hist.append(float(st.E.sum()))
                shift_hist.append(moved)
                C = new
                cen_hist.append(C.copy())
                if self.tol is not None and moved <= self.tol:
                    break
            return KMeansModel(C, init, sse_hist, shift_hist, cen_hist, spark, computed)
        finally:
            if carried is not None:
                carried.close()
            elif not held:
                pts.unpersist()
