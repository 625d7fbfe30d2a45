"""Population operators of the genetic k-means.

A population of P label vectors is stored as ONE column ``sol ARRAY<INT>`` of
length P on each point row, so every chromosome is evaluated in the same pass
over the points.  Selection and family competition only permute slots: a
lazy ``select`` of ``array(sol[i], ...)``.  Children are slot expressions
``when(pos < cut, sol[a]).otherwise(sol[b])``.  Driver state per slot is
``k x d`` centres, ``k`` counts and a few scalars.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evoclust.functions.vector import uniform
from evoclust.operators import kernels as K
from evoclust.operators.internal import DEFAULT_BLOCK_ROWS, exact_silhouettes
from evoclust.operators.kmeans import Stats, relabel, run_silhouette, run_stats
from evoclust.operators.sampling import centers_array, sample_centers
from evoclust.operators.store import PointStore
from evoclust.session import cut_lineage


def base_cols(df: DataFrame) -> list[str]:
    """Columns a population frame carries besides ``sol`` (``label`` when present)."""
    return [c for c in ("row_id", "pos", "x", "label") if c in df.columns]


@dataclass
class Population:
    df: DataFrame  # row_id, pos, x, sol ARRAY<INT>[P]
    centers: np.ndarray  # (P, k, d)
    stats: Stats  # statistics of the labels held in sol
    fitness: np.ndarray  # (P,)
    n: int
    store: PointStore | None = None  # where the labels of df are written; None: df is cached or checkpointed whole

    @property
    def P(self) -> int:
        return self.centers.shape[0]

    @property
    def k(self) -> int:
        return self.centers.shape[1]

    @property
    def d(self) -> int:
        return self.centers.shape[2]

    def sse(self) -> np.ndarray:
        """SSE of each chromosome's labels against its centres."""
        return self.stats.E.sum(axis=1)

    def take(self, src) -> "Population":
        """A population whose slot p is a copy of slot src[p] (lazy)."""
        src = [int(s) for s in src]
        df = self.df.select(*base_cols(self.df), F.array(*[F.col("sol")[s] for s in src]).alias("sol"))
        return Population(df, self.centers[src].copy(), self.stats.take(src), self.fitness[src].copy(), self.n, self.store)


def slots(cols: list[Column]) -> Column:
    return F.array(*[c.cast("int") for c in cols])


def child_slot(a: int, b: int, cut: int, pos="pos") -> Column:
    """Genes of ``a`` before the cut, genes of ``b`` from it on (aligned by row)."""
    return F.when(F.col(pos) < F.lit(cut), F.col("sol")[a]).otherwise(F.col("sol")[b])


def rotated_genes(df: DataFrame, pairs: list[tuple[int, int]], cuts: list[int], n: int, out: str = "_rot") -> DataFrame:
    """Q7 parity: ``(row_id, out ARRAY<INT>)``, for each pair (a, b) and its cut the gene of
    the child ``a[cut:] + b[:cut]`` by position.

    The row at ``pos`` holds just one gene of the child, the one at ``pos - cut``
    (mod n): a position and a label travel for each pair, neither x nor the
    other slots, and partial aggregates gather the pairs.
    """
    sent = df.select("pos", F.explode(F.array(*[
        F.struct(F.pmod(F.col("pos") - F.lit(cut), F.lit(n)).alias("to"), F.lit(i).alias("i"),
                 F.when(F.col("pos") >= F.lit(cut), F.col("sol")[a]).otherwise(F.col("sol")[b]).alias("gene"))
        for i, ((a, b), cut) in enumerate(zip(pairs, cuts))])).alias("s")).select("s.*")
    if len(pairs) > 1:
        sent = sent.groupBy("to").agg(F.array(*[F.max(F.when(F.col("i") == i, F.col("gene"))) for i in range(len(pairs))]).alias(out))
    else:
        sent = sent.select("to", F.array("gene").alias(out))
    return df.select("row_id", F.col("pos").alias("to")).join(sent, "to").select("row_id", out)


def rotated_child(df: DataFrame, a: int, b: int, cut: int, n: int, out: str = "child") -> DataFrame:
    """One rotated child: the row at pos i takes the gene of pos ``(i + cut) mod n``."""
    return df.join(rotated_genes(df, [(a, b)], [cut], n), "row_id").withColumn(out, F.col("_rot")[0]).drop("_rot")


def fitness_of(df: DataFrame, stats: Stats, spec: K.KernelSpec, kind: str = "squared",
               block_rows: int = DEFAULT_BLOCK_ROWS) -> np.ndarray:
    """Mean silhouette of every slot; -1 for slots with fewer than 2 used clusters (Q13)."""
    if kind == "squared":
        return run_silhouette(df, spec, stats)
    if kind != "exact":
        raise ValueError(f"unknown fitness kind {kind!r}")
    if spec.sol_col is None:
        raise ValueError("exact fitness needs materialised labels")
    P, k = spec.P, spec.k
    sums = exact_silhouettes(df.select("row_id", "x", F.col(spec.sol_col).alias("sol")), P, k, spec.d, stats, block_rows)
    fit = np.full(P, -1.0)
    for p, (s, m) in sums.items():
        if m:
            fit[p] = s / m
    used = (stats.n > 0).sum(axis=1)
    return np.where(used >= 2, fit, -1.0)


def evaluate_slots(base: DataFrame, cols: list[Column], k: int, d: int,
                   own_centers: np.ndarray | None = None, kind: str = "squared",
                   block_rows: int = DEFAULT_BLOCK_ROWS) -> tuple[Stats, np.ndarray]:
    """Statistics and fitness of the label vectors ``cols`` (one stats pass + one fitness pass)."""
    df = base.select("row_id", "x", slots(cols).alias("sol"))
    spec = K.KernelSpec(len(cols), k, d, own_centers=own_centers, sol_col="sol")
    st = run_stats(df, spec)
    fit = fitness_of(df, st, spec, kind, block_rows)
    return st, fit


def init_population(points: DataFrame, P: int, k: int, seed: int = 0, kind: str = "squared",
                    block_rows: int = DEFAULT_BLOCK_ROWS, store: PointStore | None = None) -> Population:
    """P chromosomes, each k sampled centres (R1 with tag = chrom) and
    nearest-centre labels, all slots filled in one pass, written as the first
    version of ``store`` (else the labelled points are checkpointed whole)."""
    base = store.points if store else points.select(*base_cols(points))
    d = len(base.select("x").first()["x"])
    centres = centers_array(sample_centers(base, k, seed, list(range(P))), P, k, d)
    if store:
        df = store.commit(relabel(base, centres, ["row_id"], sol_col=None))
    else:
        df = cut_lineage(relabel(base, centres, base_cols(base), sol_col=None))
    lab_spec = K.KernelSpec(P, k, d, own_centers=centres, sol_col="sol")
    st = run_stats(df, lab_spec)
    n = int(st.n[0].sum())
    fit = fitness_of(df, st, lab_spec, kind, block_rows)
    return Population(df, centres, st, fit, n, store)


def from_labels(points: DataFrame, centers: np.ndarray, kind: str = "squared",
                block_rows: int = DEFAULT_BLOCK_ROWS) -> Population:
    """A population from given labels: ``points(row_id, pos, x, sol ARRAY<INT>)``
    and per-slot centres ``(P, k, d)``; statistics and fitness are computed."""
    C = np.asarray(centers, dtype=np.float64)
    P, k, d = C.shape
    df = points.select(*base_cols(points), F.col("sol").cast("array<int>").alias("sol"))
    spec = K.KernelSpec(P, k, d, own_centers=C, sol_col="sol")
    st = run_stats(df, spec)
    fit = fitness_of(df, st, spec, kind, block_rows)
    return Population(df, C, st, fit, int(st.n[0].sum()))


def cluster_sizes(pop: Population) -> DataFrame:
    """``(chrom, c, n)`` from the statistics held for the population."""
    spark = pop.df.sparkSession
    rows = [(p, c, int(pop.stats.n[p, c])) for p in range(pop.P) for c in range(pop.k) if pop.stats.n[p, c] > 0]
    return spark.createDataFrame(rows, "chrom int, c int, n bigint")


def alias_table(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prob, alias) of a draw in proportion to ``sizes`` (k whole numbers).

    A uniform u picks the cell ``i = floor(u * k)``; its label is i while the rest
    of ``u * k`` is below ``prob[i]``, else ``alias[i]``.  Cells below the average
    take the rest of their room from those above, both in order of their ids; a
    cell above the average that is used up takes its own rest from the next one.
    Room is counted in whole numbers, so the table is exact.
    """
    n = np.asarray(sizes).astype(object)
    k, total = len(n), int(n.sum())
    prob, alias = np.ones(k), np.arange(k)
    if not total:
        return prob, alias
    room = n * k - total  # of each cell against the average, times k
    small, large = [c for c in range(k) if room[c] < 0], [c for c in range(k) if room[c] > 0]
    lack = np.cumsum([0] + [-room[c] for c in small])
    spare = np.cumsum([0] + [room[c] for c in large])
    j = 0
    for i, c in enumerate(small):
        while spare[j + 1] <= lack[i]:
            j += 1
        prob[c], alias[c] = (n[c] * k) / total, large[j]
    i = 0
    for j, c in enumerate(large[:-1]):
        while lack[i] < spare[j + 1]:  # all lacks together equal all spares
            i += 1
        prob[c], alias[c] = 1 - (lack[i] - spare[j + 1]) / total, large[j + 1]
    return prob, alias


def mutate_fn(P: int, k: int, tables: list[tuple[np.ndarray, np.ndarray]], keep: list[str]):
    """``sol`` with a drawn label where ``hit``; two array reads a gene, whatever k."""

    def run(batches):
        for b in batches:
            sol = K.matrix(b, "sol", P, np.int32).copy()
            hit, u = K.matrix(b, "hit", P, np.bool_), K.matrix(b, "u", P)
            for p, (prob, alias) in enumerate(tables):
                at = u[:, p] * k
                cell = np.minimum(at.astype(np.int64), k - 1)
                drawn = np.where(at - cell < prob[cell], cell, alias[cell])
                sol[:, p] = np.where(hit[:, p], drawn, sol[:, p])
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, K.list_array(sol, pa.int32())], names=[*keep, "sol"])

    return run


def mutated(pop: Population, rate: float, seed: int, gen: int) -> DataFrame:
    """With probability ``rate`` per gene, redraw the label in proportion to the
    cluster sizes of the chromosome (the distribution before mutation)."""
    keep = ["row_id"] if pop.store else base_cols(pop.df)
    slots_ = range(pop.P)
    drawn = pop.df.select(*keep, "sol", F.array(*[uniform(seed, "mut", gen, p) < F.lit(rate) for p in slots_]).alias("hit"),
                          F.array(*[uniform(seed, "draw", gen, p) for p in slots_]).alias("u"))
    fields = [pop.df.schema[c] for c in keep] + [T.StructField("sol", T.ArrayType(T.IntegerType()))]
    tables = [alias_table(pop.stats.n[p]) for p in slots_]
    return drawn.mapInArrow(mutate_fn(pop.P, pop.k, tables, keep), T.StructType(fields))


def mutate(pop: Population, rate: float, seed: int, gen: int, kind: str = "squared",
           block_rows: int = DEFAULT_BLOCK_ROWS) -> Population:
    """Mutate every slot, then recompute centres and fitness from the new labels."""
    df = mutated(pop, rate, seed, gen)
    if pop.store:
        df = pop.store.commit(df)
    spec = K.KernelSpec(pop.P, pop.k, pop.d, sol_col="sol")
    st = run_stats(df, spec)
    st.E = st.W.copy()  # the centres are the means
    return Population(df, st.means(pop.centers), st, fitness_of(df, st, spec, kind, block_rows), pop.n, pop.store)


def hold(df: DataFrame, store: PointStore | None, reliable: bool = True) -> DataFrame:
    """A frame whose labels are computed once: the next version of ``store``; without
    one, a checkpoint of it all, or (not ``reliable``) a persisted copy."""
    if store:
        return store.commit(df.select("row_id", "sol"))
    if reliable:
        return cut_lineage(df)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    return cached


def kmo(pop: Population, accept: str = "better", kind: str = "squared",
        block_rows: int = DEFAULT_BLOCK_ROWS, checkpoint: bool = True) -> tuple[Population, np.ndarray]:
    """G9 (``accept="better"``) / G10 (``accept="always"``): one k-means step per slot.

    Pass 1 labels every point by the slot's centres and aggregates the
    candidate statistics; pass 2 scores the candidates; the driver keeps a
    candidate when its silhouette is higher (or always); centres become the
    means of the labels held (empty clusters keep their centre); the new
    ``sol`` is computed once and written (:func:`hold`).
    """
    P, k, d = pop.P, pop.k, pop.d
    cand_spec = K.KernelSpec(P, k, d, centers=pop.centers)
    if kind == "squared":
        cand = run_stats(pop.df, cand_spec)
        cand_fit = fitness_of(pop.df, cand, cand_spec, kind, block_rows)
    else:
        cand_df = relabel(pop.df, pop.centers, base_cols(pop.df))
        lab_spec = K.KernelSpec(P, k, d, sol_col="sol")
        cand = run_stats(cand_df, lab_spec)
        cand_fit = fitness_of(cand_df, cand, lab_spec, kind, block_rows)
    if accept == "better":
        take = cand_fit > pop.fitness
    elif accept == "always":
        take = np.ones(P, dtype=bool)
    else:
        raise ValueError(f"accept must be 'better' or 'always', got {accept!r}")
    held = Stats(
        np.where(take[:, None], cand.n, pop.stats.n),
        np.where(take[:, None, None], cand.M, pop.stats.M),
        np.where(take[:, None], cand.W, pop.stats.W),
        np.zeros((P, k)),
    )
    fitness = np.where(take, cand_fit, pop.fitness)
    centres = held.means(pop.centers)
    held.E = held.W.copy()  # the new centres are the means of the held labels
    df = hold(relabel(pop.df, pop.centers, ["row_id"] if pop.store else base_cols(pop.df), reassign=take),
              pop.store, checkpoint)
    return Population(df, centres, held, fitness, pop.n, pop.store), take


def rescale_fitness(fitness: np.ndarray, c: float = 2.0) -> np.ndarray:
    """``c * max_fitness - fitness`` (defined by the reference, never used by it)."""
    f = np.asarray(fitness, dtype=np.float64)
    return c * f.max() - f
