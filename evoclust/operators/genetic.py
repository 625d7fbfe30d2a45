"""Genetic k-means (G5-G15, R3-R7, F6, F9): the generation loop.

Per generation: selection (driver decision, lazy slot permutation),
crossover (one statistics pass for all pairs, as moments per segment of the
cuts; the children's fitness in one pass, ``pairing="disjoint"``, or pair by
pair, ``pairing="ring"``, where a later pair may hold earlier children),
optional mutation, one k-means step per slot, and one version of the labels
written (:mod:`evoclust.operators.store`; the points are never copied).  All random choices are seeded hashes (R0), so a
run is reproducible whatever the partitioning and after task retries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import floor

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evoclust.functions.vector import uniform_scalar
from evoclust.operators import kernels as K
from evoclust.operators.external import ari_expr, pair_counts
from evoclust.operators.fused import candidates_fn, children_and_candidates_fn
from evoclust.operators.internal import DEFAULT_BLOCK_ROWS
from evoclust.operators.kmeans import Stats, assign, relabel, run_parts, run_stats, run_sums
from evoclust.operators.population import (
    Population,
    base_cols,
    child_slot,
    fitness_of,
    hold,
    init_population,
    kmo,
    mutate,
    rotated_genes,
)
from evoclust.operators.sampling import centers_array, sample_centers
from evoclust.operators.segments import Segments, SegmentStats, segment_stats
from evoclust.operators.store import PointStore
from evoclust.sources.points import with_pos


def rank_order(fitness) -> list[int]:
    """Slots by fitness, descending; ties keep slot order (stable)."""
    return sorted(range(len(fitness)), key=lambda i: -float(fitness[i]))


def select_survivors(fitness, survival: float, seed: int, gen: int, elite: int = 5) -> list[int]:
    """Keep the best ``int(P*survival)``, refill with random members
    of the top ``min(elite, P)``, return the new slot order sorted by fitness."""
    P = len(fitness)
    order = rank_order(fitness)
    keep = int(P * survival)
    src = order[:keep]
    top = order[: min(elite, P)]
    while len(src) < P:
        u = uniform_scalar(seed, "fill", gen, len(src))
        src.append(top[min(int(floor(u * len(top))), len(top) - 1)])
    return sorted(src, key=lambda i: -float(fitness[i]))


def crossover_ranks(P: int, rate: float, seed: int, gen: int) -> list[int]:
    """``int(rate*P)`` distinct ranks from 0..P-2 in draw order (the last rank is never drawn, Q8)."""
    m = int(rate * P)
    if m > P - 1:
        raise ValueError(f"crossover rate {rate} needs {m} parents, more than P-1 = {P - 1} (Q9)")
    cands = list(range(P - 1))
    return sorted(cands, key=lambda r: (uniform_scalar(seed, "rank", gen, r), r))[:m]


def cut_point(n: int, seed: int, gen: int, i: int) -> int:
    """Cut in 1..n-2."""
    if n < 3:
        raise ValueError("crossover needs at least 3 points")
    u = uniform_scalar(seed, "cut", gen, i)
    return 1 + min(int(floor(u * (n - 2))), n - 3)


def family_competition(fits: list[float]) -> list[int]:
    """Indexes of the best two of (parent a, parent b, child 1, child 2); ties keep that order."""
    return sorted(range(4), key=lambda i: -float(fits[i]))[:2]


@dataclass
class GeneticKMeansModel:
    population: Population
    best: int
    fitness_history: list[float]
    sse_history: list[float]
    ari_history: list[float | None]
    center_history: list[np.ndarray]
    log: list[tuple]  # (gen, stage, chrom, fitness)

    @property
    def centers(self) -> np.ndarray:
        return self.population.centers[self.best]

    @property
    def fitness(self) -> float:
        return float(self.population.fitness[self.best])

    @property
    def sse(self) -> float:
        return float(self.population.sse()[self.best])

    def labels(self) -> DataFrame:
        """The labels held by the best chromosome."""
        return self.population.df.select("row_id", F.col("sol")[self.best].alias("cluster"))

    def release(self) -> None:
        """Delete the stored points and labels; :meth:`labels` can't be read any more."""
        if self.population.store:
            self.population.store.close()

    def transform(self, points: DataFrame) -> DataFrame:
        """Nearest best centre for new points."""
        return assign(points, self.centers)

    def history(self) -> DataFrame:
        spark = self.population.df.sparkSession
        rows = [
            (g + 1, float(f), float(s), None if a is None else float(a))
            for g, (f, s, a) in enumerate(zip(self.fitness_history, self.sse_history, self.ari_history))
        ]
        return spark.createDataFrame(rows, "gen int, fitness double, sse double, ari double")

    def population_log(self) -> DataFrame:
        """Fitness of every slot at every stage."""
        spark = self.population.df.sparkSession
        return spark.createDataFrame(self.log, "gen int, stage string, chrom int, fitness double")


@dataclass
class GeneticKMeans:
    """``GeneticKMeans(population=10, k=3, generations=10, survival=0.8, crossover=0.8)``.

    Parity switches with the reference: ``pairing="ring"`` (sequential pairs),
    ``second_child="rotate"`` (Q7), ``child_centers="random"`` (Q6),
    ``kmo="always"`` (G10).  ``fitness="exact"`` uses the O(n^2) Euclidean
    silhouette (E5); the default is its closed-form squared variant (E6).

    One chromosome's k x d centres must fit the bound of
    :func:`evoclust.operators.kernels.check_broadcast`; all P together need not.
    """

    population: int = 10
    k: int = 3
    generations: int = 10
    survival: float = 0.8
    crossover: float = 0.8
    mutation_rate: float = 0.0
    seed: int = 0
    fitness: str = "squared"
    kmo: str = "better"
    pairing: str = "disjoint"
    second_child: str = "aligned"
    child_centers: str = "means"
    elite: int = 5
    block_rows: int = DEFAULT_BLOCK_ROWS
    track_ari: bool = True
    fuse: bool = True  # 2 passes and the relabel per generation instead of 5 (when the options allow)
    _log: list = field(default_factory=list, repr=False)

    def _check(self):
        if self.population < 2:
            raise ValueError("population must be at least 2")
        if self.k < 2:
            raise ValueError("k must be at least 2")
        if not 0.0 <= self.survival <= 1.0 or not 0.0 <= self.crossover <= 1.0:
            raise ValueError("survival and crossover are rates in [0, 1]")
        if int(self.crossover * self.population) > self.population - 1:
            raise ValueError("int(crossover * population) must not exceed population - 1 (Q9)")
        for name, val, ok in (
            ("fitness", self.fitness, ("squared", "exact")),
            ("kmo", self.kmo, ("better", "always")),
            ("pairing", self.pairing, ("disjoint", "ring")),
            ("second_child", self.second_child, ("aligned", "rotate")),
            ("child_centers", self.child_centers, ("means", "random")),
        ):
            if val not in ok:
                raise ValueError(f"{name} must be one of {ok}, got {val!r}")

    # ------------------------------------------------------------ crossover

    def _pairs(self, ranks: list[int]) -> list[tuple[int, int]]:
        m = len(ranks)
        if self.pairing == "ring":
            return [(ranks[i], ranks[(i + 1) % m]) for i in range(m)]
        return [(ranks[i], ranks[i + 1]) for i in range(0, m - 1, 2)]

    def _child_centres(self, pop: Population, stats, pairs, gen: int, step: int) -> np.ndarray:
        """Means of the children's labels; an empty cluster takes the first parent's centre."""
        if self.child_centers == "means":
            return stats.means(np.repeat(pop.centers[[a for a, _ in pairs]], 2, axis=0))
        P2 = stats.n.shape[0]
        cen = sample_centers(pop.df, self.k, self.seed, list(range(P2)), tag=f"child{gen}.{step}")
        return centers_array(cen, P2, self.k, pop.d)

    @staticmethod
    def _compete(P: int, pairs, fits) -> list[int]:
        """Family competition: the source of each slot, children numbered from P on."""
        src = list(range(P))
        for i, (a, b) in enumerate(pairs):
            cand = [a, b, P + 2 * i, P + 2 * i + 1]
            win = family_competition([fits[c] for c in cand])
            src[a], src[b] = cand[win[0]], cand[win[1]]
        return src

    def _aligned(self, pop: Population, pairs, cuts, gen: int) -> Population:
        """All pairs of a generation from one statistics pass: a child, also of children,
        is a genome over the segments of the cuts."""
        seg = Segments(cuts)
        moments, _ = segment_stats(pop.df, seg, pop.P, pop.k, pop.d)
        genomes, centres, fits = seg.own(pop.P), pop.centers.copy(), np.array(pop.fitness)
        stats = pop.stats
        steps = [[i] for i in range(len(pairs))] if self.pairing == "ring" else [list(range(len(pairs)))]
        for step, some in enumerate(steps):
            mine = [pairs[i] for i in some]
            made = [g for i in some for g in (seg.child(genomes[pairs[i][0]], genomes[pairs[i][1]], cuts[i]),
                                              seg.child(genomes[pairs[i][1]], genomes[pairs[i][0]], cuts[i]))]
            st = moments.merged(made)
            children = pop.df.select("row_id", "x", F.array(*[seg.genes(g).cast("int") for g in made]).alias("sol"))
            fit = fitness_of(children, st, K.KernelSpec(len(made), pop.k, pop.d, sol_col="sol"), self.fitness, self.block_rows)
            now = Population(pop.df, centres, stats, fits, pop.n, pop.store)
            own = self._child_centres(now, st, mine, gen, step)
            every = np.concatenate([fits, fit])
            src = self._compete(pop.P, mine, every)
            genomes = [(genomes + made)[s] for s in src]
            centres, fits, stats = np.concatenate([centres, own])[src], every[src], Stats.join([stats, st]).take(src)
        df = pop.df.select(*base_cols(pop.df), F.array(*[seg.genes(g).cast("int") for g in genomes]).alias("sol"))
        return Population(df, centres, stats, fits, pop.n, pop.store)

    def _rotated(self, pop: Population, pairs, cuts, gen: int, step: int) -> Population:
        """Q7 parity: the second child is rotated, so its genes cross the segments and it needs its own pass."""
        cols = []
        for i, ((a, b), cut) in enumerate(zip(pairs, cuts)):
            cols += [child_slot(a, b, cut), F.col("_rot")[i]]
        genes = rotated_genes(pop.df, pairs, cuts, pop.n).persist(StorageLevel.MEMORY_AND_DISK)
        frame = pop.df.join(genes, "row_id")
        try:
            children = frame.select("row_id", "x", F.array(*cols).alias("sol"))
            st, fit = evaluate_slots_frame(children, 2 * len(pairs), self.k, pop.d, self.fitness, self.block_rows)
            centres = self._child_centres(pop, st, pairs, gen, step)
            fits = np.concatenate([pop.fitness, fit])
            src = self._compete(pop.P, pairs, fits)
            every = [F.col("sol")[p] for p in range(pop.P)] + cols
            df = frame.select(*base_cols(pop.df), F.array(*[every[c] for c in src]).alias("sol"))
            df = hold(df, pop.store)  # a step adds a join: its plan must not nest in the next
        finally:
            genes.unpersist()
        both = Stats.join([pop.stats, st])
        return Population(df, np.concatenate([pop.centers, centres])[src], both.take(src), fits[src], pop.n, pop.store)

    def _plan(self, n: int, gen: int) -> tuple[list[tuple[int, int]], list[int]]:
        """Pairs of slots and their cuts: known before the generation's data."""
        pairs = self._pairs(crossover_ranks(self.population, self.crossover, self.seed, gen))
        return pairs, [cut_point(n, self.seed, gen, i) for i in range(len(pairs))]

    def crossover_population(self, pop: Population, gen: int) -> Population:
        """G6/G7."""
        pairs, cuts = self._plan(pop.n, gen)
        if not pairs:
            return pop
        if self.second_child == "aligned":
            return self._aligned(pop, pairs, cuts, gen)
        if self.pairing == "ring":
            for i, (pair, cut) in enumerate(zip(pairs, cuts)):
                pop = self._rotated(pop, [pair], [cut], gen, i)
            return pop
        return self._rotated(pop, pairs, cuts, gen, 0)

    # ------------------------------------------------------------ fused generation

    def _can_fuse(self, d: int) -> bool:
        """Fused passes hold the centres and statistics of all parents and children at once,
        and the moments of every slot's two labellings in each segment."""
        m = int(self.crossover * self.population) // 2
        slots = self.population + 2 * m
        most = max(2 * slots, 2 * self.population * (m + 1))
        return (self.fuse and self.pairing == "disjoint" and self.second_child == "aligned"
                and self.child_centers == "means" and self.fitness == "squared" and self.mutation_rate == 0
                and most * self.k * d * 8 <= K.MAX_CLOSURE_BYTES)

    def _generation_fused(self, pop: Population, moments: SegmentStats, gen: int) -> tuple[Population, SegmentStats | None]:
        """Crossover + KMO of one generation in two passes and the relabel (see ``operators.fused``).

        ``moments`` are those of ``pop`` in the segments of this generation's
        cuts; the same for the next generation are returned.
        """
        P, k, d = pop.P, pop.k, pop.d
        pairs, cuts = self._plan(pop.n, gen)
        seg = Segments(cuts)
        own = seg.own(P)
        made = [g for (a, b), cut in zip(pairs, cuts) for g in (seg.child(own[a], own[b], cut), seg.child(own[b], own[a], cut))]
        m2 = len(made)
        cst = moments.merged(made) if m2 else Stats.empty(0, k, d)
        all_centres = np.concatenate([pop.centers, self._child_centres(pop, cst, pairs, gen, 0)]) if m2 else pop.centers
        K.check_broadcast(all_centres, cst.M)
        every = own + made

        # pass B: children fitness + candidate statistics of every possible slot content
        frame_b = pop.df.select("row_id", "x", F.array(*[seg.genes(g) for g in every]).alias("sol"))
        cand_all, sil = run_parts(frame_b, children_and_candidates_fn(P, m2, k, d, cst, all_centres), P + m2, k, d,
                                  pop.store.buckets)
        child_fit = np.array([sil[i][0] / sil[i][1] if sil.get(i, (0, 0))[1] else -1.0 for i in range(m2)])
        child_fit = np.where((cst.n > 0).sum(axis=1) >= 2, child_fit, -1.0)

        # family competition on the driver
        fit = np.concatenate([pop.fitness, child_fit])
        src = self._compete(P, pairs, fit)
        held = Stats.join([pop.stats, cst]).take(src)
        fitness, centres = fit[src], all_centres[src]
        self._logpop(gen, "crossover", fitness)
        frame_c = pop.df.select("row_id", "pos", "x", F.array(*[seg.genes(every[s]) for s in src]).alias("sol"))

        # pass C: candidate fitness, and moments for the next generation
        cand = cand_all.take(src)
        bounds = Segments(self._plan(pop.n, gen + 1)[1]).bounds if gen < self.generations else None
        S = 0 if bounds is None else len(bounds) + 1
        st, sil = run_parts(frame_c, candidates_fn(P, k, d, centres, cand, bounds), 2 * P, max(S, 1) * k, d, pop.store.buckets)
        cand_fit = np.array([sil[p][0] / sil[p][1] if sil.get(p, (0, 0))[1] else -1.0 for p in range(P)])
        cand_fit = np.where((cand.n > 0).sum(axis=1) >= 2, cand_fit, -1.0)
        take = cand_fit > fitness if self.kmo == "better" else np.ones(P, dtype=bool)
        kept = Stats(np.where(take[:, None], cand.n, held.n), np.where(take[:, None, None], cand.M, held.M),
                     np.where(take[:, None], cand.W, held.W), np.zeros((P, k)))
        kept.E = kept.W.copy()
        after = SegmentStats.of(st, S).take(np.where(take, P, 0) + np.arange(P)) if S else None
        df = pop.store.commit(relabel(frame_c, centres, ["row_id"], reassign=take))
        return Population(df, kept.means(centres), kept, np.where(take, cand_fit, fitness), pop.n, pop.store), after

    # ------------------------------------------------------------ fit

    def _logpop(self, gen: int, stage: str, fitness):
        self._log += [(gen, stage, int(p), float(f)) for p, f in enumerate(fitness)]

    def _record(self, pop: Population, gen: int, track: bool, fit_h, sse_h, ari_h, cen_h) -> None:
        """Fitness, SSE, centres and (from its contingency cells) the ARI of the best slot."""
        self._logpop(gen, "kmo", pop.fitness)
        best = rank_order(pop.fitness)[0]
        fit_h.append(float(pop.fitness[best]))
        sse_h.append(float(pop.sse()[best]))
        cen_h.append(pop.centers[best].copy())
        ari = None
        if track:
            lab = pop.df.select("label", F.col("sol")[best].alias("cluster"))
            ari = float(pair_counts(lab, "label", "cluster").select(ari_expr().alias("a")).first()["a"])
        ari_h.append(ari)

    def fit(self, points: DataFrame, label_col: str | None = "label") -> GeneticKMeansModel:
        """Run the generations on ``points(row_id, [pos], x, [label])``."""
        self._check()
        self._log = []
        if "pos" not in points.columns:
            points = with_pos(points)
        if label_col is not None and label_col not in points.columns:
            label_col = None
        if label_col is not None and label_col != "label":
            points = points.withColumnRenamed(label_col, "label")
        track = label_col is not None and self.track_ari
        store = PointStore(points.select(*base_cols(points)))
        try:
            pop = init_population(points, self.population, self.k, self.seed, self.fitness, self.block_rows, store)
            self._logpop(0, "init", pop.fitness)
            fit_h, sse_h, ari_h, cen_h = [], [], [], []
            moments = None
            if self.generations and self._can_fuse(pop.d):
                moments, _ = segment_stats(pop.df, Segments(self._plan(pop.n, 1)[1]), pop.P, pop.k, pop.d)
            for gen in range(1, self.generations + 1):
                src = select_survivors(pop.fitness, self.survival, self.seed, gen, self.elite)
                pop = pop.take(src)
                self._logpop(gen, "selection", pop.fitness)
                if moments is not None:
                    pop, moments = self._generation_fused(pop, moments.take(src), gen)
                else:
                    pop = self.crossover_population(pop, gen)
                    self._logpop(gen, "crossover", pop.fitness)
                    if self.mutation_rate > 0:
                        pop = mutate(pop, self.mutation_rate, self.seed, gen, self.fitness, self.block_rows)
                    pop, _ = kmo(pop, self.kmo, self.fitness, self.block_rows)
                self._record(pop, gen, track, fit_h, sse_h, ari_h, cen_h)
        except BaseException:
            store.close()
            raise
        best = rank_order(pop.fitness)[0]
        return GeneticKMeansModel(pop, best, fit_h, sse_h, ari_h, cen_h, list(self._log))


def evaluate_slots_frame(frame: DataFrame, P: int, k: int, d: int, kind: str, block_rows: int):
    """Stats + fitness for the P ``sol`` slots of ``frame`` (children of a crossover)."""
    spec = K.KernelSpec(P, k, d, sol_col="sol")
    st = run_stats(frame, spec)
    return st, fitness_of(frame, st, spec, kind, block_rows)
