"""Segment moments (G6, G7, U3): statistics of every child from one pass.

The cuts of a generation part the positions into segments.  A slot of a
crossover, also a child of a child, holds in each segment the genes of one
slot of the population: its *genome* is a list of slots, one per segment.  So
moments per (slot, segment, cluster) from one pass give the count, mean and
squared distances of any child by merging its segments' rows, and a child's
labels are one flat expression on the population's ``sol``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evoclust.operators import kernels as K
from evoclust.operators.kmeans import Stats, run_parts


class Segments:
    """The segments of a generation's cuts: segment j holds the positions from bound j-1 to below bound j."""

    def __init__(self, cuts: list[int]):
        self.bounds = sorted(set(cuts))

    @property
    def S(self) -> int:
        return len(self.bounds) + 1

    def own(self, P: int) -> list[list[int]]:
        """Genomes of the population itself."""
        return [[p] * self.S for p in range(P)]

    def child(self, a: list[int], b: list[int], cut: int) -> list[int]:
        """Genes of ``a`` before the cut, genes of ``b`` from it on."""
        at = self.bounds.index(cut) + 1
        return [*a[:at], *b[at:]]

    def genes(self, genome: list[int], pos: str = "pos") -> Column:
        """The labels of a genome as an expression on ``sol``; neighbours of one slot are one branch."""
        out = F.col("sol")[genome[-1]]
        for j in range(len(self.bounds) - 1, -1, -1):
            if genome[j] != genome[j + 1]:
                out = F.when(F.col(pos) < F.lit(self.bounds[j]), F.col("sol")[genome[j]]).otherwise(out)
        return out


class SegmentStats:
    """Moments per (slot, segment, cluster): arrays (P, S, k[, d])."""

    def __init__(self, n: np.ndarray, M: np.ndarray, W: np.ndarray):
        self.n, self.M, self.W = n, M, W

    @staticmethod
    def of(st: Stats, S: int) -> "SegmentStats":
        """From statistics whose cluster ids are ``segment * k + cluster``."""
        P, wide = st.n.shape
        k = wide // S
        return SegmentStats(st.n.reshape(P, S, k), st.M.reshape(P, S, k, -1), st.W.reshape(P, S, k))

    def take(self, src) -> "SegmentStats":
        src = np.asarray(src)
        return SegmentStats(self.n[src], self.M[src], self.W[src])

    def merged(self, genomes: list[list[int]]) -> Stats:
        """Statistics of each genome: its segments' rows merged by weight."""
        g = np.asarray(genomes).reshape(-1, self.n.shape[1])
        at = np.arange(g.shape[1])
        n, M, W = self.n[g, at], self.M[g, at], self.W[g, at]  # (genomes, S, k[, d])
        total = n.sum(axis=1)
        mean = (n[..., None] * M).sum(axis=1) / np.maximum(total, 1)[..., None]
        diff = M - mean[:, None]
        within = (W + n * np.einsum("gskd,gskd->gsk", diff, diff)).sum(axis=1)
        return Stats(total, mean, within, np.zeros(total.shape))


def segment_labels(lab: np.ndarray, pos: np.ndarray, bounds: list[int], k: int) -> np.ndarray:
    """Labels with the segment of their row: ``segment * k + label``."""
    return np.searchsorted(np.asarray(bounds, dtype=np.int64), pos, side="right") * k + lab


def segment_stats_fn(P: int, k: int, d: int, bounds: list[int], centres: np.ndarray | None = None):
    """Moments per (slot, segment, cluster) of ``sol``; ``e`` is the squared distance to the slot's ``centres``."""
    S = len(bounds) + 1

    def run(batches):
        acc = K.Moments(P, S * k, d)
        for b in batches:
            if b.num_rows:
                X, sol = K.matrix(b, "x", d), K.matrix(b, "sol", P, np.int64)
                pos = b.column(b.schema.get_field_index("pos")).to_numpy()
                for p in range(P):
                    e = np.zeros(len(X)) if centres is None else K.own_distances(X, centres[p], sol[:, p])
                    acc.add(p, segment_labels(sol[:, p], pos, bounds, k), X, e)
        yield acc.part().batch()

    return run


def segment_stats(frame: DataFrame, seg: Segments, P: int, k: int, d: int,
                  centres: np.ndarray | None = None) -> tuple[SegmentStats, np.ndarray]:
    """One pass over ``frame(pos, x, sol)``; also the summed distances to ``centres``, (P, k)."""
    fn = segment_stats_fn(P, k, d, seg.bounds, centres)
    st, _ = run_parts(frame.select("pos", "x", "sol"), fn, P, seg.S * k, d)
    return SegmentStats.of(st, seg.S), st.E.reshape(P, seg.S, k).sum(axis=1)
