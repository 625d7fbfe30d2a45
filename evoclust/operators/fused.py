"""Fused passes of one genetic generation.

Pass B  children fitness  +  k-means candidate statistics of every slot a
        generation can end with (P parents and 2m children), computed
        speculatively so the KMO step needs no pass of its own.
Pass C  candidate fitness of every slot  +  moments of its held and of its
        candidate labels per segment of the next generation's cuts, which are
        known before: they give the next children's statistics without a pass
        (:mod:`evoclust.operators.segments`).
Relabel the labels kept, written as the next version.

Every pass is one ``mapInArrow`` kernel over the shared statistics of
:mod:`evoclust.operators.kernels`, so decisions equal the unfused path.
"""

from __future__ import annotations

import numpy as np

from evoclust.operators import kernels as K
from evoclust.operators.segments import segment_labels


def children_and_candidates_fn(P: int, m2: int, k: int, d: int, child, centres):
    """Pass B: ``sol`` holds P parent slots then m2 child slots.  Emits the
    children's silhouette sums and candidate statistics of all P + m2 slots
    (labels = nearest of that slot's centres); ``child``: the children's Stats."""
    tot = P + m2

    def run(batches):
        acc = K.Moments(tot, k, d)
        s_sum, s_cnt = np.zeros(m2), np.zeros(m2, dtype=np.int64)
        for b in batches:
            if b.num_rows == 0:
                continue
            X = K.matrix(b, "x", d)
            sol = K.matrix(b, "sol", tot, np.int64)
            for i in range(m2):
                s_sum[i] += K.sil_values(X, sol[:, P + i], child.n[i], child.M[i], child.W[i]).sum()
                s_cnt[i] += X.shape[0]
            for p in range(tot):
                lab, e = K.nearest(X, centres[p])
                acc.add(p, lab, X, e)
        yield K.Parts.concat([acc.part(), K.sil_part(s_cnt, s_sum, d)]).batch()

    return run


def candidates_fn(P: int, k: int, d: int, centres, cand, bounds: list[int] | None = None):
    """Pass C: silhouette of every slot's candidate labels (nearest centre) from the
    candidate Stats.  With ``bounds`` also the moments per (segment, cluster) of the
    held labels (``sol``, slots 0..P-1) and of the candidates (P..2P-1)."""
    S = 0 if bounds is None else len(bounds) + 1

    def run(batches):
        s_sum, s_cnt = np.zeros(P), np.zeros(P, dtype=np.int64)
        acc = K.Moments(2 * P if S else 0, S * k, d)
        for b in batches:
            if b.num_rows == 0:
                continue
            X = K.matrix(b, "x", d)
            zero = np.zeros(len(X))
            if S:
                sol = K.matrix(b, "sol", P, np.int64)
                base = segment_labels(0, b.column(b.schema.get_field_index("pos")).to_numpy(), bounds, k)
            for p in range(P):
                lab, _ = K.nearest(X, centres[p])
                s_sum[p] += K.sil_values(X, lab, cand.n[p], cand.M[p], cand.W[p]).sum()
                s_cnt[p] += X.shape[0]
                if S:
                    acc.add(p, base + sol[:, p], X, zero)
                    acc.add(P + p, base + lab, X, zero)
        yield K.Parts.concat([acc.part(), K.sil_part(s_cnt, s_sum, d)]).batch()

    return run


def scatter_and_silhouette_fn(k: int, d: int, n, M, W):
    """One labelling (``sol`` of length 1): per cluster the sum of Euclidean
    distances to the member mean (scatter, in ``e``) and the squared
    silhouette sum, in one pass (E6 + A10 of the report)."""

    def run(batches):
        root = np.zeros(k)
        s_sum, s_cnt = 0.0, 0
        for b in batches:
            if b.num_rows == 0:
                continue
            X = K.matrix(b, "x", d)
            lab = K.matrix(b, "sol", 1, np.int64)[:, 0]
            diff = X - M[lab]
            root += np.bincount(lab, weights=np.sqrt(np.einsum("ij,ij->i", diff, diff)), minlength=k)
            s_sum += float(K.sil_values(X, lab, n, M, W).sum())
            s_cnt += b.num_rows
        used = np.nonzero(root > 0)[0]
        m, z = len(used), np.zeros(len(used))
        scatter = K.Parts(np.full(m, K.STATS), z, used, np.full(m, K.task_id()), z, z, root[used], np.zeros((m, d)))
        yield K.Parts.concat([scatter, K.sil_part(np.array([s_cnt]), np.array([s_sum]), d)]).batch()

    return run
