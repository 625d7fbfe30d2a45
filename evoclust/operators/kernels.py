"""Vectorised per-partition kernels run through ``mapInArrow``.

Each kernel turns Arrow batches of ``(row_id, x, [sol])`` into either
per-partition partial statistics (a few rows per chromosome and cluster: the
map-side combine) or per-row labels.  Centres and per-cluster statistics are
captured in the closure: they are ``P x k x d`` numbers whose size is checked
by :func:`check_broadcast` before any job starts.  PySpark ships closures over
1 MB as broadcast variables.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Upper bound for centres/statistics captured in a kernel closure.
MAX_CLOSURE_BYTES = 256 * 1024 * 1024

# One row layout for every partial result: a row for each (chrom, c) of a task.
# STATS rows carry the count n, the sum w of squared distances to the member
# mean, the sum e and the mean; SIL rows (c = -1, no mean) the count n and the sum w.
PART_SCHEMA = "kind int, chrom int, c int, part int, n bigint, w double, e double, mean array<double>"
STATS, SIL = 0, 1
# Partial rows of a key that meet in one merge.
FAN_IN = 64


def check_broadcast(*arrays: np.ndarray, limit: int | None = None) -> int:
    limit = MAX_CLOSURE_BYTES if limit is None else limit
    size = int(sum(np.asarray(a).nbytes for a in arrays))
    if size > limit:
        raise ValueError(
            f"centres/statistics need {size} bytes, above the {limit} byte bound for "
            "shipping them to every task: one chromosome's k x d centres must fit"
        )
    return size


def matrix(batch: pa.RecordBatch, name: str, width: int, dtype=np.float64) -> np.ndarray:
    """A LIST column of fixed width as an ``(n, width)`` array (no per-row Python)."""
    col = batch.column(batch.schema.get_field_index(name))
    n = batch.num_rows
    if n == 0:
        return np.zeros((0, width), dtype=dtype)
    flat = col.flatten()
    if col.null_count or flat.null_count or not (np.diff(col.offsets.to_numpy()) == width).all():
        raise ValueError(f"column {name!r}: expected {width} values per row, none null")
    out = flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(n, width)
    if out.dtype.kind == "f" and not np.isfinite(out).all():
        raise ValueError(f"column {name!r}: values must be finite")
    return out


def list_array(values: np.ndarray, pa_type) -> pa.Array:
    """``(n, w)`` array to an Arrow LIST array."""
    n, w = values.shape
    offsets = pa.array(np.arange(0, (n + 1) * w, w, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), type=pa_type))


def sq_dists(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """``(n, k)`` squared distances, summed difference by difference (no
    ``|x|^2 - 2xc + |c|^2`` cancellation), so argmin ties resolve like SQL.
    Loops over the shorter of dimensions and centres."""
    n, d = X.shape
    k = C.shape[0]
    out = np.zeros((n, k))
    if d <= k:
        for j in range(d):
            t = X[:, j, None] - C[None, :, j]
            out += t * t
        return out
    for c in range(k):
        diff = X - C[c]
        out[:, c] = np.einsum("ij,ij->i", diff, diff)
    return out


def cluster_sums(lab: np.ndarray, Xs: np.ndarray, k: int) -> np.ndarray:
    """``(k, d)`` sums of the rows of ``Xs`` per label."""
    d = Xs.shape[1]
    if d <= 16:
        return np.stack([np.bincount(lab, weights=Xs[:, j], minlength=k)[:k] for j in range(d)], axis=1)
    onehot = np.zeros((Xs.shape[0], k))
    onehot[np.arange(Xs.shape[0]), lab] = 1.0
    return onehot.T @ Xs


def nearest(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (lowest id on ties) and its squared distance.

    Fast path: ``|x|^2 + |c|^2 - 2 x.c`` by BLAS on data centred on the
    centres' mean.  Rows whose best and second-best distances are closer than
    a generous bound of that formula's rounding error are recomputed by exact
    difference sums, so the labels equal the exact computation; the returned
    distance is always the exact one.
    """
    return _nearest(X, C)[:2]


def nearest_two(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`nearest` and a lower bound of the distance (not squared) to every other centre."""
    lab, e, second, error = _nearest(X, C)
    return lab, e, np.sqrt(np.maximum(second - error, 0.0))


def _nearest(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label, squared distance, the fast path's second smallest, a bound of its error)."""
    n, k = X.shape[0], C.shape[0]
    second, error = np.full(n, np.inf), np.zeros(n)
    if k == 1 or n == 0:
        lab = np.zeros(n, dtype=np.int32)
    else:
        mu = C.mean(axis=0)
        Xc, Cc = X - mu, C - mu
        x2 = np.einsum("ij,ij->i", Xc, Xc)
        c2 = np.einsum("ij,ij->i", Cc, Cc)
        D = x2[:, None] + c2[None, :] - 2.0 * (Xc @ Cc.T)
        lab = np.argmin(D, axis=1)
        rows = np.arange(n)
        best = D[rows, lab]
        D[rows, lab] = np.inf
        second = D.min(axis=1)
        error = 1e-8 * (x2 + c2.max()) + 1e-300
        risky = (second - best) <= error
        if risky.any():
            lab[risky] = np.argmin(sq_dists(X[risky], C), axis=1)
        lab = lab.astype(np.int32)
    return lab, own_distances(X, C, lab), second, error


def centre_distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """``(n, k)`` squared distances: BLAS on centred data; every entry that is
    small against what was subtracted is recomputed by differences."""
    mu = C.mean(axis=0)
    Xc, Cc = X - mu, C - mu
    x2 = np.einsum("ij,ij->i", Xc, Xc)
    c2 = np.einsum("ij,ij->i", Cc, Cc)
    D = x2[:, None] + c2[None, :] - 2.0 * (Xc @ Cc.T)
    i, c = np.nonzero(D <= 1e-4 * (x2[:, None] + c2[None, :]))
    step = max(1, (1 << 22) // max(1, X.shape[1]))
    for at in range(0, len(i), step):
        r, q = i[at:at + step], c[at:at + step]
        diff = X[r] - C[q]
        D[r, q] = np.einsum("ij,ij->i", diff, diff)
    return D


def task_id() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return 0 if ctx is None else ctx.partitionId()


class Parts:
    """Partial rows as columns; ``mean`` is a matrix, zero in SIL rows."""

    def __init__(self, kind, chrom, c, part, n, w, e, mean: np.ndarray):
        self.kind, self.chrom, self.c, self.part = (np.asarray(a, dtype=np.int32) for a in (kind, chrom, c, part))
        self.n, self.w, self.e, self.mean = np.asarray(n, dtype=np.int64), np.asarray(w, float), np.asarray(e, float), mean

    def __len__(self) -> int:
        return len(self.n)

    @staticmethod
    def concat(parts: list["Parts"]) -> "Parts":
        return Parts(*(np.concatenate([getattr(p, f) for p in parts])
                       for f in ("kind", "chrom", "c", "part", "n", "w", "e", "mean")))

    @staticmethod
    def read(t: pa.RecordBatch | pa.Table, d: int) -> "Parts":
        t = t.combine_chunks() if isinstance(t, pa.Table) else t
        col = [t.column(i).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch) else t.column(i).to_numpy() for i in range(7)]
        mean = np.zeros((t.num_rows, d))
        lists = t.column(7)
        flat = pa.concat_arrays([x.flatten() for x in lists.chunks]) if isinstance(lists, pa.ChunkedArray) and t.num_rows else (
            None if isinstance(lists, pa.ChunkedArray) else lists.flatten())
        if flat is not None:
            mean[col[0] == STATS] = flat.to_numpy(zero_copy_only=False).reshape(-1, d)
        return Parts(*col, mean)

    def merged(self, fan_in: int = FAN_IN) -> "Parts":
        """One row for each (kind, chrom, c), ``part`` that of its group.  Means combine by weight, and their
        squared distances to the combined mean are the between part of ``w``:
        nothing is a difference of large sums.  The order is that of ``part``,
        so the result does not depend on how rows arrive."""
        if not len(self):
            return self
        order = np.lexsort((self.part, self.c, self.chrom, self.kind))
        kind, chrom, c, n, w, e = (a[order] for a in (self.kind, self.chrom, self.c, self.n, self.w, self.e))
        mean = self.mean[order]
        first = np.flatnonzero(np.r_[True, (np.diff(kind) != 0) | (np.diff(chrom) != 0) | (np.diff(c) != 0)])
        group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(n)]))
        total = np.add.reduceat(n, first)
        centre = np.add.reduceat(n[:, None] * mean, first, axis=0) / np.maximum(total, 1)[:, None]
        diff = mean - centre[group]
        between = n * np.einsum("ij,ij->i", diff, diff)
        return Parts(kind[first], chrom[first], c[first], self.part[order][first] // fan_in, total,
                     np.add.reduceat(w + between, first), np.add.reduceat(e, first), centre)

    def batch(self) -> pa.RecordBatch:
        stats = self.kind == STATS
        offsets = np.r_[0, np.cumsum(np.where(stats, self.mean.shape[1], 0))].astype(np.int32)
        cols = [pa.array(a) for a in (self.kind, self.chrom, self.c, self.part, self.n, self.w, self.e)]
        means = pa.ListArray.from_arrays(offsets, pa.array(self.mean[stats].reshape(-1)))
        return pa.RecordBatch.from_arrays([*cols, means], names=["kind", "chrom", "c", "part", "n", "w", "e", "mean"])


def merge_parts_fn(d: int, fan_in: int):
    """A level of the tree: the rows of each (kind, chrom, c) of a task become one."""

    def run(batches):
        rows = [Parts.read(b, d) for b in batches if b.num_rows]
        if rows:
            yield Parts.concat(rows).merged(fan_in).batch()

    return run


def sil_part(n: np.ndarray, s: np.ndarray, d: int = 0) -> Parts:
    """SIL rows: points and silhouette sum per slot."""
    m = len(n)
    return Parts(np.full(m, SIL), np.arange(m), np.full(m, -1), np.full(m, task_id()), n, s, np.zeros(m), np.zeros((m, d)))


def batch_moments(p: int, lab: np.ndarray, X: np.ndarray, e: np.ndarray) -> Parts:
    """STATS rows of the labels that one batch holds, whatever the number of clusters."""
    used, at = np.unique(lab, return_inverse=True)
    n = np.bincount(at)
    mean = cluster_sums(at, X, len(used)) / n[:, None]
    diff = X - mean[at]
    m = len(used)
    return Parts(np.full(m, STATS), np.full(m, p), used, np.full(m, task_id()), n,
                 np.bincount(at, weights=np.einsum("ij,ij->i", diff, diff)), np.bincount(at, weights=e), mean)


class Moments:
    """Mergeable statistics of P labellings: count, mean and squared distances to
    the mean per cluster, combined by the pairwise update (nothing cancels when
    the data lie far from the origin or clusters far from each other)."""

    def __init__(self, P: int, k: int, d: int):
        self.k, self.d = k, d
        self.n = np.zeros((P, k), dtype=np.int64)
        self.M = np.zeros((P, k, d))
        self.W = np.zeros((P, k))
        self.E = np.zeros((P, k))

    def add(self, p: int, lab: np.ndarray, X: np.ndarray, e: np.ndarray) -> None:
        k = self.k
        if lab.size and (lab.min() < 0 or lab.max() >= k):
            raise ValueError(f"labels outside 0..{k - 1}")
        n = np.bincount(lab, minlength=k)
        mean = cluster_sums(lab, X, k) / np.maximum(n, 1)[:, None]
        diff = X - mean[lab]
        within = np.bincount(lab, weights=np.einsum("ij,ij->i", diff, diff), minlength=k)
        delta = np.where((n > 0)[:, None], mean - self.M[p], 0.0)
        total = np.maximum(self.n[p] + n, 1)
        self.W[p] += within + np.einsum("ij,ij->i", delta, delta) * self.n[p] * n / total
        self.M[p] += delta * (n / total)[:, None]
        self.n[p] += n
        self.E[p] += np.bincount(lab, weights=e, minlength=k)

    def part(self) -> Parts:
        """STATS rows of the used clusters."""
        pp, cc = np.nonzero(self.n)
        m = len(pp)
        return Parts(np.full(m, STATS), pp, cc, np.full(m, task_id()), self.n[pp, cc], self.W[pp, cc], self.E[pp, cc],
                     self.M[pp, cc])


@dataclass
class KernelSpec:
    """What a pass over the point table needs to know."""

    P: int
    k: int
    d: int
    centers: np.ndarray | None = None  # (P, k, d): labels = nearest centre, e = distance to it
    own_centers: np.ndarray | None = None  # (P, k, d): labels from sol, e = distance to own centre
    sol_col: str | None = None  # labels come from this ARRAY<INT> column when centers is None
    reassign: np.ndarray | None = None  # (P,) bool: which slots take nearest-centre labels
    root_e: bool = False  # accumulate Euclidean (not squared) distances in e
    e_col: str | None = None  # with labels from sol: e read from this column
    tasks: int | None = None  # partitions of the pass, where the caller knows them

    def chunk(self, lo: int, hi: int, sol_col: str | None = None) -> "KernelSpec":
        """The same pass restricted to slots lo..hi-1 (``sol`` already sliced)."""
        pick = lambda a: None if a is None else a[lo:hi]
        return KernelSpec(hi - lo, self.k, self.d, pick(self.centers), pick(self.own_centers),
                          sol_col or self.sol_col, pick(self.reassign), self.root_e, self.e_col, self.tasks)


def own_distances(X: np.ndarray, C: np.ndarray, lab: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the centre of its label."""
    diff = X - C[lab]
    return np.einsum("ij,ij->i", diff, diff)


def _labels(spec: KernelSpec, batch: pa.RecordBatch, X: np.ndarray):
    """Yield (p, labels, e) for every chromosome slot of a batch."""
    sol = matrix(batch, spec.sol_col, spec.P, np.int64) if spec.sol_col else None
    for p in range(spec.P):
        use_centres = spec.centers is not None and (spec.reassign is None or spec.reassign[p])
        if use_centres:
            lab, e = nearest(X, spec.centers[p])
        else:
            lab = sol[:, p].astype(np.int32)
            if spec.own_centers is not None:
                e = own_distances(X, spec.own_centers[p], lab)
            elif spec.e_col is not None:
                e = batch.column(batch.schema.get_field_index(spec.e_col)).to_numpy(zero_copy_only=False)
            else:
                e = np.zeros(X.shape[0])
        if spec.root_e:
            e = np.sqrt(e)
        yield p, lab, e


def partial_stats_fn(spec: KernelSpec):
    """A1/A5 map side: the moments of every (chrom, c) in a partition."""

    def run(batches):
        acc = Moments(spec.P, spec.k, spec.d)
        for b in batches:
            if b.num_rows:
                X = matrix(b, "x", spec.d)
                for p, lab, e in _labels(spec, b, X):
                    acc.add(p, lab, X, e)
        yield acc.part().batch()

    return run


def sparse_stats_fn(spec: KernelSpec, held_bytes: int = 64 << 20):
    """As :func:`partial_stats_fn` for clusters too many to keep an array of: a
    task holds the clusters it has met and sends them on when their rows pass
    ``held_bytes``."""

    def run(batches):
        held, rows = [], 0
        most = max(1, held_bytes // (8 * (spec.d + 8)))
        for b in batches:
            if b.num_rows:
                X = matrix(b, "x", spec.d)
                for p, lab, e in _labels(spec, b, X):
                    held.append(batch_moments(p, lab, X, e))
                    rows += len(held[-1])
            if rows > most:
                one = Parts.concat(held).merged()
                one.part[:] = task_id()
                held, rows = [one], len(one)
                if 2 * rows > most:
                    yield one.batch()
                    held, rows = [], 0
        if held:
            one = Parts.concat(held).merged()
            one.part[:] = task_id()
            yield one.batch()

    return run


def sil_values(X: np.ndarray, lab: np.ndarray, n: np.ndarray, mean: np.ndarray, within: np.ndarray) -> np.ndarray:
    """E6 per point: squared-Euclidean silhouette from the statistics of a labelling.

    The mean squared distance from x to the members of cluster c is
    ``|x - mean_c|^2 + W_c/n_c``; the own cluster is rescaled by ``n/(n-1)`` to
    leave the point itself out, singletons score 0.
    """
    rows, used = np.arange(X.shape[0]), np.nonzero(n > 0)[0]
    md = np.full((X.shape[0], len(n)), np.inf)
    md[:, used] = centre_distances(X, mean[used]) + (within[used] / n[used])[None, :]
    n_own = n[lab]
    own = md[rows, lab]
    a = np.where(n_own > 1, own * n_own / np.maximum(n_own - 1, 1), 0.0)
    md[rows, lab] = np.inf
    b = md.min(axis=1)
    denom = np.maximum(a, b)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where((n_own > 1) & np.isfinite(b) & (denom > 0), (b - a) / denom, 0.0)


def silhouette_partial_fn(spec: KernelSpec, n: np.ndarray, M: np.ndarray, W: np.ndarray):
    """E6 map side: silhouette sums of every slot's own labelling per partition."""

    def run(batches):
        tot, cnt = np.zeros(spec.P), np.zeros(spec.P, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                X = matrix(b, "x", spec.d)
                for p, lab, _ in _labels(spec, b, X):
                    tot[p] += sil_values(X, lab, n[p], M[p], W[p]).sum()
                    cnt[p] += X.shape[0]
        yield sil_part(cnt, tot).batch()

    return run


def relabel_fn(P: int, k: int, d: int, centers: np.ndarray, lo: int, reassign: np.ndarray | None,
               keep: list[str], sol_col: str | None, out_col: str = "sol"):
    """Per-row labels: slots ``lo .. lo+len(centers)-1`` take the nearest of their
    centres (where ``reassign``); every other slot keeps the label held in
    ``sol_col`` (0 when there is none yet).  Only this chunk's centres are held."""

    def run(batches):
        for b in batches:
            X = matrix(b, "x", d)
            if sol_col is not None and sol_col in b.schema.names:
                labs = matrix(b, sol_col, P, np.int32).copy()
            else:
                labs = np.zeros((b.num_rows, P), dtype=np.int32)
            for i in range(centers.shape[0]):
                p = lo + i
                if reassign is None or reassign[p]:
                    labs[:, p] = nearest(X, centers[i])[0]
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [list_array(labs, pa.int32())], names=keep + [out_col])

    return run


KEY_SCHEMA = "chrom int, u bigint, row_id bigint"


def _least(u: np.ndarray, row_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest ``(u, row_id)``, in order."""
    if len(u) > k:  # all that tie with the k-th smallest u stay for the sort
        near = u <= np.partition(u, k - 1)[k - 1]
        u, row_id = u[near], row_id[near]
    order = np.lexsort((row_id, u))[:k]
    return u[order], row_id[order]


def _keys(best: dict) -> pa.RecordBatch:
    """Rows of ``KEY_SCHEMA`` from ``{chrom: (u, row_id)}``."""
    chrom = np.repeat(np.array(list(best), dtype=np.int32), [len(u) for u, _ in best.values()])
    u, r = (np.concatenate([v[i] for v in best.values()]) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(chrom), pa.array(u), pa.array(r)], names=["chrom", "u", "row_id"])


def top_k_fn(P: int, k: int):
    """R1 map side: per partition and chromosome, the keys of the k rows with the smallest
    ``(u[p], row_id)``.  Only k keys per chromosome are held and sent on, no vectors."""

    def run(batches):
        best: dict = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            U = matrix(b, "u", P, np.int64)
            rid = b.column(b.schema.get_field_index("row_id")).to_numpy()
            for p in range(P):
                u, r = best.get(p, (U[:0, p], rid[:0]))
                best[p] = _least(np.concatenate([u, U[:, p]]), np.concatenate([r, rid]), k)
        if best:
            yield _keys(best)

    return run


def merge_top_k_fn(k: int):
    """R1 merge step: keeps each chromosome's k smallest ``(u, row_id)`` among the rows of a task."""

    def run(batches):
        best: dict = {}
        for b in batches:
            ch, u, r = (b.column(i).to_numpy() for i in range(3))
            for c in np.unique(ch):
                sel = ch == c
                v, q = best.get(c, (u[:0], r[:0]))
                best[c] = _least(np.concatenate([v, u[sel]]), np.concatenate([q, r[sel]]), k)
        if best:
            yield _keys(best)

    return run


def block_nearest_fn(block: np.ndarray, lo: int, d: int, keep: list[str], first: bool):
    """Nearest centre over centre blocks: this pass holds centres ``lo ..
    lo+len(block)-1`` only and updates the running ``(_bc, _bd)`` of each row.
    Exact distances are compared with ``<``, so ties keep the lower id."""

    def run(batches):
        for b in batches:
            X = matrix(b, "x", d)
            lab, e = nearest(X, block)
            lab = lab.astype(np.int64) + lo
            if not first:
                pc = b.column(b.schema.get_field_index("_bc")).to_numpy(zero_copy_only=False)
                pd_ = b.column(b.schema.get_field_index("_bd")).to_numpy(zero_copy_only=False)
                better = e < pd_
                lab = np.where(better, lab, pc)
                e = np.where(better, e, pd_)
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(lab.astype(np.int32)), pa.array(e)],
                                             names=keep + ["_bc", "_bd"])

    return run


def predict_fn(centers: np.ndarray, d: int, keep: list[str]):
    """K8: nearest final centre and squared distance, one chromosome."""

    def run(batches):
        for b in batches:
            X = matrix(b, "x", d)
            lab, e = nearest(X, centers)
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(lab), pa.array(e)], names=keep + ["cluster", "d2"])

    return run
