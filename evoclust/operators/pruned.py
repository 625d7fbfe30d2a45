"""Exact Euclidean silhouette with pruned pairs.

The mean distance of a point x to the members of a cluster c lies between
``|x - mean_c|`` (the distance to a mean is at most the mean distance) and
``sqrt(|x - mean_c|^2 + W_c / n_c)`` (the mean distance is at most the root of
the mean square).  The nearest other cluster of x is therefore among those
whose lower bound is not above the least upper bound: only these and the own
cluster need sums over pairs, every other cluster is skipped, and the result is
the same.

A pass counts how many points need each cluster.  Then a cluster's members and
the points that need it are hashed into blocks of at most ``block_rows``; every
(member block, point block) of a cluster is one task's group, which tiles its
distances and emits a sum per point, never the pairs.  Points of one or two
dimensions meet in larger blocks (``FLAT_BLOCK_ROWS``), whose sums
:mod:`evoclust.operators.farfield` finds in n log n steps.  Where a cluster takes
several such blocks they are cells of the plane, not hashed: a cell's members are
sent to each cell of points as what is seen of them from there
(``farfield.seen_from``: all that are near, some weighted points for the rest), so
a point meets about as many others however many cells there are.  The cells' cuts
come from a sample; which rows they hold does not change any sum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evoclust.operators import kernels as K
from evoclust.operators.farfield import Boxes, distance_sums, flat, seen_from
from evoclust.operators.kmeans import Stats, run_sums

#: Bounds are widened by this share, far more than their rounding error.
SLACK = 1e-9
TILE = 1024
DEFAULT_BLOCK_ROWS = 32_768
#: For points of at most two dimensions: rows of a block, and the pairs from which sums are not tiled.
FLAT_BLOCK_ROWS, FLAT_PAIRS = 131_072, 1 << 24
#: Rows a cell that cuts are found from, and in all.
CUT_ROWS, CUT_ROWS_ALL = 256, 1 << 18


def needed(X: np.ndarray, lab: np.ndarray, n: np.ndarray, M: np.ndarray, W: np.ndarray) -> np.ndarray:
    """(rows, k) bool: the clusters whose pair sums a row's silhouette needs; none for a row alone in its cluster."""
    used, rows = np.flatnonzero(n > 0), np.arange(len(X))
    square = np.full((len(X), len(n)), np.inf)
    square[:, used] = np.maximum(K.centre_distances(X, M[used]), 0.0)
    lower = np.sqrt(square) * (1 - SLACK)
    upper = np.sqrt(square + (W / np.maximum(n, 1))[None, :]) * (1 + SLACK)
    upper[rows, lab] = np.inf
    out = (lower <= upper.min(axis=1)[:, None]) & (n > 0)[None, :]
    out[rows, lab] = True
    out[n[lab] < 2] = False
    return out


def _count_fn(P: int, k: int, d: int, st: Stats):
    """SIL rows: slot ``p * k + c``, the points that need it in n."""

    def run(batches):
        count = np.zeros(P * k, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                X, sol = K.matrix(b, "x", d), K.matrix(b, "sol", P, np.int64)
                for p in range(P):
                    count[p * k:(p + 1) * k] += needed(X, sol[:, p], st.n[p], st.M[p], st.W[p]).sum(0)
        yield K.sil_part(count, np.zeros(P * k)).batch()

    return run


def need_counts(pts: DataFrame, P: int, k: int, d: int, st: Stats) -> np.ndarray:
    """(P, k): how many points need the pairs with each cluster's members; one pass, P*k sums."""
    found = run_sums(pts.select("x", "sol"), _count_fn(P, k, d, st))
    out = np.zeros(P * k, dtype=np.int64)
    for code, (_, n) in found.items():
        out[code] = n
    return out.reshape(P, k)


def _hashed(row_id: np.ndarray) -> np.ndarray:
    return (row_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _needs(batches, P: int, k: int, d: int, st: Stats, counts: np.ndarray):
    """Per slot and up to 4096 rows: (X, row_id, met, met_code, i, code, own, w): the rows ``met``
    are members of clusters that some point needs; the rows ``i`` need clusters, at the weight of a distance."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            b = whole.slice(at, 4096)
            X, sol = K.matrix(b, "x", d), K.matrix(b, "sol", P, np.int64)
            row_id = b.column(b.schema.get_field_index("row_id")).to_numpy()
            for p in range(P):
                lab = sol[:, p]
                i, c = np.nonzero(needed(X, lab, st.n[p], st.M[p], st.W[p]))
                met = np.flatnonzero(counts[p][lab] > 0)
                own = c == lab[i]
                yield X, row_id, met, p * k + lab[met], i, p * k + c, own, 1.0 / np.maximum(st.n[p][c] - own, 1)


def _deal_fn(P: int, k: int, d: int, st: Stats, counts: np.ndarray, member_blocks: np.ndarray, point_blocks: np.ndarray):
    """Rows (code, member, row_id, own, w, block, others, x): each point as a member of its
    cluster (block of the members, to be met by ``others`` point blocks), and once for
    every cluster it needs (the other way round, with the weight of a distance)."""
    at_members, at_points = member_blocks.ravel(), point_blocks.ravel()

    def run(batches):
        for X, row_id, met, mc, i, c, own, w in _needs(batches, P, k, d, st, counts):
            rows, m = np.concatenate([met, i]), len(met)
            hashed = _hashed(row_id[rows])
            blocks = np.concatenate([at_members[mc], at_points[c]]).astype(np.uint64)
            cols = [
                pa.array(np.concatenate([mc, c]).astype(np.int32)),
                pa.array(np.arange(len(rows)) < m),
                pa.array(row_id[rows]),
                pa.array(np.concatenate([np.zeros(m, bool), own])),
                pa.array(np.concatenate([np.zeros(m), w])),
                pa.array((hashed % blocks).astype(np.int32)),
                pa.array(np.concatenate([at_points[mc], at_members[c]]).astype(np.int32)),
                K.list_array(X[rows], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["code", "member", "row_id", "own", "w", "block", "others", "x"])

    return run


def _meet_fn(d: int):
    def run(table: pa.Table) -> pa.Table:
        b = table.combine_chunks().to_batches()[0]
        member = b.column(b.schema.get_field_index("member")).to_numpy(zero_copy_only=False)
        X = K.matrix(b, "x", d)
        members, points = X[member], np.flatnonzero(~member)
        total = np.zeros(len(points))
        if d <= 2 and len(points) * len(members) >= FLAT_PAIRS and np.isfinite(X).all():
            total = distance_sums(X[points], members)
        else:
            for i in range(0, len(points) if len(members) else 0, TILE):
                for j in range(0, len(members), TILE):
                    total[i:i + TILE] += np.sqrt(np.maximum(K.centre_distances(X[points[i:i + TILE]], members[j:j + TILE]), 0.0)).sum(1)
        t = pa.Table.from_batches([b]).take(pa.array(points))
        mean = total * t.column("w").to_numpy()
        return pa.table([t.column("row_id"), t.column("code"), t.column("own"), pa.array(mean)], names=["row_id", "code", "own", "m"])

    return run


class Cells:
    """Cuts of the plane for a set of points: halved ``levels`` times at the median of a sample's wider side."""

    def __init__(self, sample: np.ndarray, levels: int) -> None:
        self.levels, inner = levels, (1 << levels) - 1
        self.side, self.cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        parts = [sample]
        for node in range(inner):
            part = parts[node]
            if len(part):
                wide = int(np.ptp(part, axis=0).argmax())
                self.side[node], self.cut[node] = wide, np.median(part[:, wide])
            above = part[:, self.side[node]] > self.cut[node]
            parts += [part[~above], part[above]]

    def of(self, X: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(X), np.int64), np.arange(len(X))
        for _ in range(self.levels):
            node = 2 * node + 1 + (X[rows, self.side[node]] > self.cut[node])
        return node - len(self.side)


def _sides(part) -> list[tuple[bool, np.ndarray, np.ndarray]]:
    """(member, rows, codes) of a part of :func:`_needs`, both sides."""
    return [(True, part[2], part[3]), (False, part[4], part[5])]


def _sample_fn(P: int, k: int, d: int, st: Stats, counts: np.ndarray, rate: dict[bool, np.ndarray]):
    """Rows (code, member, x): of each side and code the share ``rate`` by a hash of row_id."""

    def run(batches):
        for part in _needs(batches, P, k, d, st, counts):
            X, row_id = part[:2]
            draw = _hashed(row_id) / float(1 << 32)
            for member, rows, codes in _sides(part):
                some = draw[rows] < rate[member][codes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[some].astype(np.int32)), pa.array(np.full(some.sum(), member)), K.list_array(X[rows[some]], pa.float64())],
                    names=["code", "member", "x"])

    return run


def _cells(cells: dict[tuple[int, bool], Cells], X: np.ndarray, codes: np.ndarray, member: bool) -> np.ndarray:
    out = np.zeros(len(codes), np.int64)
    for code in np.unique(codes).tolist():
        if (code, member) in cells:
            at = codes == code
            out[at] = cells[code, member].of(X[at])
    return out


def _extent_fn(P: int, k: int, d: int, st: Stats, counts: np.ndarray, cells: dict[tuple[int, bool], Cells]):
    """Rows (code, member, cell, n, lo, hi), one a task for each cell it met: its rows and corners."""

    def run(batches):
        found: dict[tuple[int, bool, int], tuple[int, np.ndarray, np.ndarray]] = {}
        for part in _needs(batches, P, k, d, st, counts):
            for member, rows, codes in _sides(part):
                if not len(rows):
                    continue
                cell = _cells(cells, part[0][rows], codes, member)
                order = np.lexsort([cell, codes])
                Y, c, e = part[0][rows[order]], codes[order], cell[order]
                at = np.flatnonzero(np.r_[True, (np.diff(c) != 0) | (np.diff(e) != 0)])
                new = zip(c[at].tolist(), e[at].tolist(), np.diff(np.r_[at, len(c)]).tolist(),
                          np.minimum.reduceat(Y, at), np.maximum.reduceat(Y, at))
                for code, one, n, lo, hi in new:
                    was = found.get((code, member, one))
                    found[code, member, one] = (n, lo, hi) if was is None else (n + was[0], np.minimum(lo, was[1]), np.maximum(hi, was[2]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, t) for v, t in zip(zip(*found), (pa.int32(), pa.bool_(), pa.int32()))),
                 pa.array([v[0] for v in found.values()], pa.int64()),
                 *(K.list_array(np.array([v[i] for v in found.values()]), pa.float64()) for i in (1, 2))],
                names=["code", "member", "cell", "n", "lo", "hi"])

    return run


def _spread_fn(P: int, k: int, d: int, st: Stats, counts: np.ndarray, cells: dict[tuple[int, bool], Cells],
               parts: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]], member: bool):
    """Rows (code, block, x, and of points row_id, own, w): the members or the points in the parts of
    their cells; ``parts``: of each code and side the parts of a cell and those before it."""

    def run(batches):
        for part in _needs(batches, P, k, d, st, counts):
            X, row_id = part[:2]
            _, rows, codes = _sides(part)[not member]
            cell, block = _cells(cells, X[rows], codes, member), np.zeros(len(rows), np.int64)
            for code in np.unique(codes).tolist():
                at = np.flatnonzero(codes == code)
                many, before = parts[code, member]
                block[at] = before[cell[at]] + (_hashed(row_id[rows[at]]) % many[cell[at]].astype(np.uint64)).astype(np.int64)
            cols = [pa.array(codes.astype(np.int32)), pa.array(block.astype(np.int32)), K.list_array(X[rows], pa.float64())]
            more = [] if member else [pa.array(row_id[rows]), pa.array(part[6]), pa.array(part[7])]
            yield pa.RecordBatch.from_arrays(cols + more, names=["code", "block", "x", "row_id", "own", "w"][:3 if member else 6])

    return run


def _send_fn(d: int, seen: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]]):
    """The members of a block -> a row (code, block, y, m) for each block of points: the weighted points
    it sees; ``seen``: of each code the cells of points (first block, blocks, corners)."""

    def run(table: pa.Table) -> pa.Table:
        b = table.combine_chunks().to_batches()[0]
        code = b.column(0)[0].as_py()
        tree = Boxes(flat(K.matrix(b, "x", d)))
        gathered = tree.gathered()
        blocks, ys, ms = [], [], []
        for first, many, lo, hi in seen.get(code, ()):
            y, m = seen_from(tree, gathered, lo, hi)
            for one in range(first, first + many):
                blocks.append(one)
                ys.append(y.ravel())
                ms.append(m)
        lists = [pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, v)]), pa.array(np.concatenate([np.zeros(0), *v]))) for v in (ys, ms)]
        return pa.table([pa.array([code] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()),
                         *(v.cast(pa.list_(pa.float64())) for v in lists)], names=["code", "block", "y", "m"])

    return run


def _gather_fn(d: int):
    """A block of points and what it sees -> the mean distance of each to the members."""

    def run(points: pa.Table, seen: pa.Table) -> pa.Table:
        b = points.combine_chunks().to_batches()
        total = np.zeros(points.num_rows)
        if b and seen.num_rows:
            y, m = (seen.column(c).combine_chunks().flatten().to_numpy() for c in ("y", "m"))
            total = distance_sums(K.matrix(b[0], "x", d), y.reshape(-1, 2), m)
        return pa.table([points.column("row_id"), points.column("code"), points.column("own"),
                         pa.array(total * points.column("w").to_numpy())], names=["row_id", "code", "own", "m"])

    return run


def _cell_sums(pts: DataFrame, P: int, k: int, d: int, st: Stats, counts: np.ndarray, rows: int) -> DataFrame:
    """(row_id, code, own, m): the mean distances over cells of some ``rows`` points of the plane."""
    base = (P, k, d, st, counts)
    size = {True: np.where(counts > 0, st.n, 0).ravel(), False: counts.ravel()}
    levels = {side: np.ceil(np.log2(np.maximum(n, 1) / rows).clip(0)).astype(int) for side, n in size.items()}
    want = {side: np.where(levels[side] > 0, CUT_ROWS << levels[side], 0) for side in size}
    most = min(1.0, CUT_ROWS_ALL / max(1, sum(int(w.sum()) for w in want.values())))
    rate = {side: want[side] * most / np.maximum(size[side], 1) for side in size}
    sample = pts.mapInArrow(_sample_fn(*base, rate), "code int, member boolean, x array<double>").toArrow()
    codes, member = sample.column("code").to_numpy(), sample.column("member").to_numpy()
    X = sample.column("x").combine_chunks().flatten().to_numpy().reshape(-1, d)
    cells = {(code, side): Cells(X[(codes == code) & (member == side)], int(levels[side][code]))
             for side in size for code in np.flatnonzero(levels[side]).tolist()}
    each = pts.mapInArrow(_extent_fn(*base, cells), "code int, member boolean, cell int, n bigint, lo array<double>, hi array<double>")
    corner = [F.array(*(f(F.col(c)[i]) for i in range(d))).alias(c) for c, f in (("lo", F.min), ("hi", F.max))]
    many = {key: np.ones(1 << int(levels[key[1]][key[0]]), np.int64) for key in
            ((code, side) for side in size for code in np.flatnonzero(size[side]).tolist())}
    corners = {}
    for r in each.groupBy("code", "member", "cell").agg(F.sum("n").alias("n"), *corner).collect():
        many[r["code"], r["member"]][r["cell"]] = -(-r["n"] // (2 * rows))  # copies of a point are not cut, but hashed
        corners[r["code"], r["member"], r["cell"]] = [flat(np.array([r[c]]))[0] for c in ("lo", "hi")]
    parts = {key: (n, np.cumsum(n) - n) for key, n in many.items()}
    seen: dict[int, list] = {}
    for (code, side, cell), (lo, hi) in corners.items():
        if not side:
            n, before = parts[code, side]
            seen.setdefault(code, []).append((int(before[cell]), int(n[cell]), lo, hi))
    tasks = {side: int(min(2048, max(1, sum(int(n.sum()) for key, n in many.items() if key[1] == side)))) for side in size}
    members = pts.mapInArrow(_spread_fn(*base, cells, parts, True), "code int, block int, x array<double>")
    sent = members.repartition(tasks[True], "code", "block").groupBy("code", "block").applyInArrow(
        _send_fn(d, seen), "code int, block int, y array<double>, m array<double>").repartition(tasks[False], "code", "block")
    points = pts.mapInArrow(_spread_fn(*base, cells, parts, False),
                            "code int, block int, x array<double>, row_id bigint, own boolean, w double").repartition(tasks[False], "code", "block")
    return points.groupBy("code", "block").cogroup(sent.groupBy("code", "block")).applyInArrow(
        _gather_fn(d), "row_id bigint, code int, own boolean, m double")


def _block_sums(pts: DataFrame, P: int, k: int, d: int, st: Stats, counts: np.ndarray, rows: int) -> DataFrame:
    """(row_id, code, own, m): the mean distances over hashed blocks of up to ``rows`` points."""
    blocks = lambda a: -(-a // rows)
    dealt = pts.mapInArrow(
        _deal_fn(P, k, d, st, counts, np.maximum(blocks(st.n), 1), blocks(counts)),
        "code int, member boolean, row_id bigint, own boolean, w double, block int, others int, x array<double>")
    other = F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other")
    met = dealt.select("code", "member", "row_id", "own", "w", "x", "block", other).select(
        "code", "member", "row_id", "own", "w", "x",
        F.when(F.col("member"), F.col("block")).otherwise(F.col("other")).alias("mb"),
        F.when(F.col("member"), F.col("other")).otherwise(F.col("block")).alias("pb"))
    return met.groupBy("code", "mb", "pb").applyInArrow(_meet_fn(d), "row_id bigint, code int, own boolean, m double")


def pruned_silhouettes(pts: DataFrame, P: int, k: int, d: int, st: Stats, counts: np.ndarray,
                       block_rows: int) -> dict[int, tuple[float, int]]:
    """``{slot: (sum, points)}`` of the exact silhouette of ``pts(row_id, x, sol)``; ``counts`` from :func:`need_counts`."""
    plane = d <= 2 and block_rows == DEFAULT_BLOCK_ROWS
    rows = max(256, min(FLAT_BLOCK_ROWS if plane else block_rows, (64 << 20) // (8 * (d + 8))))
    pts = pts.select(F.col("row_id").cast("long").alias("row_id"), "x", "sol")
    if plane and max(np.where(counts > 0, st.n, 0).max(), counts.max()) > rows:
        sums = _cell_sums(pts, P, k, d, st, counts, rows)
    else:
        sums = _block_sums(pts, P, k, d, st, counts, rows)
    each = sums.repartition("row_id").groupBy("row_id", "code", "own").agg(F.sum("m").alias("m"))
    slot = F.floor(F.col("code") / k).cast("int").alias("slot")
    a, b = F.max(F.when(F.col("own"), F.col("m"))), F.min(F.when(~F.col("own"), F.col("m")))
    point = each.groupBy("row_id", slot).agg(a.alias("a"), b.alias("b")).select(
        "slot", F.when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0).alias("s"))
    found = {r["slot"]: r["s"] for r in point.groupBy("slot").agg(F.sum("s").alias("s")).collect()}
    return {p: (float(found.get(p) or 0.0), int(st.n[p].sum())) for p in range(P)}
