"""Lloyd passes with carried triangle bounds.

Each point carries its label and a lower bound of its distance to every other
centre.  When centres move, the bound falls by the largest move of another
centre; while the distance to the own centre stays below it, the label cannot
change and the other k - 1 distances are not computed.  A row whose bound is
crossed, or lies within rounding error, is labelled anew by the full kernel, so labels and ties are
those of a full pass.

A pass reads the points joined with the carried columns (bucketed alike, no
Exchange) and writes one table: the next carried columns and, beside them, the
task's statistics rows.  What a pass costs besides the points is 20 bytes a row.
``row_id`` is a whole number here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evoclust.operators import kernels as K
from evoclust.operators.kmeans import Stats, merge_parts, read_parts
from evoclust.operators.store import PointStore

#: Kind of a carried row; ``K.STATS`` and ``K.SIL`` (distances computed, in n) are the others.
CARRIED = 2
PASS_SCHEMA = "row_id bigint, lab int, low double, " + K.PART_SCHEMA
#: A bound must win by this share, far more than its rounding error.
SLACK = 1e-9


def other_moves(moves: np.ndarray) -> np.ndarray:
    """(k,) the largest move of a centre other than c."""
    k = len(moves)
    if k < 2:
        return np.zeros(k)
    order = np.argsort(moves)
    out = np.full(k, moves[order[-1]])
    out[order[-1]] = moves[order[-2]]
    return out


def bounded_pass_fn(C: np.ndarray, moves: np.ndarray | None):
    """One pass; ``moves``: how far each centre went since the carried columns were written (None: there are none)."""
    k, d = C.shape
    fall = None if moves is None else other_moves(moves)
    names = ["row_id", "lab", "low", "kind", "chrom", "c", "part", "n", "w", "e", "mean"]

    def rows(parts: K.Parts) -> pa.RecordBatch:
        b = parts.batch()
        none = [pa.nulls(len(parts), t) for t in (pa.int64(), pa.int32(), pa.float64())]
        return pa.RecordBatch.from_arrays([*none, *b.columns], names=names)

    def carried(row_id, lab, low) -> pa.RecordBatch:
        m = len(lab)
        empty = [pa.nulls(m, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays([row_id, pa.array(lab.astype(np.int32)), pa.array(low),
                                           pa.array(np.full(m, CARRIED, np.int32)), *empty], names=names)

    def run(batches):
        acc, computed, seen = K.Moments(1, k, d), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            X = K.matrix(b, "x", d)
            if fall is None:
                lab, e, low = K.nearest_two(X, C)
                computed += len(X) * k
            else:
                lab = b.column(b.schema.get_field_index("lab")).to_numpy().astype(np.int32).copy()
                low = b.column(b.schema.get_field_index("low")).to_numpy() - fall[lab]
                e = K.own_distances(X, C, lab)
                computed += len(X)
                crossed = np.flatnonzero(~(np.sqrt(e) * (1 + SLACK) < low * (1 - SLACK)))
                if len(crossed):
                    lab[crossed], e[crossed], low[crossed] = K.nearest_two(X[crossed], C)
                    computed += len(crossed) * (k - 1)
            seen += len(X)
            acc.add(0, lab, X, e)
            yield carried(b.column(b.schema.get_field_index("row_id")).cast(pa.int64()), lab, low)
        count = K.sil_part(np.array([computed]), np.array([float(seen)]), d)
        yield rows(K.Parts.concat([acc.part(), count]))

    return run


class BoundedLloyd:
    """The state of a fit: the stored points and the carried columns of the last pass."""

    def __init__(self, points: DataFrame):
        self.store = PointStore(points.select("row_id", "x"))
        self.frame: DataFrame | None = None
        self.last: np.ndarray | None = None

    def step(self, C: np.ndarray) -> tuple[Stats, int]:
        """(statistics of the nearest-centre labels, distances computed)."""
        k, d = C.shape
        K.check_broadcast(C)
        moves = None if self.last is None else np.sqrt(((C - self.last) ** 2).sum(axis=1))
        frame = self.store.points if self.frame is None else self.frame
        self.frame, table = self.store.commit_pass(frame.mapInArrow(bounded_pass_fn(C, moves), PASS_SCHEMA), CARRIED, ["lab", "low"])
        self.last = C.copy()
        parts = table.where(F.col("kind") != CARRIED).select("kind", "chrom", "c", "part", "n", "w", "e", "mean")
        st, counts = read_parts(merge_parts(parts, self.store.buckets, k + 1, d).toArrow(), 1, k, d)
        return st, counts[0][1] if counts else 0

    def close(self) -> None:
        self.store.close()
