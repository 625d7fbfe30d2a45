"""Column expressions on ARRAY<DOUBLE> vectors and seeded per-row randomness.

Everything here is a built-in Spark expression (codegen'd, JVM side).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_dist(x, y) -> Column:
    """squared Euclidean distance of two equal-length arrays."""
    diffs = F.zip_with(_col(x), _col(y), lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def dist(x, y) -> Column:
    """Euclidean distance."""
    return F.sqrt(sq_dist(x, y))


def uniform(seed: int, *tags, row_id="row_id") -> Column:
    """A uniform [0, 1) value that is a pure function of (seed, tags, row_id).

    ``u = first 32 bits of md5("seed|tag...|row_id") / 2^32``.  Unlike
    ``rand()`` it does not change under re-partitioning, task retry or
    executor loss, and SQL engines with ``md5`` give the identical value.
    """
    parts = [F.lit(str(seed))] + [F.lit(str(t)) for t in tags] + [_col(row_id).cast("string")]
    h = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_key(seed: int, *tags, row_id="row_id") -> Column:
    """The first 60 bits of the hash behind :func:`uniform` as a long: the same
    order, and ties in the 32 bits of the draw are all but excluded."""
    parts = [F.lit(str(seed))] + [F.lit(str(t)) for t in tags] + [_col(row_id).cast("string")]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def uniform_scalar(seed: int, *tags) -> float:
    """Driver-side twin of :func:`uniform` for scalar draws (cuts, ranks, fillers)."""
    key = "|".join(str(p) for p in (seed, *tags))
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / 4294967296.0


def uniform_sql(seed: int, *tags, row_id: str = "row_id") -> str:
    """The same value as a DuckDB/ANSI SQL expression (used by the oracles)."""
    prefix = "|".join(str(p) for p in (seed, *tags))
    return (
        f"(('0x' || substr(md5('{prefix}|' || CAST({row_id} AS VARCHAR)), 1, 8))::BIGINT"
        f" / 4294967296.0)"
    )
