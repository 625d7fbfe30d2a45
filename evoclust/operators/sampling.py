"""Seeded choice of k distinct rows as initial centres.

Each chromosome ``chrom`` ranks rows by ``u(seed, tag, chrom, row_id)`` (R0)
and keeps the k smallest: a per-partition top-k of keys, merged level by level,
never a sort of the table.  Vectors stay where they are until the k x P rows are
known, and are fetched by one join on their ids.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evoclust.functions.vector import uniform_key
from evoclust.operators import kernels as K


def sample_centers(points: DataFrame, k: int, seed: int = 0, chrom: int | list[int] = 0, tag: str = "init",
                   fan_in: int = 256) -> DataFrame:
    """Initial centres ``(chrom, c, row_id, cx)``; ``c`` numbers the draws in order.

    One pass for all chromosomes: the JVM computes the P hash draws per row, a
    kernel keeps the keys of each chromosome's k smallest in every input
    partition, and levels of at most ``fan_in`` of those partitions merge them
    again, each level behind an exchange of P x k keys a partition, so the scan
    keeps all its tasks.  A window over the survivors picks the final k, whose
    vectors one join fetches (a broadcast of 12 bytes a centre, size-checked).
    Equal 32-bit draws are ordered by the rest of the same hash.
    """
    chroms = [chrom] if isinstance(chrom, int) else list(chrom)
    P = len(chroms)
    us = F.array(*[uniform_key(seed, tag, ch) for ch in chroms]).alias("u")
    keys = points.select(F.col("row_id").cast("bigint").alias("row_id"), us).mapInArrow(K.top_k_fn(P, k), K.KEY_SCHEMA)
    # tree merge: no task ever sees more than fan_in x P x k keys
    parts = points.rdd.getNumPartitions()
    while parts > fan_in:
        parts = -(-parts // fan_in)
        keys = keys.repartition(parts, F.xxhash64("row_id", "chrom")).mapInArrow(K.merge_top_k_fn(k), K.KEY_SCHEMA)
    w = Window.partitionBy("chrom").orderBy("u", "row_id")
    ids = F.array(*[F.lit(ch) for ch in chroms])
    drawn = keys.withColumn("c", (F.row_number().over(w) - 1).cast("int")).where(F.col("c") < k).select(
        ids[F.col("chrom")].cast("int").alias("chrom"), "c", F.col("row_id").alias("drawn"))
    if P * k * 32 <= K.MAX_CLOSURE_BYTES:
        drawn = F.broadcast(drawn)
    rows = points.select(F.col("row_id").cast("bigint").alias("row_id"), F.col("x").cast("array<double>").alias("cx"))
    return rows.join(drawn, F.col("row_id") == F.col("drawn")).select("chrom", "c", "row_id", "cx")


def centers_array(centers: DataFrame, P: int, k: int, d: int) -> np.ndarray:
    """Collect a ``(chrom, c, cx)`` table of at most P*k rows into ``(P, k, d)``."""
    out = np.full((P, k, d), np.nan)
    rows = centers.select("chrom", "c", "cx").collect()
    if len(rows) > P * k:
        raise ValueError("centre table is larger than P*k")
    for r in rows:
        out[r["chrom"], r["c"]] = np.asarray(r["cx"], dtype=np.float64)
    if np.isnan(out).any():
        raise ValueError("fewer distinct rows than clusters: cannot draw k centres")
    return out
