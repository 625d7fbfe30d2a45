"""External quality indices (E1-E4, A7, A8): agreement of a clustering with known labels.

All pair-counting indices come from the contingency cells: one aggregation of
the rows with map-side partials (a label or cluster holding a third of all
rows costs nothing extra), then grouping sets over the cells alone for the
label margins, the cluster margins and the total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contingency(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """Long-form contingency table ``(label, cluster, n)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


def _pairs(cnt: Column) -> Column:
    c = cnt.cast("double")
    return c * (c - 1.0) / 2.0


def pair_counts(df: DataFrame, label: str = "label", cluster: str = "cluster", with_agreement: bool = False) -> DataFrame:
    """One row ``(T, A, B, NP, rows[, agree])``: pairs together in both, in the
    same label, in the same cluster, all pairs, the row count (and the rows
    whose cluster id equals their label id)."""
    cells = contingency(df, label, cluster).select(F.col("label").alias("l"), F.col("cluster").alias("k"), "n")
    g = cells.groupingSets([["l", "k"], ["l"], ["k"], []], "l", "k").agg(
        F.sum("n").alias("cnt"), F.grouping_id().alias("gid"))
    extra = [F.sum(F.when((F.col("gid") == 0) & (F.col("l") == F.col("k")), F.col("cnt")).otherwise(0)).alias("agree")]
    return g.agg(*(extra if with_agreement else []),
        F.sum(F.when(F.col("gid") == 0, _pairs(F.col("cnt")))).alias("T"),
        F.sum(F.when(F.col("gid") == 1, _pairs(F.col("cnt")))).alias("A"),
        F.sum(F.when(F.col("gid") == 2, _pairs(F.col("cnt")))).alias("B"),
        F.max(F.when(F.col("gid") == 3, _pairs(F.col("cnt")))).alias("NP"),
        F.max(F.when(F.col("gid") == 3, F.col("cnt"))).alias("rows"),
    )


def ari_expr(T="T", A="A", B="B", N="NP") -> Column:
    """E2 from pair counts; 1.0 when the denominator vanishes (both partitions trivial and equal)."""
    t, a, b, n = (F.col(c) for c in (T, A, B, N))
    expected = F.when(n > 0, a * b / n).otherwise(F.lit(0.0))
    denom = (a + b) / 2.0 - expected
    return F.when(denom == 0, F.lit(1.0)).otherwise((t - expected) / denom)


def fm_expr(T="T", A="A", B="B") -> Column:
    """T / sqrt(A B); 0 when T = 0."""
    t, a, b = (F.col(c) for c in (T, A, B))
    return F.when(t == 0, F.lit(0.0)).otherwise(t / F.sqrt(a * b))


def pair_jaccard_expr(T="T", A="A", B="B") -> Column:
    """E3 (true pair-counting Jaccard): T / (A + B - T)."""
    t, a, b = (F.col(c) for c in (T, A, B))
    den = a + b - t
    return F.when(den == 0, F.lit(1.0)).otherwise(t / den)


def adjusted_rand(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    return pair_counts(df, label, cluster).select(ari_expr().alias("ari"))


def fowlkes_mallows(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    return pair_counts(df, label, cluster).select(fm_expr().alias("fowlkes_mallows"))


def pair_jaccard(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    return pair_counts(df, label, cluster).select(pair_jaccard_expr().alias("pair_jaccard"))


def label_agreement(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """E3 as the reference reports it: share of rows whose cluster id equals the label id."""
    return df.agg(F.avg((F.col(label) == F.col(cluster)).cast("double")).alias("label_agreement"))


def purity(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """Sum over clusters of the largest label count, divided by n."""
    cells = contingency(df, label, cluster)
    per_cluster = cells.groupBy("cluster").agg(F.max("n").alias("best"), F.sum("n").alias("size"))
    return per_cluster.agg((F.sum("best") / F.sum("size")).alias("purity"))
