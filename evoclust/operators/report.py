"""The quality report as a metrics table and its text/JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import numpy as np

from evoclust.operators.external import ari_expr, fm_expr, pair_counts, pair_jaccard_expr
from evoclust.operators.fused import scatter_and_silhouette_fn
from evoclust.operators.internal import (
    davies_bouldin_value,
    dense_clusters,
    label_stats,
    labelled,
    scatter_stats,
    silhouette_exact,
)
from evoclust.operators.kmeans import run_parts

# Report lines in the reference's order and wording.
REPORT_LINES = (
    ("sse", "Final SSE: "),
    ("time_ms", "Spend Time: "),
    (None, "[External Index]"),
    ("ari", "Adjusted Rand Index: "),
    ("label_agreement", "Jaccard Index: "),
    ("fowlkes_mallows", "Fowlkes Mallows Index: "),
    (None, "[Internal Index]"),
    ("silhouette_exact", "Silhouette Index: "),
    ("silhouette_squared", "Silhouette Index (squared): "),
    ("davies_bouldin", "Davies Bouldin Index:"),
)


def evaluate(df: DataFrame, label: str = "label", cluster: str = "cluster", silhouette: str = "squared",
             time_ms: float | None = None, with_sse: bool = True) -> DataFrame:
    """``metrics(metric, kind, value)`` for a labelled clustering ``(row_id, x, label, cluster)``.

    Passes: one grouping-sets aggregation for every external index (label
    agreement included), one statistics pass (SSE in closed form, centroids),
    one scatter pass (Davies-Bouldin) and one silhouette pass.  The silhouette
    is named after its metric: ``silhouette_squared`` (default) or, with
    ``silhouette="exact"``, the Euclidean ``silhouette_exact`` of the reference's
    report line.  Q12: ``kind`` says external / internal.
    """
    spark = df.sparkSession
    pc = pair_counts(df, label, cluster, with_agreement=True).select(
        ari_expr().alias("ari"), F.col("agree") / F.col("rows"), fm_expr().alias("fm"), pair_jaccard_expr().alias("pj")
    ).first()
    # sparse ids are numbered for the internal indices; the external ones keep them
    df = dense_clusters(df, cluster)
    if silhouette == "exact":
        st, scatter = scatter_stats(df, cluster)
        sil = silhouette_exact(df, cluster).first()[0]
    else:
        # statistics pass, then scatter and squared silhouette in one more pass
        st, k, d = label_stats(df, cluster)
        if (st.n[0] > 0).sum() < 2:
            raise ValueError("silhouette needs at least 2 non-empty clusters")
        fn = scatter_and_silhouette_fn(k, d, st.n[0], st.M[0], st.W[0])
        part, sums = run_parts(labelled(df, cluster), fn, 1, k, d)
        scatter = part.E[0] / np.maximum(st.n[0], 1)
        sil = sums[0][0] / sums[0][1]
    rows = [
        ("ari", "external", float(pc[0])),
        ("label_agreement", "external", float(pc[1])),
        ("fowlkes_mallows", "external", float(pc[2])),
        ("pair_jaccard", "external", float(pc[3])),
        (f"silhouette_{silhouette}", "internal", float(sil)),
        ("davies_bouldin", "internal", davies_bouldin_value(st.M[0], scatter, st.n[0], spark)),
    ]
    if with_sse:
        rows.append(("sse", "internal", float(st.sse_to_means()[0])))
    if time_ms is not None:
        rows.append(("time_ms", "run", float(time_ms)))
    return spark.createDataFrame(rows, "metric string, kind string, value double")


def format_report(metrics: DataFrame) -> str:
    """The reference's text layout from a (tiny) metrics table."""
    vals = {r["metric"]: r["value"] for r in metrics.collect()}
    out = []
    for key, text in REPORT_LINES:
        if key is None:
            out.append(text)
        elif key in vals:
            out.append(f"{text}{vals[key]}")
    return "\n".join(out)


def write_report(metrics: DataFrame, path: str, fmt: str = "text") -> None:
    """Overwrite ``path`` with the report (one small file)."""
    spark = metrics.sparkSession
    if fmt == "json":
        metrics.coalesce(1).write.mode("overwrite").json(path)
        return
    lines = format_report(metrics).split("\n")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
