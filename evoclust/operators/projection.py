"""Label centres and the 2-D PCA projection of points and centres."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evoclust.operators.kmeans import array_means


def label_centers(points: DataFrame, label: str = "label") -> DataFrame:
    """A4: mean point per true label ``(label, center)``; rows without a label are one group."""
    return array_means(points, label).select(F.col("key").alias("label"), "center")


def project(points: DataFrame, centers=None, label_centres: DataFrame | None = None, k: int = 2,
            cluster: str | None = "cluster") -> DataFrame:
    """Fit mean-centring + PCA(k) on the points (Spark ML: the covariance is a
    distributed Gramian, d x d on the driver) and project points, final centres and
    label centres into one table ``(kind, id, pc1..pck, label, cluster)``.

    Spark's ``PCAModel.transform`` does not centre, so the fitted scaler is
    applied first; each component's sign is fixed so its largest loading is positive.
    """
    vec = points.withColumn("v", array_to_vector("x"))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="v", outputCol="vc").fit(vec)
    pca = PCA(k=k, inputCol="vc", outputCol="pc").fit(scaler.transform(vec))
    comps = pca.pc.toArray()  # (d, k)
    sign = np.sign(comps[np.abs(comps).argmax(axis=0), range(k)])
    sign[sign == 0] = 1.0
    signs = F.array(*[F.lit(float(s)) for s in sign])

    def proj(df: DataFrame, kind: str, id_col, lab, clu) -> DataFrame:
        v = df.withColumn("v", array_to_vector("x"))
        p = pca.transform(scaler.transform(v)).withColumn("pc", vector_to_array("pc"))
        pcs = [(F.col("pc")[i] * signs[i]).alias(f"pc{i + 1}") for i in range(k)]
        return p.select(F.lit(kind).alias("kind"), F.col(id_col).cast("bigint").alias("id"), *pcs,
                        lab.cast("int").alias("label"), clu.cast("int").alias("cluster"))

    spark = points.sparkSession
    lab = F.col("label") if "label" in points.columns else F.lit(None)
    clu = F.col(cluster) if cluster and cluster in points.columns else F.lit(None)
    out = proj(points, "point", "row_id", lab, clu)
    if centers is not None:
        C = np.asarray(centers, dtype=np.float64)
        cdf = spark.createDataFrame([(int(c), [float(v) for v in C[c]]) for c in range(C.shape[0])], "c int, x array<double>")
        out = out.unionByName(proj(cdf, "center", "c", F.lit(None), F.col("c")))
    if label_centres is not None:
        ldf = label_centres.select("label", F.col("center").alias("x"))
        out = out.unionByName(proj(ldf, "label_center", "label", F.col("label"), F.lit(None)))
    return out
