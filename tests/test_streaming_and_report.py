"""K8 on a stream, E8 report, D1 projection."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, points_1d
from evoclust.operators.projection import label_centers, project
from evoclust.operators.report import evaluate, format_report, write_report
from evoclust.plans.catalog import embedding_points
from evoclust.streaming import assign_stream


def test_assign_stream_memory_sink(spark, tmp_path):
    src = os.path.join(str(tmp_path), "in")
    points_1d(spark, [0, 1, 10, 12]).select("row_id", "x").write.parquet(src)
    stream = spark.readStream.schema("row_id bigint, x array<double>").parquet(src)
    q = assign_stream(stream, np.array([[0.5], [11.0]])).writeStream.format("memory").queryName("scored").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["row_id"], r["cluster"]) for r in spark.sql("SELECT * FROM scored").collect())
    assert got == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_report(spark, tmp_path):
    df = points_1d(spark, [0, 1, 10, 12], clusters=[0, 0, 1, 1], labels=[0, 0, 1, 1])
    m = evaluate(df, silhouette="exact", time_ms=1.5)
    vals = {r["metric"]: r["value"] for r in m.collect()}
    assert vals["ari"] == 1.0 and vals["label_agreement"] == 1.0 and vals["sse"] == pytest.approx(2.5)
    assert vals["davies_bouldin"] == pytest.approx(1.5 / 10.5)
    text = format_report(m)
    assert text.splitlines()[0] == "Final SSE: 2.5" and "Jaccard Index: 1.0" in text
    out = os.path.join(str(tmp_path), "report")
    write_report(m, out)
    assert spark.read.text(out).count() == len(text.splitlines())


def test_projection(spark):
    pts = embedding_points(spark, SF_SMALL)
    C = np.zeros((2, 64))
    proj = project(pts.withColumn("cluster", F.lit(0)), centers=C, label_centres=label_centers(pts))
    kinds = {r["kind"]: r["count"] for r in proj.groupBy("kind").count().collect()}
    assert kinds == {"point": 500, "center": 2, "label_center": 10}
    # the projected points are centred
    m = proj.filter("kind = 'point'").agg(F.avg("pc1"), F.avg("pc2")).collect()[0]
    assert abs(m[0]) < 1e-9 and abs(m[1]) < 1e-9


def test_projection_matches_numpy_eigen(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(60, 3)) @ np.array([[3.0, 0.5, 0.1], [0.0, 1.0, 0.3], [0.0, 0.0, 0.2]]) + 50.0
    rows = [(i, [float(v) for v in X[i]]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, x array<double>").repartition(3)
    C = X[:2]
    got = project(df, centers=C)
    Xc = X - X.mean(axis=0)
    w, V = np.linalg.eigh(np.cov(Xc.T))
    V = V[:, np.argsort(w)[::-1][:2]]
    V = V * np.sign(V[np.abs(V).argmax(axis=0), range(2)])
    pts = {r["id"]: (r["pc1"], r["pc2"]) for r in got.filter("kind = 'point'").collect()}
    cen = {r["id"]: (r["pc1"], r["pc2"]) for r in got.filter("kind = 'center'").collect()}
    assert np.allclose([pts[i] for i in range(60)], Xc @ V, atol=1e-8)
    assert np.allclose([cen[i] for i in range(2)], (C - X.mean(axis=0)) @ V, atol=1e-8)
