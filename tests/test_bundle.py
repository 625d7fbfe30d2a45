"""Saved fits: written, read in another session, same labels; a half-written version is not seen."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from evoclust import GeneticKMeans, KMeansLloyd
from evoclust.operators.bundle import GeneticBundle, load_model, save_model
from evoclust.plans.catalog import embedding_points
from evoclust.streaming.predict import assign_stream


def labels(df):
    return {r["row_id"]: r["cluster"] for r in df.select("row_id", "cluster").collect()}


def test_kmeans_bundle(spark, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    pts = embedding_points(spark, SF_SMALL)
    first, second = (KMeansLloyd(k=4, n_iter=3, seed=s).fit(pts) for s in (1, 2))
    assert save_model(first, spark, path) == 1 and save_model(second, spark, path) == 2
    other = spark.newSession()
    got = load_model(other, path)
    for a, b in ((got, second), (load_model(other, path, 1), first)):
        assert np.array_equal(a.centers, b.centers) and np.array_equal(a.initial_centers, b.initial_centers)
        assert a.sse_history == b.sse_history and a.shift_history == b.shift_history
        assert all(np.array_equal(x, y) for x, y in zip(a.center_history, b.center_history, strict=True))
        assert labels(a.transform(embedding_points(other, SF_SMALL))) == labels(b.transform(pts))
    # a writer that dies before its manifest leaves the last version as it is
    os.makedirs(f"{path}/version-dead/centers")
    open(f"{path}/.manifest-dead", "w").close()
    assert np.array_equal(load_model(other, path).centers, second.centers)
    with pytest.raises(FileNotFoundError):
        load_model(other, path, 3)


def test_loaded_centres_label_a_stream(spark, tmp_path):
    path, source = str(tmp_path / "model"), str(tmp_path / "in")
    pts = embedding_points(spark, SF_SMALL).select("row_id", "x")
    model = KMeansLloyd(k=4, n_iter=2, seed=1).fit(pts)
    save_model(model, spark, path)
    pts.write.parquet(source)
    stream = spark.readStream.schema(pts.schema).parquet(source)
    q = assign_stream(stream, load_model(spark, path).centers).writeStream.format("memory").queryName("bundle_stream").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "ckpt")).start()
    q.awaitTermination(120)
    assert labels(spark.table("bundle_stream")) == labels(model.transform(pts))


def test_genetic_bundle(spark, tmp_path):
    path = str(tmp_path / "model")
    pts = embedding_points(spark, SF_SMALL, pos=True)
    model = GeneticKMeans(population=4, k=4, generations=2, seed=3).fit(pts)
    want = labels(model.labels())
    save_model(model, spark, path)
    model.release()  # the bundle does not need the fit's tables
    got = load_model(spark.newSession(), path)
    assert isinstance(got, GeneticBundle) and labels(got.labels()) == want
    assert np.array_equal(got.centers, model.centers) and got.fitness == model.fitness and got.sse == model.sse
    assert got.fitness_history == model.fitness_history and got.ari_history == model.ari_history
    assert sorted(got.log) == sorted(model.log)
    assert got.transform(pts).select(F.max("cluster")).first()[0] <= 3
