"""K1-K8, J1, J4, A1-A3, A11 and Q1/Q2/Q3."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, points_1d
from evoclust.operators.kmeans import KMeansLloyd, assign, center_shift, cluster_stats, own_center_distance
from evoclust.plans.catalog import embedding_points


def test_c3_tie_goes_to_lowest_id(spark):
    df = points_1d(spark, [1])
    r = assign(df, np.array([[0.0], [2.0]])).collect()[0]
    assert r["cluster"] == 0 and r["d2"] == 1.0


def test_c4_empty_cluster_keeps_centre(spark):
    df = points_1d(spark, [0, 1])
    m = KMeansLloyd(k=3, n_iter=2, init_centers=np.array([[0.0], [1.0], [100.0]])).fit(df)
    assert m.centers[:, 0].tolist() == [0.0, 1.0, 100.0]


def test_sse_history_not_increasing_and_partition_invariant(spark):
    pts = embedding_points(spark, SF_SMALL)
    a = KMeansLloyd(k=5, n_iter=4, seed=3).fit(pts)
    b = KMeansLloyd(k=5, n_iter=4, seed=3).fit(pts.repartition(3))
    assert all(x >= y - 1e-9 for x, y in zip(a.sse_history, a.sse_history[1:]))
    assert np.allclose(a.centers, b.centers)
    assert len(a.center_history) == 5 and np.allclose(a.center_history[-1], a.centers)
    # Q2: the model SSE redraws labels with the final centres
    assert a.sse(pts) <= a.sse_history[-1] + 1e-9


def test_predict_and_own_centre_distance(spark):
    df = points_1d(spark, [0, 1, 10, 12])
    C = np.array([[0.5], [11.0]])
    out = assign(df, C)
    assert sorted((r["row_id"], r["cluster"]) for r in out.collect()) == [(0, 0), (1, 0), (2, 1), (3, 1)]
    cen = spark.createDataFrame([(0, [0.5]), (1, [11.0])], "c int, cx array<double>")
    d = own_center_distance(out.drop("d2"), cen).agg(F.sum("d2")).collect()[0][0]
    assert d == pytest.approx(2.5)


def test_cluster_stats_and_shift(spark):
    df = points_1d(spark, [0, 1, 10, 12], clusters=[0, 0, 1, 1])
    st = {r["c"]: (r["n"], r["center"][0]) for r in cluster_stats(df).collect()}
    assert st == {0: (2, 0.5), 1: (2, 11.0)}
    old = spark.createDataFrame([(0, [0.0]), (1, [12.0])], "c int, cx array<double>")
    new = spark.createDataFrame([(0, [0.5]), (1, [11.0])], "c int, cx array<double>")
    assert center_shift(old, new).collect()[0][0] == pytest.approx(1.25)


def test_labels_in_range(spark):
    pts = embedding_points(spark, SF_SMALL)
    m = KMeansLloyd(k=7, n_iter=2, seed=1).fit(pts)
    r = m.transform(pts).agg(F.min("cluster"), F.max("cluster")).collect()[0]
    assert 0 <= r[0] and r[1] < 7


def test_sample_tree_merge_equals_direct(spark):
    from evoclust.operators.sampling import sample_centers

    pts = embedding_points(spark, SF_SMALL).repartition(40)
    direct = sorted(tuple(r) for r in sample_centers(pts, 6, 9, [0, 1]).select("chrom", "c", "row_id").collect())
    tree = sorted(tuple(r) for r in sample_centers(pts, 6, 9, [0, 1], fan_in=3).select("chrom", "c", "row_id").collect())
    assert direct == tree and len(direct) == 12


def test_agrees_with_spark_ml_on_separated_blobs(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from evoclust.operators.external import adjusted_rand

    rng = np.random.default_rng(2)
    centres = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [10.0, 10.0]])
    X = np.concatenate([c + rng.normal(scale=0.5, size=(50, 2)) for c in centres])
    rows = [(i, [float(v) for v in X[i]]) for i in range(len(X))]
    pts = spark.createDataFrame(rows, "row_id bigint, x array<double>").repartition(4)
    ours = KMeansLloyd(k=4, n_iter=10, seed=1).fit(pts).transform(pts).select("row_id", "cluster")
    ml = KMeans(k=4, seed=1, featuresCol="v", predictionCol="label").fit(pts.withColumn("v", array_to_vector("x")))
    theirs = ml.transform(pts.withColumn("v", array_to_vector("x"))).select("row_id", F.col("label").cast("int"))
    both = ours.join(theirs, "row_id")
    assert adjusted_rand(both).collect()[0][0] == pytest.approx(1.0)


def test_fast_nearest_equals_exact_difference_sums():
    from evoclust.operators.kernels import nearest, sq_dists

    rng = np.random.default_rng(1)
    for trial in range(60):
        n, d, k = 500, int(rng.integers(1, 70)), int(rng.integers(2, 30))
        scale = 10.0 ** int(rng.integers(-3, 6))
        X = rng.normal(size=(n, d)) * scale + rng.normal() * scale * 10
        C = X[rng.integers(0, n, size=k)]
        X[:20] = C[rng.integers(0, k, 20)]  # exact hits and ties
        lab, e = nearest(X, C)
        D = sq_dists(X, C)
        assert (lab == np.argmin(D, axis=1)).all()
        assert np.allclose(e, D[np.arange(n), lab], rtol=1e-12, atol=0)


def test_centres_above_the_bound_use_blocks(spark, monkeypatch):
    """k x d over the broadcast bound: chained centre blocks give the same fit."""
    from evoclust.operators import kernels as K

    pts = embedding_points(spark, SF_SMALL)
    whole = KMeansLloyd(k=12, n_iter=3, seed=6).fit(pts)
    a = sorted((r["row_id"], r["cluster"], round(r["d2"], 12)) for r in whole.transform(pts).collect())
    monkeypatch.setattr(K, "MAX_CLOSURE_BYTES", 5 * 64 * 8)  # five centres per pass
    blocks = KMeansLloyd(k=12, n_iter=3, seed=6).fit(pts)
    b = sorted((r["row_id"], r["cluster"], round(r["d2"], 12)) for r in blocks.transform(pts).collect())
    assert np.allclose(whole.centers, blocks.centers) and np.allclose(whole.sse_history, blocks.sse_history)
    assert a == b
    assert blocks.sse(pts) == pytest.approx(whole.sse(pts))


def test_own_center_join_above_the_bound(spark, monkeypatch):
    """The salted shuffle join gives what the broadcast gives."""
    from evoclust.operators import kernels

    df = points_1d(spark, [0, 1, 2, 10, 11], clusters=[0, 0, 0, 0, 1])
    cen = spark.createDataFrame([(0, [1.0]), (1, [10.0])], "c int, cx array<double>")
    want = sorted((r["row_id"], r["d2"]) for r in own_center_distance(df, cen).collect())
    monkeypatch.setattr(kernels, "MAX_CLOSURE_BYTES", 1)
    assert sorted((r["row_id"], r["d2"]) for r in own_center_distance(df, cen).collect()) == want


def test_merge_is_independent_of_partitions(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(0, 1, (500, 2)) + 1e6).tolist()
    runs = [KMeansLloyd(k=4, n_iter=3, seed=1).fit(points_1d(spark, x, partitions=p)) for p in (1, 7)]
    assert np.allclose(runs[0].centers, runs[1].centers, rtol=1e-12) and np.allclose(runs[0].sse_history, runs[1].sse_history, rtol=1e-9)


def test_array_means_plan_does_not_grow_with_the_dimension(spark):
    from evoclust.operators.projection import label_centers

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 400)) + 1e4
    df = spark.createDataFrame([(i, v.tolist(), i % 3 if i % 7 else None) for i, v in enumerate(x)],
                               "row_id long, x array<double>, label int").repartition(5)
    got = {r["label"]: r["center"] for r in label_centers(df).collect()}
    lab = np.array([i % 3 if i % 7 else -1 for i in range(300)])
    for key in (0, 1, 2, None):
        assert np.allclose(got[key], x[lab == (-1 if key is None else key)].mean(0))
    assert len(label_centers(df)._jdf.queryExecution().optimizedPlan().toString()) < 5000


def test_parts_merge_in_a_tree_like_one_pass(spark, monkeypatch):
    from evoclust.operators import kernels as K
    from evoclust.operators import kmeans as M

    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3)) * 0.01 + 1e6  # far from the origin
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, x array<double>").repartition(30)
    C = x[:4]
    want = M.run_stats(pts.coalesce(1), K.KernelSpec(1, 4, 3, centers=C[None]))
    monkeypatch.setattr(K, "FAN_IN", 3)
    for most in (16 << 20, 0):  # the driver merges the last level, or a level leaves a row for each cluster
        monkeypatch.setattr(M, "DRIVER_BYTES", most)
        assert M.merge_levels(30, 5, 3) == ([10, 4, 2] if most else [10, 4, 2, 1])
        got = M.run_stats(pts, K.KernelSpec(1, 4, 3, centers=C[None]))
        assert (got.n == want.n).all() and np.allclose(got.M, want.M, rtol=1e-14)
        assert np.allclose(got.W, want.W, rtol=1e-6) and np.allclose(got.E, want.E, rtol=1e-9)
    parts = pts.mapInArrow(K.partial_stats_fn(K.KernelSpec(1, 4, 3, centers=C[None])), K.PART_SCHEMA)
    assert parts.count() <= 30 * 4  # a row for each task and cluster
    merged = M.merge_parts(parts, 30, 5, 3)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and merged.count() <= 2 * 4


def test_more_clusters_than_a_task_can_hold(spark, monkeypatch):
    from evoclust.operators import kernels as K
    from evoclust.operators import kmeans as M

    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, x array<double>").repartition(6)
    C = x[:200]
    want = M.stats_by_centres(pts, C)
    monkeypatch.setattr(K, "MAX_CLOSURE_BYTES", 60 * 2 * 8)  # four blocks of centres
    monkeypatch.setattr(K.sparse_stats_fn, "__defaults__", (2000,))  # rows leave the task early
    got = M.stats_by_centres(pts, C)
    assert (got.n == want.n).all() and np.allclose(got.M, want.M) and np.allclose(got.W, want.W) and np.allclose(got.E, want.E)


def test_carried_bounds_equal_full_passes(spark):
    from evoclust.operators.bounded import BoundedLloyd
    from evoclust.operators.kmeans import stats_by_centres

    rng = np.random.default_rng(3)
    k = 12
    x = np.concatenate([rng.normal(3 * i, 1.0, (100, 2)) for i in range(k)] + [np.zeros((20, 2))])  # repeated rows: ties
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, x array<double>").repartition(4)
    full = KMeansLloyd(k=k, n_iter=10, seed=1).fit(pts)
    fast = KMeansLloyd(k=k, n_iter=10, seed=1, bounds=True).fit(pts)
    assert np.allclose(fast.centers, full.centers, rtol=1e-12, atol=1e-12)
    assert np.allclose(fast.sse_history, full.sse_history, rtol=1e-12)
    n = len(x)
    assert len(fast.distances) == 10 and fast.distances[0] == n * k
    assert all(n <= c <= n * k for c in fast.distances) and fast.distances[-1] < n * k / 2
    # labels after each step, and no exchange between points and carried columns
    state, C = BoundedLloyd(pts), full.initial_centers
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for t in range(10):
            st, _ = state.step(C)
            want = {r["row_id"]: r["cluster"] for r in assign(pts, C).collect()}
            assert {r["row_id"]: r["lab"] for r in state.frame.select("row_id", "lab").collect()} == want
            assert "Exchange" not in state.frame._jdf.queryExecution().executedPlan().toString()
            assert (st.n == stats_by_centres(pts, C).n).all()
            C = st.means(C[None])[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        state.close()


def test_bounds_with_one_cluster_and_coinciding_centres(spark):
    pts = points_1d(spark, [0.0, 1.0, 2.0, 9.0]).select("row_id", "x")
    for init in ([[1.0]], [[0.0], [0.0], [9.0]]):
        a = KMeansLloyd(k=len(init), n_iter=4, init_centers=np.array(init)).fit(pts)
        b = KMeansLloyd(k=len(init), n_iter=4, init_centers=np.array(init), bounds=True).fit(pts)
        assert np.array_equal(a.centers, b.centers) and a.sse_history == b.sse_history
