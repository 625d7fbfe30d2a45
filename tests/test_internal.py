"""E5-E7 and A5/A10 on hand fixtures, against NumPy and Spark ML."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import points_1d
from evoclust.operators import internal as I


def one(df):
    return df.collect()[0][0]


def brute_silhouette(X, lab, squared=False):
    X = np.asarray(X, dtype=float)
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    if squared:
        D = D ** 2
    out = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_c2_exact_silhouette_sse_db(spark):
    df = points_1d(spark, [0, 1, 10, 12], clusters=[0, 0, 1, 1])
    assert one(I.silhouette_exact(df)) == pytest.approx(np.mean([10 / 11, 9 / 10, 15 / 19, 19 / 23]))
    assert one(I.sse(df)) == pytest.approx(2.5)
    assert one(I.davies_bouldin(df)) == pytest.approx(1.5 / 10.5)
    sc = {r["c"]: r["scatter"] for r in I.cluster_scatter(df).collect()}
    assert sc == {0: pytest.approx(0.5), 1: pytest.approx(1.0)}


def test_c5_singleton_scores_zero(spark):
    df = points_1d(spark, [0, 1, 9], clusters=[0, 0, 1])
    expected = brute_silhouette([[0], [1], [9]], np.array([0, 0, 1]))
    assert one(I.silhouette_exact(df)) == pytest.approx(expected)


def test_c6_one_cluster_raises(spark):
    df = points_1d(spark, [0, 1, 2], clusters=[0, 0, 0])
    with pytest.raises(ValueError):
        I.silhouette_exact(df)
    with pytest.raises(ValueError):
        I.silhouette_squared(df)


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_exact_silhouette_blocks_match_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(40, 3))
    lab = rng.integers(0, 4, size=40)
    df = points_1d(spark, [list(r) for r in X], clusters=lab, partitions=3)
    got = one(I.silhouette_exact(df, block_rows=block_rows))
    assert got == pytest.approx(brute_silhouette(X, lab), abs=1e-9)


def test_squared_silhouette_matches_spark_ml_and_brute_force(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(50, 4)) + 100.0  # far from the origin: closed form must not cancel
    lab = rng.integers(0, 3, size=50)
    df = points_1d(spark, [list(r) for r in X], clusters=lab, partitions=4)
    got = one(I.silhouette_squared(df))
    ml = ClusteringEvaluator(featuresCol="v", predictionCol="p").evaluate(
        df.withColumn("v", array_to_vector("x")).withColumn("p", F.col("cluster").cast("double"))
    )
    assert got == pytest.approx(ml, abs=1e-9)
    assert got == pytest.approx(brute_silhouette(X, lab, squared=True), abs=1e-9)


def test_far_outlier_does_not_cancel(spark):
    """Two tight clusters and one point at 1e8: SSE and silhouette by plain differences."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.01, 300), rng.normal(1, 0.01, 300), [1e8]])
    lab = np.array([0] * 300 + [1] * 300 + [2])
    df = points_1d(spark, list(x[::-1]), clusters=list(lab[::-1]), partitions=3)
    want = sum(((x[lab == c] - x[lab == c].mean()) ** 2).sum() for c in range(3))
    assert one(I.sse(df)) == pytest.approx(want, rel=1e-9)
    s = []
    for i in range(601):
        d2 = (x - x[i]) ** 2
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d2[own].sum() / (own.sum() - 1)
        b = min(d2[lab == c].mean() for c in range(3) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert one(I.silhouette_squared(df)) == pytest.approx(np.mean(s), rel=1e-9)
    assert one(I.silhouette_exact(df)) > 0.9


def test_exact_silhouette_is_the_same_for_any_blocks(spark):
    rng = np.random.default_rng(1)
    df = points_1d(spark, rng.normal(0, 1, (700, 3)).tolist(), clusters=rng.integers(0, 4, 700).tolist())
    assert one(I.silhouette_exact(df, block_rows=256)) == pytest.approx(one(I.silhouette_exact(df, block_rows=100_000)), abs=1e-12)


def test_coincident_centroids_and_sparse_ids(spark):
    df = points_1d(spark, [-1, 1, -2, 2, 10, 12], clusters=[0, 0, 1, 1, 2, 2])
    # centres 0, 0, 11; scatters 1, 1.5... the coincident pair gives no ratio
    assert one(I.davies_bouldin(df)) == pytest.approx(((1 + 1) / 11 + (2 + 1) / 11 + (2 + 1) / 11) / 3)
    sparse = df.withColumn("cluster", (df["cluster"] * 700_000_000 + 5).cast("int"))
    for f in (I.sse, I.davies_bouldin, I.silhouette_squared, I.silhouette_exact):
        assert one(f(sparse)) == pytest.approx(one(f(df)))


def test_bad_vectors_and_ids_are_errors(spark):
    bad = [[(0, [1.0]), (1, [1.0, 2.0, 3.0])], [(0, [1.0, float("nan")]), (1, [1.0, 2.0])], [(0, [1.0, None]), (1, [1.0, 2.0])]]
    for rows in bad:
        df = spark.createDataFrame([(i, x, i) for i, x in rows], "row_id bigint, x array<double>, cluster int").coalesce(1)
        with pytest.raises(Exception, match="values"):
            I.sse(df).collect()
    twice = spark.createDataFrame([(0, [1.0], 0), (0, [2.0], 1), (1, [3.0], 1)], "row_id bigint, x array<double>, cluster int")
    with pytest.raises(ValueError, match="unique"):
        I.silhouette_exact(twice)


def _brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    out = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_pruned_pairs_give_the_same_silhouette(spark, monkeypatch):
    from evoclust.operators import internal as I

    rng = np.random.default_rng(5)
    X = np.concatenate([rng.normal(c, 1.0, (80, 3)) for c in (0, 4, 8, 40, 44)] + [np.full((3, 3), 90.0), [[70.0, 70, 70]]])
    lab = np.concatenate([np.repeat(np.arange(5), 80), [5, 5, 5, 6]])
    df = spark.createDataFrame([(i, X[i].tolist(), int(lab[i])) for i in range(len(X))], "row_id bigint, x array<double>, cluster int").repartition(4)
    pairs = I.silhouette_pairs(df).first()
    assert pairs["pairs"] == len(X) ** 2 and 0.5 < pairs["skipped"] < 1 and pairs["computed"] > 0
    used = []
    real = I.pruned_silhouettes
    monkeypatch.setattr(I, "pruned_silhouettes", lambda *a: used.append(1) or real(*a))
    want = _brute_silhouette(X, lab)
    got = I.silhouette_exact(df).first()[0]
    assert used and abs(got - want) < 1e-12
    small = I.silhouette_exact(df, block_rows=256).first()[0]
    assert abs(small - want) < 1e-12
    # The block pairs, which serve where little can be skipped, agree.
    monkeypatch.setattr(I, "pair_shares", lambda *a: (1, 1))
    assert abs(I.silhouette_exact(df).first()[0] - want) < 1e-12


def test_blocks_of_pruned_pairs(spark):
    """Many blocks a cluster, two slots of labels in one run."""
    from evoclust.operators import pruned as R
    from evoclust.operators.kernels import KernelSpec
    from evoclust.operators.kmeans import run_stats

    rng = np.random.default_rng(6)
    X = np.concatenate([rng.normal(c, 1.0, (600, 2)) for c in (0, 12)])
    labs = np.stack([np.repeat([0, 1], 600), np.repeat([0, 1, 2, 1], 300)], 1)
    df = spark.createDataFrame([(i, X[i].tolist(), labs[i].tolist()) for i in range(len(X))], "row_id bigint, x array<double>, sol array<int>")
    st = run_stats(df, KernelSpec(2, 3, 2, sol_col="sol"))
    counts = R.need_counts(df, 2, 3, 2, st)
    got = R.pruned_silhouettes(df, 2, 3, 2, st, counts, 256)
    for p in range(2):
        assert abs(got[p][0] / got[p][1] - _brute_silhouette(X, labs[:, p])) < 1e-12
    assert (counts <= len(X)).all() and counts[0, 2] == 0


@pytest.mark.parametrize("shape", ["plane", "line", "copies", "tail", "one box"])
def test_sums_without_all_pairs(shape):
    """Near, far, stretched and equal points: every member counts, up to a share of 1e-9."""
    from evoclust.operators.farfield import distance_sums

    rng = np.random.default_rng(8)
    n = 20_000
    X = {"plane": lambda: np.column_stack([rng.uniform(0, 10, n), rng.integers(0, 60, n) / 10]),
         "line": lambda: rng.normal(0, 1, (n, 1)),
         "copies": lambda: np.repeat(rng.uniform(0, 1, (40, 2)), n // 40, axis=0) * [1, 0],
         "tail": lambda: rng.pareto(0.7, (n, 2)) + 1000,
         "one box": lambda: np.full((n, 2), 3.25)}[shape]()
    Y = np.concatenate([X[: n // 3], X[: n // 7] + 20.0])
    some = rng.integers(0, n, 200)
    want = np.array([np.sqrt(((x - Y) ** 2).sum(1)).sum() for x in X[some]])
    assert np.allclose(distance_sums(X, Y)[some], want, rtol=1e-9, atol=1e-6)
    assert np.allclose(distance_sums(X[:3], Y), [np.sqrt(((x - Y) ** 2).sum(1)).sum() for x in X[:3]], rtol=1e-9, atol=1e-6)
    assert not distance_sums(X[:5], Y[:0]).any() and not len(distance_sums(X[:0], Y))


def test_large_blocks_of_the_plane_are_not_tiled(monkeypatch):
    """A group of many points takes no pass over all of its pairs."""
    import pyarrow as pa

    from evoclust.operators import pruned as R

    rng = np.random.default_rng(9)
    n = 40_000
    X = rng.uniform(0, 5, (n, 2))
    member = np.arange(n) % 2 == 0
    group = pa.table({"code": pa.array(np.zeros(n, np.int32)), "member": pa.array(member), "row_id": pa.array(np.arange(n)),
                      "own": pa.array(np.zeros(n, bool)), "w": pa.array(np.full(n, 2.0 / n)), "x": pa.array(X.tolist())})
    monkeypatch.setattr(R.K, "centre_distances", lambda *a: pytest.fail("all pairs are computed"))
    got = R._meet_fn(2)(group)
    assert got.column("row_id").to_pylist() == np.flatnonzero(~member).tolist()
    for i in range(0, n // 2, 997):
        want = np.sqrt(((X[~member][i] - X[member]) ** 2).sum(1)).mean()
        assert got.column("m")[i].as_py() == pytest.approx(want, rel=1e-9)


def test_members_as_seen_from_afar():
    """Some weighted points stand for the members of a far box, their own points for those that are near."""
    from evoclust.operators import farfield as A

    rng = np.random.default_rng(10)
    n = 20_000
    Y = np.column_stack([rng.uniform(0, 10, n), rng.integers(0, 60, n) / 10])
    tree = A.Boxes(Y)
    gathered = tree.gathered()
    for shift, most in (((0, 0), n + 1024), ((10, 0), n // 2), ((-10, 6), n // 4), ((40, 0), 1024), ((1e6, 1e6), 64)):
        X = Y[:500] + shift
        seen, weight = A.seen_from(tree, gathered, X.min(0), X.max(0))
        assert len(seen) <= most and weight.sum() == pytest.approx(n, rel=1e-12)
        want = [np.sqrt(((x - Y) ** 2).sum(1)).sum() for x in X[::25]]
        assert np.allclose([(np.sqrt(((x - seen) ** 2).sum(1)) * weight).sum() for x in X[::25]], want, rtol=1e-9)
        assert np.allclose(A.distance_sums(X, seen, weight)[::25], want, rtol=1e-9)


@pytest.mark.parametrize("d", [1, 2])
def test_cells_of_the_plane_give_the_same_silhouette(spark, monkeypatch, d):
    """Clusters of many cells, one of them copies of few points; blocks of a cluster do not all meet in full."""
    from evoclust.operators import pruned as R
    from evoclust.operators.kernels import KernelSpec
    from evoclust.operators.kmeans import run_stats

    rng = np.random.default_rng(11)
    X = np.concatenate([rng.normal(c, 1.0, (1500, d)) for c in (0, 12)] + [np.repeat(rng.uniform(30, 31, (3, d)), 500, axis=0), np.full((1, d), 60.0)])
    labs = np.stack([np.r_[np.repeat([0, 1, 2], 1500), 3], np.r_[np.repeat([0, 2, 1, 2, 4, 4], 750), 4]], 1)
    df = spark.createDataFrame([(i, X[i].tolist(), labs[i].tolist()) for i in range(len(X))], "row_id bigint, x array<double>, sol array<int>").repartition(3)
    st = run_stats(df, KernelSpec(2, 5, d, sol_col="sol"))
    counts = R.need_counts(df, 2, 5, d, st)
    monkeypatch.setattr(R, "FLAT_BLOCK_ROWS", 256)
    monkeypatch.setattr(R, "_block_sums", lambda *a: pytest.fail("hashed blocks"))
    got = R.pruned_silhouettes(df, 2, 5, d, st, counts, R.DEFAULT_BLOCK_ROWS)
    for p in range(2):
        assert got[p][1] == len(X) and abs(got[p][0] / got[p][1] - _brute_silhouette(X, labs[:, p])) < 1e-9


def test_ratios_of_many_clusters_are_searched_under_bounds(spark):
    """k = 100,000 centroids: dealt over tasks, most block pairs skipped; equal to all pairs on fewer."""
    rng = np.random.default_rng(7)
    C, S = rng.uniform(0, 100, (3000, 2)), rng.uniform(0.1, 1.0, 3000)
    C[5] = C[6]  # coincident centroids give no ratio
    want = I.worst_ratios(C, S, C, S)
    got, met, every = I.pruned_ratios(spark, C, S)
    assert abs(got - want.sum()) < 1e-9 * want.sum() and met < every / 2
    ones = np.ones(3000, dtype=int)
    assert abs(I.davies_bouldin_value(C, S, ones, spark) - I.davies_bouldin_value(C, S, ones)) < 1e-9
    order = I.near_blocks(C, 256)
    assert sorted(order.tolist()) == list(range(3000))
    C = rng.uniform(0, 1000, (100_000, 2))
    total, met, every = I.pruned_ratios(spark, C, rng.uniform(0.1, 1.0, 100_000))
    assert total > 0 and met < every / 20
