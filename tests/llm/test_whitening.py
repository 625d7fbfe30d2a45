"""Whitening against numpy on exact integers."""

import numpy as np
import pytest

from evoclust.llm import whitening as W

SF = "/root/testdata/sf0.001"


def brute(vectors):
    """(n, deviations, eigenvalues, components, whitened) of the integer vectors."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return n, ((n * x - s) ** 2).sum(1), e[::-1], u[:, ::-1], centred @ u[:, ::-1]


def check(rows, ids, vectors):
    n, deviation, e, _, coordinates = brute(vectors)
    k = min(32, int((e > 1e-12 * e.sum()).sum()))
    assert len(rows) == n * k
    got = np.array([[r["whitened"] for r in sorted(rows, key=lambda r: (r["vec_id"], r["component"]))]]).reshape(n, k)
    want = (coordinates[:, :k] / np.sqrt(e[:k]))[np.argsort(ids)]
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-8)
    assert np.abs(got.T @ got / n - np.eye(k)).max() < 1e-8
    by_id = dict(zip(ids, deviation.tolist()))
    assert all(r["deviation"] == by_id[r["vec_id"]] and r["n"] == n and r["identity_error"] < 1e-8 for r in rows)
    assert np.allclose([r["explained"] for r in rows], [(e / e.sum())[r["component"] - 1] for r in rows], rtol=1e-9)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = W.op12_whitening(spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    check(got.collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    good = rng.normal(size=(300, 5))
    good[:, 4] = 3.0  # a constant dimension: four components
    good[7] = good[8]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(good)]
    bad = [None, [], [None] * 5, [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf")] * 5, [0.0, 0.0, -float("inf"), 0.0, 0.0]]
    df = spark.createDataFrame([*rows, *((1000 + i, v, 1) for i, v in enumerate(bad))], "vec_id long, embedding array<double>, n int")
    got = W.whitened(df, W.fit(df.repartition(7))).collect()
    check(got, list(range(300)), good)
    null_key = spark.createDataFrame([(None, [0.0, 1.0]), (None, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(str(r["vec_id"]) for r in W.whitened(null_key, W.fit(null_key)).collect()) == ["3", "None", "None"]


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (1, [0.5, 0.25])]):
        df = spark.createDataFrame(rows, schema)
        assert W.whitened(df, W.fit(df)).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        W.fit(spark.createDataFrame([(1, [0.5]), (2, [0.5, 1.0])], schema))
    with pytest.raises(ValueError, match="beyond"):
        W.fit(spark.createDataFrame([(1, [1e30]), (2, [0.5])], schema))


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for high, rows in ((2, 1), (2, 200), (2 ** 7, 1000), (2 ** 30, 3000)):
        y = rng.integers(0, high, (rows, 4))
        y[:, 1] = high - 1
        lo, hi = W.scatter(y, np.array([max(1, (high - 1).bit_length())] * 4))
        want = y.astype(object).T @ y.astype(object)
        assert all(int(lo[i, j]) + (int(hi[i, j]) << 32) == want[i, j] for i in range(4) for j in range(i, 4))


def test_tree_of_many_tasks(spark):
    x = np.random.default_rng(2).integers(-100, 100, (500, 3)) / 64
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(40)
    low, bits = np.array([-100] * 3), np.array([8] * 3)
    z = df.select(W.integers(W.F.col("embedding")).alias("z"))
    one = W.tree_sums(z.mapInArrow(W.partial(W._sums, low=low, bits=bits), W._SUMS), fan=3).collect()
    y = np.floor(x * 64).astype(int) + 100
    assert len(one) == 1 and one[0]["n"] == 500 and list(one[0]["s"]) == y.sum(0).tolist()
    assert [a + (b << 32) for a, b in zip(one[0]["lo"], one[0]["hi"])] == (y.T @ y)[np.triu_indices(3)].tolist()


def test_deviation_beyond_64_bits():
    y = np.array([[0], [2 ** 29]])
    model = W.Whitening(2 * 10 ** 6, np.array([0]), [10 ** 6 * 2 ** 29], [10 ** 6 * 2 ** 58])
    deviation, white = model.apply(y)
    assert deviation == [(10 ** 6 * 2 ** 29) ** 2] * 2
    assert np.allclose(np.abs(white), 1)
