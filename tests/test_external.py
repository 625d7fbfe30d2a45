"""E1-E4 on the hand fixture C1 and invariance properties."""

import math

import pytest

from conftest import points_1d
from evoclust.operators import external as X

LABELS = [0, 0, 1, 1, 2, 2]
CLUSTERS = [0, 0, 1, 2, 2, 2]


@pytest.fixture()
def c1(spark):
    return points_1d(spark, range(6), clusters=CLUSTERS, labels=LABELS)


def one(df):
    return df.collect()[0][0]


def test_pair_counts_c1(c1):
    r = X.pair_counts(c1).collect()[0]
    assert (r["T"], r["A"], r["B"], r["rows"]) == (2, 3, 4, 6)


def test_indices_c1(c1):
    assert one(X.purity(c1)) == pytest.approx(5 / 6)
    assert one(X.label_agreement(c1)) == pytest.approx(5 / 6)
    assert one(X.adjusted_rand(c1)) == pytest.approx(4 / 9)
    assert one(X.fowlkes_mallows(c1)) == pytest.approx(2 / math.sqrt(12))
    assert one(X.pair_jaccard(c1)) == pytest.approx(2 / 5)


def test_contingency_c1(c1):
    cells = {(r["label"], r["cluster"]): r["n"] for r in X.contingency(c1).collect()}
    assert cells == {(0, 0): 2, (1, 1): 1, (1, 2): 1, (2, 2): 2}


def test_permuting_cluster_ids(spark):
    perm = {0: 2, 1: 0, 2: 1}
    a = points_1d(spark, range(6), clusters=CLUSTERS, labels=LABELS)
    b = points_1d(spark, range(6), clusters=[perm[c] for c in CLUSTERS], labels=LABELS)
    for f in (X.adjusted_rand, X.fowlkes_mallows, X.purity, X.pair_jaccard):
        assert one(f(a)) == pytest.approx(one(f(b)))
    assert one(X.label_agreement(a)) != pytest.approx(one(X.label_agreement(b)))


def test_ari_identical_trivial_partitions(spark):
    df = points_1d(spark, range(4), clusters=[0, 0, 0, 0], labels=[0, 0, 0, 0])
    assert one(X.adjusted_rand(df)) == 1.0


def test_ari_matches_brute_force(spark):
    import random

    rnd = random.Random(3)
    labels = [rnd.randrange(4) for _ in range(60)]
    clusters = [rnd.randrange(5) for _ in range(60)]
    df = points_1d(spark, range(60), clusters=clusters, labels=labels, partitions=5)
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60)]
    same_l = [labels[i] == labels[j] for i, j in pairs]
    same_c = [clusters[i] == clusters[j] for i, j in pairs]
    T = sum(a and b for a, b in zip(same_l, same_c))
    A, B, N = sum(same_l), sum(same_c), len(pairs)
    E = A * B / N
    assert one(X.adjusted_rand(df)) == pytest.approx((T - E) / ((A + B) / 2 - E))
    assert one(X.pair_jaccard(df)) == pytest.approx(T / (A + B - T))
