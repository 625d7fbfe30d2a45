"""G1-G10, G13-G15, F4, R3-R5 and fixtures C7-C10."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, points_1d
from evoclust.operators.genetic import (
    GeneticKMeans,
    crossover_ranks,
    cut_point,
    family_competition,
    select_survivors,
)
from evoclust.operators.population import (
    child_slot,
    from_labels,
    init_population,
    kmo,
    mutate,
    rescale_fitness,
    rotated_child,
)
from evoclust.plans.catalog import embedding_points


def pop_frame(spark, xs, sols):
    rows = [(i, i, [float(x)], [int(v) for v in s]) for i, (x, s) in enumerate(zip(xs, sols))]
    return spark.createDataFrame(rows, "row_id bigint, pos bigint, x array<double>, sol array<int>").repartition(2)


def test_c7_crossover_children(spark):
    df = pop_frame(spark, range(5), [[0, 1]] * 5)
    out = df.select("pos", child_slot(0, 1, 2).alias("c1"), child_slot(1, 0, 2).alias("c2")).orderBy("pos").collect()
    assert [r["c1"] for r in out] == [0, 0, 1, 1, 1]
    assert [r["c2"] for r in out] == [1, 1, 0, 0, 0]
    rot = rotated_child(df, 0, 1, 2, 5).orderBy("pos").collect()
    assert [r["child"] for r in rot] == [0, 0, 0, 1, 1]


def test_c8_guarded_kmo(spark):
    df = pop_frame(spark, [0, 1, 10, 12], [[0], [0], [1], [1]])
    pop = from_labels(df, np.array([[[0.0], [12.0]]]))
    new, take = kmo(pop, "better")
    assert not take[0]
    assert new.centers[0, :, 0].tolist() == [0.5, 11.0]
    assert new.sse()[0] == pytest.approx(2.5)
    labels = sorted((r["row_id"], r["sol"][0]) for r in new.df.collect())
    assert labels == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_c9_selection():
    fit = [0.9 - 0.1 * i for i in range(10)]
    src = select_survivors(fit, 0.8, seed=0, gen=1)
    assert len(src) == 10
    assert sorted(set(range(8)) - set(src)) == []
    extra = list(src)
    for r in range(8):
        extra.remove(r)
    assert len(extra) == 2 and all(0 <= e <= 4 for e in extra)
    assert [fit[s] for s in src] == sorted((fit[s] for s in src), reverse=True)


def test_c10_rescale():
    assert rescale_fitness([0.9, 0.5], 2.0)[1] == pytest.approx(1.3)


def test_draws_are_valid():
    ranks = crossover_ranks(10, 0.8, 0, 1)
    assert len(ranks) == 8 and len(set(ranks)) == 8 and max(ranks) <= 8
    cuts = [cut_point(50, 0, g, 0) for g in range(100)]
    assert min(cuts) >= 1 and max(cuts) <= 48
    with pytest.raises(ValueError):
        crossover_ranks(10, 1.0, 0, 1)  # Q9: int(Pc*P) > P-1
    assert family_competition([0.1, 0.5, 0.3, 0.5]) == [1, 3]


def test_degenerate_chromosome_fitness_is_minus_one(spark):
    df = pop_frame(spark, [0, 1, 2], [[0, 0], [0, 1], [0, 1]])
    pop = from_labels(df, np.array([[[0.0], [5.0]], [[0.0], [1.5]]]))
    assert pop.fitness[0] == -1.0 and pop.fitness[1] > -1.0


def test_population_and_mutation(spark):
    pts = embedding_points(spark, SF_SMALL, pos=True)
    pop = init_population(pts, 3, 4, seed=2)
    assert pop.n == 500 and pop.stats.n.sum(axis=1).tolist() == [500, 500, 500]
    same = mutate(pop, 0.0, seed=2, gen=1)
    assert (same.stats.n == pop.stats.n).all()
    moved = mutate(pop, 0.3, seed=2, gen=1)
    r = moved.df.select(F.explode("sol").alias("c")).agg(F.min("c"), F.max("c")).collect()[0]
    assert 0 <= r[0] and r[1] < 4
    assert (moved.stats.n != pop.stats.n).any()


@pytest.mark.parametrize("pairing,second", [("disjoint", "aligned"), ("ring", "rotate")])
def test_fit_best_fitness_never_falls(spark, pairing, second):
    pts = embedding_points(spark, SF_SMALL, pos=True)
    ga = GeneticKMeans(population=4, k=5, generations=3, seed=1, pairing=pairing, second_child=second)
    m = ga.fit(pts)
    h = m.fitness_history
    assert all(b >= a - 1e-12 for a, b in zip(h, h[1:]))
    assert len(m.ari_history) == 3 and all(a is not None for a in m.ari_history)
    assert m.labels().count() == 500
    log = m.population_log()
    assert set(r["stage"] for r in log.select("stage").distinct().collect()) == {"init", "selection", "crossover", "kmo"}


def test_fit_options_validated():
    with pytest.raises(ValueError):
        GeneticKMeans(pairing="star")._check()
    with pytest.raises(ValueError):
        GeneticKMeans(population=10, crossover=1.0)._check()


def test_chunked_passes_give_the_same_population(spark, monkeypatch):
    """Above the broadcast bound the slots are split over several passes: same result."""
    from evoclust.operators import kernels as K

    pts = embedding_points(spark, SF_SMALL, pos=True)
    whole = init_population(pts, 3, 4, seed=5)
    w2, wt = kmo(whole, "always", checkpoint=False)
    monkeypatch.setattr(K, "MAX_CLOSURE_BYTES", 2 * 4 * 64 * 8 + 100)  # one or two chromosomes per pass
    parts = init_population(pts, 3, 4, seed=5)
    p2, pt = kmo(parts, "always", checkpoint=False)
    assert np.allclose(whole.fitness, parts.fitness) and np.allclose(w2.fitness, p2.fitness)
    assert (whole.stats.n == parts.stats.n).all() and np.allclose(w2.centers, p2.centers)
    a = sorted((r["row_id"], tuple(r["sol"])) for r in w2.df.select("row_id", "sol").collect())
    b = sorted((r["row_id"], tuple(r["sol"])) for r in p2.df.select("row_id", "sol").collect())
    assert a == b
    monkeypatch.setattr(K, "MAX_CLOSURE_BYTES", 100)  # not even one chromosome fits
    with pytest.raises(ValueError):
        init_population(pts, 3, 4, seed=5)


def test_fused_generations_equal_unfused(spark):
    """The fused generation takes the same decisions as the one with a pass for each step."""
    pts = embedding_points(spark, SF_SMALL, pos=True)
    kw = dict(population=6, k=5, generations=3, seed=4)
    a = GeneticKMeans(fuse=True, **kw).fit(pts)
    b = GeneticKMeans(fuse=False, **kw).fit(pts)
    assert np.allclose(a.fitness_history, b.fitness_history, atol=1e-12)
    assert np.allclose(a.sse_history, b.sse_history, rtol=1e-9)
    assert np.allclose(a.ari_history, b.ari_history, atol=1e-12)
    assert np.allclose(a.population.fitness, b.population.fitness, atol=1e-12)
    la = sorted((r["row_id"], r["cluster"]) for r in a.labels().collect())
    lb = sorted((r["row_id"], r["cluster"]) for r in b.labels().collect())
    assert la == lb


def test_fit_with_exact_fitness(spark):
    """fitness="exact" (E5 as fitness, block pairs) runs end to end and the
    best chromosome's fitness equals the public exact silhouette of its labels."""
    from evoclust.operators.internal import silhouette_exact

    pts = embedding_points(spark, SF_SMALL, pos=True)
    m = GeneticKMeans(population=3, k=4, generations=2, seed=3, fitness="exact", block_rows=128).fit(pts)
    h = m.fitness_history
    assert all(b >= a - 1e-12 for a, b in zip(h, h[1:]))
    lab = m.labels().join(pts.select("row_id", "x"), "row_id")
    assert silhouette_exact(lab).collect()[0][0] == pytest.approx(m.fitness, abs=1e-9)


def test_mutation_keeps_fitness_true(spark):
    """At rate 0.9 every slot's fitness is the silhouette of the labels it holds."""
    from evoclust.operators.genetic import GeneticKMeans
    from evoclust.operators.internal import silhouette_squared

    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.2, (30, 2)) for c in (0, 4, 8)])
    pts = points_1d(spark, x.tolist())
    for gens in (1, 3):
        model = GeneticKMeans(population=4, k=3, generations=gens, mutation_rate=0.9, seed=1).fit(pts)
        for p in range(4):
            held = model.population.df.select("row_id", "x", F.col("sol")[p].alias("cluster"))
            if held.select("cluster").distinct().count() > 1:
                assert model.population.fitness[p] == pytest.approx(silhouette_squared(held).first()[0], abs=1e-9)


def test_fit_above_the_broadcast_bound(spark, monkeypatch):
    """With the bound lowered the fused fit takes the chunked passes and ends in the same place."""
    from evoclust.operators import kernels
    from evoclust.operators.genetic import GeneticKMeans

    rng = np.random.default_rng(2)
    pts = points_1d(spark, rng.normal(0, 1, (60, 3)).tolist())
    make = lambda: GeneticKMeans(population=4, k=3, generations=2, seed=3, fuse=True).fit(pts)
    want = make()
    monkeypatch.setattr(kernels, "MAX_CLOSURE_BYTES", 2 * 3 * 3 * 8)
    got = make()
    assert np.allclose(got.population.fitness, want.population.fitness) and np.allclose(got.centers, want.centers)


def test_seeding_keeps_the_scans_partitions(spark):
    """1,000 partitions: an exchange between the levels, the scan in as many tasks, the same centres."""
    from evoclust.operators.sampling import sample_centers

    pts = spark.range(0, 3000, 1, 1000).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("double")).alias("x"))
    many = sample_centers(pts, 5, seed=3, chrom=[0, 1])
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.count("MapInArrow") == 2 and "REPARTITION_BY_NUM" in plan
    few = sample_centers(pts.coalesce(3), 5, seed=3, chrom=[0, 1])
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))


def test_rotated_children_take_one_join(spark):
    from evoclust.operators.population import rotated_genes

    df = spark.createDataFrame([(i, i, [i, 10 + i]) for i in range(6)], "row_id bigint, pos bigint, sol array<int>")
    cuts = [1, 2, 4, 5]
    got = rotated_genes(df, [(0, 0)] * 4, cuts, 6)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    for r in got.collect():
        assert list(r["_rot"]) == [(r["row_id"] + c) % 6 for c in cuts]


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_points_are_written_once_and_labels_join_without_exchange(spark):
    from evoclust.operators.store import PointStore

    pts = embedding_points(spark, SF_SMALL, pos=True)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = PointStore(pts, buckets=4)
        pop = init_population(pts, 3, 4, seed=5, store=store)
        for step in range(3):
            assert _exchanges(pop.df) == 0 and pop.df.count() == store.n
            # The version's files hold ids and labels, and the next version comes from it without a shuffle.
            assert spark.read.parquet(f"{store.root}/labels_{store.version}").columns == ["row_id", "sol"]
            pop, _ = kmo(pop, "always")
        assert len(store.tables) == 3  # the points and the last two versions
        whole = kmo(kmo(kmo(init_population(pts, 3, 4, seed=5), "always")[0], "always")[0], "always")[0]
        key = lambda df: sorted((r["row_id"], tuple(r["sol"])) for r in df.select("row_id", "sol").collect())
        assert key(pop.df) == key(whole.df)
        store.close()
        assert not store.tables and not spark.sql("SHOW TABLES").where("tableName LIKE 'evoclust_%labels%'").where(
            F.col("tableName").contains(store.root.rsplit("-", 1)[-1])).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(ValueError, match="unique"):
        PointStore(pts.union(pts.limit(1)))


def test_a_fit_keeps_no_copy_of_the_points(spark, tmp_path):
    """Whatever the number of generations, x is in one folder of the store."""
    pts = embedding_points(spark, SF_SMALL, pos=True)
    m = GeneticKMeans(population=4, k=4, generations=3, seed=2).fit(pts)
    import glob

    root = m.population.store.root.removeprefix("file:")
    folders = {f.rsplit("/", 2)[-2] for f in glob.glob(f"{root}/*/*.parquet")}
    assert folders == {"points", "labels_2", "labels_3"}
    assert m.labels().count() == pts.count()
    m.release()
    assert not glob.glob(f"{root}/*")


def test_children_of_children_are_merged_segments(spark):
    from evoclust.operators.population import slots
    from evoclust.operators.segments import Segments, segment_stats

    pts = embedding_points(spark, SF_SMALL, pos=True)
    pop = init_population(pts, 4, 5, seed=3)
    cuts = [100, 300, 100, 37]
    seg = Segments(cuts)
    assert seg.bounds == [37, 100, 300] and seg.S == 4
    moments, e = segment_stats(pop.df, seg, 4, 5, pop.d, pop.centers)
    assert np.allclose(e, pop.stats.E) and np.allclose(moments.merged(seg.own(4)).M, pop.stats.M)
    own = seg.own(4)
    c1 = seg.child(own[0], own[1], 100)
    c2 = seg.child(c1, own[2], 300)  # a child of a child
    c3 = seg.child(own[3], c2, 37)
    assert c3 == [3, 0, 1, 2]
    got = moments.merged([c1, c2, c3])
    rows = sorted(pop.df.select("pos", "x", slots([seg.genes(g) for g in (c1, c2, c3)]).alias("child"), "sol").collect())
    X = np.array([r["x"] for r in rows])
    for i, g in enumerate((c1, c2, c3)):
        lab = np.array([r["sol"][g[int(np.searchsorted(seg.bounds, r["pos"], "right"))]] for r in rows])
        assert [r["child"][i] for r in rows] == lab.tolist()
        for c in range(5):
            part = X[lab == c]
            assert got.n[i, c] == len(part)
            if len(part):
                assert np.allclose(got.M[i, c], part.mean(0)) and np.isclose(got.W[i, c], ((part - part.mean(0)) ** 2).sum())


def test_ring_generation_has_one_statistics_job(spark, monkeypatch):
    from evoclust.operators import genetic as G

    seen = []
    real = G.segment_stats
    monkeypatch.setattr(G, "segment_stats", lambda *a, **k: seen.append(1) or real(*a, **k))
    monkeypatch.setattr(G, "run_stats", lambda *a, **k: seen.append("pair"))
    pts = embedding_points(spark, SF_SMALL, pos=True)
    ga = GeneticKMeans(population=10, k=4, seed=3, pairing="ring")
    pop = init_population(pts, 10, 4, seed=3)
    out = ga.crossover_population(pop, 1)
    assert seen == [1]
    fresh = from_labels(out.df, out.centers)  # the statistics and fitness of what came out, computed anew
    assert np.allclose(fresh.fitness, out.fitness, atol=1e-12) and np.allclose(fresh.stats.M, out.stats.M)


def test_alias_table_draws_in_proportion():
    from evoclust.operators.population import alias_table

    rng = np.random.default_rng(0)
    tables = [[1], [5, 0, 0], [0, 0, 7], [1, 1, 1, 1], [10, 1, 1, 1, 1, 0], [3, 9, 1, 27, 2, 2], list(range(40)), [1, 1, 1, 97],
              *rng.integers(0, 50, (200, 7)).tolist()]
    for sizes in tables:
        n = np.array(sizes)
        if not n.sum():
            continue
        k = len(n)
        prob, alias = alias_table(n)
        share = np.zeros(k)
        np.add.at(share, np.arange(k), prob / k)
        np.add.at(share, alias, (1 - prob) / k)
        assert ((prob >= 0) & (prob <= 1)).all() and np.allclose(share, n / n.sum(), atol=1e-12)


def test_mutation_plan_does_not_grow_with_k(spark):
    from evoclust.operators.population import mutated

    pts = embedding_points(spark, SF_SMALL, pos=True)
    plans = [len(mutated(init_population(pts, 2, k, seed=2), 0.3, 2, 1).select("row_id", "sol")._jdf.queryExecution().optimizedPlan().toString())
             for k in (3, 60)]
    assert abs(plans[0] - plans[1]) < 200


def test_sampling_sends_keys_only(spark):
    from evoclust.operators.sampling import sample_centers

    pts = embedding_points(spark, SF_SMALL).repartition(9)
    drawn = sample_centers(pts, 4, seed=1, chrom=[0, 1], fan_in=3)
    plan = drawn._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    below = text[text.index("Window"):] if "Window" in text else text
    assert "cx" not in below and " x#" not in "\n".join(line for line in below.splitlines() if "MapInArrow" in line or "Repartition" in line)
    assert drawn.count() == 8


def test_rotation_sends_one_gene_a_pair(spark):
    from evoclust.operators.population import rotated_genes

    pts = embedding_points(spark, SF_SMALL, pos=True)
    pop = init_population(pts, 4, 5, seed=3)
    n, pairs, cuts = pop.n, [(0, 1), (2, 3)], [7, 450]
    genes = rotated_genes(pop.df, pairs, cuts, n)
    assert genes.columns == ["row_id", "_rot"]
    sol = {r["pos"]: r["sol"] for r in pop.df.select("pos", "sol").collect()}
    got = {r["pos"]: r["_rot"] for r in pop.df.join(genes, "row_id").select("pos", "_rot").collect()}
    for i, ((a, b), cut) in enumerate(zip(pairs, cuts)):
        child = [sol[p][a] for p in range(cut, n)] + [sol[p][b] for p in range(cut)]
        assert [got[p][i] for p in range(n)] == child
