"""The registered queries: one per operator of the inventory, each reading the
given tables whole and returning a DataFrame (the SQL twins are in
:mod:`evoclust.plans.oracle`).  Every float leaves rounded to 6 digits and
every integer as BIGINT, so the two sides compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evoclust.operators import external as X
from evoclust.operators import internal as I
from evoclust.operators.genetic import GeneticKMeans, cut_point, family_competition, select_survivors
from evoclust.operators.kmeans import KMeansLloyd, assign, own_center_distance
from evoclust.operators.population import (
    child_slot,
    cluster_sizes,
    evaluate_slots,
    init_population,
    kmo,
    mutate,
    rescale_fitness,
    rotated_child,
)
from evoclust.operators.projection import label_centers, project
from evoclust.operators.report import evaluate, write_report
from evoclust.operators.sampling import centers_array, sample_centers
from evoclust.plans.params import ITERS, K, MUT_RATE, OFFSET, P, SEED
from evoclust.session import ensure_checkpoint_dir
from evoclust.sources.points import (
    drop_feature,
    parse_vector,
    points_by_position,
    points_from_array,
    points_from_columns,
    read_abalone,
    read_iris,
    read_named_csv,
    read_numeric_csv,
    recode,
    with_pos,
)


def _r(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _b(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embedding_points(spark: SparkSession, sf_dir: str, pos: bool = False) -> DataFrame:
    pts = points_from_array(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return with_pos(pts) if pos else pts


def _centres0(pts: DataFrame) -> np.ndarray:
    d = len(pts.select("x").first()["x"])
    return centers_array(sample_centers(pts, K, SEED, 0), 1, K, d)[0]


def _assigned(spark, sf_dir) -> DataFrame:
    pts = embedding_points(spark, sf_dir)
    return assign(pts, _centres0(pts))


def _long_centres(spark: SparkSession, C: np.ndarray, it: int | None = None) -> DataFrame:
    rows = [(int(c), int(j), float(C[c, j])) for c in range(C.shape[0]) for j in range(C.shape[1])]
    df = spark.createDataFrame(rows, "c bigint, j bigint, v double").select("c", "j", _r("v").alias("v"))
    return df if it is None else df.select(F.lit(it).cast("bigint").alias("iter"), "c", "j", "v")


def _fit(spark, sf_dir, iters=ITERS, init=None):
    pts = embedding_points(spark, sf_dir)
    return pts, KMeansLloyd(k=K, n_iter=iters, seed=SEED, init_centers=init).fit(pts)


# ------------------------------------------------------------------ sources / projections

def s_points_from_columns(spark, sf_dir):
    pts = with_pos(points_from_columns(_table(spark, sf_dir, "part"), "p_partkey", ["p_size", "p_retailprice"]))
    return pts.select("row_id", _b("pos").alias("pos"), F.col("x")[0].alias("x0"), F.col("x")[1].alias("x1"))


def s_parse_vector_text(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer")
    text = cust.select("c_custkey", F.concat_ws(",", F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")).alias("line"))
    v = text.select(F.col("c_custkey").alias("row_id"), parse_vector("line").alias("x"))
    return v.select("row_id", _r(F.col("x")[0]).alias("x0"), F.col("x")[1].alias("x1"))


def p_recode_label(spark, sf_dir):
    emb = _table(spark, sf_dir, "embeddings")
    return emb.groupBy(_b(recode("label", {9: 8})).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def p_nominal_code(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer")
    seg = cust.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    # alphabetical rank over the table of distinct values, one row each
    return seg.select("segment", _b(F.row_number().over(Window.orderBy("segment")) - 1).alias("code"), "n")


def p_drop_feature(spark, sf_dir):
    pts = points_from_columns(_table(spark, sf_dir, "part"), "p_partkey", ["p_size", "p_retailprice"])
    out = drop_feature(pts, 0)
    return out.select("row_id", _b(F.size("x")).alias("n_features"), F.col("x")[0].alias("x0"))


def r_sample_centers(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    return sample_centers(pts, K, SEED, [0, 1, 2]).select(_b("chrom").alias("chrom"), _b("c").alias("c"), "row_id")


# ------------------------------------------------------------------ k-means

def j1_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).select("row_id", _b("cluster").alias("cluster"), _r("d2").alias("d2"))


def j4_own_center_distance(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    C = _centres0(pts)
    cen = spark.createDataFrame([(c, [float(v) for v in C[c]]) for c in range(K)], "c int, cx array<double>")
    own = own_center_distance(pts.withColumn("cluster", F.col("label")), cen)
    return own.select("row_id", _r("d2").alias("d2"))


def k_one_step_centers(spark, sf_dir):
    _, m = _fit(spark, sf_dir, iters=1)
    return _long_centres(spark, m.centers)


def k_fit_3_iterations(spark, sf_dir):
    pts, m = _fit(spark, sf_dir)
    return m.transform(pts).groupBy(_b("cluster").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), _r(F.sum("d2")).alias("sse")
    )


def k_predict(spark, sf_dir):
    pts, m = _fit(spark, sf_dir)
    return m.transform(pts).select("row_id", _b("cluster").alias("cluster"))


def k_sse_history(spark, sf_dir):
    _, m = _fit(spark, sf_dir)
    return m.history().select(_b("iter").alias("iter"), _r("sse").alias("sse"))


def k_center_history(spark, sf_dir):
    _, m = _fit(spark, sf_dir)
    parts = [_long_centres(spark, C, it) for it, C in enumerate(m.center_history)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def a11_center_shift(spark, sf_dir):
    _, m = _fit(spark, sf_dir)
    return m.history().select(_b("iter").alias("iter"), _r("shift").alias("shift"))


def k_empty_cluster_keeps_center(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    C = _centres0(pts).copy()
    C[K - 1] += 100.0
    m = KMeansLloyd(k=K, n_iter=2, seed=SEED, init_centers=C).fit(pts)
    return _long_centres(spark, m.centers)


def a4_label_centers(spark, sf_dir):
    lc = label_centers(embedding_points(spark, sf_dir))
    return lc.select(_b("label").alias("label"), F.posexplode("center").alias("j", "v")).select(
        "label", _b("j").alias("j"), _r("v").alias("v")
    )


# ------------------------------------------------------------------ indices

def a7_contingency(spark, sf_dir):
    ct = X.contingency(_assigned(spark, sf_dir))
    return ct.select(_b("label").alias("label"), _b("cluster").alias("cluster"), "n")


def e1_purity(spark, sf_dir):
    return X.purity(_assigned(spark, sf_dir)).select(_r("purity").alias("purity"))


def e2_ari(spark, sf_dir):
    return X.adjusted_rand(_assigned(spark, sf_dir)).select(_r("ari").alias("ari"))


def e3_label_agreement(spark, sf_dir):
    return X.label_agreement(_assigned(spark, sf_dir)).select(_r("label_agreement").alias("label_agreement"))


def e3_pair_jaccard(spark, sf_dir):
    return X.pair_jaccard(_assigned(spark, sf_dir)).select(_r("pair_jaccard").alias("pair_jaccard"))


def e4_fowlkes_mallows(spark, sf_dir):
    return X.fowlkes_mallows(_assigned(spark, sf_dir)).select(_r("fowlkes_mallows").alias("fowlkes_mallows"))


def e5_silhouette_exact(spark, sf_dir):
    return I.silhouette_exact(_assigned(spark, sf_dir)).select(_r("silhouette_exact").alias("silhouette_exact"))


def _price_bands(spark, sf_dir) -> DataFrame:
    """``events`` by value and minute of the hour, clustered by tens of the value (most points far from most clusters)."""
    ev = _table(spark, sf_dir, "events")
    band = F.least(F.floor(F.col("value") / 10), F.lit(12)).cast("int")
    minute = F.minute("ts").cast("double") / 10
    pts = points_from_columns(ev.withColumn("minute", minute).withColumn("band", band), "event_id", ["value", "minute"], "band")
    return pts.withColumnRenamed("label", "cluster")


def e5_silhouette_pruned(spark, sf_dir):
    """10,000 points at sf0.01 whose bounds skip most pairs."""
    return I.silhouette_exact(_price_bands(spark, sf_dir)).select(_r("silhouette_exact").alias("silhouette_exact"))


def e6_silhouette_squared(spark, sf_dir):
    return I.silhouette_squared(_assigned(spark, sf_dir)).select(_r("silhouette_squared").alias("silhouette_squared"))


def e7_davies_bouldin(spark, sf_dir):
    return I.davies_bouldin(_assigned(spark, sf_dir)).select(_r("davies_bouldin").alias("davies_bouldin"))


def e8_report(spark, sf_dir):
    m = evaluate(_assigned(spark, sf_dir))
    return m.select("metric", "kind", _r("value").alias("value"))


# ------------------------------------------------------------------ population

def _population(spark, sf_dir):
    return init_population(embedding_points(spark, sf_dir, pos=True), P, K, SEED)


def g1_population_init(spark, sf_dir):
    pop = _population(spark, sf_dir)
    return pop.df.select("row_id", F.posexplode("sol").alias("chrom", "cluster")).select(
        _b("chrom").alias("chrom"), "row_id", _b("cluster").alias("cluster")
    )


def a6_cluster_sizes(spark, sf_dir):
    pop = _population(spark, sf_dir)
    return cluster_sizes(pop).select(_b("chrom").alias("chrom"), _b("c").alias("c"), "n")


def _per_chrom(spark, values, name) -> DataFrame:
    rows = [(int(p), float(v)) for p, v in enumerate(values)]
    return spark.createDataFrame(rows, f"chrom bigint, {name} double").select("chrom", _r(name).alias(name))


def g3_population_fitness(spark, sf_dir):
    return _per_chrom(spark, _population(spark, sf_dir).fitness, "fitness")


def g4_population_sse(spark, sf_dir):
    return _per_chrom(spark, _population(spark, sf_dir).sse(), "sse")


def f4_fitness_rescale(spark, sf_dir):
    return _per_chrom(spark, rescale_fitness(_population(spark, sf_dir).fitness, 2.0), "value")


def g5_selection(spark, sf_dir):
    pop = _population(spark, sf_dir)
    src = select_survivors(pop.fitness, 0.8, SEED, 1)
    rows = [(slot, int(s), float(pop.fitness[s])) for slot, s in enumerate(src)]
    df = spark.createDataFrame(rows, "slot bigint, chrom bigint, fitness double")
    return df.select("slot", "chrom", _r("fitness").alias("fitness"))


def g7_crossover_children(spark, sf_dir):
    pop = _population(spark, sf_dir)
    cut = cut_point(pop.n, SEED, 1, 0)
    return pop.df.select("row_id", _b(child_slot(0, 1, cut)).alias("child1"), _b(child_slot(1, 0, cut)).alias("child2"))


def g7_crossover_rotated(spark, sf_dir):
    pop = _population(spark, sf_dir)
    cut = cut_point(pop.n, SEED, 1, 0)
    return rotated_child(pop.df, 0, 1, cut, pop.n).select("row_id", _b("child").alias("child"))


def g7_family_competition(spark, sf_dir):
    pop = _population(spark, sf_dir)
    cut = cut_point(pop.n, SEED, 1, 0)
    _, fit = evaluate_slots(pop.df, [child_slot(0, 1, cut), child_slot(1, 0, cut)], K, pop.d)
    fits = [pop.fitness[0], pop.fitness[1], fit[0], fit[1]]
    rows = [(place, int(w), float(fits[w])) for place, w in enumerate(family_competition(fits))]
    df = spark.createDataFrame(rows, "place bigint, candidate bigint, fitness double")
    return df.select("place", "candidate", _r("fitness").alias("fitness"))


def g8_mutation(spark, sf_dir):
    pop = mutate(_population(spark, sf_dir), MUT_RATE, SEED, 1)
    return pop.df.select("row_id", F.posexplode("sol").alias("chrom", "cluster")).select(
        _b("chrom").alias("chrom"), "row_id", _b("cluster").alias("cluster")
    )


def _kmo_twice(spark, sf_dir, accept):
    pop = _population(spark, sf_dir)
    pop, _ = kmo(pop, accept)
    pop, take = kmo(pop, accept)
    rows = [(p, bool(take[p]), float(pop.fitness[p]), float(pop.sse()[p])) for p in range(pop.P)]
    df = spark.createDataFrame(rows, "chrom bigint, accepted boolean, fitness double, sse double")
    return df.select("chrom", "accepted", _r("fitness").alias("fitness"), _r("sse").alias("sse"))


def g9_kmo_guarded(spark, sf_dir):
    return _kmo_twice(spark, sf_dir, "better")


def g10_kmo_always(spark, sf_dir):
    return _kmo_twice(spark, sf_dir, "always")


# ------------------------------------------------------------------ rows-only

def d1_pca_2d(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    C = _centres0(pts)
    a = assign(pts, C)
    return project(a, centers=C, label_centres=label_centers(pts))


def d1_pca_part(spark, sf_dir):
    pts = points_from_columns(_table(spark, sf_dir, "part"), "p_partkey", ["p_size", "p_retailprice"])
    return project(pts).select("id", F.round("pc1", 3).alias("pc1"), F.round("pc2", 3).alias("pc2"))


def _history(spark, sf_dir, generations, **options):
    pts = embedding_points(spark, sf_dir, pos=True)
    model = GeneticKMeans(population=P, k=K, generations=generations, seed=SEED, **options).fit(pts)
    model.release()  # the history is all that is asked for
    return model.history().select(_b("gen").alias("gen"), _r("fitness").alias("fitness"), _r("sse").alias("sse"), _r("ari").alias("ari"))


def g11_fit(spark, sf_dir):
    return _history(spark, sf_dir, 3)


def g11_fit_one_generation(spark, sf_dir):
    return _history(spark, sf_dir, 1)


def g11_fit_mutation(spark, sf_dir):
    return _history(spark, sf_dir, 2, mutation_rate=MUT_RATE)


def g11_fit_always(spark, sf_dir):
    return _history(spark, sf_dir, 2, kmo="always")


def g6_crossover_ring(spark, sf_dir):
    pop = _population(spark, sf_dir)
    pop = pop.take(select_survivors(pop.fitness, 0.8, SEED, 1))
    crossed = GeneticKMeans(population=P, k=K, seed=SEED, pairing="ring").crossover_population(pop, 1)
    return _per_chrom(spark, crossed.fitness, "fitness")


def g15_population_log(spark, sf_dir):
    model = GeneticKMeans(population=P, k=K, generations=1, seed=SEED).fit(embedding_points(spark, sf_dir, pos=True))
    model.release()
    return model.population_log().select(_b("gen").alias("gen"), "stage", _b("chrom").alias("chrom"), _r("fitness").alias("fitness"))


def g3_fitness_exact(spark, sf_dir):
    pop = init_population(embedding_points(spark, sf_dir, pos=True), P, K, SEED, kind="exact")
    return _per_chrom(spark, pop.fitness, "fitness")


def e8_report_exact(spark, sf_dir):
    m = evaluate(_assigned(spark, sf_dir), silhouette="exact")
    return m.select("metric", "kind", _r("value").alias("value"))


def _off_centre(spark, sf_dir) -> DataFrame:
    """``part`` far from the origin, with a small cluster far from all others."""
    part = _table(spark, sf_dir, "part").withColumn(
        "cluster", F.when(F.col("p_partkey") % 997 == 1, 3).otherwise(F.col("p_size") % 3))
    price = F.col("p_retailprice") + F.lit(OFFSET)
    part = part.withColumn("a", F.when(F.col("cluster") == 3, price * 100).otherwise(price))
    return points_from_columns(part.withColumn("label", F.col("cluster")), "p_partkey", ["a", "p_size"], "label").withColumnRenamed(
        "label", "cluster")


def a5_sse_offset(spark, sf_dir):
    return I.sse(_off_centre(spark, sf_dir)).select(F.round("sse", 3).alias("sse"))


def e6_silhouette_offset(spark, sf_dir):
    return I.silhouette_squared(_off_centre(spark, sf_dir)).select(_r("silhouette_squared").alias("silhouette_squared"))


def s_points_by_position(spark, sf_dir):
    pts = points_by_position(_table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return pts.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("n_pos"), F.min("pos").alias("first"),
                   F.max("pos").alias("last"), F.round(F.sum(F.col("x")[0]), 2).alias("quantity"))


def g13_fit_defaults(spark, sf_dir):
    """One generation with the default parameters: 10 chromosomes, 3 clusters, rates 0.8."""
    model = GeneticKMeans(generations=1, seed=SEED).fit(embedding_points(spark, sf_dir, pos=True))
    model.release()
    return model.history().select(_b("gen").alias("gen"), _r("fitness").alias("fitness"), _r("sse").alias("sse"), _r("ari").alias("ari"))


def g6_crossover_ring_p10(spark, sf_dir):
    """Eight pairs on the ring, each with what the one before left, in the default population."""
    ga = GeneticKMeans(seed=SEED, pairing="ring")
    pop = init_population(embedding_points(spark, sf_dir, pos=True), ga.population, ga.k, SEED)
    pop = pop.take(select_survivors(pop.fitness, ga.survival, SEED, 1))
    return _per_chrom(spark, ga.crossover_population(pop, 1).fitness, "fitness")


def g11_fit_parity(spark, sf_dir):
    """Two generations with a rotated second child and drawn child centres."""
    return _history(spark, sf_dir, 2, second_child="rotate", child_centers="random")


def d2_projection(spark, sf_dir):
    """Points, final centres and label centres in one projected table."""
    part = _table(spark, sf_dir, "part").withColumn("lab", F.col("p_size") % 3)
    pts = points_from_columns(part, "p_partkey", ["p_size", "p_retailprice"], "lab")
    C = [r["center"] for r in label_centers(pts.withColumn("label", (F.col("x")[0] % 4).cast("int"))).orderBy("label").collect()]
    out = project(pts, centers=np.array(C), label_centres=label_centers(pts))
    return out.select("kind", _b("id").alias("id"), F.round("pc1", 3).alias("pc1"), F.round("pc2", 3).alias("pc2"))


def _written(df: DataFrame, header: bool = False) -> str:
    """The folder of a driver table written as CSV to the checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    df.write.csv(path, header=header)
    return path


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as points (value, minute of the hour / 10), labelled by their type in alphabetical order."""
    types = F.array(*(F.lit(t) for t in ("click", "error", "purchase", "signup", "view")))
    ev = _table(spark, sf_dir, "events").withColumn("minute", F.minute("ts").cast("double") / 10).withColumn(
        "type", (F.array_position(types, F.col("event_type")) - 1).cast("int"))
    return points_from_columns(ev, "event_id", ["value", "minute"], "type")


def k_fit_3_iterations_events(spark, sf_dir):
    pts = event_points(spark, sf_dir)
    m = KMeansLloyd(k=K, n_iter=ITERS, seed=SEED).fit(pts)
    return m.transform(pts).groupBy(_b("cluster").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), _r(F.sum("d2")).alias("sse"))


def _events_history(spark, sf_dir, **options):
    m = KMeansLloyd(k=K, n_iter=ITERS, seed=SEED, **options).fit(event_points(spark, sf_dir))
    return m.history().select(_b("iter").alias("iter"), _r("sse").alias("sse"))


def k_sse_history_events(spark, sf_dir):
    return _events_history(spark, sf_dir)


def k_bounds_events(spark, sf_dir):
    """The same history from a fit that carries triangle bounds."""
    return _events_history(spark, sf_dir, bounds=True)


def _events_assigned(spark, sf_dir) -> DataFrame:
    pts = event_points(spark, sf_dir)
    return assign(pts, _centres0(pts))


def j1_assign_events(spark, sf_dir):
    return _events_assigned(spark, sf_dir).select("row_id", _b("cluster").alias("cluster"), _r("d2").alias("d2"))


def e2_ari_events(spark, sf_dir):
    return X.adjusted_rand(_events_assigned(spark, sf_dir)).select(_r("ari").alias("ari"))


def e7_davies_bouldin_events(spark, sf_dir):
    return I.davies_bouldin(_events_assigned(spark, sf_dir)).select(_r("davies_bouldin").alias("davies_bouldin"))


def a4_label_centers_events(spark, sf_dir):
    lc = label_centers(event_points(spark, sf_dir))
    return lc.select(_b("label").alias("label"), F.posexplode("center").alias("j", "v")).select(
        "label", _b("j").alias("j"), _r("v").alias("v"))


def r_sample_centers_events(spark, sf_dir):
    drawn = sample_centers(event_points(spark, sf_dir), K, SEED, [0, 1, 2])
    return drawn.select(_b("chrom").alias("chrom"), _b("c").alias("c"), "row_id")


def s1_numeric_csv(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    pts = read_numeric_csv(spark, _written(part))
    return pts.select(*(F.col("x")[i].alias(f"x{i}") for i in range(3)))


def s2_named_csv(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    pts = read_named_csv(spark, _written(cust, header=True), ["c_acctbal", "c_custkey"], "c_nationkey")
    return pts.select(F.col("x")[0].alias("x0"), F.col("x")[1].alias("x1"), _b("label").alias("label"))


def s4_iris_csv(spark, sf_dir):
    """``part`` in the layout of the labelled flower file: four numbers and a class name."""
    names = F.array(*(F.lit(f"Iris-{c}") for c in ("setosa", "versicolor", "virginica")))
    part = _table(spark, sf_dir, "part").select(
        (F.col("p_size") / 10).alias("a"), (F.col("p_partkey") % 7).alias("b"), F.col("p_retailprice").alias("c"),
        (F.col("p_size") % 5).alias("d"), names[(F.col("p_partkey") % 3).cast("int")].alias("class"))
    pts = read_iris(spark, _written(part))
    return pts.select(*(F.col("x")[i].alias(f"x{i}") for i in range(4)), _b("label").alias("label"))


def p8_abalone_csv(spark, sf_dir):
    """``part`` in the layout of the shell file: a sex, seven numbers and 1 to 29 rings."""
    sex = F.array(*(F.lit(c) for c in "FIM"))[(F.col("p_partkey") % 3).cast("int")]
    part = _table(spark, sf_dir, "part").select(
        sex.alias("sex"), "p_retailprice", *(F.lit(i).alias(f"n{i}") for i in range(5)), "p_size", (F.col("p_size") % 29 + 1).alias("rings"))
    pts = read_abalone(spark, _written(part))
    x = F.col("x")
    letter = F.array(*(F.lit(c) for c in "FIM"))[x[0].cast("int")]
    return pts.select(letter.alias("sex"), x[0].alias("x0"), x[1].alias("x1"), x[7].alias("x7"), _b("label").alias("label"))


def s7_report_file(spark, sf_dir):
    """The report written as text and read back, line by line."""
    path = f"{ensure_checkpoint_dir(spark)}/report-{uuid.uuid4().hex}"
    write_report(evaluate(_assigned(spark, sf_dir)), path)
    line = F.split("value", ":")
    return spark.read.text(path).where(F.col("value").contains(":")).select(
        line[0].alias("line"), F.round(line[1].cast("double"), 6).alias("value"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s_points_from_columns": s_points_from_columns,
    "s_parse_vector_text": s_parse_vector_text,
    "p_recode_label": p_recode_label,
    "p_nominal_code": p_nominal_code,
    "p_drop_feature": p_drop_feature,
    "r_sample_centers": r_sample_centers,
    "j1_assign": j1_assign,
    "j4_own_center_distance": j4_own_center_distance,
    "k_one_step_centers": k_one_step_centers,
    "k_fit_3_iterations": k_fit_3_iterations,
    "k_predict": k_predict,
    "k_sse_history": k_sse_history,
    "k_center_history": k_center_history,
    "a11_center_shift": a11_center_shift,
    "k_empty_cluster_keeps_center": k_empty_cluster_keeps_center,
    "a4_label_centers": a4_label_centers,
    "a7_contingency": a7_contingency,
    "e1_purity": e1_purity,
    "e2_ari": e2_ari,
    "e3_label_agreement": e3_label_agreement,
    "e3_pair_jaccard": e3_pair_jaccard,
    "e4_fowlkes_mallows": e4_fowlkes_mallows,
    "e5_silhouette_exact": e5_silhouette_exact,
    "e5_silhouette_pruned": e5_silhouette_pruned,
    "e6_silhouette_squared": e6_silhouette_squared,
    "e7_davies_bouldin": e7_davies_bouldin,
    "e8_report": e8_report,
    "g1_population_init": g1_population_init,
    "a6_cluster_sizes": a6_cluster_sizes,
    "g3_population_fitness": g3_population_fitness,
    "g4_population_sse": g4_population_sse,
    "f4_fitness_rescale": f4_fitness_rescale,
    "g5_selection": g5_selection,
    "g7_crossover_children": g7_crossover_children,
    "g7_crossover_rotated": g7_crossover_rotated,
    "g7_family_competition": g7_family_competition,
    "g8_mutation": g8_mutation,
    "g9_kmo_guarded": g9_kmo_guarded,
    "g10_kmo_always": g10_kmo_always,
    "d1_pca_2d": d1_pca_2d,
    "g11_fit": g11_fit,
    "g11_fit_one_generation": g11_fit_one_generation,
    "g11_fit_mutation": g11_fit_mutation,
    "g11_fit_always": g11_fit_always,
    "g6_crossover_ring": g6_crossover_ring,
    "g15_population_log": g15_population_log,
    "g3_fitness_exact": g3_fitness_exact,
    "e8_report_exact": e8_report_exact,
    "a5_sse_offset": a5_sse_offset,
    "e6_silhouette_offset": e6_silhouette_offset,
    "s_points_by_position": s_points_by_position,
    "d1_pca_part": d1_pca_part,
    "d2_projection": d2_projection,
    "g13_fit_defaults": g13_fit_defaults,
    "g6_crossover_ring_p10": g6_crossover_ring_p10,
    "g11_fit_parity": g11_fit_parity,
    "s1_numeric_csv": s1_numeric_csv,
    "s2_named_csv": s2_named_csv,
    "s4_iris_csv": s4_iris_csv,
    "s7_report_file": s7_report_file,
    "p8_abalone_csv": p8_abalone_csv,
    "k_fit_3_iterations_events": k_fit_3_iterations_events,
    "k_sse_history_events": k_sse_history_events,
    "k_bounds_events": k_bounds_events,
    "j1_assign_events": j1_assign_events,
    "e2_ari_events": e2_ari_events,
    "e7_davies_bouldin_events": e7_davies_bouldin_events,
    "a4_label_centers_events": a4_label_centers_events,
    "r_sample_centers_events": r_sample_centers_events,
}
