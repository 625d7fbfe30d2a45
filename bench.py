"""Headline timings: prints ONE JSON line.

Configurations mirror the reference's stored runs, on the given tables:
k-means with k=28 and 10 iterations (the abalone setting) on lineitem's 4
numeric columns; genetic k-means with its defaults (population 10, 10
generations, survival 0.8, crossover 0.8) on the 64-d embeddings; the full
quality report; the exact O(n^2) silhouette; the two shapes of the reference's
own data (150 x 4 with k=3, 4,177 x 8 with k=28); PCA, numbering by key and the
rotated child.

Before timing, one untimed 1-iteration k-means on the smallest embeddings
table starts the JVM code paths and Python workers; it is not in the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from pyspark.sql import functions as F  # noqa: E402

from evoclust.operators.genetic import GeneticKMeans  # noqa: E402
from evoclust.operators.internal import silhouette_exact  # noqa: E402
from evoclust.operators.kmeans import KMeansLloyd  # noqa: E402
from evoclust.operators.population import init_population, rotated_child  # noqa: E402
from evoclust.operators.projection import project  # noqa: E402
from evoclust.operators.report import evaluate  # noqa: E402
from evoclust.plans.catalog import embedding_points  # noqa: E402
from evoclust.session import local_session  # noqa: E402
from evoclust.sources.points import points_by_position, recode, with_pos  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        warm = embedding_points(spark, warm_dir)
        KMeansLloyd(k=3, n_iter=1, seed=0).fit(warm).transform(warm).count()

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                   recode("l_returnflag", {"A": 0, "N": 1, "R": 2}).cast("int").alias("flag"))
    def ingest():
        p = points_by_position(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "flag").persist()
        p.count()  # materialised inside the timing
        return p

    pts = timed("ingest_lineitem_pos", ingest)

    model = timed("kmeans_lineitem_k28_10it", lambda: KMeansLloyd(k=28, n_iter=10, seed=0).fit(pts))
    assigned = model.transform(pts).persist()
    timed("report_lineitem", lambda: evaluate(assigned).collect())

    def ingest_emb():
        e = embedding_points(spark, sf_dir, pos=True).persist()
        e.count()
        return e

    emb = timed("ingest_embeddings_pos", ingest_emb)
    g = timed("gka_embeddings_p10_k10_g10", lambda: GeneticKMeans(population=10, k=10, generations=10, seed=0).fit(emb))
    lab = g.labels().join(emb.select("row_id", "x"), "row_id")
    timed("silhouette_exact_embeddings", lambda: silhouette_exact(lab).collect())
    timed("gka_lineitem_p10_k28_g3", lambda: GeneticKMeans(population=10, k=28, generations=3, seed=0,
                                                          track_ari=False).fit(pts))

    # the reference's own shapes, cut from the embeddings: 150 x 4 (k=3) and 4,177 x 8 (k=28)
    def shape(n, d):
        wide = emb.select("x", "label").union(emb.select(F.transform("x", lambda v: v * 1.01).alias("x"), "label")).union(
            emb.select(F.transform("x", lambda v: v * 0.99).alias("x"), "label")).limit(n)
        rows = [(i, i, r["x"][:d], r["label"]) for i, r in enumerate(wide.collect())]
        out = spark.createDataFrame(rows, "row_id bigint, pos bigint, x array<double>, label int").coalesce(1).persist()
        out.count()
        return out

    for n, d, k in ((150, 4, 3), (4177, 8, 28)):
        small = shape(n, d)
        timed(f"kmeans_{n}x{d}_k{k}_10it", lambda: KMeansLloyd(k=k, n_iter=10, seed=0).fit(small))
        timed(f"gka_{n}x{d}_p10_k{k}_g10", lambda: GeneticKMeans(population=10, k=k, generations=10, seed=0).fit(small))
        if n == 150:
            timed("gka_exact_150x4_p10_k3_g3",
                  lambda: GeneticKMeans(population=10, k=k, generations=3, seed=0, fitness="exact").fit(small))
    timed("pca_embeddings", lambda: project(emb).count())
    timed("with_pos_by_key_embeddings", lambda: with_pos(emb.drop("pos")).count())
    pop = init_population(emb, 4, 10, 0)
    timed("rotated_child_embeddings", lambda: rotated_child(pop.df, 0, 1, pop.n // 3, pop.n).select("child").count())

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "sse_kmeans": round(model.sse_history[-1], 4), "gka_fitness": round(g.fitness, 6)}))
    spark.stop()


if __name__ == "__main__":
    main()
