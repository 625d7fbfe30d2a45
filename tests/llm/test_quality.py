"""Quality classifier: held-out accuracy, densities against numpy, awkward rows."""

import zlib

import numpy as np

from evoclust.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    out = Q.op11_quality(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 50
    assert np.mean([p for y, p in held if y == 1]) > 0.97
    assert np.mean([1 - p for y, p in held if y == 0]) > 0.97


def test_score_is_the_difference_of_normal_log_densities():
    rng = np.random.default_rng(0)
    d = len(Q.STATISTICS)
    x = [rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) for n in (40, 200)]
    n, means, cov = np.array([40.0, 200.0]), np.array([v.mean(0) for v in x]), np.array([np.cov(v.T, bias=True) for v in x])
    model = Q.Discriminant.of(n, means, cov)
    whole = np.concatenate(x)
    assert np.allclose(model.centre, whole.mean(0)) and np.allclose(model.scale, whole.std(0))
    z = (whole - whole.mean(0)) / whole.std(0)
    logs = []
    for k, v in enumerate(np.split(z, [40])):
        pooled = sum(m * np.cov(w.T, bias=True) for m, w in zip((40, 200), np.split(z, [40]))) / 240
        s = (len(v) * np.cov(v.T, bias=True) + Q.POOLED * pooled) / (len(v) + Q.POOLED)
        s = (1 - Q.SPHERE) * s + (Q.SPHERE * np.trace(s) / d + 1e-6) * np.eye(d)
        left = z - v.mean(0)
        logs.append(np.log(len(v) / 240) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (left @ np.linalg.inv(s) * left).sum(1))
    assert np.allclose(model.score(whole), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_moments_come_from_all_labelled_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(Q.stored(Q.measured(docs)), labels.union(labels))  # a label given twice teaches once
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    rows = [(Q.statistics(np.array([Q.counts(text[r["doc_id"]])]))[0], r["quality"]) for r in labels.collect()
            if r["doc_id"] in text and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    x = [np.array([v for v, y in rows if y == k]) for k in (0, 1)]
    own = Q.Discriminant.of(np.array([len(v) for v in x], float), np.array([v.mean(0) for v in x]),
                            np.array([np.cov(v.T, bias=True) for v in x]))
    for a, b in zip([*model.means, *model.factors, model.centre, model.scale], [*own.means, *own.factors, own.centre, own.scale]):
        assert np.allclose(a, b)


def test_labels_are_not_sent_through_the_driver(spark):
    """A small table of labels, which is repeated for the salts, is merged, not broadcast."""
    docs = spark.createDataFrame([(i, "some text " * (i % 9)) for i in range(60)], "doc_id long, text string")
    labels = Q.stored(spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    found = Q.moments(Q.stored(Q.measured(docs)), labels)
    plans = [found._jdf.queryExecution().executedPlan().toString()]
    n = sum(r["n"] for r in found.collect())
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert n == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(60))
    assert all("Broadcast" not in p and "SortMergeJoin" in p for p in plans)


def test_awkward_rows(spark):
    good = "The old house by the river was sold, and nobody asked why. " * 6
    rows = [(i, good[i % 7:] if i % 4 else f"BUY NOW!! {i} $$$ %%% ### | | " * 20, "s") for i in range(200)]
    rows += [(300, None, "s"), (301, "", "s"), (302, "x" * 200_000, "s"), (None, good, "s"), (None, None, "s"), (303, good, "s"), (303, good, "s")]
    docs = spark.createDataFrame([(*r, 0.5, "p", 7) for r in rows],
                                 "doc_id long, text string, row string, score double, predicted string, stats int").repartition(3)
    labels = spark.createDataFrame([*((i, int(i % 4 > 0)) for i in range(200)), (300, None), (None, 0), (301, 5), (303, 1), (303, 1)],
                                   "doc_id long, quality int")
    stats = Q.stored(Q.measured(docs))
    out = Q.scored(stats, Q.train(stats, labels))
    assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes)["score"] == "double"
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["row"] == "s" and r["stats"] == 7 for r in got)
    assert all(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 200)
    empty = {r["score"] for r in got if not r["text"]}
    assert len(empty) == 1  # null and empty texts score alike
    kept = Q.good_quality(docs, labels)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.where("doc_id < 200 and doc_id % 4 = 0").count() == 0 and kept.where("doc_id < 200").count() == 150


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    stats = Q.measured(docs)
    for labels, want in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)):
        model = Q.train(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert [r["score"] for r in Q.scored(stats, model).collect()] == [want] * 2
    both = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in Q.scored(stats, Q.train(stats, both)).collect())
    nothing = Q.measured(docs.limit(0))
    assert Q.scored(nothing, Q.train(nothing, both)).count() == 0
