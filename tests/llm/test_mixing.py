"""Mixing: targets met closely, repeated rows dealt apart, columns kept."""

from collections import Counter

import numpy as np
import pytest
from llm_cases import frame
from pyspark.sql import functions as F

from evoclust.llm import mixing

SF = "/root/testdata/sf0.01"


def test_query_meets_every_target_within_one_per_cent(spark):
    out = mixing.op5_mixing(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}
    docs = {r["doc_id"]: (len((r["text"] or "").split()), r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(docs.keys())
    taken, target = Counter(), {}
    for r in rows:
        assert r["size"] == docs[r["doc_id"]][0] and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[docs[r["doc_id"]][1]] += r["taken"]
        target[docs[r["doc_id"]][1]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())


@pytest.mark.parametrize("factor,sizes", [(1.5, list(range(60, 0, -1))), (0.3, [9] * 30), (1.9, [500, 3, 2, 1]), (1.5, [5184, *[40] * 100])])
def test_leaves_settle_by_size(factor, sizes):
    """All but one document are whole, the words stay, and draws keep the expectation where both directions are open."""
    total, early = np.zeros(len(sizes)), len(sizes) // 3
    for t in range(300):
        keys = [f"{t}-{i}".encode() for i in range(len(sizes))]
        copies, left = mixing._settle(keys, sizes, [1] * len(sizes), factor, 2.0, False)
        own = np.array(copies) + left
        assert own @ sizes == pytest.approx(factor * sum(sizes)) and ((own >= 0) & (own <= 2)).all()
        assert sum(p > 0 for p in left) <= 1
        whole, none = mixing._settle(keys, sizes, [1] * len(sizes), factor, 2.0, True)
        assert not any(none) and abs(np.array(whole) @ sizes - factor * sum(sizes)) <= (max(s for s, p in zip(sizes, left) if p) / 2 + 1e-6 if any(left) else 1e-6)
        total += own
    if sum(sizes) > 10 * max(sizes):  # behind them the pool is still large
        assert np.abs(total[:early] / 300 - factor).max() < 0.15


def test_columns_of_any_name_stay(spark):
    schema = "doc_id long, text string, source string, __key long, __i long, __c int, id string, tk long, rows int, copies int, size int"
    data = [(i % 9 if i % 4 else None, "word " * (i % 5), "ab"[i % 2], -1, -2, -3, "x", -4, -5, -6, -7) for i in range(80)]
    docs = spark.createDataFrame(data, schema).repartition(4)
    out = mixing.mix(docs)
    assert out.schema == docs.schema
    got = out.collect()
    assert got and all(tuple(r)[3:] == (-1, -2, -3, "x", -4, -5, -6, -7) for r in got)
    count = Counter()
    for r in mixing.copies(docs).collect():
        count[r["id"], r["source"], r["size"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in got) == +count


def test_repeated_rows_are_dealt_apart(spark):
    """A third of the table is one text without an id: its parts go to many leaves, its copies to all its rows."""
    n = 6000
    rows = [(None if i % 3 == 0 else i, "same words here" if i % 3 == 0 else f"w{i} " * (i % 7 + 1), "s") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    leaf = 100
    out = mixing.copies(docs, leaf_rows=leaf).collect()
    same = [r["copies"] for r in out if r["id"] is None]
    assert len(same) == n // 3 and max(same) - min(same) <= 1
    taken, target = sum(r["copies"] * r["size"] for r in out), out[0]["target"]
    assert abs(taken - target) <= 4
    sized = mixing._sized(docs, "doc_id", "text", "source", mixing.word_count(F.col("text")).alias("size"))
    totals = {r["id"]: (r["rows"], r["copies"]) for r in mixing._totals(sized, (1,), 1.5, 2.0, leaf).collect()}
    assert totals[None] == (n // 3, sum(same))


def test_awkward_tables(spark):
    assert mixing.mix(frame(spark, [], 1)).count() == 0
    docs = frame(spark, [(1, None, None, None, "", 1, "", ""), (1, "a b c", None, None, "", 1, "", "")] * 3, 2)
    got = mixing.copies(docs).collect()
    assert Counter((r["size"], r["copies"] > 0) for r in got) == {(0, False): 3, (3, True): 3}
