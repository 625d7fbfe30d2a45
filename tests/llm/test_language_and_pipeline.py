"""Language ID and the corpus pipeline."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import frame, rows
from test_free import brute_print, groups_of
from test_native import brute_hits

import corpus_pipeline
from evoclust.llm import language_id, mixing, token_output

SF = "/root/testdata/sf0.001"


def test_gradients_are_right():
    net = language_id.Network(["a", "b", "c"], hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    pieces, labels = [b"abc", b"z", b"hello", b"ab\xff"], np.array([0, 1, 2, 1])
    _, g = net.gradients(pieces, labels)
    rng = np.random.default_rng(0)
    for name in g:
        flat = net.w[name].reshape(-1)
        live = np.flatnonzero(np.abs(g[name].reshape(-1)) > 1e-4)
        for i in rng.choice(live, min(8, len(live)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-3
            up = net.gradients(pieces, labels)[0]
            flat[i] = kept - 1e-3
            down = net.gradients(pieces, labels)[0]
            flat[i] = kept
            assert (up - down) / 2e-3 == pytest.approx(g[name].reshape(-1)[i], rel=0.05, abs=2e-4)


def test_sums_equal_position_by_position():
    net = language_id.Network(["a", "b"])
    pieces = [b"x", b"longer piece", b"\xc3\xa9"]
    sums = net.sums(pieces)
    assert sums[:, -1].tolist() == [1, 12, 2]
    assert np.allclose(np.concatenate([net.sums([p]) for p in pieces]), sums, atol=1e-4)


def test_every_byte_is_labelled_with_its_context(monkeypatch):
    """Windows with a warm-up as long as the text equal one run over all bytes, digits and 3-byte characters included."""
    net = language_id.Network(["a", "b", "c"])
    texts = ["Ab 12, cd! " * 9, "7", "\u4e2d\u6587\u5b57" * 40, "\u00e9\u4e2d x3 " * 25, "?" * 64]
    raw = [t.encode() for t in texts]
    monkeypatch.setattr(language_id, "CORE", 50)
    monkeypatch.setattr(language_id, "WARM", 1000)
    whole = np.concatenate([net.sums([t.lower()]) for t in raw])
    assert whole[:, -1].tolist() == [len(t) for t in raw]
    assert np.allclose(net.totals(raw), whole[:, :-1], rtol=1e-3, atol=1e-2)
    monkeypatch.setattr(language_id, "ROWS", 2)
    assert np.allclose(net.totals(raw), whole[:, :-1], rtol=1e-3, atol=1e-2)
    assert language_id.pooled(net, [b"aa 11"])[0][1] != language_id.pooled(net, [b"aa 22"])[0][1]


def test_held_out_accuracy_and_awkward_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = language_id.train(docs)
    out = language_id.predict(docs.select("doc_id", "lang", language_id.held_out().alias("held_out"), "text"), net).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert len(held) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    odd = frame(spark, rows()).withColumn("score", language_id.F.lit("clash"))
    got = language_id.predict(odd, net).collect()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in net.classes) == letters and 0 <= r["score"] <= 1
    assert len(got) == len(rows())
    kept = language_id.predict(odd, None).collect()
    assert {r["lang_pred"] for r in kept} == {"und"}


def test_long_documents_teach(spark, monkeypatch):
    """A language whose documents are all long is sampled by parts of them."""
    texts = [(i, "".join(f"{i}:{j}é " for j in range(20_000)) if i % 2 else "short words", "xx" if i % 2 else "en") for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = language_id.sample(docs)
    assert {lang for lang, _ in got} == {"xx", "en"}
    long = [t for lang, t in got if lang == "xx"]
    part = language_id.SAMPLE_BYTES // language_id.PARTS
    whole = [t.encode() for _, t, lang in texts if lang == "xx"]
    for t in long:
        assert len(t) == language_id.SAMPLE_BYTES
        assert any(all(t[a:a + part] in w for a in range(0, len(t), part)) for w in whole)
    assert got == language_id.sample(docs.repartition(7))


def test_nothing_to_learn_from(spark):
    assert language_id.train(frame(spark, [], 1)) is None
    assert language_id.known_language(frame(spark, [], 1)).count() == 0


def test_rejection_is_fitted_on_all_held_out_documents(spark):
    """The least score is that of the 1 % quantile of every held-out labelled document, not of a sample of them."""
    docs = spark.createDataFrame([(i, "the plain words of one tongue " * 3 if i % 40 else "zq xj kv " * 3, "en" if i % 3 else "de")
                                  for i in range(5000)], "doc_id long, text string, lang string").repartition(5)
    net = language_id.train(docs)
    held = [r["text"].encode() for r in docs.where(language_id.held_out()).collect()]
    assert len(held) > 900
    language_id.fit_rejection(net, docs)
    scores = np.sort([s for _, s in language_id.pooled(net, held)])
    assert net.min_score == pytest.approx(0.5 * scores[int((len(held) - 1) * 0.01)], rel=1e-6)
    assert net.kept == pytest.approx((scores >= net.min_score).mean())
    # Without held-out documents those of training count; without any nothing is fitted.
    language_id.fit_rejection(net, docs.where(~language_id.held_out()))
    assert 0 < net.min_score < 1
    net.min_score = 0.25
    language_id.fit_rejection(net, docs.where("text is null"))
    assert net.min_score == 0.25


def test_order_statistic_is_exact(spark):
    rng = np.random.default_rng(5)
    values = np.r_[rng.random(3000) ** 9, np.full(40, 0.3), 1e-300, np.nextafter(0.3, 1), 1.0]
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    for share in (0.0, 0.01, 0.5, 0.73, 1.0):
        assert language_id.order_statistic(rows, "v", share) == np.quantile(values, share, method="lower")
    assert language_id.order_statistic(rows.where("v < 0"), "v", 0.5) is None


def test_documents_in_no_learned_language_go(spark):
    """An unlearned script and letter noise go; clean documents stay."""
    clean = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(1)

    def words(letters):
        return " ".join("".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(80))

    strange = [(10 ** 6 + i, words(s), None) for i, s in enumerate(
        ["абвгдежзиклмнопрстуя", "αβγδεζηθικλμνξοπρστ", "אבגדהוזחטיכלמנ", "कखगघचछजझटठडढ", "中文字語言學習明日本"] * 4
        + ["abcdefghijklmnopqrstuvwxyz"] * 4)]
    docs = clean.union(spark.createDataFrame(strange, clean.schema))
    kept = {r["doc_id"] for r in language_id.known_language(docs).collect()}
    ours = {r["doc_id"] for r in clean.collect()}
    assert not kept - ours
    assert len(kept) >= 0.99 * len(ours)


def test_pipeline_stages_take_effect(spark, tmp_path):
    """Every stage over what its predecessor kept, against plain Python."""
    from tokenizers import Tokenizer

    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    columns = docs.columns
    docs = docs.union(spark.createDataFrame([(10 ** 6, "12 34 !!", "en", "src0", 8), (10 ** 6 + 1, None, "en", None, 0)], docs.schema))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append([r.asDict() for r in docs.collect()])
        assert name == "token_output" or docs.columns == columns
    language, single, clean, mixed, tokens = seen
    assert {r["doc_id"] for r in language} == {r["doc_id"] for r in language if re.search("[A-Za-z]", r["text"])}
    assert len(language) == 120
    prints = [brute_print(r["text"]) for r in language]
    root = groups_of(prints, 4)
    assert Counter(r["doc_id"] for r in single) == Counter(
        min(r["doc_id"] for r, g in zip(language, root) if g == x) for x in set(root))
    hit = brute_hits([r["text"] for r in single], bench, 10)
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r, b in zip(single, hit) if not b[1]}
    copies = mixing.copies(spark.read.parquet(str(tmp_path / "benchmark_decontamination"))).collect()
    assert Counter(r["doc_id"] for r in mixed) == +Counter({r["id"]: r["copies"] for r in copies})
    tok = Tokenizer.from_file(token_output.tokenizer_path())
    want = Counter((r["doc_id"], zlib.crc32(np.array(tok.encode(r["text"], add_special_tokens=False).ids + [1], "<u4").tobytes()))
                   for r in mixed)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in tokens) == want


def test_pipeline_is_registered():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None


PIPELINE_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __id int, row string, tk long, copies int"


def written(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_run_on_awkward_tables(spark, tmp_path):
    """Null rows, repeated rows and clashing columns; nothing but the last stage and the token files stays behind."""
    from evoclust.llm.common import STORED

    docs = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], -1, "x", -2, -3)
            for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    docs += [(None, None, None, None, None, -1, "x", -2, -3), (10 ** 7, "", "en", None, 0, -1, "x", -2, -3)] + [docs[0]] * 5
    one = written(spark, tmp_path / "one", spark.createDataFrame(docs, PIPELINE_COLUMNS).repartition(3))
    folder, before = tmp_path / "out", len(STORED)
    out = corpus_pipeline.run(spark, one, str(folder))
    assert dict(out.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    rows = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in out.collect())
    assert rows and all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:]))
    assert {d for _, _, d in rows} <= {d[0] for d in docs if d[1]} and len(STORED) == before
    assert [p.name.split("-")[0] for p in folder.iterdir()] == ["token_output"]
    # the same again gives the same
    assert rows == sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in corpus_pipeline.run(spark, one).collect())


def test_pipeline_run_on_tables_without_anything(spark, tmp_path):
    empty = spark.createDataFrame([], PIPELINE_COLUMNS)
    nothing = spark.createDataFrame([(None,) * 9] * 3 + [(1, "no lang at all", None, None, None, 1, "", 1, 1)], PIPELINE_COLUMNS)
    for i, docs in enumerate((empty, nothing)):
        path = written(spark, tmp_path / str(i), docs)
        assert corpus_pipeline.run(spark, path).count() == 0


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op2_simhash", "op5_mixing", "op7_token_output", "op10_language_id"])
def test_registered_queries_return_their_contract(spark, name):
    """The thin queries themselves: columns, types and a row for each document."""
    from evoclust.llm.queries import QUERIES

    small = "/root/testdata/sf0.001"
    want = {
        "op1_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op2_simhash": "doc_id bigint, fingerprint string, component_id bigint",
        "op5_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op7_token_output": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double"}[name]
    out = QUERIES[name](spark, small)
    assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == want
    rows = {r["doc_id"]: r for r in out.collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert rows.keys() == docs.keys() and out.count() == len(docs)
    if name == "op2_simhash":
        prints = [brute_print(t) for t in docs.values()]
        groups = groups_of(prints, 4)
        least = {}
        for d, g in zip(docs, groups):
            least[g] = min(d, least.get(g, d))
        for d, p, g in zip(docs, prints, groups):
            assert (rows[d]["fingerprint"], rows[d]["component_id"]) == (f"{p:016x}", least[g])
