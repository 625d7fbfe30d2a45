"""Cross-tokenizer alignment against a plain alignment of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evoclust.llm import token_alignment as T

SF = "/root/testdata/sf0.001"
TEXTS = ["plain words, twice. plain words", "a  b", " lead and trail ", "line\nbreak\n\n  in\ttabs", "<|endoftext|> <s> </s> <unk>",
         "<0x41>", "a▁b stays without tokens", "naïve café ﬁne 中文 🙂 á", "x" * 3000, "no-break space　wide", "\x00 \x1c z",
         "one" + " more" * 2000, "'s it's 12345 --- !!"]


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(Path(T.tokenizer_path(T.A_FILE)).read_text(), Path(T.tokenizer_path(T.B_FILE)).read_bytes())


def brute(aligner, texts):
    """(n_a, n_b, groups as text, links) of each text, walking along the bytes; None without tokens."""
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
        one, two = [aligner.first.tokens[i] for i in a], [aligner.second.tokens[i] for i in b]
        if b"".join(one) != (" " + text).encode() or b"".join(two) != (" " + text).encode():
            out.append(None)
            continue
        ends, at, groups, links = [set(), set()], [0, 0], [], []
        for k, tokens in enumerate((one, two)):
            place = 0
            for t in tokens:
                place += len(t)
                ends[k].add(place)
        here, i, j, group = [0, 0], 0, 0, ([], [])
        for end in sorted(ends[0] & ends[1]):
            while here[0] < end:
                group[0].append(a[i])
                here[0] += len(one[i])
                i += 1
            while here[1] < end:
                group[1].append(b[j])
                here[1] += len(two[j])
                j += 1
            groups.append("|".join(",".join(map(str, g)) for g in group))
            links.append((group[0][-1], group[1][-1]))
            group = ([], [])
        out.append((len(a), len(b), ";".join(groups), links))
    return out


def expected(aligner, texts):
    found = brute(aligner, texts)
    count = Counter(link for f in found if f for link in f[3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (
        f[0], f[1], f[2].count(";") + 1, len(f[3]), sum(count[x] == best[x[1]] for x in f[3]), sum(count[x] for x in f[3]),
        hashlib.sha256(f[2].encode()).hexdigest()) for f in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force(spark, aligner):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in docs], expected(aligner, [r["text"] for r in docs])))
    got = T.op13_token_alignment(spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", **dict.fromkeys(COLUMNS, "bigint"), "groups_sha256": "string"}
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == want


def test_awkward_rows_groups_and_counts(spark, aligner):
    rows = [*enumerate(TEXTS), (100, None), (101, ""), (102, TEXTS[0]), (102, TEXTS[0]), (None, TEXTS[0]), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_a int, pairs string").repartition(3)
    aligned = T.stored(T.alignments(docs, with_groups=True))
    got = T.with_counts(aligned, T.pair_counts(aligned))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted(((i, *e) for (i, _), e in zip(rows, expected(aligner, [t for _, t in rows]))), key=key)
    assert sorted((tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in got.collect()), key=key) == want
    # Real output: the groups, and the counts of the pairs.
    texts = {r["doc_id"]: r["g"] for r in got.where("doc_id < 100").select("doc_id", T.groups_of(F.col("groups")).alias("g")).collect()}
    for i, f in enumerate(brute(aligner, TEXTS)):
        assert (texts[i] is None) == (f is None)
        assert f is None or ";".join("|".join(",".join(map(str, side)) for side in g) for g in texts[i]) == f[2]
    count = Counter(link for f in brute(aligner, [t for _, t in rows]) if f for link in f[3])
    assert {(r["a_id"], r["b_id"]): r["n"] for r in T.pair_counts(aligned).collect()} == count
    assert len(count) <= T.pair_bound(aligner.first.tokens, aligner.second.tokens)


def test_empty_table(spark):
    aligned = T.stored(T.alignments(spark.createDataFrame([], "doc_id long, text string")))
    assert T.with_counts(aligned, T.pair_counts(aligned)).count() == 0


def test_words_equal_whole_texts(aligner):
    rng = random.Random(1)
    parts = [*"ab  \n\t'sé中1!.<|>0x_▁ 　́​\x00\x1c🙂", "<|endoftext|>", "<s>", " the", "word", "\r\n", "  ", "ﬁ", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(2000)]
    assert list(aligner.batch(texts)) == aligner.aligned(texts) == [aligner.aligned([t])[0] for t in texts]


def test_full_cache_changes_nothing(aligner, monkeypatch):
    texts = [f"word{i} and word{i % 7}" for i in range(300)]
    want = aligner.aligned(texts)
    monkeypatch.setattr(T, "CACHE", 5)
    fresh = T.Aligner(Path(T.tokenizer_path(T.A_FILE)).read_text(), Path(T.tokenizer_path(T.B_FILE)).read_bytes())
    assert [x for i in range(0, 300, 10) for x in fresh.batch(texts[i:i + 10])] == want
    assert len(fresh.known) <= 5


def test_a_task_keeps_no_more_words_than_the_cache_holds(aligner, monkeypatch):
    import pyarrow as pa

    class Files:
        value = (Path(T.tokenizer_path(T.A_FILE)).read_text(), Path(T.tokenizer_path(T.B_FILE)).read_bytes())

    texts = [f"word{i} and word{i % 7} " + "long" * 30 for i in range(3 * T.ROWS)]
    monkeypatch.setattr(T, "CACHE", 50)
    monkeypatch.setattr(T, "_ALIGNERS", {})
    raw = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], names=["doc_id", "raw"])
    got = pa.Table.from_batches(T._align(iter([raw]), Files, False))
    assert [len(x.known) for x in T._ALIGNERS.values()] == [50]
    assert got.column("groups_sha256").to_pylist() == [x[-1] for x in expected(aligner, texts)]


def test_a_pair_ends_alike():
    assert T.pair_bound([b"ab", b"c"], [b"b", b"ab", b"xc"]) == 3
    assert T.slices([1, 3, 6], [3, 4, 6]) == ([3, 6], [2, 3], [1, 3])
