"""Suffix-array dedup, SimHash, mixing, token output, top-k search."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_cases import ascii_lower, frame, key, rows, words

from evoclust.llm import components, mixing, simhash, suffix_dedup, token_output, topk

# ------------------------------------------------------------------ suffix arrays


def brute_removed(data, length=50):
    least = {}
    inf = math.inf
    for d, t in data:
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            least[w] = min(least.get(w, inf), inf if d is None else d)
    out = []
    for d, t in data:
        cov = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if least[t[i:i + length]] < (inf if d is None else d):
                cov[i:i + length] = b"\1" * length
        kept = bytes(c for c, x in zip(t, cov) if not x)
        spans = len([s for s in bytes(cov).replace(b"\0", b" ").split()])
        out.append((d, len(t), sum(cov), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_passages_go(spark, parts):
    data = rows()
    docs = frame(spark, data)
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs, parts=parts).collect()), key=key)
    want = brute_removed([(r[0], (r[1] or "").encode()) for r in data])
    assert got == sorted(want, key=key)
    assert sum(w[2] for w in want) > 1000


def test_kept_bytes_and_empty_table(spark):
    data = [(1, "a" * 60 + "b" * 60), (2, "c" + "b" * 55 + "d")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, keep_text=True).collect()}
    assert bytes(got[2]["kept"]) == b"cd" and got[2]["spans"] == [[1, 56]] and got[1]["n_removed"] == 0
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_family_equals_brute_force_for_any_batches(seed):
    """Batches in any order, of few letters, so that anchors and windows repeat a lot."""
    rng = random.Random(seed)
    shared = [bytes(rng.choice(b"ab") for _ in range(120)) for _ in range(3)]
    data = []
    for d in range(30):
        t = b"".join(rng.choice([rng.choice(shared)[:rng.randint(40, 120)], bytes(rng.choice(b"abc") for _ in range(30)), b"z" * 60])
                     for _ in range(rng.randint(1, 4)))
        data.append((d // 2 if d % 5 else d, t))
    family = suffix_dedup.LevelFamily()
    order = list(range(len(data)))
    rng.shuffle(order)
    for at in range(0, len(order), 3):
        family.add(suffix_dedup.cut([(data[i][0], i, 0, data[i][1]) for i in order[at:at + 3]])[0])
    assert len(family.levels) > 1
    gone = suffix_dedup.Removals.join(family.removals).merged()
    removed = defaultdict(set)
    for tag, p, r in zip(gone.tag.tolist(), gone.pos.tolist(), gone.runs.tolist()):
        removed[tag] |= set(range(p, p + r + 49))
    assert [len(removed[i]) for i in range(len(data))] == [b[2] for b in brute_removed(data)]


def test_texts_of_one_id_that_share_a_tag_keep_what_is_theirs(spark, monkeypatch):
    """The first null-id text repeats a document; the second has the same tag, but no repeated byte."""
    rng = random.Random(3)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    first, clean = say(300), say(300)
    monkeypatch.setattr(suffix_dedup, "_tag", lambda text: 7)
    slots = [0]
    batch = suffix_dedup.pa.RecordBatch.from_pydict({"doc_id": [1, None, None], "raw": [first.encode(), first.encode(), clean.encode()]})
    blocks = [r for b in (*suffix_dedup._cut_task(iter([batch]), slots), *suffix_dedup._text_task(iter([batch]), slots)) for r in b.to_pylist()]
    gone = [r for r in blocks if r["kind"] == suffix_dedup.REMOVALS]
    texts = [r for r in blocks if r["kind"] == suffix_dedup.TEXTS]
    rows = [suffix_dedup._rows([0], [r["kind"]], [r["payload"]]) for r in gone + texts]
    out = [r for b in suffix_dedup._remove_task(iter(rows), True) for r in b.to_pylist()]
    assert [(r["doc_id"], r["n_removed"]) for r in out] == [(1, 0), (None, 300), (None, 0)]


def test_texts_of_one_id_are_dealt_to_many_slots():
    doc, tag = np.full(1000, suffix_dedup.NULL_ID), np.random.default_rng(0).integers(0, 2 ** 32, 1000).astype(np.uint32)
    assert max(len(i) for _, i in suffix_dedup._doc_deal(doc, tag, list(range(50)))) < 60


def hot_texts():
    """Each document holds one 16-byte string in its own surroundings; some also a passage, with and without an id."""
    rng = random.Random(4)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, passage = "=" * 3 + "the same string" + "=" * 3, say(120)
    return [(None if i % 9 == 5 else i // 2 * 2, say(60) + shared + say(60) + (passage if i % 3 == 0 else "") + say(20), "en", "s", "", 0, "", "")
            for i in range(300)]


def test_hot_anchors_change_no_result(spark, monkeypatch):
    docs = frame(spark, hot_texts(), 5)
    by = lambda df: sorted((tuple(r) for r in df.collect()), key=key)
    plain = by(suffix_dedup.remove_repeats(docs, parts=4))
    monkeypatch.setattr(suffix_dedup, "SHARE", 1)
    for hot in (100, 2):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        assert by(suffix_dedup.remove_repeats(docs, parts=4)) == plain


@pytest.mark.parametrize("at_once", [50, 1_000_000])
def test_windows_of_hot_anchors_in_small_shares(spark, monkeypatch, at_once):
    """What is removed, window by window, with and without hot anchors; several tasks."""
    docs = frame(spark, hot_texts()).select("doc_id", suffix_dedup.F.col("text").cast("binary").alias("raw"))
    batches = docs.toArrow().to_batches()
    keys = [suffix_dedup.hot_anchors(docs, n, 1) for n in (100, 2)]
    assert 0 < len(keys[0]) < len(keys[1])

    def removed(hot):
        blocks = [r for b in batches for out in suffix_dedup._cut_task(iter([b]), [0, 1], hot=hot) for r in out.to_pylist()]
        blocks.sort(key=lambda r: r["slot"])
        rows = [suffix_dedup._rows([r["slot"]], [r["kind"]], [r["payload"]]) for r in blocks]
        gone = [suffix_dedup.Removals.unpack(r["payload"]) for b in suffix_dedup._index_task(iter(rows), [0, 1]) for r in b.to_pylist()]
        return {(d, t, p + k) for g in gone for d, t, p, n in zip(g.doc.tolist(), g.tag.tolist(), g.pos.tolist(), g.runs.tolist())
                for k in range(n)}

    plain = removed(None)
    monkeypatch.setattr(suffix_dedup, "WINDOWS_AT_ONCE", at_once)
    for k in keys:
        assert plain and removed(spark.sparkContext.broadcast(k)) == plain


def test_entries_of_a_hot_anchor_meet_in_no_slot(spark):
    docs = frame(spark, hot_texts()).select("doc_id", suffix_dedup.F.col("text").cast("binary").alias("raw"))
    hot = spark.sparkContext.broadcast(suffix_dedup.hot_anchors(docs, 100, 1))
    batches = docs.toArrow().to_batches()
    load = Counter()
    for b in suffix_dedup._cut_task(iter(batches), list(range(20)), hot=hot):
        for r in b.to_pylist():
            if r["kind"] == suffix_dedup.ENTRIES:
                assert not np.isin(suffix_dedup._anchor_key(*(e := suffix_dedup.unpack_entries(r["payload"])).suffix(e.words())), hot.value).any()
            if r["kind"] == suffix_dedup.WINDOWS:
                load[r["slot"]] += len(suffix_dedup.Windows.unpack(r["payload"]).doc)
    assert len(load) == 20 and max(load.values()) < 0.1 * sum(load.values())


def test_entries_survive_packing_and_pieces():
    text = np.random.default_rng(0).integers(97, 101, 4000).astype(np.uint8).tobytes()
    e = suffix_dedup.cut([(5, 1, 0, text), (2, 9, 0, b"short"), (-3, 7, 100, text[:77])])[0]
    back = suffix_dedup.unpack_entries(suffix_dedup.pack_entries(e, np.arange(len(e))))
    order = np.lexsort((e.pos, e.tag, e.doc))
    for f in ("doc", "tag", "pos", "runs", "anchor"):
        assert (getattr(e, f)[order] == getattr(back, f)).all()
    assert int(e.runs.sum()) == (4000 - 49) + (77 - 49)


# ------------------------------------------------------------------ SimHash


def brute_print(text, k=4):
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def groups_of(prints, distance):
    n = len(prints)
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("bucket_rows", [16_384, 1])
def test_simhash_groups(spark, bucket_rows):
    data = rows()
    base = " ".join(f"w{i}" for i in range(300))
    data += [(200 + i, base.replace(f"w{7 * i}", "zz", i % 3)) + data[0][2:] for i in range(12)]
    docs = frame(spark, data)
    prints = [brute_print(r[1]) for r in data]
    root = groups_of(prints, 4)
    least = {g: min((r[0] for r, x in zip(data, root) if x == g and r[0] is not None), default=None) for g in set(root)}
    out = simhash.near_duplicates(docs, bucket_rows=bucket_rows)
    got = sorted(((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in out.collect()), key=key)
    assert got == sorted(((r[0], p, least[g]) for r, p, g in zip(data, prints, root)), key=key)
    kept = simhash.one_of_each(docs, bucket_rows=bucket_rows)
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter(least.values()) and kept.columns == docs.columns


def test_links_find_every_pair_within_the_distance(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(30)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for p in prints for _ in range(6)]
    signed = sorted({p - 2 ** 64 if p >= 2 ** 63 else p for p in prints})
    fps = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    want = groups_of([p % 2 ** 64 for p in signed], 4)
    for options in ({}, {"bucket_rows": 2}, {"segments": (32, 32), "radii": (2, 1)}):
        roots = {r["node"]: r["root"] for r in components.components(simhash.links(fps, **options)).collect()}
        assert [roots.get(p, p) for p in signed] == [signed[g] for g in want]


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [], 1)).count() == 0
    assert simhash.one_of_each(frame(spark, [], 1)).count() == 0


def test_components_of_long_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(7, 7), (100, 90), (90, 100), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90}


# ------------------------------------------------------------------ mixing


def fill(size, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(size.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * size[s]]
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = cap * size[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


@pytest.mark.parametrize("leaf_rows", [10_000, 4])
def test_mix_meets_targets(spark, leaf_rows):
    data = rows(n=120)
    docs = frame(spark, data)
    got = mixing.copies(docs, leaf_rows=leaf_rows).collect()
    assert len(got) == len(data)
    size, taken, most, target = Counter(), Counter(), Counter(), {}
    for r in got:
        s = r["source"]
        assert r["copies"] in (0, 1, 2) and (r["size"] or not r["copies"])
        size[s] += r["size"]
        taken[s] += r["size"] * r["copies"]
        most[s] = max(most[s], r["size"])
        target[s] = r["target"]
    want = fill({s: sum(len(words(r[1])) for r in data if r[3] == s) for s in {r[3] for r in data}})
    for s in want:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6
    again = mixing.copies(frame(spark, data, 5), leaf_rows=leaf_rows).collect()
    each = lambda rs: Counter((r["id"], r["tk"], r["source"], r["copies"]) for r in rs)
    assert each(again) == each(got)
    mixed = mixing.mix(docs, leaf_rows=leaf_rows)
    assert mixed.columns == docs.columns
    want_rows = Counter()
    for r in got:
        want_rows[r["id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +want_rows


def test_copies_are_unbiased():
    """Over many draws each fraction is taken about as often as it says."""
    n, total = 400, np.zeros(6)
    p, size = [0.3, 0.8, 0.5, 0.1, 0.6, 0.7], [50, 40, 30, 20, 10, 5]
    for t in range(n):
        keys = [f"{t}-{i}".encode() for i in range(6)]
        out = mixing._round_group(keys, size, p, 0, False)
        assert sum(o * s for o, s in zip(out, size)) == pytest.approx(sum(o * s for o, s in zip(p, size)))
        assert sum(0 < o < 1 for o in out) <= 1
        total += out
    assert np.abs(total / n - p).max() < 0.1


def test_mix_of_an_empty_table_and_empty_texts(spark):
    assert mixing.copies(frame(spark, [], 1)).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None, None, "", 1, "", "")] * 3, 1)).count() == 0


# ------------------------------------------------------------------ token output


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    data = rows() + [(300 + i, t) + ("en", "s", "", 1, "", "") for i, t in enumerate(
        ["I'm İstanbul ΣΑΣ", "<|endoftext|> a", "a\x1cb\x85c\u2003d", "\u0301e \u0301", "'s 't 12345"])]
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(spark, data), path, token_output.tokenizer_path(), parts=3)
    got = spark.createDataFrame(token_output.read_tokens(spark, path).collect()).orderBy("start").collect()
    tok = Tokenizer.from_file(token_output.tokenizer_path())
    want = Counter((r[0], tuple(tok.encode(r[1] or "", add_special_tokens=False).ids + [1])) for r in data)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids[:len(known)] == known
    assert sorted(map(tuple, token_output.lookup(spark, path, 104))) == sorted(i for (d, i), n in want.items() for _ in range(n) if d == 104)
    payload = bytes(spark.read.parquet(f"{path}/segments").first()["payload"])
    with pytest.raises(ValueError):
        token_output.Segment(payload, b"\0" * 32)


def test_a_dictionary_is_trained_where_there_is_enough(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = str(tmp_path / "t")
    token_output.write_tokens(docs, path, token_output.tokenizer_path())
    d = spark.read.parquet(f"{path}/dictionary").first()
    assert len(d["dictionary"]) > 1000 and hashlib.sha256(bytes(d["dictionary"])).hexdigest() == d["hash"]
    assert token_output.read_tokens(spark, path, False).count() == docs.count()


def test_long_and_few_documents_have_a_dictionary(spark, tmp_path):
    """All documents long, or one short one: the dictionary is there, and every document is read back."""
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(3000)]
    long = [(i, " ".join(rng.choice(vocab, 5000))) for i in range(30)]
    for n, data in enumerate((long, [(1, "a")], [(1, None)], [(5, "same text")] * 50)):
        path = str(tmp_path / f"t{n}")
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
        token_output.write_tokens(docs, path, token_output.tokenizer_path())
        d = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
        assert len(d) >= (10_000 if n == 0 else 8)
        tok = __import__("tokenizers").Tokenizer.from_file(token_output.tokenizer_path())
        want = Counter(tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in data)
        assert Counter(tuple(r["ids"]) for r in token_output.read_tokens(spark, path).collect()) == want
    # Slices, not prefixes: what only stands at the ends of long texts is learned too.
    tail = [(i, "x " * 30_000 + "unusual tail words here " * 2000) for i in range(4)]
    docs = spark.createDataFrame(tail, "doc_id long, text string")
    encoder = token_output.Encoder(open(token_output.tokenizer_path()).read())
    assert encoder.batch([b"unusual tail words here"])[0][:-2] in token_output.train_dictionary(
        docs, open(token_output.tokenizer_path()).read())


def test_no_documents_no_tokens(spark):
    assert token_output.encoded(frame(spark, [], 1)).count() == 0


# ------------------------------------------------------------------ top-k


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_topk_equals_brute_force(spark, scale):
    rng = np.random.default_rng(0)
    vectors = [(i, (rng.normal(0, scale, 12 if i % 7 else 9)).tolist()) for i in range(150)]
    vectors += [(200, None), (201, [1.0, None]), (202, [float("nan")]), (203, [float("inf")]), (204, []), (None, [1.0] * 12),
                (205, vectors[3][1]), (206, vectors[3][1]), (206, vectors[3][1])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    whole = topk.whole_numbers(df, "vec_id", "embedding")
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for parts, k in ((1, 10), (6, 3)):
        got = sorted(map(tuple, topk.search(whole, whole.where("id % 10 = 0"), k, parts, step=4).select(
            "query_id", "rank", "vec_id", "score").collect()))
        want = []
        for q, v in good:
            if q % 10 == 0:
                scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
                want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
        assert got == sorted(want)


def test_topk_of_empty_tables(spark):
    df = topk.whole_numbers(spark.createDataFrame([(0, [1.0])], "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    assert topk.search(df, df, 10, 2).count() == 0
    assert topk.search(df.limit(0), df, 10, 2).count() == 0


def test_levels_are_suffix_arrays_and_merge_by_order():
    rng = np.random.default_rng(3)
    vocab = [bytes(rng.integers(97, 101, rng.integers(2, 9)).astype(np.uint8)) for _ in range(40)]
    texts = [b" ".join(vocab[j] for j in rng.integers(0, 40, 400)) for _ in range(12)]
    texts[7] = texts[2][100:900] + texts[7]
    entries = [suffix_dedup.cut([(d, 0, 0, t)])[0] for d, t in enumerate(texts)]

    def suffixes(level):
        e = level.entries
        return [bytes(e.content[i, e.anchor[i]:e.runs[i] + suffix_dedup.LENGTH - 1]).ljust(84, b"\0") for i in range(len(e))]

    a, b = (suffix_dedup.Level.of(suffix_dedup.Entries.join(entries[i::2])) for i in (0, 1))
    whole = suffix_dedup.Level.of(suffix_dedup.Entries.join(entries))
    for level in (a, b, whole, a.merged(b)):
        assert suffixes(level) == sorted(suffixes(level))
        assert [s[:16] for s in suffixes(level)] == [x.ljust(16, b"\0") for x in level.anchor.tolist()]
    assert suffixes(a.merged(b)) == suffixes(whole)
    groups, rows = a.scan(b)
    shared = set(a.anchor.tolist()) & set(b.anchor.tolist())
    assert {a.distinct[g] for g in groups.tolist()} == shared and {b.anchor[r] for r in rows.tolist()} == shared
    assert len(rows) == sum(x in shared for x in b.anchor.tolist())
    family = suffix_dedup.LevelFamily()
    for e in entries:
        family.add(e)
    sizes = {rank: len(level.anchor) for rank, level in family.levels.items()}
    assert sorted(sizes) == [2, 3]  # 12 batches: levels of 4 and of 8
