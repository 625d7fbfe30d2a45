"""Operators on the DataFrame path: line dedup, URL filter, sharding, decontamination."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_cases import SCHEMA, ascii_lower, frame, key, rows

from evoclust.llm import decontaminate, line_dedup, queries, sharding, url_filter

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark embeddings".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
    res = con.execute(queries.ORACLE[name])
    at = [[d[0] for d in res.description].index(c) for c in cols]
    assert got == sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=key)


# ------------------------------------------------------------------ line dedup


def brute_lines(data, min_docs, min_chars):
    keyed = [[(line, ascii_lower(line.strip(" \t\n\x0b\x0c\r"))) for line in (t or "").split("\n")] for t in data]
    n = Counter(k for lines in keyed for k in {k for _, k in lines if len(k) >= min_chars})
    out = []
    for lines in keyed:
        stay = [line for line, k in lines if len(k) < min_chars or n[k] < min_docs]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 1), (2, 8), (1, 1)])
def test_lines(spark, min_docs, min_chars):
    data = rows()
    out = line_dedup.drop_common_lines(frame(spark, data), min_docs, min_chars)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=key)
    want = [(r[0], *b) for r, b in zip(data, brute_lines([r[1] for r in data], min_docs, min_chars))]
    assert got == sorted(want, key=key)
    assert {"shard", "h", "rank", "id"} <= set(out.columns)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.drop_common_lines(frame(spark, [], 1)).count() == 0


# ------------------------------------------------------------------ URL filter


def brute_rule(host, path, rules):
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return None, "allow"
    best = min(fit, key=lambda f: (-f[0], -f[1], f[2], f[3] != "block"))
    return best[2], best[3]


URLS = ["http://a.com/x/y", "https://A.B.com/x/", "http://b.com", "http://b.com?q=/x/", "no scheme", None, "", "://", "http:///x",
        "ftp://c.b.com/x#f", "http://com/", "http://acom/x", "http://b.com:80/x", "http://u@b.com/x", "a://b://c/d", "http://x.b.com./x",
        "http://é.b.com/é/", "http://b.com/x\ny", "http://" + "a." * 300 + "com/x/"]


def test_url_rules(spark):
    rng = random.Random(1)
    rules = [("com", "/", "block"), ("com", "/x/", "allow"), ("b.com", "", "allow"), ("b.com", "/x", "block"), ("a.b.com", "/x/", "allow"),
             ("c.b.com", "/x", "block"), ("c.b.com", "/x", "allow"), ("é.b.com", "/é", "block")]
    data = [(i, rng.choice(URLS), "h", "k") for i in range(200)] + [(None, URLS[0], "h", "k")] * 2
    pages = spark.createDataFrame(data, "page_id bigint, url string, host string, key string").repartition(3)
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("com", "/", None)], "host string, path string, verdict string")
    got = sorted(((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"], r["key"])
                  for r in url_filter.judge(pages, table, lanes=5).collect()), key=key)
    want = []
    for i, url, _, k in data:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (ascii_lower(m[1]), m[2]) if m else ("", "")
        want.append((i, url, host, path, *brute_rule(host, path, rules), k))
    assert got == sorted(want, key=key)
    assert url_filter.judge(pages.limit(0), table).count() == 0
    assert url_filter.judge(pages, table.limit(0)).where("rule is null and verdict = 'allow'").count() == len(data)


def test_many_nested_rules(spark):
    """Hundreds of rules a host, paths inside paths, hosts inside hosts: as brute force, and no row carries them all."""
    rng = random.Random(2)
    hosts = ["com", "b.com", "a.b.com", "c.b.com", "net", "x.net"]
    paths = ["".join(rng.choice(["/", "a", "b", "é", "/a"]) for _ in range(rng.randint(0, 9))) for _ in range(150)]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(900)]
    data = [(i, f"http://{rng.choice(['', 'www.', 'Z.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'b', '/x', '?q', '#f'])}")
            for i in range(400)] + [(7, "http://www.com/a")] * 50
    pages = spark.createDataFrame(data, "page_id long, url string").repartition(4)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(((r["page_id"], r["url"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, table, lanes=5).collect()), key=key)
    want = []
    for i, url in data:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
        want.append((i, url, *brute_rule(ascii_lower(m[1]), m[2], rules)))
    assert got == sorted(want, key=key)
    one = url_filter.path_breakpoints(url_filter._rules(table))
    assert dict(one.dtypes)["rule"].startswith("struct<") and one.count() == 2 * len({r[:2] for r in rules})


# ------------------------------------------------------------------ sharding


def test_shards_are_stable_and_slots_gapless(spark):
    docs = frame(spark, rows())
    raw = sharding.assign(docs.drop("shard"), 24)
    grown = sharding.assign(raw, 25, out="grown")
    got = grown.collect()
    assert all(0 <= r["shard"] < 24 for r in got)
    assert all(r["grown"] in (r["shard"], 24) for r in got)
    slots = defaultdict(list)
    for r in sharding.number(raw, "shard", ["doc_id", "text"], cells=3).collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = {(r["doc_id"], r["text"]): r["shard"] for r in raw.repartition(7).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["shard"] for r in got)


def test_shares_follow_weights_and_moves_stay_in_subtrees(spark):
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    weights = [1.0] * 24
    more = weights[:5] + [4.0] + weights[6:]
    both = sharding.assign(sharding.assign(ids, 24, out="a", weights=weights), 24, out="b", weights=more).collect()
    n = Counter(r["b"] for r in both)
    assert abs(n[5] / 6000 - 4 / 27) < 0.03
    for r in both:  # shard 5 is in region 0 and rack 2
        if r["a"] != r["b"]:
            assert r["b"] // 8 == 0 or r["a"] // 8 == 0
        if r["a"] // 8 != 0 and r["b"] // 8 != 0:
            assert r["a"] == r["b"]
    none = sharding.assign(ids, 24, out="s", weights=[0.0] + [1.0] * 23)
    assert none.where("s = 0").count() == 0


def test_shards_of_an_empty_table_and_files(spark, tmp_path):
    assert sharding.number(sharding.assign(frame(spark, [], 1), 24), "shard", ["doc_id"]).count() == 0
    sharding.write_shards(frame(spark, rows()), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows())


# ------------------------------------------------------------------ decontamination


def bench_words(s):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(s or ""))


def brute_hits(texts, items, window):
    grams = defaultdict(set)
    for item, t in items:
        w = bench_words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[i:i + n])].add("" if item is None else str(item))
    out = []
    for t in texts:
        w, hit, found = bench_words(t), set(), set()
        for g, ids in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= ids
        out.append((len(w), len(hit), ",".join(sorted(found))))
    return out


@pytest.mark.parametrize("block_rows", [100_000, 5])
def test_decontamination(spark, block_rows):
    data = rows()
    body = bench_words(data[2][1])
    items = [(1, " ".join(body[:14])), (2, data[7][1]), (3, "É ÀB"), (4, None), (5, "!"), (10, data[7][1]), (None, "alone, WITHOUT"),
             (6, "x" * 3000), (7, "read")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = frame(spark, data)
    found = {(r["id"], r["tk"]): (r["n_hit"], ",".join(r["items"])) for r in decontaminate.hits(docs, bench, block_rows=block_rows).collect()}
    tk = {(r["doc_id"], r["text"]): r["k"] for r in docs.selectExpr("doc_id", "text", "xxhash64(text) k").collect()}
    want = brute_hits([r[1] for r in data], items, 10)
    assert [found.get((r[0], tk[r[0], r[1]]), (0, "")) for r in data] == [(b[1], b[2]) for b in want]
    clean = sorted((tuple(r) for r in decontaminate.clean(docs, bench, block_rows=block_rows).collect()), key=key)
    assert clean == sorted((r for r, b in zip(data, want) if not b[1]), key=key)


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.hits(frame(spark, rows()), bench).count() == 0
    assert decontaminate.clean(frame(spark, [], 1), bench).count() == 0


def test_crc_and_sha_are_the_usual_ones(spark):
    r = spark.createDataFrame([("é",)], "t string").selectExpr("crc32(cast(t as binary)) c", "sha2(cast(t as binary), 256) s").first()
    assert r["c"] == zlib.crc32("é".encode()) and r["s"] == hashlib.sha256("é".encode()).hexdigest()
    assert SCHEMA


CLASHING = ("doc_id long, text string, __id long, __tk long, __lines int, __line_key string, row string, id int, tk int, dropped int, "
            "lines int, hit_id int, bad_id int, items string, keep_id int, fp int, root int")


def test_columns_of_any_name_stay(spark):
    from evoclust.llm import simhash

    rows = [(i, t) + tuple(-j if k not in (5, 6, 13) else f"v{j}" for j, k in enumerate(range(2, 17)))
            for i, t in [(1, "shared line\none two three"), (2, "Shared line \nfour"), (3, None), (None, "shared line"), (4, "alone here")]]
    docs = spark.createDataFrame(rows, CLASHING).repartition(2)
    out = line_dedup.drop_common_lines(docs, min_docs=3)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == "one two three" and got[1]["n_dropped"] == 1 and got[3]["text"] == "" and got[None]["text"] == ""
    assert all(tuple(r)[2:17] == rows[0][2:] for r in got.values())
    again = line_dedup.drop_common_lines(out, min_docs=3)
    assert again.columns == out.columns  # its own counts are replaced
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    clean = decontaminate.clean(docs, bench)
    assert clean.schema == docs.schema and {r["doc_id"] for r in clean.collect()} == {2, 3, None, 4}
    one = simhash.one_of_each(docs.unionByName(docs))
    assert one.schema == docs.schema and one.count() == 5
