"""Benchmark decontamination by a prefix-filtered set join.

Method: a benchmark item's windows of ``window`` consecutive words (a shorter
item is one window) are sets of word shingles that a document must hold whole.
Shingles are ordered by their count in all documents.  Containment of all
shingles needs a prefix of one token, so each window is joined through its
rarest shingle only.  A joined position fixes where the window would start:
the positional bound (start not before the document) and the length bound
(end not behind it) come first, then the words are compared exactly.
DataFrame functions only.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.

Plan: documents are exploded to shingles inside one code-generated stage that
probes a broadcast table, so neither texts nor shingles are shuffled; only
matches are.  The broadcast table holds shingle, place, length and a hash
of at most ``block_rows`` windows, 24 bytes each, whatever their words and items:
a bound that is checked; more windows run in more passes.  Matched words are
compared with the window's, and windows led to their items, in salted joins.

Defined cases: null texts have no words; an item without words has no window;
items with the same id are one item, a null item_id counts as an item with an
empty id; rows with equal (doc_id, text) get equal results, also for a null
doc_id; empty tables give no hits; the input's columns stay in :func:`clean`,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stored, table, text_of, word_count

WINDOW, SHINGLE, BLOCK_ROWS, SALTS = 10, 3, 200_000, 16
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lower-cased.
ANY_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), GAPS), "")


def windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, w, len, wid): each item's distinct windows: the words space-joined, their number, 128 bits of hash."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                     words(text_of(text_col)).alias("words")).where(F.size("words") > 0)
    return w.select("item", F.least(F.size("words"), F.lit(window)).alias("len"), F.explode(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))),
                    lambda i: F.array_join(F.slice("words", i, window), " "))).alias("w"),
    ).distinct().withColumn("wid", _wid("w"))


def _wid(w) -> Column:
    return F.unhex(F.md5(F.col(w) if isinstance(w, str) else w))


def _shingle_hash(array: str, pos: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(F.col(array), pos + j) for j in range(n)])


def _document_shingles(docs: DataFrame, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """(id, tk, words, pos, h) for every shingle of ``lengths`` words; stays in the scan's stage."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), words(text_of(text_col)).alias("words"))
    at = rows.select("id", "tk", "words", F.posexplode("words").alias("pos", "word"))
    hashes = [_shingle_hash("words", F.col("pos"), n) for n in lengths]
    return at.select("id", "tk", "words", "pos", hashes[0].alias("h") if len(hashes) == 1
                     else F.explode(F.array(*hashes)).alias("h"))


def _pass(docs: DataFrame, own: DataFrame, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """Matches (id, tk, start, len, x, found) of one block of distinct windows, by the hash x of the words found."""
    tokens = own.withColumn("ws", F.split("w", " ")).select(
        F.xxhash64("w").alias("x"), "len", F.least("len", F.lit(SHINGLE)).alias("n"), "ws",
        F.explode(F.sequence(F.lit(0), F.col("len") - F.least("len", F.lit(SHINGLE)))).alias("off"))
    h = reduce(lambda out, n: F.when(F.col("n") == n, _shingle_hash("ws", F.col("off"), n)).otherwise(out), lengths,
               F.lit(None).cast("long"))
    tokens = tokens.select("x", "len", "off", h.alias("h"))
    probed = _document_shingles(docs, lengths, id_col, text_col)
    counts = probed.join(F.broadcast(tokens.select("h").distinct()), "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    # A token that no document holds rules its window out: the inner join on the
    # rarest one, counted 0 where it is absent, drops it.
    prefix = tokens.join(counts, "h", "left").groupBy("x", "len").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "h")).alias("t")
    ).where("t.n > 0").select(F.col("t.h").alias("h"), F.col("t.off").alias("off"), "x", "len")
    start = F.col("pos") - F.col("off")
    bounds = (start >= 0) & (start + F.col("len") <= F.size("words"))
    found = F.array_join(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("len")), " ")
    return probed.join(F.broadcast(prefix), "h").where(bounds & (F.xxhash64(found) == F.col("x"))).select(
        "id", "tk", start.alias("start"), "len", "x", found.alias("found"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_rows: int = BLOCK_ROWS,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document that holds a window: (id, tk, n_hit, items, spans).

    ``tk`` is xxhash64 of the text; ``items`` the sorted ids; ``spans`` the
    [start, end) word spans of the windows.
    """
    held = stored(windows(items, window, item_col, item_text))
    each = stored(held.select("wid", "w", "len").distinct())
    found = {r["n"]: r["c"] for r in each.groupBy(F.least("len", F.lit(SHINGLE)).alias("n")).agg(
        F.count(F.lit(1)).alias("c")).collect()}  # at most SHINGLE rows
    lengths = sorted(found) or [SHINGLE]
    blocks = max(1, -(-sum(found.values()) // block_rows))
    passes = [_pass(docs, each.where(F.pmod(F.xxhash64("w"), F.lit(blocks)) == b) if blocks > 1 else each,
                    lengths, id_col, text_col) for b in range(blocks)]
    # Few rows from here on.  The words are compared themselves, and windows led to their
    # items, in joins salted on the documents' side: one window may be in very many documents.
    salt = F.pmod(F.xxhash64("id", "tk", "start"), F.lit(SALTS)).cast("int").alias("salt")
    salted = lambda t: t.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    raw = stored(reduce(DataFrame.unionByName, passes).withColumn("salt", salt))
    # Only windows that some document holds are copied to the salts.
    met = each.withColumn("x", F.xxhash64("w")).join(raw.select("x").distinct(), "x", "left_semi")
    exact = salted(met.select("wid", "x", F.col("w").alias("found")))
    matched = stored(raw.join(exact, ["x", "found", "salt"]).select("id", "tk", "start", "len", "wid", "salt"))
    owners = held.select("item", "wid").join(matched.select("wid").distinct(), "wid", "left_semi")
    spans = matched.groupBy("id", "tk").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("spans"))
    ids = matched.select("id", "tk", "wid", "salt").distinct().join(salted(owners), ["wid", "salt"]).groupBy(
        "id", "tk").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.col("id").alias("item_doc"), F.col("tk").alias("item_tk"), "items")
    per_doc = spans.join(ids, F.col("id").eqNullSafe(F.col("item_doc")) & (F.col("tk") == F.col("item_tk")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["e"]))).alias("n"),
                              F.greatest(a["e"], s["end"]).alias("e")))["n"]
    return per_doc.select("id", "tk", covered.cast("long").alias("n_hit"), "items", "spans")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item; same columns."""
    bad = hits(docs, items, id_col=id_col, text_col=text_col, **options).select(
        F.col("id").alias("bad_id"), F.col("tk").alias("bad_tk"))
    # The row travels in one struct: no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("tk") == F.col("bad_tk")), "left_anti").select("row.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hits(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    every = docs.select("doc_id", F.xxhash64("text").alias("__tk"),
                        word_count(text_of("text"), ANY_GAPS).alias("n_words"))
    out = every.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("__tk") == F.col("tk")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
    SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, n, p, array_to_string(ws[p:p + n - 1], ' ') AS w FROM (
    SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, ns WHERE len(ws) >= n)),
m AS (SELECT r, item, p, iw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.w = iw.w),
c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
