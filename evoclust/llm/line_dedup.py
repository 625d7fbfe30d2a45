"""Line dedup: lines that many documents share are dropped everywhere.

Method: explode the normalised lines, hash them, count the distinct documents
of each hash, drop the lines over the threshold, reassemble by position.
DataFrame functions only.

Every input row is one document, whatever its ``doc_id``.  A line's key is the
line without blanks (space, 09-0D) at both ends and with A-Z lower-cased.
Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` are never dropped; rows with equal (doc_id, text) get equal
results, also when ``doc_id`` is null; an empty table gives an empty result;
the input's columns are carried through by :func:`drop_common_lines`, whatever
their names; those named ``n_lines`` or ``n_dropped`` are replaced.

Plan: the text itself is shuffled once, in the last join.  What else moves
are rows of (document key, line positions, 128-bit line hash).  The count is
pre-aggregated per task; the join of lines with the common hashes is salted
(each common hash goes to ``SALTS`` places, each line to one), so a line that a
third of all documents hold is spread, and sort-merge or broadcast is Spark's
choice at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, text_of

SALTS = 16


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _document_key(text: str) -> Column:
    return F.xxhash64(F.col(text))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(id, text hash, line hash, positions of that line), a row for each document and distinct key."""
    rows = docs.select(
        F.col(id_col).alias("id"), _document_key(text_col).alias("tk"),
        F.posexplode(F.split(text_of(text_col), "\n")).alias("pos", "line"),
    ).withColumn("key", line_key(F.col("line")))
    return rows.where(F.char_length("key") >= min_chars).select("id", "tk", "pos", F.unhex(F.md5("key")).alias("h"))


def common_lines(docs: DataFrame, min_docs: int, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 1) -> DataFrame:
    """Hashes of the keys that at least ``min_docs`` rows of ``docs`` hold: (h, n_docs)."""
    keys = F.array_distinct(F.transform(F.split(text_of(text_col), "\n"), line_key))
    return (
        docs.select(F.explode(keys).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .groupBy(F.unhex(F.md5("key")).alias("h"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` reassembled from the lines that stay, plus ``n_lines``, ``n_dropped``."""
    common = common_lines(docs, min_docs, id_col, text_col, min_chars).select(
        "h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # Equal rows would each list their positions: the set keeps one of each.
    hits = (
        line_rows(docs, id_col, text_col, min_chars)
        .withColumn("salt", F.pmod(F.xxhash64("id", "tk", "pos"), F.lit(SALTS)).cast("int"))
        .join(common, ["h", "salt"])
        .groupBy("id", "tk")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    named = hits.select(F.col("id").alias("hit_id"), F.col("tk").alias("hit_tk"), "dropped")
    # The row travels in one struct: no column of it can clash.
    left = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), _document_key(text_col).alias("tk"))
    joined = left.join(named, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("tk") == F.col("hit_tk")), "left")
    cut = joined.select("row", F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"), "dropped").select(
        "row", "text", F.split("text", "\n").alias("lines"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    text = F.when(F.size("dropped") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n"))
    kept = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cut.select(*kept, F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"))


def op6_line_dedup(spark, sf_dir) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document, at 10 documents and 1 code point."""
    from .common import table

    out = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, unnest(range(0, len(string_split(t, chr(10))))) AS pos, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (SELECT r, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
f AS (SELECT r, pos, line, key IN (SELECT key FROM c) AS gone FROM k)
SELECT d.doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM f JOIN d USING (r) GROUP BY f.r, d.doc_id
"""
