"""Mixing sources to target weights by pivotal dependent rounding.

Method: every document of a source should be copied target / source size
times, a number between 0 and ``cap``.  Documents are drawn from the largest
to the smallest, each paired with the pool of those behind it, which share one
copy number: word mass moves at random between the document and the pool until
the document's number is integral (or the pool's is, at 0 or ``cap``).  A move
of m words changes a number by m / size, so the words of the pair stay the
same, and the directions are drawn so that both keep their expectation; where
the pool can only bear one direction, that one is taken, for the target's sake.
Each leaf of about ``leaf_rows`` documents leaves one fractional document, as a
rule its smallest.  The leaves' residuals are paired in a reduction tree of
that fan-in, level by level, down to one document per source, which is rounded
to the nearer side; a source's words miss its target by at most half of it.

Targets share ``share`` times all words in proportion to the sources' weights
(5, 2, 1 repeating in code-point order, null last); no target exceeds ``cap``
times its source's words, the excess is shared among the others by weight.

Distribution: rows that agree in id, text and source are counted first (a
partial aggregate) and travel as one row, in parts of at most ``leaf_rows``
documents.  A leaf is (source, hash bucket), the number of buckets grows with
the source, so a source with a third of all rows has a third of the leaves, and
a document repeated in a third of all rows has as many parts.  Where the copies
of repeated rows are dealt to the rows, these are numbered within the partitions
they lie in.  All draws are hashes of the documents, so reruns agree.

Sizes are counts of ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null or empty texts
have size 0 and are never copied; a source without words has target 0; a null
doc_id counts as an id of its own; repeated rows are documents each, and their
copies differ by one at most; an empty table gives an empty result; the input's
columns stay in :func:`mix`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from math import floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, table, text_of, word_count

WEIGHTS, SHARE, CAP, LEAF_ROWS = (5, 2, 1), 1.5, 2.0, 10_000
_EPS = 1e-9


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size, rows); n documents have words.

    With sources in order of cap / weight, those up to some place are capped;
    the rest shares what is left by weight.  The two windows run over one row
    per source.
    """
    per = sizes.groupBy("source").agg(F.coalesce(F.sum(F.col("size") * F.col("rows")), F.lit(0)).alias("source_size"),
                                      F.sum(F.when(F.col("size") > 0, F.col("rows")).otherwise(0)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(cap))
    every = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    ranked = per.withColumn("weight", weight).withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    after = every.rowsBetween(0, Window.unboundedFollowing)
    all_ = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ranked.withColumn("total", F.sum("source_size").over(all_) * F.lit(float(share))).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # The first place whose level its own ratio reaches sets the level of all behind it.
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(all_)
    fill = level.withColumn("fill", first["level"]).withColumn("place_", F.row_number().over(every)).withColumn(
        "from_", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("place_"))).over(all_))
    return fill.select("source", "source_size", "n", F.when(
        F.col("place_") >= F.col("from_"), F.least(F.col("limit"), F.col("weight") * F.col("fill"))
    ).otherwise(F.col("limit")).alias("target"))


def _uniform(level: int, a: bytes, b: bytes) -> float:
    return (xxhash.xxh3_64_intdigest(a + b"|" + b, level) + 0.5) / 2.0 ** 64


def _round_group(key: list[bytes], size: list[int], p: list[float], level: int, last: bool) -> list[float]:
    """Fractions after pivoting; at most one stays between 0 and 1, none if ``last``."""
    out, at = list(p), -1
    for i in range(len(out)):
        if not _EPS < out[i] < 1 - _EPS:
            out[i] = float(round(out[i]))
            continue
        if at < 0:
            at = i
            continue
        si, sj = size[at], size[i]
        up = min((1 - out[at]) * si, out[i] * sj)      # words that can move to the held document
        down = min(out[at] * si, (1 - out[i]) * sj)    # and away from it
        moved = up if _uniform(level, key[at], key[i]) * (up + down) < down else -down
        out[at] += moved / si
        out[i] -= moved / sj
        held = [x for x in (at, i) if _EPS < out[x] < 1 - _EPS]
        for x in (at, i):
            if x not in held:
                out[x] = float(round(out[x]))
        at = held[0] if held else -1
    if last and at >= 0:
        out[at] = float(out[at] > 0.5)
    return out


def _settle(key: list[bytes], size: list[int], rows: list[int], factor: float, cap: float, last: bool) -> tuple[list[int], list[float]]:
    """(copies, fraction left of one document) for rows of ``rows`` documents each, sizes falling.

    ``f`` is the copy number that all documents from here on share.
    """
    copies, left = [0] * len(size), [0.0] * len(size)
    f, rest = factor, float(sum(s * n for s, n in zip(size, rows)))
    for r, (s, n) in enumerate(zip(size, rows)):
        for j in range(n):
            rest = max(0.0, rest - s)
            low = floor(f + _EPS)
            part = f - low
            if part < _EPS:
                copies[r] += low
                continue
            up, down = (1 - part) * s, part * s  # words that make the document integral
            can_up, can_down = up <= f * rest + _EPS, down <= (cap - f) * rest + _EPS
            if can_up or can_down:
                higher = can_up and (not can_down or _uniform(j, key[r], b"") < part)
                copies[r] += low + higher
                f += (down if not higher else -up) / max(rest, _EPS)
                f = min(max(f, 0.0), cap)
                continue
            # The pool becomes integral instead, and the document is what the leaf leaves.
            out, back = f * rest, (cap - f) * rest
            if rest > _EPS:
                gains = _uniform(j, key[r], b"") * (out + back) < back
                own = f + (out if gains else -back) / s
                f = 0.0 if gains else cap
            else:
                own = f
            low = floor(own + _EPS)
            copies[r] += low
            left[r] = max(0.0, own - low)
    if last:
        copies = [c + (p > 0.5) for c, p in zip(copies, left)]
        left = [0.0] * len(left)
    return copies, left


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups (source_key, bucket) from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("source_key", "bucket")]
        same = (group[0] == group[0][-1]) & (group[1] == group[1][-1])
        cut = batch.num_rows - int(same.sum())
        now = (group[0][-1], group[1][-1])
        if held and (cut or now != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
        last = now
    if held:
        yield pa.Table.from_batches(held)


def _pivot(batches: Iterator[pa.RecordBatch], level: int, last: bool, cap: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: level 0 settles leaves, the others pair the residual fractions ``p`` of groups."""
    for t in _grouped(batches):
        group = [t.column(n).to_numpy() for n in ("source_key", "bucket")]
        cuts = np.flatnonzero(np.r_[True, (group[0][1:] != group[0][:-1]) | (group[1][1:] != group[1][:-1]), True]).tolist()
        key, size, rows, p, factor, copies = (t.column(n).to_pylist() for n in ("key", "size", "rows", "p", "factor", "copies"))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if level:
                p[a:b] = _round_group(key[a:b], size[a:b], p[a:b], level, last)
            else:
                copies[a:b], p[a:b] = _settle(key[a:b], size[a:b], rows[a:b], factor[a], cap, last)
        for name, values, kind in (("p", p, pa.float64()), ("copies", copies, pa.int64())):
            t = t.set_column(t.schema.get_field_index(name), name, pa.array(values, kind))
        yield from t.combine_chunks().to_batches()


def _totals(sized: DataFrame, weights: Sequence[float], share: float, cap: float, leaf_rows: int) -> DataFrame:
    """(id, tk, source, size, rows, source_size, target, copies): all copies of each group of equal rows.

    ``sized`` has a row (id, tk, source, size) for each document.
    """
    spark = sized.sparkSession
    own = ["id", "tk", "source", "size"]
    keyed = stored(sized.groupBy(*own).agg(F.count(F.lit(1)).alias("rows")))
    goal = stored(targets(keyed, weights, share, cap)).withColumnRenamed("source", "__source")
    deep = goal.agg(F.max("n")).first()[0] or 0
    whole = keyed.join(goal, F.col("source").eqNullSafe(F.col("__source")))
    parts = F.ceil(F.col("rows") / leaf_rows).cast("int")
    key = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("tk").cast("string"),
                      F.coalesce("source", F.lit("")), F.col("part").cast("string"))
    rows = whole.where("size > 0").select(*own, "source_size", "target", "n", F.col("rows").alias("all"),
                                          F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")).select(
        *own, "source_size", "target", "all", F.md5(key).cast("binary").alias("key"),
        (F.floor(F.col("all") / F.ceil(F.col("all") / leaf_rows)) + (
            F.col("part") < F.col("all") % F.ceil(F.col("all") / leaf_rows)).cast("long")).cast("long").alias("rows"),
        (F.col("target") / F.col("source_size")).alias("factor"), F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("copies"),
        F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("source_key"),
        F.ceil(F.col("n") / leaf_rows).cast("int").alias("buckets"),
    ).withColumn("bucket", F.pmod(F.xxhash64("key"), F.col("buckets")).cast("int")).drop("buckets")
    finished, level, top = [], 0, 1
    while leaf_rows ** top < deep:
        top += 1
    while True:
        last = level == top - 1
        dealt = rows.repartition(shuffle_partitions(spark), "source_key", "bucket").sortWithinPartitions(
            "source_key", "bucket", F.col("size").desc(), "key")
        rounded = dealt.mapInArrow(partial(_pivot, level=level, last=last, cap=float(cap)), rows.schema)
        if last:
            finished.append(rounded)
            break
        rounded = stored(rounded)
        half = (F.col("p") > 0) & (F.col("p") < 1)
        finished.append(rounded.withColumn("p", F.when(half, 0.0).otherwise(F.col("p"))))
        # One residual per bucket: leaf_rows buckets meet in one of the next level, as one document each.
        rows = rounded.where(half).withColumn("bucket", F.floor(F.col("bucket") / leaf_rows).cast("int")).withColumn(
            "copies", F.lit(0).cast("long"))
        level += 1
    every = finished[0]
    for more in finished[1:]:
        every = every.unionByName(more)
    out = every.groupBy(*own, "source_size", "target", F.col("all").alias("rows")).agg(
        F.sum(F.col("copies") + F.col("p").cast("long")).alias("copies"))
    none = whole.where("size = 0").select(*own, "source_size", "target", "rows", F.lit(0).cast("long").alias("copies"))
    return out.unionByName(none.select(*out.columns))


def _shared(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` (id, tk, source, ...) with the columns of ``totals`` and each row's own ``copies``.

    Of n copies of m equal rows each row gets n div m, and the first n mod m one
    more.  Equal rows are numbered within the partitions that the join left
    them in, so a text in a third of all rows is no task's alone.
    """
    goal = totals.select(F.col("id").alias("g_id"), F.col("tk").alias("g_tk"), F.col("source").alias("g_source"),
                         "size", "rows", "source_size", "target", F.col("copies").alias("all"))
    joined = rows.join(goal, rows["id"].eqNullSafe(goal["g_id"]) & (rows["tk"] == goal["g_tk"])
                       & rows["source"].eqNullSafe(goal["g_source"])).drop("g_id", "g_tk", "g_source")
    single = joined.where("rows = 1").withColumn("copies", F.col("all")).drop("all", "rows")
    many = joined.where("rows > 1")
    same, place = ["id", "tk", "source"], F.spark_partition_id()
    numbered = stored(many.withColumn("place", place).withColumn("i", F.row_number().over(
        Window.partitionBy(*same, "place").orderBy(F.lit(0)))))
    before = Window.partitionBy(*same).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy(*same, "place").agg(F.count(F.lit(1)).alias("c")).select(
        F.col("id").alias("c_id"), F.col("tk").alias("c_tk"), F.col("source").alias("c_source"), F.col("place").alias("c_place"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    placed = numbered.join(counts, numbered["id"].eqNullSafe(counts["c_id"]) & (numbered["tk"] == counts["c_tk"])
                           & numbered["source"].eqNullSafe(counts["c_source"]) & (numbered["place"] == counts["c_place"]))
    each = F.floor(F.col("all") / F.col("rows")) + (F.col("base") + F.col("i") <= F.col("all") % F.col("rows")).cast("long")
    return single.unionByName(placed.withColumn("copies", each.cast("long")).select(*single.columns))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), F.col(source_col).alias("source"), *more)


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
           leaf_rows: int = LEAF_ROWS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, tk, source, size, source_size, target, copies), a row for each row of ``docs``; ``tk`` is xxhash64 of the text."""
    size = word_count(text_of(text_col)).alias("size")
    sized = stored(_sized(docs, id_col, text_col, source_col, size))
    out = _shared(sized.drop("size"), _totals(sized, weights, share, cap, leaf_rows))
    return out.select("id", "tk", "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, leaf_rows: int = LEAF_ROWS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; same columns."""
    size = word_count(text_of(text_col)).alias("size")
    totals = _totals(_sized(docs, id_col, text_col, source_col, size), weights, share, cap, leaf_rows).where("copies > 0")
    rows = _sized(docs, id_col, text_col, source_col, F.struct(*docs.columns).alias("row"))
    taken = _shared(rows, totals).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    out = copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"))
