"""URL filters by a sort-merge range join.

Method: a host is turned into a canonical key of its labels in reverse, each
followed by a dot (``www.example.com`` -> ``com.example.www.``).  A rule host
and all its subdomains are then one interval of keys, and below a rule host a
rule path and all paths that it starts are one interval of ``host#path``.  The
interval ends are breakpoints.  Two sorted sweeps give every page what the last
breakpoint at or before its key says: the first the stack of nested rule hosts it lies in (at
most as many as the host has labels), the second, for each of these, the innermost rule
path.  A breakpoint of the second sweep carries one rule, the top of its stack,
so a page's work does not grow with the number of rules of a host.  Of the
rules found the longest wins.  DataFrame functions only.

Distribution: pages are dealt over ``lanes`` lanes by a hash of the place they
are read from, so a host with a third of all pages, or a page that repeats, is
spread like any other, and each lane gets a copy of the breakpoints (two for
each rule host, two for each rule).  The sweeps are windows
with a running frame inside a lane, which Spark sorts and spills.

Defined cases: a url that is null or has no ``://`` has empty host and path; a
rule fits its host and all subdomains if the page's path starts with the
rule's, so a url without a path meets no rule whose path is ``/``; longest is
by code points of host and path together, then the longer host, then the
smaller rule text, then ``block`` before ``allow``; rules with a null host or
verdict are ignored, a null rule path is the empty one; no rule: ``default``.
Empty tables and repeated rows need no care; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, shuffle_partitions, table

#: The rules of the registered query: fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_key(host: Column) -> Column:
    """Labels in reverse, each with a dot behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict), one verdict for each rule: ``block`` before the others."""
    clean = rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rank = F.struct(F.when(F.col("verdict") == "block", 0).otherwise(1), F.col("verdict").alias("verdict"))
    return clean.groupBy("host", "path").agg(F.min(rank)["verdict"].alias("verdict"))


def host_breakpoints(rules: DataFrame) -> DataFrame:
    """(key, stack): from ``key`` on, up to the next breakpoint, ``stack`` holds the rule hosts that lie around.

    A host cannot hold a slash, the character after the dot, so ``com.example/``
    is the first key behind all that start with ``com.example.``.
    """
    own = rules.select("host").distinct().withColumn("key", host_key(F.col("host")))
    # Keys of the hosts that a rule host lies in: itself cut after each dot.
    labels = F.split(F.expr("substring(key, 1, char_length(key) - 1)"), r"\.")
    cuts = own.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."))
    )).alias("outer"))
    stacks = cuts.join(own.select(F.col("key").alias("outer"), "host"), "outer").groupBy("key").agg(
        F.collect_list("host").alias("from_here"),
        F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("host"))).alias("behind"))
    ends = F.expr("concat(substring(key, 1, char_length(key) - 1), '/')")
    return stacks.select(F.explode(F.array(
        F.struct(F.col("key"), F.col("from_here").alias("stack")),
        F.struct(ends.alias("key"), F.col("behind").alias("stack")))).alias("b")).select("b.*")


def _path_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("#"), path).cast("binary")


def path_breakpoints(rules: DataFrame) -> DataFrame:
    """(key, rule): from ``key`` on the innermost rule of a host is ``rule`` (host, path, verdict; nulls for none).

    Neither hosts nor paths hold a ``#``, and no UTF-8 text the byte FF, so the
    key with FF behind it is the first behind all that start with the key.
    """
    outer = rules.select("host", "path", F.explode(F.sequence(F.lit(0), F.char_length("path"))).alias("n")).where(
        F.col("n") < F.char_length("path")).select("host", "path", F.col("path").substr(F.lit(1), F.col("n")).alias("start"))
    around = outer.join(rules.select(F.col("host").alias("o_host"), F.col("path").alias("o_path"), F.col("verdict").alias("o_verdict")),
                        (F.col("host") == F.col("o_host")) & (F.col("start") == F.col("o_path"))).groupBy("host", "path").agg(
        F.max(F.struct(F.char_length("o_path"), "o_path", "o_verdict")).alias("o"))
    both = rules.join(around.select(F.col("host").alias("a_host"), F.col("path").alias("a_path"), "o"),
                      (F.col("host") == F.col("a_host")) & (F.col("path") == F.col("a_path")), "left")
    key, inside = _path_key(F.col("host"), F.col("path")), F.col("o").isNotNull()
    mine = F.struct("host", "path", "verdict")
    before = F.struct(F.when(inside, F.col("host")).alias("host"), F.col("o.o_path").alias("path"), F.col("o.o_verdict").alias("verdict"))
    return both.select(F.explode(F.array(
        F.struct(key.alias("key"), mine.alias("rule")),
        F.struct(F.concat(key, F.unhex(F.lit("FF"))).alias("key"), before.alias("rule")))).alias("b")).select("b.*")


def _sweep(rows: DataFrame, marks: DataFrame, lanes: int, value: str) -> DataFrame:
    """``rows`` (lane, key, ...) with the ``value`` of the last of ``marks`` at or before their key."""
    every = marks.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))).withColumn("kind", F.lit(0))
    order = Window.partitionBy("lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("kind", F.lit(1)).unionByName(every, allowMissingColumns=True).withColumn(
        value, F.last(value, ignorenulls=True).over(order)).where(F.col("kind") == 1).drop("kind")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url_col: str = "url",
          lanes: int | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced)."""
    spark = pages.sparkSession
    lanes = lanes or 2 * shuffle_partitions(spark)
    kept = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c in pages.columns and c != url_col])
    url = F.coalesce(F.col(url_col), F.lit(""))
    split = kept.select(F.struct(*[F.col(c) for c in kept.columns]).alias("row"), ascii_lower(F.regexp_extract(url, URL, 1)).alias("host"),
                        F.regexp_extract(url, URL, 2).alias("path"), F.monotonically_increasing_id().alias("uid")).withColumn(
        "lane", F.pmod(F.xxhash64("uid"), F.lit(lanes)))
    clean = _rules(rules)
    inside = _sweep(split.withColumn("key", host_key(F.col("host"))), host_breakpoints(clean), lanes, "stack")
    each = inside.withColumn("around", F.explode_outer("stack")).withColumn("key", _path_key(F.col("around"), F.col("path"))).drop("stack")
    met = _sweep(each, path_breakpoints(clean), lanes, "rule")
    # A page that lies in no rule host has no key and comes before all marks.
    found = F.when(F.col("around").isNotNull() & F.col("rule.host").isNotNull(), F.struct(
        (-(F.char_length("rule.host") + F.char_length("rule.path"))).alias("a"), (-F.char_length("rule.host")).alias("b"),
        F.concat("rule.host", "rule.path").alias("rule"), F.when(F.col("rule.verdict") == "block", 0).otherwise(1).alias("c"),
        F.col("rule.verdict").alias("verdict")))
    best = met.groupBy("lane", "uid").agg(F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"),
                                          F.min(found).alias("best"))
    return best.select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT h.page_id, max({'n': length(rh) + length(rp), 'rule': rh || rp, 'v': v}) AS b
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY h.page_id)
SELECT h.page_id, host, path, m.b.rule AS rule, coalesce(m.b.v, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id
"""
