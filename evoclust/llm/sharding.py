"""Sharding by a hierarchical weighted hash tree (law ``key``).

Method: a document descends region, rack and shard.  At each level every
child draws an exponential variate with the child's weight as its rate from a
hash of (child, doc_id), and the smallest draw wins; a child is thus chosen in
proportion to its weight.  A draw does not depend on the siblings, so when
the weight of a subtree changes, documents move into or out of that subtree
only.  DataFrame functions only; the shard needs no shuffle.

Slots number the rows of a shard without gaps from 0.  Rows are cut into
``cells`` cells of a hash per shard, cells are counted with a partial
aggregate, the counts (at most shards x cells rows) give each cell its first
slot, and a window numbers the rows inside a cell.  No task holds a shard.

Defined cases: a null text has size 8 and CRC 0; a null doc_id is a key of
its own (all such rows share a shard); repeated rows get the same shard and
different slots; empty tables give empty results; extra columns stay, columns
of the names written here are replaced.  Rows that agree in doc_id, size and
CRC share a cell; doc_id is an identifier, so that is a handful.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Shards of a tree that is laid out as regions of racks; later shards are regions of their own.
BASE, RACKS, PER_RACK = 24, 4, 2
CELLS = 1024
DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def tree(shards: int, weights: Sequence[float] | None = None, base: int = BASE, racks: int = RACKS,
         per_rack: int = PER_RACK) -> Node:
    """Regions of ``racks`` racks of ``per_rack`` shards up to ``base``; each further shard is a region by itself.

    So one more shard beyond ``base`` changes the weight of its own subtree
    only, and takes documents only into itself.
    """
    w = list(weights or [1.0] * shards)
    regions: dict[str, dict[str, list[int]]] = {}
    for s in range(shards):
        region = f"g{s // (racks * per_rack)}" if s < base else f"x{s}"
        regions.setdefault(region, {}).setdefault(f"{region}/k{s // per_rack if s < base else s}", []).append(s)
    built = []
    for region, by_rack in regions.items():
        kids = tuple(Node(rack, sum(w[s] for s in own), tuple(Node(f"{rack}/s{s}", w[s], (), s) for s in own))
                     for rack, own in by_rack.items())
        built.append(Node(region, sum(k.weight for k in kids), kids))
    return Node("", sum(n.weight for n in built), tuple(built))


def draw(name: str, weight: float, key: Column) -> Column:
    """Exponential variate of rate ``weight`` from the hash of (name, key)."""
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{name}|"), key)), 1, DIGITS), 16, 10).cast("double") + 0.5) / F.lit(
        float(16 ** DIGITS))
    return -F.log(u) / F.lit(float(weight))


def shard_of(node: Node, key: Column) -> Column:
    """The shard that ``key`` (a string column) reaches from ``node``; ties go to the earlier child."""
    if node.shard is not None:
        return F.lit(node.shard)
    kids = [k for k in node.children if k.weight > 0]
    if len(kids) == 1:
        return shard_of(kids[0], key)
    least = F.array_min(F.array(*[F.struct(draw(k.name, k.weight, key).alias("d"), F.lit(i).alias("i"))
                                  for i, k in enumerate(kids)]))["i"]
    out = shard_of(kids[-1], key)
    for i in range(len(kids) - 2, -1, -1):
        out = F.when(least == i, shard_of(kids[i], key)).otherwise(out)
    return out


def key_of(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("null"))


def assign(docs: DataFrame, shards: int = BASE, id_col: str = "doc_id", out: str = "shard",
           weights: Sequence[float] | None = None) -> DataFrame:
    """``docs`` with the shard of each row; narrow."""
    return docs.withColumn(out, shard_of(tree(shards, weights), key_of(id_col)).cast("int"))


def number(rows: DataFrame, shard: str, by: Sequence[str], out: str = "slot", cells: int = CELLS) -> DataFrame:
    """``rows`` with a slot, gapless from 0 in each shard.  ``by``: columns that order and spread the rows."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by])
    cell = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(cells)).cast("int")
    celled = rows.withColumn("__cell", cell)
    counts = celled.groupBy(F.col(shard).alias("__s"), F.col("__cell").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__s", "__c", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(shard, "__cell").orderBy(*by)
    # At most shards x cells rows whatever the data: safe to broadcast.
    return (
        celled.withColumn("__k", F.row_number().over(inside))
        .join(F.broadcast(first), (F.col(shard) == F.col("__s")) & (F.col("__cell") == F.col("__c")))
        .withColumn(out, (F.col("__first") + F.col("__k") - 1).cast("long"))
        .drop("__cell", "__s", "__c", "__first", "__k")
    )


def write_shards(docs: DataFrame, path: str, shards: int = BASE, id_col: str = "doc_id") -> None:
    """Parquet folders ``shard=N``; rows are spread over tasks before, so none writes a shard alone."""
    assign(docs, shards, id_col).write.partitionBy("shard").mode("overwrite").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"))
    both = assign(assign(rows, BASE), BASE + 1, out="grown_shard")
    return number(both, "shard", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _sql_draw(name: str, weight: float) -> str:
    return (f"(-ln((CAST(('0x' || substr(md5('{name}|' || k), 1, {DIGITS})) AS BIGINT) + 0.5::DOUBLE)"
            f" / {float(16 ** DIGITS)!r}) / {float(weight)!r}::DOUBLE)")


def _sql_shard(node: Node) -> str:
    if node.shard is not None:
        return str(node.shard)
    kids = [k for k in node.children if k.weight > 0]
    if len(kids) == 1:
        return _sql_shard(kids[0])
    draws = ", ".join(_sql_draw(k.name, k.weight) for k in kids)
    arms = " ".join(f"WHEN {i + 1} THEN {_sql_shard(k)}" for i, k in enumerate(kids))
    return f"(CASE list_position([{draws}], list_min([{draws}])) {arms} END)"


def oracle() -> str:
    cell = (f"(CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || size || '|' || text_crc32),"
            f" 1, 8)) AS BIGINT) % {CELLS})")
    return f"""
WITH RECURSIVE bits(i, b, c) AS (
  SELECT i, 0, i::BIGINT FROM range(0, 256) t(i)
  UNION ALL
  SELECT i, b + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE b < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE b = 8),
d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)),
           lambda c, b: xor(c >> 8, t[CAST(1 + xor(c & 255, b) AS INT)]), 4294967295::BIGINT)) AS text_crc32
  FROM documents, tab),
s AS (SELECT *, {_sql_shard(tree(BASE))} AS shard, {_sql_shard(tree(BASE + 1))} AS grown_shard, {cell} AS cell FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INT) AS grown_shard
FROM s
"""
