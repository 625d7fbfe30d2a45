"""SimHash near-dedup by multi-index hashing.

Method: the 64 bits are cut into three segments.  Two fingerprints at distance
4 or less agree in the last segment or differ in at most one bit of the first
or of the second (the radii 1, 1, 0 plus one each make 5).  So a fingerprint
is filed in a table under its three segment values, small Hamming balls around
the first two are enumerated, the table matches fetched, and the whole
distance of each is verified.

Work is done on distinct fingerprints, so copies cost nothing.  A table entry
(bucket) is compared in blocks of at most ``bucket_rows`` fingerprints inside
a task, and only links that join two groups of the block are written, never
all pairs.  The fingerprints of a larger bucket take an exact linear way
instead: two are within distance 4 if and only if some point lies within
distance 2 of both, so each is linked to the smallest fingerprint it shares
such a point with.  Links become groups by :mod:`.components`.

Words are runs of anything but space and 09-0D, after lower-casing A-Z.
Defined cases: a null text has no words; without words the fingerprint is
zero and linked like any other; fewer words than the shingle length make one
shingle of the whole; a null doc_id is never the smallest of a group unless
all are null (component_id is then null); repeated rows are kept as rows;
an empty table gives an empty result; the input's columns stay in
:func:`one_of_each`, whatever their names.

Segments: with N distinct fingerprints a segment of about log2(N) bits keeps
buckets of unrelated fingerprints at a few entries: ``SEGMENTS`` (22, 21, 21
bits, 24 keys a fingerprint on average) fits up to some 10^8 distinct
fingerprints.  ``radii`` beyond 1 are supported for wider segments: (32, 32)
with radii (2, 1) gives some 280 keys and fits 10^10.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import shuffle_partitions, stored, table
from .components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
SEGMENTS, RADII = (22, 21, 21), (1, 1, 0)
BUCKET_ROWS = 16_384
_HASHES = 65_536  # hashes whose bits are counted at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, unsigned."""
    words = (text or b"").lower().split()  # bytes: A-Z and the ASCII blanks alone
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    first, last = (end - size)[: len(words) - k + 1].tolist(), end[k - 1:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(first), _HASHES):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(first[i:i + _HASHES], last[i:i + _HASHES])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _add_fingerprints(batches: Iterator[pa.RecordBatch], text: str, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle) for t in batch.column(text)]
        fp = pa.array(np.array(values, np.uint64).view(np.int64))
        keep = [i for i, n in enumerate(batch.schema.names) if n != text]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [fp],
                                         names=[batch.schema.names[i] for i in keep] + ["fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``fp``, the fingerprint as a signed long; narrow."""
    keep = [c for c in docs.columns if c != "fp"] if keep is None else keep
    raw = docs.select(*keep, F.col(text_col).cast("binary").alias("__raw"))
    schema = StructType([docs.schema[c] for c in keep]).add("fp", LongType())
    return raw.mapInArrow(partial(_add_fingerprints, text="__raw", shingle=shingle), schema)


def _balls(segments: tuple[int, ...], radii: tuple[int, ...]) -> list[tuple[int, int, np.ndarray]]:
    """(shift, bits, masks of the ball without its centre) of each segment."""
    out, shift = [], 0
    for bits, r in zip(segments, radii):
        masks = [sum(1 << b for b in c) for d in range(1, r + 1) for c in combinations(range(bits), d)]
        out.append((shift, bits, np.array(masks, np.uint64)))
        shift += bits
    return out


def _keys(batches: Iterator[pa.RecordBatch], segments: tuple[int, ...], radii: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """(bucket, fp, home): each segment value as it is, and the ball around it.

    Of two values in each other's ball one is the larger; probing upwards only
    meets it from one side.
    """
    balls = _balls(segments, radii)
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 1024):
            fp = every[at:at + 1024]
            bucket, owner, home = [], [], []
            for n, (shift, bits, masks) in enumerate(balls):
                value = (fp.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
                near = value[:, None] ^ masks[None, :]
                row, col = np.nonzero(near > value[:, None])
                for v, f, h in ((value, fp, True), (near[row, col], fp[row], False)):
                    bucket.append((v << np.uint64(2) | np.uint64(n)).view(np.int64))
                    owner.append(f)
                    home.append(np.full(len(f), h))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (bucket, owner, home)],
                                             names=["bucket", "fp", "home"])


class _Groups:
    """Union-find over the fingerprints of one block."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _block_links(bucket: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of whole buckets that join two groups."""
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[start, len(bucket)])
    left = np.repeat(start + size, size) - np.arange(len(bucket))  # rows of the bucket from here on
    at, lag, found, groups = np.flatnonzero(left > 1), 1, [], _Groups()
    bits = fp.view(np.uint64)
    while len(at):
        near = (np.bitwise_count(bits[at] ^ bits[at + lag]) <= distance) & (home[at] | home[at + lag])
        for i in at[near].tolist():
            a, b = int(fp[i]), int(fp[i + lag])
            if groups.join(a, b):
                found.append((a, b))
        lag += 1
        at = at[left[at] > lag]
    return found


def _links(batches: Iterator[pa.RecordBatch], distance: int, bucket_rows: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket -> (a, b) links; (a, null) for the fingerprints of buckets over ``bucket_rows``."""
    names = ("bucket", "fp", "home")
    rest, large = None, None  # an unfinished bucket; the large bucket that is passing by

    def batch(a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def linked(cols) -> Iterator[pa.RecordBatch]:
        found = _block_links(*cols, distance)
        if found:
            yield batch([x for x, _ in found], [x for _, x in found])

    for arrow in batches:
        cols = [arrow.column(arrow.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols)]
            rest = None
        if large is not None:
            n = int(np.searchsorted(cols[0], large, "right"))
            if n:
                yield batch(cols[1][:n], [None] * n)
            cols = [c[n:] for c in cols]
        if not len(cols[0]):
            continue
        large = None
        start = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
        size = np.diff(np.r_[start, len(cols[0])])
        over = np.repeat(size > bucket_rows, size)
        if over.any():
            yield batch(cols[1][over], [None] * int(over.sum()))
            if size[-1] > bucket_rows:
                large = cols[0][-1]
            cols = [c[~over] for c in cols]
        if not len(cols[0]):
            continue
        cut = 0 if large is None else len(cols[0])
        if large is None:
            cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            rest = [c[cut:] for c in cols]
        if cut:
            yield from linked([c[:cut] for c in cols])
    if rest is not None:
        yield from linked(rest)


def _midpoints(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """(mid, fp) for every point within ``radius`` bits."""
    masks = np.array([sum(1 << b for b in c) for d in range(radius + 1) for c in combinations(range(64), d)], np.uint64)
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 32):
            fp = every[at:at + 32]
            mid = (fp.view(np.uint64)[:, None] ^ masks[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mid), pa.array(np.repeat(fp, len(masks)))], names=["mid", "fp"])


def links(fps: DataFrame, distance: int = DISTANCE, segments: tuple[int, ...] = SEGMENTS,
          radii: tuple[int, ...] = RADII, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``distance`` bits; ``fps`` has distinct longs ``fp``."""
    if sum(r + 1 for r in radii) < distance + 1 or sum(segments) != 64 or distance % 2:
        raise ValueError("radii plus one each must reach the distance plus one, segments 64 bits, an even distance")
    spark = fps.sparkSession
    keyed = fps.select("fp").mapInArrow(partial(_keys, segments=segments, radii=radii),
                                        "bucket long, fp long, home boolean")
    found = stored(
        keyed.repartition(2 * shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(partial(_links, distance=distance, bucket_rows=bucket_rows), "a long, b long"))
    direct = found.where("b is not null")
    large = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if not large.head(1):
        return direct
    mids = large.mapInArrow(partial(_midpoints, radius=distance // 2), "mid long, fp long")
    least = mids.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return direct.unionByName(mids.join(least, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """(id_col, tk, fp, root, component_id), a row for each row of ``docs``.

    ``tk`` is xxhash64 of the text; ``root`` a fingerprint that names the group.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("__text"))
    # Of the text one copy goes to Python, and none comes back.
    marked = stored(fingerprints(rows, shingle, "__text", ["id", "tk"]).select(F.col("id").alias(id_col), "tk", "fp"))
    own = stored(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(links(own, distance, **options))
    member = own.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(member.select("fp", "root").join(least, "root"), "fp")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                text_col: str = "text", **options) -> DataFrame:
    """The row of ``docs`` with the smallest id of each group, nulls last; same columns."""
    groups = near_duplicates(docs, shingle, distance, id_col, text_col, **options)
    keep = groups.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), "tk")).alias("k")
                                      ).select(F.col("k.id").alias("keep_id"), F.col("k.tk").alias("keep_tk"))
    # The row travels in one struct: no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"))
    one = rows.join(keep, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("tk") == F.col("keep_tk")), "left_semi")
    return one.dropDuplicates(["id", "tk"]).select("row.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
