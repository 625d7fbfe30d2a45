"""Token-ID output: documents as compressed id arrays under a shared zstandard dictionary.

Method: texts are encoded with a public tokenizer, an end id is appended, and
each document's serialized id array is compressed by itself with a dictionary
trained on serialized id arrays, so a short document compresses well and can
be read without its neighbours.

File format: the output folder holds two Parquet tables.  ``dictionary`` has
one row (hash, dictionary).  ``segments`` has a row per segment of documents
in ascending doc_id order: part, segment, first and last doc_id, n_docs,
n_tokens and ``payload``, a self-describing block:

    magic 'TKZ1' | id width (2 or 4) u32 | n u32 | flags u32 | dictionary sha256 (32 bytes)
    doc ids i64[n] | null marks u8[n] | frame offsets u64[n+1] | first ids u64[n+1] | frames

Offsets count from the first frame; first ids count ids from the start of the
part.  A reader refuses a payload whose dictionary hash is another.

Order: a range partition on (doc_id, hash of the text), nulls last, so ties
and hot ids are split too.  Where a document starts overall follows from the
totals of the parts (one row per part).

The tokenizer drops white space and none of its tokens spans any, so a text's
ids are those of its pieces between ASCII blanks; each worker keeps the ids of
up to ``CACHE`` pieces.  The dictionary is trained on the id arrays of at most
``SAMPLE_DOCS`` documents of any length (the lowest hash in each hash bucket, so
repeated rows count once), of those over ``SAMPLE_BYTES`` bytes on ``PARTS`` slices
at places chosen by hash; where zstandard refuses to train on so little, the
arrays themselves are the dictionary.

Defined cases: a null or empty text yields the end id alone; null doc_ids come
last; repeated rows are documents each; an empty table gives empty tables;
extra columns are not written.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evoclust.session import ensure_checkpoint_dir

from .common import shuffle_partitions, table

MAGIC, END_ID, LEVEL = b"TKZ1", 1, 3
SAMPLE_DOCS, SAMPLE_BYTES, PARTS, DICTIONARY_BYTES = 1024, 16_384, 16, 65_536
SEGMENT_DOCS, SEGMENT_IDS = 1024, 4_000_000
CACHE = 500_000
SEGMENTS = ("part int, segment int, first_id long, last_id long, n_docs int, n_tokens long, payload binary")
_HEAD = struct.Struct("<4sIII32s")
#: Byte-level tokenizers write a byte as a character: the printable ones of
#: Latin-1 stand for themselves, the others take 256, 257, ... in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder(dict):
    """Text bytes -> serialized ids; as a dict it keeps the ids of up to ``CACHE`` pieces.

    A new piece goes through the tokenizer's own steps: normalizer,
    pre-tokenizer, model.  The first two leave lower-case ASCII letters as they
    are and write other letters of Latin-1 byte by byte; the pre-tokenizer parts a full stop or comma from the letter or
    digit before it.  Pieces that may hold an added token are encoded whole.
    """

    def __init__(self, tokenizer_json: str, end_id: int = END_ID) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        size = max([end_id, *self.tokenizer.get_vocab(with_added_tokens=True).values()]) + 1
        self.dtype = np.dtype("<u2" if size <= 65_536 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.model, self.normal, self.split = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        # The short way for Latin-1 holds where the tokenizer itself takes it.
        self.byte_level = all(
            [p for p, _ in self.split.pre_tokenize_str(self.normal.normalize_str(w))] == [
                w.lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS)]
            for w in ("abc", "\xc0\xe9\xdf\xff", "\xaa\xb5\xba", "\xc3\xed\xe0x"))

    def _ids(self, piece: bytes) -> list[int]:
        if b"<|" in piece:
            return self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        if piece.isalpha() and piece.islower():  # of bytes: ASCII letters
            return [t.id for t in self.model.tokenize(piece.decode())]
        text = piece.decode("utf-8", "replace")
        if self.byte_level and text.isalpha() and max(text) <= "\xff":  # letters of Latin-1: one word, composed already
            return [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS))]
        text = self.normal.normalize_str(text)
        return [t.id for part, _ in self.split.pre_tokenize_str(text) for t in self.model.tokenize(part)]

    def __missing__(self, piece: bytes) -> bytes:
        if piece[-1:] in (b".", b",") and piece[-2:-1].isalnum() and b"<|" not in piece:
            out = self[piece[:-1]] + self[piece[-1:]]
        else:
            out = np.array(self._ids(piece), self.dtype).tobytes()
        if len(self) < CACHE:
            self[piece] = out
        return out

    def batch(self, texts: list[bytes | None]) -> list[bytes]:
        get = self.__getitem__
        # Of bytes, lower() and split() know ASCII alone.  Added tokens are matched before lower-casing.
        return [b"".join(map(get, (t if b"<|" in t else t.lower()).split())) + self.end for t in (x or b"" for x in texts)]


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def _encoder(tokenizer_json: str, end_id: int) -> Encoder:
    """One encoder for each worker process, tasks after each other share it."""
    key = (hash(tokenizer_json), end_id)
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json, end_id)
    return _ENCODERS[key]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def pack(ids: list[int | None], frames: list[bytes], counts: list[int], first: int, width: int, digest: bytes) -> bytes:
    """The payload of a segment."""
    n = len(ids)
    return b"".join([
        _HEAD.pack(MAGIC, width, n, 0, digest),
        np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        bytes(i is None for i in ids),
        np.concatenate([[0], np.cumsum([len(f) for f in frames], dtype=np.int64)]).astype("<u8").tobytes(),
        (first + np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])).astype("<u8").tobytes(),
        *frames])


class Segment:
    """A payload's index; frames are sliced on demand."""

    def __init__(self, payload: bytes, digest: bytes) -> None:
        magic, self.width, n, _, own = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        if own != digest:
            raise ValueError("the segment was written with another dictionary")
        at = _HEAD.size
        ids = np.frombuffer(payload, "<i8", n, at).tolist()
        null = np.frombuffer(payload, np.uint8, n, at + 8 * n)
        self.ids = [None if z else i for i, z in zip(ids, null)]
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 9 * n).tolist()
        self.first = np.frombuffer(payload, "<u8", n + 1, at + 9 * n + 8 * (n + 1)).tolist()
        self.frames, self.at = payload, at + 9 * n + 16 * (n + 1)

    def tokens(self, i: int, reader: zstandard.ZstdDecompressor) -> np.ndarray:
        raw = reader.decompress(self.frames[self.at + self.offsets[i]:self.at + self.offsets[i + 1]])
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def _write(batches: Iterator[pa.RecordBatch], tokenizer, dictionary, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, squeeze = _encoder(tokenizer.value, end_id), _compressor(dictionary.value)
    digest, width = hashlib.sha256(dictionary.value).digest(), encoder.dtype.itemsize
    part, segment, first = TaskContext.get().partitionId(), 0, 0
    ids: list[int | None] = []
    frames: list[bytes] = []
    counts: list[int] = []
    held = 0  # ids in the open segment

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal segment, first
        payload = pack(ids, frames, counts, first, width, digest)
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([ids[0]], pa.int64()),
            pa.array([ids[-1]], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([sum(counts)], pa.int64()),
            pa.array([payload], pa.binary())],
            names=["part", "segment", "first_id", "last_id", "n_docs", "n_tokens", "payload"])
        first += sum(counts)
        segment += 1
        ids.clear(), frames.clear(), counts.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            texts = [x.as_buffer().to_pybytes() if x.is_valid else None for x in some.column("raw")]
            for doc, data in zip(some.column("doc_id").to_pylist(), encoder.batch(texts)):
                ids.append(doc)
                frames.append(squeeze.compress(data))
                counts.append(len(data) // width)
                held += counts[-1]
                if len(ids) >= SEGMENT_DOCS or held >= SEGMENT_IDS:
                    yield from flush()
                    held = 0
    if ids:
        yield from flush()


def train_dictionary(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID, id_col: str = "doc_id",
                     text_col: str = "text") -> bytes:
    """A dictionary from the id arrays of a bounded sample; empty only if there is no document."""
    raw, part = F.coalesce(F.col(text_col), F.lit("")).cast("binary"), SAMPLE_BYTES // PARTS
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("k"), raw.alias("raw"))
    least = rows.groupBy(F.pmod("k", F.lit(SAMPLE_DOCS))).agg(F.min("k").alias("k")).select("k")
    room = F.octet_length("raw") - part
    slices = F.array(*(F.substring("raw", F.pmod(F.xxhash64("k", F.lit(i)), room).cast("int") + 1, F.lit(part)) for i in range(PARTS)))
    picked = rows.join(F.broadcast(least), "k", "left_semi").select(
        "k", F.when(F.octet_length("raw") <= SAMPLE_BYTES, F.array("raw")).otherwise(slices).alias("some")).dropDuplicates(["k"]).collect()
    samples = Encoder(tokenizer_json, end_id).batch([bytes(t) for r in sorted(picked, key=lambda r: r["k"]) for t in r["some"]])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(samples) * 8)[-DICTIONARY_BYTES:]  # zstandard reads no less than 8 bytes


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", parts: int | None = None) -> None:
    """Write ``docs`` in ascending ``id_col`` order to the folder ``path``."""
    spark = docs.sparkSession
    tokenizer_json = Path(tokenizer_path).read_text()
    dictionary = train_dictionary(docs, tokenizer_json, end_id, id_col, text_col)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "hash string, dictionary binary"
                          ).write.parquet(f"{path}/dictionary")
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                       F.col(text_col).cast("binary").alias("raw"))
    rows.repartitionByRange(parts or shuffle_partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(
        partial(_write, tokenizer=spark.sparkContext.broadcast(tokenizer_json),
                dictionary=spark.sparkContext.broadcast(dictionary), end_id=end_id), SEGMENTS
    ).write.option("compression", "none").parquet(f"{path}/segments")


def _read(batches: Iterator[pa.RecordBatch], dictionary, with_ids: bool) -> Iterator[pa.RecordBatch]:
    reader, digest = _decompressor(dictionary.value), hashlib.sha256(dictionary.value).digest()
    for batch in batches:
        for part, payload in zip(batch.column("part").to_pylist(), batch.column("payload")):
            s = Segment(payload.as_py(), digest)
            for at in range(0, len(s.ids), 128):
                some = range(at, min(at + 128, len(s.ids)))
                tokens = [s.tokens(i, reader) for i in some]
                cols = [pa.array([part] * len(tokens), pa.int32()), pa.array([s.ids[i] for i in some], pa.int64()),
                        pa.array([s.first[i] for i in some], pa.int64()), pa.array([len(t) for t in tokens], pa.int64()),
                        pa.array([zlib.crc32(t.tobytes()) for t in tokens], pa.int64())]
                names = ["part", "doc_id", "first", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array([t.tolist() for t in tokens], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    dictionary = bytes(spark.read.schema("hash string, dictionary binary").parquet(f"{path}/dictionary").first()["dictionary"])
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: the number of parts is fixed by the writer.
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = "part int, doc_id long, first long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = segments.select("part", "payload").mapInArrow(
        partial(_read, dictionary=spark.sparkContext.broadcast(dictionary), with_ids=with_ids), schema)
    return docs.join(F.broadcast(totals), "part").select(
        "doc_id", (F.col("base") + F.col("first")).cast("long").alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id: one pruned scan, one frame decompressed each."""
    dictionary = bytes(spark.read.schema("hash string, dictionary binary").parquet(f"{path}/dictionary").first()["dictionary"])
    digest, reader, out = hashlib.sha256(dictionary).digest(), _decompressor(dictionary), []
    found = spark.read.schema(SEGMENTS).parquet(f"{path}/segments").where(
        (F.col("first_id") <= doc_id) & ((F.col("last_id") >= doc_id) | F.col("last_id").isNull()))
    for row in found.select("payload").toLocalIterator():
        s = Segment(bytes(row["payload"]), digest)
        out += [s.tokens(i, reader).tolist() for i, d in enumerate(s.ids) if d == doc_id]
    return out


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encoded(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to ``path`` (a new folder beside the checkpoints by default) and read the files' index and digests."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer or tokenizer_path(), **options)
    return read_tokens(spark, path, with_ids=False)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files written."""
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
