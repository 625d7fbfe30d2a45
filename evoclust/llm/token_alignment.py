"""Cross-tokenizer alignment: which tokens of two tokenizers meet, and how often over the corpus.

Method: the tokens of either side have cumulative byte ends.  Two dictionaries
lead from an end to the tokens up to it; the intersection of their key sets,
sorted, slices both id lists into groups, and the links of each slice are
expanded from it: the token pairs whose byte ranges end together.  Token bytes
are never empty, so these are the last token of either side of a slice.

A (``tokenizers``, byte-level) encodes a space and the text, B
(``sentencepiece``) the text, to which it adds a space; strings of special
tokens are plain text.  Where the joined bytes of a side are not space + text,
the document has no tokens.

A text is aligned word by word: at a single blank between characters that are
no white space A's pre-tokenizer always parts, and no piece of B holds a blank
behind another character, so both restart there.  Words come again and again,
and each worker keeps the alignments of up to ``CACHE`` of them.  A text with
other blanks, or with a word whose bytes are not its own, is aligned as a whole
by the same function, and so gives the same result (tested).

Distribution: a narrow pass aligns the documents and writes counts of their
pairs to the shared folder; per task these are summed to a row per pair before
the shuffle.  A pair's shorter token ends the longer one, so
:func:`pair_bound` of the vocabularies (some 10^5 pairs for the given ones)
bounds the table of corpus-wide counts, whatever the corpus; it alone is
broadcast for the last narrow pass.

Defined cases: a null or empty text has no tokens (zeros and an empty digest);
a null doc_id stays a row; repeated rows are documents each and count each;
an empty table gives an empty result; columns besides id and text are not
carried, so none can clash.  Bytes that are no UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow.compute import binary_length
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .token_output import _BYTE_CHARACTERS, tokenizer_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CACHE, WORD_CHARS, GROUP_BYTES, ROWS = 250_000, 64, 1 << 20, 256
#: Pairs a task holds before it sums them up, documents whose pairs it reads at a time.
HELD, READ = 500_000, 512
BLANK = "▁"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def byte_level(token: str) -> bytes:
    """The bytes of a byte-level token."""
    byte = {c: b for b, c in _BYTE_CHARACTERS.items()}
    return bytes(byte.get(ord(c), ord(c) & 0xFF) for c in token)


def byte_tokens(tokenizer_json: str) -> list[bytes]:
    """A's tokens by id."""
    spec = json.loads(tokenizer_json)
    vocab = spec["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in vocab.items():
        out[i] = byte_level(token)
    return out


def piece_tokens(model: bytes) -> list[bytes]:
    """B's tokens by id: the marker of a blank as a space, <0xHH> as its byte."""
    import sentencepiece

    b = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(b.id_to_piece(list(range(b.vocab_size()))))]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """The pairs that can be linked: the shorter token ends the longer one."""
    first, second = set(a) - {b""}, set(b) - {b""}
    ends = lambda t, of: sum(t[i:] in of for i in range(1, len(t)))
    return len(first & second) + sum(ends(t, second) for t in first) + sum(ends(t, first) for t in second)


def slices(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(ends that both share, A's tokens up to each, B's tokens up to each)."""
    at_a = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    at_b = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    ends = sorted(at_a.keys() & at_b.keys())
    return ends, [at_a[end] for end in ends], [at_b[end] for end in ends]


#: (links as A << 16 | B, groups as text, A's tokens, B's tokens); None: no tokens.
Alignment = tuple[bytes, bytes, int, int] | None


class Side:
    """One tokenizer's token bytes, their sizes, and its ids as text before either separator."""

    def __init__(self, tokens: list[bytes], last: str) -> None:
        if len(tokens) > 1 << 16:
            raise ValueError("a pair of ids takes 32 bits: vocabularies of at most 65,536 tokens")
        self.tokens, self.size = tokens, np.array([len(t) for t in tokens])
        self.inner, self.last = (np.array([f"{i}{end}".encode() for i in range(len(tokens))], object) for end in (",", last))

    def text(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.inner[ids]
        out[ends - 1] = self.last[ids[ends - 1]]
        return out


class Aligner:
    """Alignments of words and texts; keeps those of words."""

    def __init__(self, tokenizer_json: str, model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.first, self.second = Side(byte_tokens(tokenizer_json), "|"), Side(piece_tokens(model), ";")
        # Words can be aligned by themselves where no piece of B holds a blank behind another character.
        self.by_word = not any(BLANK in p.lstrip(BLANK) for p in self.b.id_to_piece(list(range(self.b.vocab_size()))))
        self.known: dict[str, Alignment] = {}

    def aligned(self, texts: list[str]) -> list[Alignment]:
        """The alignment of each text as a whole."""
        if not texts:
            return []
        raws = [(" " + t).encode() for t in texts]
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return self._align(raws, a, self.b.encode(texts, num_threads=1))

    def _align(self, raws: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[Alignment]:
        """Texts behind each other are one sequence of bytes; each text's end is an end of both sides."""
        spell = lambda side, ids: b"".join(map(side.tokens.__getitem__, ids))
        n_a, n_b, sizes = ([len(x) for x in some] for some in (a, b, raws))
        top_a, top_b, top = np.cumsum(n_a), np.cumsum(n_b), np.cumsum(sizes)
        flat_a, flat_b = np.fromiter(chain.from_iterable(a), np.int64), np.fromiter(chain.from_iterable(b), np.int64)
        end_a, end_b = np.cumsum(self.first.size[flat_a]), np.cumsum(self.second.size[flat_b])
        text = b"".join(raws)
        if not (all(n_a) and all(n_b) and spell(self.first, flat_a.tolist()) == text == spell(self.second, flat_b.tolist())
                and (end_a[top_a - 1] == top).all() and (end_b[top_b - 1] == top).all()):
            # Some text has bytes that are not its own.
            good = [i for i, raw in enumerate(raws) if spell(self.first, a[i]) == raw == spell(self.second, b[i])]
            out: list[Alignment] = [None] * len(raws)
            if good:
                for i, found in zip(good, self._align(*([x[i] for i in good] for x in (raws, a, b)))):
                    out[i] = found
            return out
        ends, to_a, to_b = (np.array(x) for x in slices(end_a.tolist(), end_b.tolist()))
        links = (flat_a[to_a - 1] << 16 | flat_b[to_b - 1]).astype("<u4")
        # Behind each group of A's ids comes B's.
        both = np.empty(len(flat_a) + len(flat_b), object)
        own, other = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        both[np.arange(len(flat_a)) + np.repeat(to_b - other, own)] = self.first.text(flat_a, to_a)
        both[np.arange(len(flat_b)) + np.repeat(to_a, other)] = self.second.text(flat_b, to_b)
        words, group, cut = both.tolist(), np.searchsorted(ends, top, "right").tolist(), (top_a + top_b).tolist()
        return [(links[g:h].tobytes(), b"".join(words[i:j])[:-1], m, n)
                for g, h, i, j, m, n in zip([0, *group], group, [0, *cut], cut, n_a, n_b)]

    def batch(self, texts: list[str]) -> list[Alignment]:
        """What :meth:`aligned` gives, word by word where that is the same.

        A list, not a generator: a caller that stops at the last text would leave the words over ``CACHE`` behind.
        """
        known, words = self.known, [t.split(" ") if self.by_word else [] for t in texts]
        out: list[Alignment] = []
        new = list({w for some in words for w in some if w not in known})
        safe = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()]
        known.update(dict.fromkeys(new))
        known.update(zip(safe, self.aligned(safe)))
        for text, some in zip(texts, words):
            found = [known[w] for w in some]
            if not found or None in found:
                out += self.aligned([text])
                continue
            links, groups, n_a, n_b = zip(*found)
            out.append((b"".join(links), b";".join(groups), sum(n_a), sum(n_b)))
        room = CACHE - len(known) + len(new)
        for i, w in enumerate(new):
            if i >= room or len(w) > WORD_CHARS:
                del known[w]
        return out


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(tokenizer_json: str, model: bytes) -> Aligner:
    """One for each worker process, tasks after each other share it."""
    key = hash((tokenizer_json, model))
    if key not in _ALIGNERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(tokenizer_json, model)
    return _ALIGNERS[key]


def _align(batches: Iterator[pa.RecordBatch], files, with_groups: bool) -> Iterator[pa.RecordBatch]:
    aligner = _aligner(*files.value)
    for batch in batches:
        size, at = binary_length(batch.column("raw").fill_null(b"")).to_numpy(), 0
        while at < batch.num_rows:
            # At most ROWS texts, and no more than GROUP_BYTES but in one text.
            end = at + max(1, int(np.searchsorted(np.cumsum(size[at:at + ROWS]), GROUP_BYTES, "right")))
            some = batch.slice(at, end - at)
            at = end
            texts = [x.as_buffer().to_pybytes().decode("utf-8", "replace") if x.is_valid else "" for x in some.column("raw")]
            rows: list[tuple] = [(0, 0, 0, "", b"", b"", "")] * len(texts)
            full = [i for i, t in enumerate(texts) if t]
            for i, found in zip(full, aligner.batch([texts[i] for i in full])):
                if found is not None:
                    links, groups, n_a, n_b = found
                    pairs, times = np.unique(np.frombuffer(links, "<u4"), return_counts=True)
                    # Differences of the sorted pairs compress better.
                    rows[i] = (n_a, n_b, len(links) // 4, hashlib.sha256(groups).hexdigest(),
                               np.diff(pairs, prepend=np.uint32(0)).astype("<u4").tobytes(), times.astype("<u4").tobytes(),
                               groups.decode() if with_groups else "")
            n_a, n_b, n, digest, pairs, times, groups = zip(*rows)
            long = lambda x: pa.array(x, pa.int64())
            cols = [some.column("doc_id"), long(n_a), long(n_b), long(n), long(n), pa.array(digest, pa.string()),
                    pa.array(pairs, pa.binary()), pa.array(times, pa.binary())]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
            if with_groups:
                cols, names = [*cols, pa.array(groups, pa.large_string())], [*names, "groups"]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def _read(pairs: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, row of each) of the documents of a batch."""
    raw = [p.as_buffer() for p in pairs]
    each = [np.cumsum(np.frombuffer(p, "<u4"), dtype=np.uint32) for p in raw]
    count = [np.frombuffer(t.as_buffer(), "<u4") for t in times]
    if not each:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(each), np.concatenate(count).astype(np.int64), np.repeat(np.arange(len(each)), [len(x) for x in each])


def _sum(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, time = np.concatenate(pairs), np.concatenate(times)
    order = np.argsort(pair, kind="stable")
    pair, time = pair[order], time[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    return pair[first], np.add.reduceat(time, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (pair, n) for each pair of the task."""
    pairs: list[np.ndarray] = []
    times: list[np.ndarray] = []
    held = 0
    for batch in (whole.slice(at, READ) for whole in batches for at in range(0, whole.num_rows, READ)):
        pair, time, _ = _read(batch.column("pairs"), batch.column("times"))
        if len(pair):
            pairs.append(pair)
            times.append(time)
            held += len(pair)
        if held > HELD:
            pair, time = _sum(pairs, times)
            pairs, times, held = [pair], [time], 0
    if pairs:
        pair, time = _sum(pairs, times)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(time)], names=["pair", "n"])


def _judge(batches: Iterator[pa.RecordBatch], counts) -> Iterator[pa.RecordBatch]:
    """n_best and count_sum of each document in place of its pairs."""
    pair, n, best = counts.value
    for batch in (whole.slice(at, READ) for whole in batches for at in range(0, whole.num_rows, READ)):
        own, time, row = _read(batch.column("pairs"), batch.column("times"))
        at = np.searchsorted(pair, own)
        sums = np.zeros((2, batch.num_rows), np.int64)
        np.add.at(sums[0], row, time * best[at])
        np.add.at(sums[1], row, time * n[at])
        keep = [i for i, name in enumerate(batch.schema.names) if name not in ("pairs", "times")]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(s) for s in sums],
                                         names=[batch.schema.names[i] for i in keep] + ["n_best", "count_sum"])


def alignments(docs: DataFrame, tokenizer: str | None = None, model: str | None = None, id_col: str = "doc_id",
               text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """A row for each document: counts, digest, its linked pairs, and with ``with_groups`` the groups as text."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(tokenizer or tokenizer_path(A_FILE)).read_text(),
                                          Path(model or tokenizer_path(B_FILE)).read_bytes()))
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    return raw.mapInArrow(partial(_align, files=files, with_groups=with_groups), ALIGNED + ", groups string" * with_groups)


def groups_of(groups: Column) -> Column:
    """The groups of ``with_groups`` as an array of (a ids, b ids)."""
    side = lambda g, i: F.split(F.split_part(g, F.lit("|"), F.lit(i)), ",").cast("array<int>")
    return F.when(groups != "", F.transform(F.split(groups, ";"), lambda g: F.struct(side(g, 1).alias("a"), side(g, 2).alias("b"))))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, n): how often each pair is linked over all documents of :func:`alignments`."""
    each = aligned.select("pairs", "times").mapInArrow(_count, "pair long, n long")
    return each.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.shiftright("pair", 16).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFF).cast("int").alias("b_id"), "n")


def with_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best (links whose pair is the most frequent of its B id) and count_sum added to stored :func:`alignments`."""
    rows = counts.toArrow()  # of a size that the vocabularies bound
    a, b, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("a_id", "b_id", "n"))
    order = np.argsort(a << 16 | b)
    a, b, n = a[order], b[order], n[order]
    top = np.zeros(1 << 16, np.int64)
    np.maximum.at(top, b, n)
    shared = aligned.sparkSession.sparkContext.broadcast(((a << 16 | b).astype(np.uint32), n, n == top[b]))
    schema = ", ".join(f"{c} {t}" for c, t in aligned.dtypes if c not in ("pairs", "times")) + ", n_best long, count_sum long"
    return aligned.mapInArrow(partial(_judge, counts=shared), schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and corpus-wide links of every document."""
    aligned = stored(alignments(table(spark, sf_dir, "documents")))
    return with_counts(aligned, pair_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
