"""Language ID by a bidirectional gated recurrent network over bytes.

Method: a text is its UTF-8 bytes, A-Z lower-cased; blanks, digits and
punctuation are read like letters.  A gated recurrent unit runs over the bytes
from either end, and a softmax over both states labels every byte with a
probability per language.  The document pools all of them: the mean
log-probability of each language, normalised to sum to one.  Whole texts
count; nothing is cut off.

For speed a text is read in windows of about ``CORE`` bytes, cut between
characters, many at a time.  Each byte is labelled once, in its own window; the
states are warmed up on the ``WARM`` bytes before (from the end: behind) it, so
context crosses the cuts.

The network is trained here, in numpy, by backpropagation through time with
Adam, on at most ``SAMPLE`` labelled documents, of those over ``SAMPLE_BYTES``
bytes on ``PARTS`` parts at places chosen by hash (64 MB in all): of each
language the one with the lowest hash in each of ``BUCKETS`` hash buckets,
found with a partial aggregate; it learns from ``LEARN`` runs of
``PIECE`` bytes a language, drawn evenly over the bytes of these.  Training uses text and lang
alone, of documents whose crc32(doc_id as text) mod 5 is not 0; the prediction
sees the text alone.

One class more is learned from noise that is made here: characters of scripts
that the sample does not hold, and letters of the sample in random order.  Its
share lowers ``score``; it is never an answer.  ``known_language`` rejects
below a score fitted on all labelled documents held out of training, read
whole: ``SLACK`` of their ``CUT`` quantile, and ``Network.kept`` is the share
of them that passes.  Languages that resemble a learned one in its own script
may pass.

Distribution: the weights (some 10,000 numbers) are broadcast; prediction is
one narrow pass.  For the fitted score a pass over the held-out documents
stores their scores; the quantile is an order statistic of them, found exactly
by counts of ever narrower bins.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text when nothing was learned; a null doc_id counts as the empty text
in the crc32, so it is held out; documents without lang teach nothing; repeated
rows and extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import STORED, drop_stored, stored, table

HIDDEN, PIECE = 16, 32
STEPS, BATCH, RATE, SEED = 300, 512, 0.01, 0
BUCKETS, SAMPLE, SAMPLE_BYTES, PARTS = 256, 8192, 8192, 16
LEARN, CORE, WARM = 32_768, 512, 32
GROUP_BYTES, ROWS = 4 << 20, 2048
UNKNOWN = "und"
#: For the score below which a document is in no learned language.
CUT, SLACK = 0.01, 0.5
#: Bins of a round of :func:`order_statistic`.
BINS = 4096
_LETTER = re.compile(rb"[A-Za-z]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Byte-level bidirectional GRU with a softmax at every position."""

    #: Fitted by ``known_language``: the least score, and the share of held-out documents that have it.
    min_score, kept = 0.0, 1.0

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = SEED, noise: bool = False) -> None:
        rng = np.random.default_rng(seed)
        self.classes, self.hidden = classes, hidden
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":
            self.w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.w[f"u{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        self.w["o"] = rng.normal(0, 0.3, (2 * hidden, len(classes) + noise)).astype(np.float32)
        self.w["c"] = np.zeros(len(classes) + noise, np.float32)

    @staticmethod
    def matrix(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, bytes from the end, sizes); rows are padded with zeros."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(size.max())
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        out, back = np.zeros((2, len(pieces), width), np.uint8)
        row = np.repeat(np.arange(len(pieces)), size)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        out[row, col] = flat
        back[row, np.repeat(size, size) - 1 - col] = flat
        return out, back, size

    def _run(self, side: str, x: np.ndarray, size: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step (rows, steps, hidden); with ``keep`` what the way back needs."""
        n, width, h = *x.shape, self.hidden
        wx, u = self.w[f"x{side}"], self.w[f"u{side}"]
        state, out, tape = np.zeros((n, h), np.float32), np.empty((n, width, h), np.float32), []
        for t in range(width):
            a, g = wx[x[:, t]], state @ u
            gates = _sigmoid(a[:, :2 * h] + g[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(a[:, 2 * h:] + r * g[:, 2 * h:])
            live = (t < size)[:, None]
            if keep:
                tape.append((state, z, r, new, g[:, 2 * h:], live))
            state = np.where(live, state + z * (new - state), state)
            out[:, t] = state
        return out, tape

    def _back(self, side: str, x: np.ndarray, tape: list, grad: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of ``grad``, the loss by the states."""
        h, u = self.hidden, self.w[f"u{side}"]
        dx, du = np.zeros_like(self.w[f"x{side}"]), np.zeros_like(u)
        steps = np.zeros((x.shape[1], len(x), 3 * h), u.dtype)
        carried = np.zeros((len(x), h), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            state, z, r, new, g, live = tape[t]
            d = carried + grad[:, t]
            here = np.where(live, d, 0)
            dnew = here * z * (1 - new * new)
            dz = here * (new - state) * z * (1 - z)
            dr = dnew * g * r * (1 - r)
            np.concatenate([dz, dr, dnew], axis=1, out=steps[t])
            dg = np.concatenate([dz, dr, dnew * r], axis=1)
            du += state.T @ dg
            carried = np.where(live, here * (1 - z) + dg @ u.T, d)
        read = x.T.ravel()
        order = np.argsort(read, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(read[order]) != 0])
        dx[read[order][starts]] = np.add.reduceat(steps.reshape(-1, 3 * h)[order], starts)
        return {f"x{side}": dx, f"u{side}": du}

    def _log_probabilities(self, pieces: list[bytes], keep: bool = False):
        x, y, size = self.matrix(pieces)
        fwd, tape_f = self._run("f", x, size, keep)
        bwd, tape_b = self._run("b", y, size, keep)
        at = size[:, None] - 1 - np.arange(x.shape[1])[None, :]
        inside = at >= 0
        both = np.concatenate([fwd, np.take_along_axis(bwd, np.maximum(at, 0)[:, :, None], axis=1)], axis=2)
        s = both @ self.w["o"] + self.w["c"]
        s -= s.max(2, keepdims=True)
        logp = s - np.log(np.exp(s).sum(2, keepdims=True))
        return logp, inside, (x, y, size, at, both, tape_f, tape_b)

    def sums(self, pieces: list[bytes]) -> np.ndarray:
        """Per piece, the log-probabilities of all its positions summed by language, and their number."""
        logp, inside, _ = self._log_probabilities(pieces)
        return np.concatenate([(logp * inside[:, :, None]).sum(1), inside.sum(1, keepdims=True)], axis=1).astype(np.float64)

    def _scores(self, side: str, x: np.ndarray, before: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Unnormalised scores (classes, steps, rows) of one direction behind the warm-up.

        ``x`` is (steps, rows): row i's warm-up ends at step ``before.max()``, its ``size[i]`` labelled bytes follow;
        sizes fall.
        """
        h, warm, (width, n) = self.hidden, int(before.max()), x.shape
        half = np.float32(0.5)  # the sigmoid as a hyperbolic tangent of the half
        wz, wr, wn = (np.ascontiguousarray(self.w[f"x{side}"][:, i * h:(i + 1) * h], np.float32) for i in range(3))
        uz, ur, un = (np.ascontiguousarray(self.w[f"u{side}"][:, i * h:(i + 1) * h], np.float32) for i in range(3))
        wz, wr, uz, ur = wz * half, wr * half, uz * half, ur * half
        o = np.ascontiguousarray((self.w["o"][:h] if side == "f" else self.w["o"][h:]).T, np.float32)
        state, out = np.zeros((n, h), np.float32), np.zeros((len(o), width - warm, n), np.float32)
        m = n
        for t in range(width):
            while t >= warm and size[m - 1] <= t - warm:
                m -= 1
            now, at = state[:m], x[t, :m]
            z, r, new = wz.take(at, 0), wr.take(at, 0), wn.take(at, 0)
            z += now @ uz
            r += now @ ur
            for gate in (z, r):
                np.tanh(gate, out=gate)
                gate *= half
                gate += half
            r *= now @ un
            new += r
            np.tanh(new, out=new)
            new -= now
            new *= z
            now += new
            if t < warm:
                now *= (t >= warm - before)[:, None]
            else:
                np.matmul(o, now.T, out=out[:, t - warm, :m])
        return out

    def _read(self, data: np.ndarray, lo: np.ndarray, first: np.ndarray, end: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Log-probabilities, summed by language, of the bytes first .. end - 1 of each window, read from lo to hi."""
        order = np.argsort(first - end, kind="stable")
        lo, first, end, hi = lo[order], first[order], end[order], hi[order]
        size = end - first
        step = np.arange(size[0])[:, None]

        def steps(before: np.ndarray, at: np.ndarray, way: int) -> np.ndarray:
            t = np.arange(before.max() + size[0])[:, None] - before.max()
            return data[np.clip(at + way * t, 0, len(data) - 1)]

        s = self._scores("f", steps(first - lo, first, 1), first - lo, size)
        back = self._scores("b", steps(hi - end, end - 1, -1), hi - end, size)
        full = int((size == size[0]).sum())
        s[:, :, :full] += back[:, ::-1, :full]
        if full < len(size):
            turned = np.maximum(size[full:] - 1 - step, 0)
            s[:, :, full:] += np.take_along_axis(back[:, :, full:], turned[None], axis=1)
        s += self.w["c"].astype(np.float32)[:, None, None]
        s -= s.max(0)
        s -= np.log(np.exp(s).sum(0))
        s *= step < size
        out = np.empty((len(size), len(s)))
        out[order] = s.sum(1, dtype=np.float64).T
        return out

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Log-probabilities of all bytes of each text (none is empty), summed by language; windows share context."""
        data = np.frombuffer(b"".join(texts).lower(), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.cumsum(size) - size
        count = -(-size // CORE)
        owner = np.repeat(np.arange(len(texts)), count)
        floor, top = start[owner], (start + size)[owner]
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        first = between(data, floor + nth * CORE, floor)
        end = np.where(nth + 1 == count[owner], top, np.r_[first[1:], 0])
        lo = between(data, np.maximum(first - WARM, floor), floor)
        hi = np.maximum(between(data, np.minimum(end + WARM, top), floor, top), end)
        out = np.zeros((len(texts), len(self.w["c"])))
        order = np.argsort(end - first, kind="stable")
        for a in range(0, len(order), ROWS):
            i = order[a:a + ROWS]
            np.add.at(out, owner[i], self._read(data, lo[i], first[i], end[i], hi[i]))
        return out

    def gradients(self, pieces: list[bytes], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradients."""
        logp, inside, (x, y, size, at, both, tape_f, tape_b) = self._log_probabilities(pieces, keep=True)
        n = inside.sum()
        loss = -float((np.take_along_axis(logp, labels[:, None, None], axis=2)[:, :, 0] * inside).sum() / n)
        d = np.exp(logp)
        d[np.arange(len(labels)), :, labels] -= 1
        d *= (inside / n)[:, :, None].astype(np.float32)
        g = {"o": both.reshape(-1, both.shape[2]).T @ d.reshape(-1, d.shape[2]), "c": d.sum((0, 1))}
        dboth = d @ self.w["o"].T
        h = self.hidden
        turned = np.take_along_axis(np.where(inside[:, :, None], dboth[:, :, h:], 0), np.maximum(at, 0)[:, :, None], axis=1)
        g |= self._back("f", x, tape_f, dboth[:, :, :h])
        g |= self._back("b", y, tape_b, np.where(inside[:, :, None], turned, 0))
        return loss, g

    def fit(self, pieces: list[bytes], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS, batch: int = BATCH,
            rate: float = RATE, seed: int = SEED) -> float:
        """Adam on pieces drawn by weight; the mean loss of the last tenth of the steps."""
        rng = np.random.default_rng(seed)
        chance = np.cumsum(weights / weights.sum())
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = np.minimum(np.searchsorted(chance, rng.random(batch)), len(pieces) - 1)
            loss, g = self.gradients([pieces[i] for i in pick], labels[pick])
            losses.append(loss)
            now = rate * (1 - step / (steps + 1))
            for k, d in g.items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                self.w[k] = (self.w[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)
                             ).astype(np.float32)
        return float(np.mean(losses[-max(1, steps // 10):])) if losses else float("nan")


def between(data: np.ndarray, at: np.ndarray, floor: np.ndarray, top: np.ndarray | None = None) -> np.ndarray:
    """The places ``at``, moved back to the start of their UTF-8 character, not before ``floor``; ``top`` is one too."""
    at, ended = at.copy(), at == top if top is not None else np.zeros(len(at), bool)
    for _ in range(3):
        inner = (data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80
        at -= inner & ~ended & (at > floor)
    return at


def drawn(texts: list[bytes], n: int, seed: int) -> list[bytes]:
    """``n`` runs of ``PIECE`` bytes from a character's start on, drawn evenly over the bytes of the texts."""
    data = np.frombuffer(b"".join(texts).lower(), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    at = np.sort(np.random.default_rng(seed).integers(0, len(data), n))
    owner = np.searchsorted(end, at, "right")
    floor, top = np.r_[0, end[:-1]][owner], end[owner]
    first = between(data, np.maximum(np.minimum(at, top - PIECE), floor), floor)
    last = np.maximum(between(data, np.minimum(first + PIECE, top), floor, top), first + 1)
    return [data[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
           ) -> list[tuple[str, bytes]]:
    """(lang, text) of at most ``SAMPLE`` training documents; of long ones parts, joined."""
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.col(lang_col))
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                      ).withColumn("__k", key)
    least = rows.groupBy(lang_col, F.pmod("__k", F.lit(BUCKETS)).alias("__b")).agg(F.min("__k").alias("__k"))
    few = least.orderBy("__b", lang_col).limit(SAMPLE).select("__k")
    raw, part = F.col(text_col).cast("binary"), SAMPLE_BYTES // PARTS
    room = F.octet_length(raw) - part
    parts = F.concat(*(F.substring(raw, F.pmod(F.xxhash64("__k", F.lit(i)), room).cast("int") + 1, F.lit(part)) for i in range(PARTS)))
    picked = rows.join(F.broadcast(few), "__k", "left_semi").select(
        "__k", F.col(lang_col), F.when(F.octet_length(raw) <= SAMPLE_BYTES, raw).otherwise(parts)).dropDuplicates(["__k"]).collect()
    return [(r[1], bytes(r[2])) for r in sorted(picked, key=lambda r: (r[1], r[0]))]


def noise(texts: list[bytes], n: int, seed: int) -> list[bytes]:
    """``n`` runs of ``PIECE`` bytes: half in blocks of characters that no text holds, half of the texts' letters at random."""
    rng = np.random.default_rng(seed)
    held = set("".join(t.decode("utf-8", "ignore") for t in texts).lower())
    letters, blocks = sorted(c for c in held if c.isalpha()), {ord(c) >> 6 for c in held}
    # Blocks of 64 characters, those of two and of three bytes each.
    free = [[b for b in span if b not in blocks and sum(chr(64 * b + i).isalpha() for i in range(64)) > 16]
            for span in (range(0x80 >> 6, 0x800 >> 6), range(0x800 >> 6, 0xD800 >> 6))]
    out = []
    for i in range(n):
        kind = [i % 4 // 2, None][i % 2]
        if kind is None:
            own = letters
        elif free[kind]:
            block = free[kind][rng.integers(len(free[kind]))]
            own = [c for c in map(chr, range(64 * block, 64 * block + 64)) if c.isalpha()]
        else:
            continue
        if own:
            chars = [own[j] for j in rng.integers(0, len(own), PIECE)]
            for at in np.cumsum(rng.integers(2, 12 if rng.random() < 0.7 else 2 * PIECE, PIECE)):
                if at < PIECE:
                    chars[at] = " "
            out.append("".join(chars).lower().encode()[:PIECE])
    return out


def train(docs: DataFrame, **columns) -> Network | None:
    """The network trained on a bounded sample; None if there is nothing to learn from."""
    texts = sample(docs, **columns)
    by: dict[str, list[bytes]] = {}
    for lang, text in texts:
        if text:
            by.setdefault(lang, []).append(text)
    if not by:
        return None
    classes = sorted(by)
    net = Network(classes, noise=True)
    # Every language gets the same share of the draws, and so does noise.
    pieces = [drawn(by[lang], LEARN, SEED + i) for i, lang in enumerate(classes)]
    pieces.append(noise([t for lang in classes for t in by[lang]], LEARN // 4, SEED))
    labels = np.repeat(np.arange(len(pieces)), [len(some) for some in pieces])
    net.fit([p for some in pieces for p in some], labels, np.concatenate([np.full(len(some), 1 / max(1, len(some))) for some in pieces]))
    return net


def fit_rejection(net: Network, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> None:
    """Sets ``min_score`` and ``kept`` by all labelled documents that were held out (by those of training if there are none)."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    held = labelled.where(held_out(id_col))
    some = labelled.where(~held_out(id_col)) if held.isEmpty() else held
    mark = len(STORED)
    found = predict(some.select(F.col(text_col).alias("text")), net).where(~((F.col("lang_pred") == UNKNOWN) & (F.col("score") == 0)))
    scores = stored(found.select("score"))
    cut = order_statistic(scores, "score", CUT)
    if cut is not None:
        net.min_score = SLACK * cut
        net.kept = float(scores.agg(F.avg((F.col("score") >= net.min_score).cast("double"))).first()[0])
    drop_stored(docs.sparkSession, mark)


def order_statistic(rows: DataFrame, column: str, share: float) -> float | None:
    """The value at place floor((n - 1) * share) of the n sorted values, exactly; None without values.

    Each round counts the values in ``BINS`` bins of the range that holds the place
    and goes on in its bin, until that is a single value.
    """
    value = F.col(column).cast("double")
    n, lo, hi = rows.agg(F.count(value), F.min(value), F.max(value)).first()
    place = math.floor((n - 1) * share)
    while n and lo < hi:
        bin_of = F.floor((value - F.lit(lo)) / F.lit(hi - lo) * BINS)
        bins = rows.where(value.between(lo, hi)).groupBy(bin_of.alias("bin")).agg(
            F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).orderBy("bin").collect()
        for b in bins:
            if place < b["n"]:
                lo, hi = b["lo"], b["hi"]
                break
            place -= b["n"]
    return float(lo) if n else None


def pooled(net: Network, texts: list[bytes]) -> list[tuple[str, float]]:
    """(language, probability) of each text; every text has a letter."""
    out: list[tuple[str, float]] = []
    group: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        group.append(text)
        size += len(text)
        if size >= GROUP_BYTES or i == len(texts) - 1:
            mean = net.totals(group) / np.array([len(t) for t in group])[:, None]
            p = np.exp(mean - mean.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p[:, :len(net.classes)].argmax(1)
            out += [(net.classes[b], float(q[b])) for b, q in zip(best.tolist(), p)]
            group, size = [], 0
    return out


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "ignore")))


def _predict(batches: Iterator[pa.RecordBatch], net, text: str, inside: str | None = None) -> Iterator[pa.RecordBatch]:
    """``text`` is a column of its own, which goes, or a field of the struct column ``inside``."""
    net = net.value
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
        found = [(UNKNOWN, 0.0)] * batch.num_rows
        texts = batch.column(inside).field(text) if inside else batch.column(text)
        raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]
        ours = [i for i, t in enumerate(raw) if net is not None and has_letter(t)]
        for i, answer in zip(ours, pooled(net, [raw[i] for i in ours]) if ours else ()):
            found[i] = answer
        keep = [i for i, n in enumerate(batch.schema.names) if inside or n != text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array([f[0] for f in found], pa.string()),
                                               pa.array([f[1] for f in found], pa.float64())],
            names=[batch.schema.names[i] for i in keep] + ["lang_pred", "score"])


def predict(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced); narrow."""
    raw = docs.drop("lang_pred", "score").withColumn("__raw", F.col(text_col).cast("binary"))
    schema = StructType([f for f in raw.schema if f.name != "__raw"]).add("lang_pred", StringType()).add("score", DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return raw.mapInArrow(partial(_predict, net=shared, text="__raw"), schema)


def known_language(docs: DataFrame, min_score: float | None = None, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are in a learned language, by a score of ``min_score`` (else a fitted one); same columns."""
    columns = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    net = train(docs.select(id_col, text_col, lang_col), **columns)
    if net is not None and min_score is None:
        fit_rejection(net, docs.select(id_col, text_col, lang_col), **columns)
        min_score = net.min_score
    # The row travels in one struct, once: no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    schema = StructType([*rows.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    judged = rows.mapInArrow(partial(_predict, net=docs.sparkSession.sparkContext.broadcast(net), text=text_col, inside="row"), schema)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= (min_score or 0.0))).select("row.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train(docs)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), net).select(
        "doc_id", "held_out", "lang_pred", "score")
