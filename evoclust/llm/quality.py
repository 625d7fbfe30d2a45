"""Quality classifier: regularised quadratic discriminant over document statistics.

Method: a text's counts (words, distinct words, words equal to the word before,
lines, distinct lines, bytes by kind) become ``STATISTICS``: logarithms of sizes
and log-odds of shares.  A share of n things counts ``BYTES``, ``WORDS`` or
``LINES`` things more at a usual rate, so short texts lie near the usual ones
and an empty text has defined statistics.  Each class is a normal density with
its own mean and covariance, in units of the deviations over both classes.  The
covariance is shrunk twice: towards the classes' pooled one by the weight of
``POOLED`` documents, then towards the sphere of the same trace by ``SPHERE``.
Its Cholesky factor is computed once and kept; a document's Mahalanobis distance
is the squared length of the forward substitution with it.  The score is the
logistic of the difference of the classes' log-densities with their shares as
priors: the probability of label 1.

Training reads the labels of rows whose crc32(doc_id as text) mod 5 is not 0,
all of them: class means and covariances are Spark aggregates (a few hundred
numbers), so nothing is sampled.  A score sees the text alone.

Distribution: one narrow pass over the texts gives a row of ``len(STATISTICS)``
doubles each, stored; its join with the labels is salted on the documents' side,
the labels are distinct, so a hot doc_id is dealt over ``SALT`` tasks.  Both sides
are sorted and merged: the labels, each ``SALT`` times, are never collected for a
broadcast, which a small Parquet file of them would otherwise call for.  The model
(some 200 numbers) is broadcast and scoring is narrow.

Defined cases: a null text is an empty one; labels that are null or not 0 or 1,
and labels of a null doc_id, teach nothing; a document with both labels teaches
both, a label given twice teaches once, repeated documents teach once each; a
null doc_id counts as the empty text in the crc32, so it is held out; where one
class has no example the score is the other's share (1 or 0), and 0.5 without
any; an empty table gives an empty result.  Other columns stay; those named
score or predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from .common import stored, table
from .language_id import held_out

STATISTICS = ("words", "word_size", "upper", "symbols", "marks", "digits", "repeats", "common", "lines")
#: Things added to each share at a usual rate.
BYTES, WORDS, LINES = 100, 40, 4
POOLED, SPHERE, THRESHOLD, SALT = 20, 0.05, 0.3, 16
UPPER, LOWER, DIGIT, SPACE, MARK, SYMBOL, OTHER = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    for b in range(128):
        c = chr(b)
        kind[b] = (UPPER if c.isupper() else LOWER if c.islower() else DIGIT if c.isdigit() else SPACE if c in " \t\n\x0b\x0c\r"
                   else MARK if c in ".,;:?'\"()-" else SYMBOL)
    return kind


_KIND = _kinds()


def counts(raw: bytes) -> list[int]:
    """Words, distinct words, words equal to the word before, lines, distinct lines, bytes of each kind."""
    words, lines = raw.split(), raw.split(b"\n")
    return [len(words), len(set(words)), sum(map(bytes.__eq__, words, words[1:])), len(lines), len(set(lines)),
            *np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=OTHER + 1).tolist()]


def statistics(count: np.ndarray) -> np.ndarray:
    """``STATISTICS`` from rows of :func:`counts`."""
    words, distinct, repeats, lines, distinct_lines, upper, lower, digit, _, mark, symbol, other = count.T.astype(float)
    letters = upper + lower + other
    full = letters + digit + mark + symbol

    def odds(part: np.ndarray, of: np.ndarray, rate: float, more: int) -> np.ndarray:
        share = (part + more * rate) / (of + more)
        return np.log(share / (1 - share))

    return np.stack([
        np.log1p(words), np.log((full + 5 * WORDS) / (words + WORDS)),
        odds(upper, letters, 0.03, BYTES), odds(symbol, full, 0.005, BYTES), odds(mark, full, 0.03, BYTES),
        odds(digit, full, 0.005, BYTES), odds(repeats, words, 0.02, WORDS), odds(words - distinct, words, 0.3, WORDS),
        odds(lines - distinct_lines, lines, 0.02, LINES)], axis=1)


def _measure(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(text)]
        x = statistics(np.array([counts(t) for t in raw]).reshape(len(raw), 5 + OTHER + 1))
        keep = [i for i, n in enumerate(batch.schema.names) if n != text]
        flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), flat],
                                         names=[*(batch.schema.names[i] for i in keep), "__stats"])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, stats): each row of ``docs`` as a struct and the statistics of its text; narrow."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).cast("binary").alias("__raw"))
    schema = StructType([rows.schema["__row"]]).add("__stats", ArrayType(DoubleType()))
    return rows.mapInArrow(partial(_measure, text="__raw"), schema).select(F.col("__row").alias("row"), F.col("__stats").alias("stats"))


@dataclass
class Discriminant:
    """Two normal densities with the Cholesky factors of their covariances."""

    centre: np.ndarray
    scale: np.ndarray
    share: np.ndarray  # of the classes, 0 and 1
    means: list[np.ndarray] = field(default_factory=list)
    factors: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, n: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> "Discriminant":
        """From each class's number of rows, mean and covariance (divisor n)."""
        share, d = n / max(n.sum(), 1), means.shape[1]
        if not n.all():
            return cls(np.zeros(d), np.ones(d), np.where(n.sum() > 0, share, 0.5))
        centre = share @ means
        within = np.tensordot(share, covariances, 1)
        scale = np.sqrt(np.diag(within) + share @ (means - centre) ** 2)
        scale[scale < 1e-9] = 1.0
        out = cls(centre, scale, share)
        pooled = within / np.outer(scale, scale)
        for k in (0, 1):
            s = (n[k] * covariances[k] / np.outer(scale, scale) + POOLED * pooled) / (n[k] + POOLED)
            s = (1 - SPHERE) * s + (SPHERE * np.trace(s) / d + 1e-6) * np.eye(d)
            out.means.append((means[k] - centre) / scale)
            out.factors.append(np.linalg.cholesky(s))
        return out

    def log_density(self, k: int, x: np.ndarray) -> np.ndarray:
        """Of class k at rows x of standardised statistics, with the class's share, less what both classes share."""
        factor = self.factors[k]
        solved = np.empty_like(x)
        left = x - self.means[k]
        for j in range(x.shape[1]):  # forward substitution, all rows at once
            solved[:, j] = (left[:, j] - solved[:, :j] @ factor[j, :j]) / factor[j, j]
        return np.log(self.share[k]) - np.log(np.diag(factor)).sum() - 0.5 * (solved ** 2).sum(1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if not self.factors:
            return np.full(len(stats), self.share[1])
        x = (stats - self.centre) / self.scale
        return 1 / (1 + np.exp(np.clip(self.log_density(0, x) - self.log_density(1, x), -700, 700)))


def moments(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(label, n, m0.., c0_0..): of each class the rows, means and covariances over all labelled rows that are not held out."""
    dims = range(len(STATISTICS))
    taught = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct().withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = stats.select(F.col("row")[id_col].alias("id"), F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int").alias("salt"),
                        *(F.col("stats")[i].alias(f"x{i}") for i in dims))
    return rows.join(taught.hint("merge"), ["id", "salt"]).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *(F.avg(f"x{i}").alias(f"m{i}") for i in dims),
        *(F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i in dims for j in dims if i <= j))


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant:
    """The discriminant of all labelled rows of :func:`measured` that are not held out."""
    dims = range(len(STATISTICS))
    n, means, cov = np.zeros(2), np.zeros((2, len(dims))), np.zeros((2, len(dims), len(dims)))
    for r in moments(stats, labels, id_col, label_col).collect():
        k = r["label"]
        n[k], means[k] = r["n"], [r[f"m{i}"] for i in dims]
        cov[k] = [[r[f"c{min(i, j)}_{max(i, j)}"] for j in dims] for i in dims]
    return Discriminant.of(n, means, cov)


def _score(batches: Iterator[pa.RecordBatch], model, threshold: float) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))
        score = model.score(x)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                         names=["row", "__score", "__predicted"])


def scored(stats: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of :func:`measured` with score and predicted; narrow."""
    schema = StructType([stats.schema["row"]]).add("__score", DoubleType()).add("__predicted", IntegerType())
    out = stats.select("row", "stats").mapInArrow(
        partial(_score, model=stats.sparkSession.sparkContext.broadcast(model), threshold=threshold), schema)
    names = [c for c in stats.schema["row"].dataType.names if c not in ("score", "predicted")]
    return out.select(*(F.col("row")[c].alias(c) for c in names), F.col("__score").alias("score"),
                      F.col("__predicted").alias("predicted"))


def good_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which label 1 is likely enough; same columns."""
    only = docs.select(id_col, text_col)
    model = train(stored(measured(only, text_col).select(F.struct(F.col("row")[id_col].alias(id_col)).alias("row"), "stats")),
                  labels, id_col)
    whole = docs.select(F.struct(*docs.columns).alias("kept"), F.col(text_col).alias("text"))
    return scored(measured(whole), model, threshold).where("predicted = 1").select("kept.*")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out().alias("held_out"), "text")
    stats = stored(measured(docs).select(F.col("row").dropFields("text").alias("row"), "stats"))
    return scored(stats, train(stats, table(spark, sf_dir, "labels")))
