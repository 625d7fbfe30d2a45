"""A corpus pipeline of five training-data operators over ``documents``.

Each stage takes the rows its predecessor kept, as Parquet, and returns rows
with the columns of ``documents``; the last returns the index of the token
files it wrote.  What a stage decides takes effect: documents in no learned
language go, one document of each near-duplicate group stays, documents that
hold a benchmark window go, and the mix repeats or drops documents.

Defined cases: a null text, an empty one and one without a letter are in no
language and go; where no document has a lang, nothing is learned and none
stays; a null doc_id is an id of its own, kept behind the others; documents
without a source are one source; repeated rows are one near-duplicate group; an
empty table, or a stage that keeps nothing, gives an empty result of the same
columns; the input's other columns, whatever their names, stay up to the last
stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from evoclust.llm import decontaminate, language_id, mixing, simhash, token_output
from evoclust.llm.common import STORED, drop_stored, table
from evoclust.operators.store import remove
from evoclust.session import ensure_checkpoint_dir


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language (operator 10)."""
    return language_id.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group (operator 2)."""
    return simhash.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (operator 3)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (operator 5)."""
    return mixing.mix(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; doc_id, start, n_tokens, ids_crc32 of what they hold (operator 7)."""
    return token_output.encoded(docs)


STAGES = [
    ("language_id", by_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", without_benchmarks),
    ("mixing", to_weights),
    ("token_output", to_tokens),
]

#: Language ID, SimHash and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    Stages are written below ``folder`` (by default a new one in the checkpoint
    folder); when the next one is done, a stage and the tables it was made from
    are deleted.  The last one stays, and so do the token files.
    """
    folder = folder or f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        mark = len(STORED)
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        out = stage(spark, docs, sf_dir)
        schema = out.schema
        out.write.parquet(path)
        drop_stored(spark, mark)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(schema).parquet(path), path
    return docs
