"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evoclust.operators.store import remove
from evoclust.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Space and the ASCII controls 09-0D.
BLANKS = " \t\n\x0b\x0c\r"
#: Folders that :func:`stored` has written, oldest first.
STORED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept.

    ``lower`` does just that to a text of ASCII only; the slower per-character
    ``translate`` is left to texts that hold other characters.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_of(name: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column, gaps: str = r"[\x20\x09-\x0D]+") -> Column:
    """The number of words between ``gaps`` (a pattern); several times as fast as counting matches."""
    return F.size(F.array_remove(F.split(text, gaps), "")).cast("long")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder, and read back.

    The table survives lost executors and cuts the lineage.  It stays until
    :func:`drop_stored`, as results are read from it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    STORED.append(path)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_stored(spark: SparkSession, since: int = 0) -> None:
    """Deletes the tables that :func:`stored` wrote in this program, from number ``since`` on:
    for a caller whose results are written elsewhere."""
    while len(STORED) > since:
        remove(spark, STORED.pop())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
