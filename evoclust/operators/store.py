"""One table of points, versions of their labels.

Points are written once, bucketed on ``row_id``; a version holds ``(row_id,
sol)`` only and is bucketed alike, so a frame of both is a join without an
Exchange: bucket i of the points meets bucket i of the labels in one task,
which hashes the labels.  Both live in the session's checkpoint folder, so a
fit survives lost executors at every generation and its plans stay as small as
in the first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evoclust.session import ensure_checkpoint_dir
from evoclust.sources.points import target_partitions


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system ``path`` names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class PointStore:
    """``points(row_id, ...)`` and versions of ``(row_id, sol)``, both bucketed on ``row_id``."""

    def __init__(self, points: DataFrame, buckets: int | None = None):
        self.spark = points.sparkSession
        self.buckets = buckets or target_partitions(points)
        self.root = f"{ensure_checkpoint_dir(self.spark)}/points-{uuid.uuid4().hex}"
        self.tables: list[str] = []
        self.version = -1
        self.points = self._write(points.repartition(self.buckets, "row_id"), "points")
        self.n = self.points.count()
        if self.points.select("row_id").distinct().count() != self.n:
            self.close()
            raise ValueError("row_id must be unique and not null: labels are joined to points by it")

    def _write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        table = f"{self.root.rsplit('-', 1)[-1]}_{name}"
        writer = df.write.partitionBy(by) if by else df.write
        writer.bucketBy(self.buckets, "row_id").option("path", f"{self.root}/{name}").saveAsTable(f"evoclust_{table}")
        self.tables.append(f"evoclust_{table}")
        return self.spark.table(self.tables[-1])

    def commit(self, labels: DataFrame) -> DataFrame:
        """Write the next version and return the frame of points and labels.

        ``labels(row_id, sol)`` comes from a frame of this store or from its
        points, so its rows lie in their buckets and nothing is shuffled.  Of
        earlier versions only the last stays: plans made from it may still run.
        """
        self.version += 1
        new = self._write(labels.select("row_id", "sol"), f"labels_{self.version}")
        while len(self.tables) > 3:
            self._drop(self.tables.pop(1))
        return self.points.join(new.hint("shuffle_hash"), "row_id")

    def commit_pass(self, rows: DataFrame, kind: int, carried: list[str]) -> tuple[DataFrame, DataFrame]:
        """As :meth:`commit` for a pass that emits rows of several kinds: (frame of the points and
        the ``carried`` columns of rows of this ``kind``, the table with all kinds)."""
        self.version += 1
        new = self._write(rows, f"labels_{self.version}", "kind")
        while len(self.tables) > 3:
            self._drop(self.tables.pop(1))
        mine = new.where(F.col("kind") == kind).select("row_id", *carried)
        return self.points.join(mine.hint("shuffle_hash"), "row_id"), new

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(self.spark, f"{self.root}/{table.split('_', 2)[2]}")

    def close(self) -> None:
        """Drop all tables with their files."""
        while self.tables:
            self._drop(self.tables.pop())
        remove(self.spark, self.root)
