"""Session helpers: checkpoint folder and a local session for tests/bench."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    ``spark.checkpoint.dir`` names it, on a cluster a folder that driver and
    executors share.  Only a session without that setting (tests, the bench)
    gets a folder of its own, below the warehouse, which they share too; a
    local one is removed when the program ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/evoclust-{uuid.uuid4().hex}"
        if folder.startswith(("file:", "/")):
            atexit.register(shutil.rmtree, re.sub("^file:/*", "/", folder), ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster where it isn't installed
    (the same as ``spark-submit --py-files``): kernels are imported there."""
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="evoclust-py-"), "evoclust"), "zip",
                                  os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder (survives executor loss).

    The plan is persisted first, so writing the checkpoint reads the cached
    blocks instead of computing the plan a second time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session configured like the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("evoclust")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
