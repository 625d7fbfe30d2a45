import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[*]")
        .appName("evoclust-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def points_1d(spark, xs, clusters=None, labels=None, partitions=2):
    """Tiny point tables for the hand fixtures."""
    rows = []
    for i, x in enumerate(xs):
        r = [i, i, [float(x)] if not isinstance(x, (list, tuple)) else [float(v) for v in x]]
        r.append(None if clusters is None else int(clusters[i]))
        r.append(None if labels is None else int(labels[i]))
        rows.append(tuple(r))
    df = spark.createDataFrame(rows, "row_id bigint, pos bigint, x array<double>, cluster int, label int")
    return df.repartition(partitions)
