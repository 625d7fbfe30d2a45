"""Point tables: ``points(row_id BIGINT, pos BIGINT, x ARRAY<DOUBLE>, label INT)``.

Sources (S1-S5) and projections (P1-P8).  ``row_id`` is the stable identity of
a point (the reference identifies points by position, a DataFrame has none);
``pos`` is a dense 0..n-1 rank by ``row_id`` used for crossover cut points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evoclust.session import cut_lineage

# Class names of the iris data set in label order 0, 1, 2.
IRIS_CLASSES = ("Iris-setosa", "Iris-versicolor", "Iris-virginica")
# Abalone column order of the raw file.
ABALONE_COLUMNS = (
    "sex", "length", "diameter", "height", "whole_weight",
    "shucked_weight", "viscera_weight", "shell_weight", "rings",
)
# Our choice for the nominal sex code (alphabetical): F=0, I=1, M=2.
ABALONE_SEX_CODE = {"F": 0, "I": 1, "M": 2}


def points_from_columns(
    df: DataFrame,
    id_col: str,
    feature_cols: Sequence[str],
    label_col: str | None = None,
) -> DataFrame:
    """Assemble named numeric columns into ``x ARRAY<DOUBLE>``."""
    cols = [F.col(id_col).cast("bigint").alias("row_id"),
            F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("x")]
    if label_col is not None:
        cols.append(F.col(label_col).cast("int").alias("label"))
    return df.select(*cols)


def points_from_array(df: DataFrame, id_col: str, array_col: str, label_col: str | None = None) -> DataFrame:
    """A table that already holds a vector column (e.g. ARRAY<FLOAT> embeddings)."""
    cols = [F.col(id_col).cast("bigint").alias("row_id"),
            F.col(array_col).cast("array<double>").alias("x")]
    if label_col is not None:
        cols.append(F.col(label_col).cast("int").alias("label"))
    return df.select(*cols)


def parse_vector(col, sep: str = ",") -> Column:
    """S3/F8: a delimited text field to ``ARRAY<DOUBLE>`` (quotes and blanks stripped)."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, sep)
    return F.transform(parts, lambda v: F.trim(F.regexp_replace(v, '"', "")).cast("double"))


def recode(col, mapping: Mapping, default=None) -> Column:
    """Map values through a small fixed dictionary; others keep their value
    (or take ``default`` when given)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return c
    return expr.otherwise(c if default is None else F.lit(default))


def drop_feature(points: DataFrame, index: int) -> DataFrame:
    """P5: remove feature ``index`` from every vector ("without sex" runs)."""
    return points.withColumn("x", F.filter("x", lambda v, i: i != F.lit(index)))


def _csv(spark: SparkSession, path: str | list[str], header: bool) -> DataFrame:
    """A CSV table of strings: quotes and blanks around fields stripped, blank
    lines skipped, and with ``header`` the first line of every file."""
    return spark.read.csv(path, header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def _by_input(df: DataFrame, x: Column, label: Column | None = None) -> DataFrame:
    """Points ``row_id = pos`` in scan order from expressions over a scan."""
    cols = [x.alias("x")] + ([label.cast("int").alias("label")] if label is not None else [])
    numbered = with_pos(df.select(*cols), None)
    return numbered.select(F.col("pos").alias("row_id"), "pos", *[c for c in numbered.columns if c != "pos"])


def read_numeric_csv(spark: SparkSession, path: str | list[str], header: bool = False, label_last: bool = False) -> DataFrame:
    """Numeric CSV -> points; one or several files, each with a header line or none."""
    df = _csv(spark, path, header)
    names = df.columns[:-1] if label_last else df.columns
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    return _by_input(df, x, F.col(f"`{df.columns[-1]}`") if label_last else None)


def read_named_csv(spark: SparkSession, path: str | list[str], features: Sequence[str], label: str | None = None) -> DataFrame:
    """CSV with a header line in every file; features and label by name."""
    df = _csv(spark, path, header=True)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    return _by_input(df, x, F.col(f"`{label}`") if label is not None else None)


def read_iris(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """Labelled iris (4 features + class name) -> points with label 0..2.

    Handles the quoted file with a header and leading-dot decimals as well as
    the raw file with a trailing blank line; ``header`` says which, the file's
    name does not.  Another class name is an error.
    """
    df = _csv(spark, path, header)
    *feats, name = [F.col(f"`{c}`") for c in df.columns[:5]]
    mapping = {c.replace("Iris-", "").capitalize(): i for i, c in enumerate(IRIS_CLASSES)}
    label = recode(F.initcap(F.regexp_replace(name, "^Iris-", "")), mapping)
    return _by_input(df, F.array(*[f.cast("double") for f in feats]), label)


def read_abalone(spark: SparkSession, path: str | list[str], with_sex: bool = True) -> DataFrame:
    """Raw abalone file -> points; label = rings - 1 with 28 -> 27."""
    df = _csv(spark, path, header=False).toDF(*ABALONE_COLUMNS)
    sex = recode("sex", ABALONE_SEX_CODE).cast("double")
    nums = [F.col(c).cast("double") for c in ABALONE_COLUMNS[1:-1]]
    x = F.array(sex, *nums) if with_sex else F.array(*nums)
    return _by_input(df, x, recode(F.col("rings").cast("int") - 1, {28: 27}))


def target_partitions(df: DataFrame, min_bytes: int = 512 << 10, max_bytes: int = 128 << 20) -> int:
    """Partitions for a point table from the optimizer's size estimate: none
    smaller than ``min_bytes`` (tiny tables get few tasks), none larger than
    ``max_bytes``, and at least the cluster's parallelism when the data allow."""
    fallback = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no estimate: fall back to the shuffle setting
        return fallback
    if size <= 0 or size >= 1 << 60:  # Spark reports "unknown" as a huge default
        return fallback
    cores = df.sparkSession.sparkContext.defaultParallelism
    by_min = -(-size // min_bytes)
    by_max = -(-size // max_bytes)
    return int(max(1, min(max(cores, by_max), by_min, 1 << 20)))


#: Plan nodes over which two jobs see the same rows in the same partitions.
_STABLE = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "LocalRelation", "LogicalRDD", "Range"}


def _stable_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a scan with deterministic narrow operators on it."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() not in _STABLE or not node.deterministic():
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def _number_partitions(df: DataFrame, unique: str | None = None) -> DataFrame:
    """``pos`` = rows before this partition + index inside it.

    Needs a plan whose partitions and row order are the same on every
    computation (a stable scan, or reliable checkpoint data): one job counts
    rows per partition (one row per partition reaches the driver), a narrow
    ``mapInArrow`` numbers them.  ``unique`` names a column by which the rows
    are range-partitioned and sorted: equal neighbours are an error.
    """
    counts = {
        r["pid"]: r["n"]
        for r in df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    offsets, acc = {}, 0
    for pid in sorted(counts):
        offsets[pid] = acc
        acc += counts[pid]
    schema = T.StructType(df.schema.fields + [T.StructField("pos", T.LongType())])

    def number(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        start = first = offsets.get(pid, 0)
        last = None
        for b in batches:
            if unique is not None and b.num_rows:
                ids = b.column(b.schema.get_field_index(unique))
                if (last is not None and ids[0].equals(last)) or pc.any(pc.equal(ids[1:], ids[:-1])).as_py():
                    raise ValueError(f"{unique} repeats: every point needs an id of its own")
                last = ids[b.num_rows - 1]
            pos = pa.array(range(start, start + b.num_rows), type=pa.int64())
            start += b.num_rows
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pos], names=list(b.schema.names) + ["pos"])
        if start - first != counts.get(pid, 0):
            raise RuntimeError("the input's partitions changed between counting and numbering")

    return df.mapInArrow(number, schema)


def with_pos(points: DataFrame, order_col="row_id", num_partitions: int | None = None) -> DataFrame:
    """Add dense ``pos`` 0..n-1, fully distributed.

    ``order_col`` (a name or a list of columns): range-partition and sort by
    it once, materialised on reliable storage so that counting and numbering
    see the same partitions; a single column must not repeat.
    ``order_col=None``: the order in which the scan deals its splits; only a
    scan with narrow operators is numbered as it is (no sort, no checkpoint),
    any other plan is materialised first.  Only when there are fewer splits
    than ``num_partitions`` (size-aware by default) are the rows spread by a
    range partition on ``pos``.  No single-partition window, no ``monotonically_increasing_id``.
    """
    if "pos" in points.columns:
        points = points.drop("pos")
    n_parts = num_partitions or target_partitions(points)
    if order_col is None:
        numbered = _number_partitions(points if _stable_scan(points) else cut_lineage(points))
        # spread rows only when the scan has fewer splits than wanted (small
        # inputs); a large scan already has enough partitions: no shuffle
        if n_parts > 1 and points.rdd.getNumPartitions() < n_parts:
            numbered = numbered.repartitionByRange(n_parts, "pos")
        out = numbered
    else:
        order = [order_col] if isinstance(order_col, str) else list(order_col)
        out = _number_partitions(cut_lineage(points.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)),
                                 order[0] if len(order) == 1 else None)
    front = [c for c in ("row_id", "pos") if c in out.columns]
    return out.select(*front, *[c for c in out.columns if c not in front])


def points_by_position(df: DataFrame, feature_cols: Sequence[str], label_col: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Points from a table without a key: ``row_id = pos``, numbered in scan
    order without a shuffle."""
    cols = [F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(feature_cols)]
    if label_col is not None:
        cols.append(F.col(label_col).alias("_label"))
    base = df.select(*cols)
    numbered = with_pos(base, None, num_partitions)
    out = [F.col("pos").alias("row_id"), "pos", F.array(*[f"_f{i}" for i in range(len(feature_cols))]).alias("x")]
    if label_col is not None:
        out.append(F.col("_label").alias("label"))
    return numbered.select(*out)
