"""K8 on a stream: ``assign_stream(stream_points, centers)``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evoclust.operators import kernels as K


def assign_stream(points: DataFrame, centers) -> DataFrame:
    """Nearest-centre ``cluster`` and ``d2`` for every row of a (streaming) point table.

    A narrow ``mapInArrow`` with the centres in the closure: no state, no
    shuffle, so any trigger and output mode work.
    """
    C = np.asarray(centers, dtype=np.float64)
    K.check_broadcast(C)
    keep = [c for c in points.columns if c not in ("cluster", "d2")]
    schema = T.StructType([points.schema[c] for c in keep] + [T.StructField("cluster", T.IntegerType()), T.StructField("d2", T.DoubleType())])
    return points.mapInArrow(K.predict_fn(C, C.shape[1], keep), schema)
