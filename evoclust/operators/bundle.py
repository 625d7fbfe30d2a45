"""Stored result bundles (S9, S10, K8): fits written as Parquet tables under a manifest.

``path`` holds one folder per saved version and a manifest ``manifest-<n>.json``
for each; a version counts from the moment its manifest is renamed into place,
which is one step on any file system that Spark writes to, so a reader meets
a whole bundle or the one before it.  Vectors are rows of tables, nothing is
pickled, and any session can load them.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from evoclust.operators.genetic import GeneticKMeansModel
from evoclust.operators.kmeans import KMeansModel, assign

FORMAT = 1


@dataclass
class GeneticBundle:
    """A genetic fit read back: its best chromosome, histories and log."""

    centers: np.ndarray
    fitness: float
    sse: float
    fitness_history: list[float]
    sse_history: list[float]
    ari_history: list[float | None]
    center_history: list[np.ndarray]
    log: list[tuple] = field(default_factory=list)
    table: DataFrame | None = None

    def labels(self) -> DataFrame:
        """``(row_id, cluster)`` of the fitted points."""
        return self.table

    def transform(self, points: DataFrame) -> DataFrame:
        """Nearest best centre for new points."""
        return assign(points, self.centers)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(m[1]) for m in (re.fullmatch(r"manifest-(\d+)\.json", n) for n in names) if m)


def _commit(spark: SparkSession, path: str, manifest: dict) -> int:
    """Write the manifest beside the others and rename it to the next free number."""
    folder, fs = _folder(spark, path)
    path_of = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    mine = path_of(f".manifest-{uuid.uuid4().hex}")
    out = fs.create(mine)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    n = max(_versions(spark, path), default=0) + 1
    while fs.exists(path_of(f"manifest-{n}.json")) or not fs.rename(mine, path_of(f"manifest-{n}.json")):
        n += 1  # another writer was first
        if n > 1_000_000:
            raise RuntimeError(f"cannot write to {path}")
    return n


def _center_rows(C: np.ndarray) -> list[tuple[int, list[float]]]:
    return [(c, [float(v) for v in row]) for c, row in enumerate(C)]


def save_model(model: KMeansModel | GeneticKMeansModel, spark: SparkSession, path: str) -> int:
    """Write the fit as a new version of the bundle ``path``; the version's number."""
    version = f"version-{uuid.uuid4().hex}"
    write = lambda df, name: df.write.option("compression", "zstd").parquet(f"{path}/{version}/{name}")
    steps = [(t, c, x) for t, C in enumerate(model.center_history) for c, x in _center_rows(C)]
    write(spark.createDataFrame(_center_rows(model.centers), "c int, cx array<double>").coalesce(1), "centers")
    write(spark.createDataFrame(steps, "iter int, c int, cx array<double>").coalesce(1), "center_history")
    manifest = {"format": FORMAT, "folder": version, "k": int(model.centers.shape[0]), "d": int(model.centers.shape[1])}
    if isinstance(model, KMeansModel):
        manifest |= {"kind": "kmeans", "sse_history": model.sse_history, "shift_history": model.shift_history,
                     "distances": model.distances}
        write(spark.createDataFrame(_center_rows(model.initial_centers), "c int, cx array<double>").coalesce(1), "initial_centers")
    else:
        manifest |= {"kind": "genetic", "fitness": model.fitness, "sse": model.sse, "fitness_history": model.fitness_history,
                     "sse_history": model.sse_history, "ari_history": model.ari_history}
        write(spark.createDataFrame(model.log, "gen int, stage string, chrom int, fitness double").coalesce(1), "log")
        write(model.labels(), "labels")
    return _commit(spark, path, manifest)


def load_model(spark: SparkSession, path: str, version: int | None = None) -> KMeansModel | GeneticBundle:
    """Read a bundle's last version, or the one with this number."""
    found = _versions(spark, path)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no bundle{'' if version is None else f' version {version}'} at {path}")
    text = spark.read.text(f"{path}/manifest-{found[-1] if version is None else version}.json").first()[0]
    manifest = json.loads(text)
    if manifest["format"] != FORMAT:
        raise ValueError(f"the bundle at {path} has format {manifest['format']}, this library reads {FORMAT}")
    read = lambda name: spark.read.parquet(f"{path}/{manifest['folder']}/{name}")
    array = lambda rows: np.array([r["cx"] for r in sorted(rows, key=lambda r: r["c"])], dtype=np.float64)
    centers, steps = array(read("centers").collect()), {}
    for r in read("center_history").collect():
        steps.setdefault(r["iter"], []).append(r)
    history = [array(steps[t]) for t in sorted(steps)]
    if manifest["kind"] == "kmeans":
        return KMeansModel(centers, array(read("initial_centers").collect()), manifest["sse_history"], manifest["shift_history"],
                           history, spark, manifest["distances"])
    log = [tuple(r) for r in read("log").orderBy("gen", "stage", "chrom").collect()]
    return GeneticBundle(centers, manifest["fitness"], manifest["sse"], manifest["fitness_history"], manifest["sse_history"],
                         manifest["ari_history"], history, log, read("labels"))
