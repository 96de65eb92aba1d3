"""Table sinks: artifacts (S3) and run logs.

Artifacts and run records are plain Parquet (or CSV) tables under a base
folder that the cluster shares (e.g. the checkpoint folder or a warehouse
path), partitioned by ``run_id`` so that a run replaces its own rows only.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_artifact(df: DataFrame, base: str, run_id: str, artifact_path: str, name: str,
                   fmt: str = "parquet") -> str:
    """S3: store a DataFrame as an artifact of a run; returns its folder.

    Only the run's own partition is replaced, so a repeated run leaves one copy."""
    path = os.path.join(base, artifact_path, name)
    writer = (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("run_id"))
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown artifact format {fmt!r}")
    return path


def read_artifact(spark: SparkSession, path: str, run_id: str | None = None,
                  fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Read an artifact back (one run when ``run_id`` is given: partition pruned).

    A CSV artifact needs its columns' ``schema``; without one they are strings."""
    if fmt == "csv":
        reader = spark.read.option("header", True)
        df = (reader.schema(f"{schema}, run_id string") if schema else reader).csv(path)
    else:
        df = spark.read.parquet(path)
    return df.where(F.col("run_id") == run_id).drop("run_id") if run_id else df


class RunLog:
    """Parameters, metrics and configuration per run, as tables.

    ``runs(run_id, parent, method, param, value)``, ``metrics(run_id, key, value)``,
    ``configs(run_id, config)`` and ``commits(run_id, finished)``.  What a run logs under
    one name is a partition of its own, replaced when the run is repeated, and ``table``
    shows the rows of finished runs, so a run that failed half way or ran twice leaves
    each row once.
    """

    def __init__(self, spark: SparkSession, base: str, experiment: str = "default"):
        self.spark, self.base, self.experiment = spark, os.path.join(base, experiment), experiment

    def run_id(self, method: str, params: dict) -> str:
        """The id of this method with these parameters: the same for a repeated run."""
        text = json.dumps([self.experiment, method, params], sort_keys=True)
        return "r" + hashlib.md5(text.encode()).hexdigest()

    def new_run(self) -> str:
        """An id of its own, for a run that is never repeated."""
        return "r" + uuid.uuid4().hex

    def _put(self, table: str, run_id: str, name: str, rows: DataFrame) -> None:
        (rows.withColumn("run_id", F.lit(run_id)).withColumn("part", F.lit(f"p-{name}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "part").parquet(os.path.join(self.base, table)))

    def log_params(self, run_id: str, method: str, params: dict, parent: str = "") -> None:
        rows = [(parent, method, k, json.dumps(v)) for k, v in params.items()]
        self._put("runs", run_id, "params", self.spark.createDataFrame(
            rows, "parent string, method string, param string, value string"))

    def log_metric(self, run_id: str, key: str, value: float) -> None:
        self._put("metrics", run_id, f"one-{key}", self.spark.createDataFrame(
            [(key, float(value))], "key string, value double"))

    def log_metrics_df(self, run_id: str, metrics: DataFrame, name: str = "table") -> None:
        """Metrics computed as a DataFrame (key, value), logged under ``name`` - no driver round trip."""
        self._put("metrics", run_id, name, metrics.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("double").alias("value")))

    def log_config(self, run_id: str, config: dict) -> None:
        self._put("configs", run_id, "config", self.spark.createDataFrame(
            [(json.dumps(config, sort_keys=True),)], "config string"))

    def finish(self, run_id: str) -> None:
        """Marks the run as complete: from now on ``table`` shows it."""
        self._put("commits", run_id, "done", self.spark.createDataFrame([(time.time(),)], "finished double"))

    def table(self, name: str, finished: bool = True) -> DataFrame:
        """A table's rows: of finished runs, or (``finished=False``) of all."""
        read = lambda t: self.spark.read.parquet(os.path.join(self.base, t)).drop("part")
        rows = read(name)
        return rows.join(read("commits").select("run_id"), "run_id", "left_semi") if finished else rows


def param_grid(space: dict) -> list[dict]:
    """The cartesian product of the value lists, in key order."""
    keys = list(space)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[space[k] for k in keys])]
