"""Spark session helpers.

The library never creates a cluster session on its own: library functions take
the caller's ``SparkSession``.  ``local_session`` exists for tests, the bench
and examples only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query of this package relies on.  The reference works on naive
# UTC datetimes, so hour-of-day, weekday and minute buckets are UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
}


def ensure_session_rules(spark: SparkSession) -> SparkSession:
    """Apply the session rules the queries need (UTC wall clock)."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as-is; it must be set there.  Only in local mode, where driver and
    executors are one process, an unset folder becomes a scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sessionary-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sessionary") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SESSIONARY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_rules(spark)
    return spark


def tables_dir(spark: SparkSession) -> str:
    """Where this application's ``materialize`` tables lie."""
    return os.path.join(checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's ``materialize`` tables, when no result needs them any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, mode: str = "table"):
    """Compute ``df`` once for operators that read it several times.

    ``table`` (default) writes it as Parquet under the shared
    ``spark.checkpoint.dir`` and reads it back: one pass, survives executor
    loss, cuts the lineage, and later reads prune columns and push filters.
    ``checkpoint`` uses ``Dataset.checkpoint`` (same folder); ``persist`` keeps
    it in executor memory/disk (lost blocks are recomputed from lineage).
    """
    import uuid
    spark = df.sparkSession
    if mode == "table":
        path = os.path.join(tables_dir(spark), uuid.uuid4().hex)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if mode == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    if mode == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError(f"unknown materialize mode {mode!r}")
