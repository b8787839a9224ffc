"""Session settings the library is written for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "martwright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # attach() relies on it: a join on (key, half) must not reuse an aggregate's partitioning by key.
        "spark.sql.requireAllClusterKeysForCoPartition": "true",
        "spark.ui.enabled": "false",
        # Call-site capture for error messages doubles the time to build a plan in Python.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; a cluster session must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return os.path.dirname(current)
    folder = tempfile.mkdtemp(prefix="martwright-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once into the shared folder and read it back, with the path for :func:`discard`.

    Later uses read the file instead of computing ``df`` again, also after an executor is lost. What
    isn't discarded goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, target = _file(spark, path)
    system.deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path), path


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    system, target = _file(spark, path)
    if not system.exists(target):
        return []
    return [f.getPath().getName() for f in system.listStatus(target)]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of files, if it is there."""
    system, target = _file(spark, path)
    system.delete(target, True)


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target
