"""Cutting lineage in storage that every executor shares."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for cut lineage: ``spark.checkpoint.dir`` or the one set by ``setCheckpointDir``.

    Where there is neither, a folder of this machine is used if the session runs on this machine alone;
    on a cluster that would give each executor a disk of its own, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("no folder that all executors share: set spark.checkpoint.dir")
    return os.path.join(tempfile.gettempdir(), "atlasmill-checkpoints")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder; what is written there goes when the program ends."""
    path = f"{shared_dir(spark)}/atlasmill/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_all)
    _written[path] = spark
    return path


def write_shared(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once into the shared folder; gives a scan of the files and their path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(path: str) -> None:
    """Delete what ``write_shared`` wrote; only for scans that nothing reads any more."""
    spark = _written.pop(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _remove_all() -> None:
    """At the end of the program: results that are still lazy read these files until then."""
    for path in list(_written):
        with contextlib.suppress(Exception):  # the JVM may be gone already
            remove(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and return a scan of the files.

    The result survives lost executors, has no lineage and carries exact size statistics, so the
    planner can decide about a broadcast from a measured size. The files go when the program ends.
    """
    return write_shared(df, name)[0]
