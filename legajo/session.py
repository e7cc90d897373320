"""Session, table and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on; sizes (shuffle partitions, split bytes) are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "legajo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; an existing session is returned as it is."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, below ``spark.checkpoint.dir``.

    Only in local mode, where all tasks run on this machine, a temporary folder takes the place of a missing setting; on a
    cluster a missing setting is an error. Results may be read from the folder until the program ends, when it is removed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "legajo-checkpoints")
    folder = f"{base.rstrip('/')}/legajo-{uuid.uuid4().hex}"
    atexit.register(_drop_quietly, spark, folder)
    return folder


def _drop_quietly(spark: SparkSession, folder: str) -> None:
    try:
        drop_folder(spark, folder)
    except Exception:  # the session has ended; the folder stays
        pass


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with files that survive the loss of executors.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder made by :func:`shared_folder`, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
