"""Session settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> None:
    """Settings the results depend on, for sessions made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def build_session(app: str = "icetally", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library relies on; a cluster supplies its own master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # capturing the call site of every expression doubles the time plans take to build
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see, from ``spark.checkpoint.dir``.

    Where it is unset a local session takes a temporary folder; on a cluster that would be the driver's own disk, so it
    is an error there.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors see")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        found = context.getCheckpointDir()
    return found


def shared_path(spark: SparkSession, stem: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{stem}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
