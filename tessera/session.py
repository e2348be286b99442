"""Sessions with the settings that the engine relies on, and the folder that a session's executors and driver share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; the master and sizes are left to the cluster unless given."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true").config(
        "spark.sql.adaptive.skewJoin.enabled",
        "true",
    )
    b = b.master(master) if master else b
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors and the driver see: below `spark.checkpoint.dir`, in one folder per application.

    A temporary folder of this machine is taken only where the setting is unset and all tasks run in the driver's process,
    as in tests; on a cluster without the setting this fails. Folders stay until `cleanup`, for the frames that read them
    are lazy.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors and driver need a folder that they share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"tessera-{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, uri: str) -> None:
    """Removes a file or folder through Spark's own file systems."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cleanup(spark: SparkSession) -> None:
    """Deletes every intermediate folder of this application. Frames that were returned before cannot be read any more."""
    base = shared_dir(spark, "x").rsplit("/", 1)[0]
    delete(spark, base)
