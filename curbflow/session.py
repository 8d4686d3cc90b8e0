"""Shared-folder handling for work that has to outlive a lost executor."""

from __future__ import annotations

import uuid
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, the checkpoint folder that the context was
    given serves. Having neither is an error: a folder of this machine's own
    would be invisible to the others, so the choice is the caller's.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CONF, None) or context.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {_CONF} to a folder that every executor can reach")
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; a folder already set is kept."""
    if not spark.sparkContext.getCheckpointDir():
        folder = shared_dir(spark)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def session_now(spark: SparkSession) -> datetime:
    """The current time in the session's time zone, without the zone: how stored times are read."""
    return datetime.now(ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))).replace(tzinfo=None)


def session_time(spark: SparkSession, text: str) -> datetime:
    """An ISO time in the session's time zone; one with an offset is converted."""
    moment = datetime.fromisoformat(text)
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))).replace(tzinfo=None)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system its address names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where it is absent."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def rename_path(spark: SparkSession, path: str, new_path: str) -> None:
    """Rename a folder; ``OSError`` if the file system refuses."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new = make(path), make(new_path)
    if not old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"can't rename {path} to {new_path}")
