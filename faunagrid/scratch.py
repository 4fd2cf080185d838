"""Folders for intermediate results, on storage that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="faunagrid-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where that is unset and driver and executors are one process, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _own_folder()
    return found.rstrip("/")


#: Who wants to know of new paths.
_listeners: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that are made meanwhile."""
    paths: list[str] = []
    _listeners.append(paths)
    try:
        yield paths
    finally:
        _listeners.remove(paths)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path there, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/faunagrid-{name}-{uuid.uuid4().hex}"
    for paths in _listeners:
        paths.append(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
