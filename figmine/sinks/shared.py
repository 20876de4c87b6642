"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where that is unset, a temporary folder serves a local
    master only (as in tests); on a cluster the executors would not see it, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="figmine-"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path in any store that Spark knows; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
