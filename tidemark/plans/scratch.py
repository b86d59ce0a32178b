"""Shared scratch space: the checkpoint folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A cluster sets ``spark.checkpoint.dir`` to a folder all executors share. Only
    where it is unset and the master is local does a temporary folder stand in.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CONF, None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {_CONF} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tidemark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, in whatever store Spark reads it from?"""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers ``n`` of the finished tables ``path``/``name``=n, ascending."""
    jvm = spark._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}=*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)
