"""State tables that keep one version per micro-batch.

A micro-batch may run again after a failure. Version ``n`` is always computed from
version ``n - 1`` and written over itself, so a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "batch_id"


def version_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{VERSION}={batch_id}"


def write_version(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write version ``batch_id`` and return it as stored."""
    target = version_path(path, batch_id)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def previous_version(initial: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The version a micro-batch starts from: ``initial`` for the first one."""
    if batch_id == 0:
        return initial
    spark = initial.sparkSession
    return spark.read.schema(initial.schema).parquet(version_path(path, batch_id - 1))


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the newest version."""
    return spark.read.parquet(path).agg(F.max(VERSION).cast("bigint")).first()[0]


def all_versions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all versions together, for tables that get new rows with each version."""
    return spark.read.parquet(path).drop(VERSION)


def current_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest version."""
    return spark.read.parquet(version_path(path, last_batch(spark, path)))
