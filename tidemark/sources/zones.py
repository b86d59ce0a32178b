"""Topic logs with a zone map: which offsets of which topic-partition each file holds.

An appended part is dealt out to files by range of (topic, partition, offset), so a file holds a
short stretch, and a topic-partition with most of the messages has many files. The stretches are
written as a small table beside the files. A read from start positions joins them with that table
and opens only the files that reach beyond a start; catalog and retained ranges need no file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.start import read_from
from tidemark.plans.bounded import settle
from tidemark.plans.scratch import numbered
from tidemark.schemas import TP

ZONES = "append int, file string, topic string, partition int, first_offset bigint, last_offset bigint, messages bigint"
ROWS_PER_FILE = 1_000_000


def append_zoned(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append messages to the log at ``path``. The part becomes visible with its zones, which
    are written last."""
    spark, root = df.sparkSession, path.rstrip("/")
    number = max(numbered(spark, f"{root}/zones", "append"), default=-1) + 1
    files = max(-(-df.count() // rows_per_file), 1)
    target = f"{root}/data/append={number}"
    dealt = df.repartitionByRange(files, *TP, "offset").sortWithinPartitions(*TP, "offset")
    dealt.write.mode("overwrite").parquet(target)
    # File names only: the folder is known, and a name needs no decoding.
    stored = spark.read.schema(df.schema).parquet(target)
    zones = stored.groupBy(F.col("_metadata.file_name").alias("file"), *TP).agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("messages"),
    )
    zones.coalesce(1).write.mode("overwrite").parquet(f"{root}/zones/append={number}")


def zones_of(spark: SparkSession, path: str) -> DataFrame:
    """The zone map: a row per file and topic-partition in it."""
    return spark.read.schema(ZONES).parquet(f"{path.rstrip('/')}/zones")


def zone_catalog(zones: DataFrame) -> DataFrame:
    """Every topic-partition of the log."""
    return zones.select(*TP).distinct()


def zone_bounds(zones: DataFrame) -> DataFrame:
    """Retained range per topic-partition: first offset and next offset to be written."""
    return zones.groupBy(*TP).agg(
        F.min("first_offset").alias("oldest"), (F.max("last_offset") + 1).alias("newest")
    )


def zoned_files(zones: DataFrame, starts: DataFrame) -> DataFrame:
    """(append, file) of the files that hold messages at or after a start."""
    side = settle(starts.select(*TP, "resolved_offset")).df
    reach = F.col("last_offset") >= F.col("resolved_offset")
    return zones.join(side, TP).where(reach).select("append", "file").distinct()


def read_zoned(spark: SparkSession, path: str, starts: DataFrame, schema) -> DataFrame:
    """Messages of the started topic-partitions from their start on.

    The chosen files become the relation's file list, as long as the list Spark itself keeps of
    any table's files.
    """
    root = path.rstrip("/")
    chosen = zoned_files(zones_of(spark, path), starts).toArrow()
    names = [
        f"{root}/data/append={a}/{f}"
        for a, f in zip(chosen["append"].to_pylist(), chosen["file"].to_pylist())
    ]
    if not names:
        return spark.createDataFrame([], schema)
    return read_from(spark.read.schema(schema).parquet(*sorted(names)), starts)
