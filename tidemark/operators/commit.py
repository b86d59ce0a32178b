"""Commit of progress, and the rows operators reject."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.progress import dirty
from tidemark.plans.bounded import settle
from tidemark.schemas import COMMIT_LOG, TP

#: Writer of batches whose caller names none.
DEFAULT_WRITER = "default"


def commit_rows(
    state: DataFrame,
    group_id: str,
    member_id: str,
    generation: int,
    retention_ms: int = -1,
    batch_id: int = 0,
    committed_at: Column | None = None,
) -> DataFrame:
    """Commit records of the dirty topic-partitions."""
    return dirty(state).select(
        F.lit(group_id).alias("group_id"),
        F.lit(member_id).alias("member_id"),
        F.lit(generation).cast("int").alias("generation"),
        *TP,
        "offset",
        "metadata",
        F.lit(retention_ms or -1).cast("bigint").alias("retention_ms"),
        (F.current_timestamp() if committed_at is None else committed_at).alias("committed_at"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def write_commits(rows: DataFrame, path: str, writer: str | None = None) -> None:
    """Store commit records under their (group_id, member_id, writer, batch_id).

    Only the same writer's same batch is replaced, so a repeated attempt leaves one copy and
    members, or two runs of one member, never erase each other. Without rows nothing is stored.
    """
    (
        rows.withColumn("writer", F.lit(writer or DEFAULT_WRITER))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("group_id", "member_id", "writer", "batch_id")
        .parquet(path)
    )


def read_commits(spark, path: str) -> DataFrame:
    """Stored commit records; a group filter prunes the folders of other groups."""
    return spark.read.schema(COMMIT_LOG).parquet(path)


def commit_offsets(
    state: DataFrame,
    path: str,
    group_id: str,
    member_id: str,
    generation: int,
    retention_ms: int = -1,
    batch_id: int | None = None,
    writer: str | None = None,
) -> DataFrame:
    """Write the dirty topic-partitions and return what was written as commit results.

    Without ``batch_id`` every call is a batch of its own, of a writer of its own.
    """
    if batch_id is None:
        batch_id, writer = 0, writer or uuid.uuid4().hex
    rows = commit_rows(state, group_id, member_id, generation, retention_ms, batch_id)
    write_commits(rows, path, writer)
    return commit_results(rows)


def commit_results(rows: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Result per committed topic-partition; ``rejected`` rows carry their error."""
    done = rows.select(*TP, "offset", F.lit(None).cast("string").alias("error"))
    if rejected is None:
        return done
    failed = rejected.select(*TP, "offset", F.col("message").alias("error"))
    return done.join(failed.select(*TP), TP, "left_anti").unionByName(failed)


def stale_commits(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Commit records of an older generation than their group has already committed."""
    latest = commits.groupBy("group_id").agg(F.max("generation").alias("latest"))
    return rows.join(settle(latest).df, "group_id").where(F.col("generation") < F.col("latest")).drop("latest")


def error_rows(rejected: DataFrame, ctx: str, message) -> DataFrame:
    """Rejected rows as error records tagged with the operation that refused them."""
    text = F.lit(message) if isinstance(message, str) else message
    has = rejected.columns

    def pick(name: str, dtype: str) -> Column:
        return (F.col(name) if name in has else F.lit(None)).cast(dtype).alias(name)

    return rejected.select(
        F.lit(ctx).alias("ctx"),
        pick("topic", "string"),
        pick("partition", "int"),
        pick("offset", "bigint"),
        text.cast("string").alias("message"),
    )


def errors_of(*streams: DataFrame) -> DataFrame:
    """All error records as one table."""
    out = streams[0]
    for other in streams[1:]:
        out = out.unionByName(other)
    return out
