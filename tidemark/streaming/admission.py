"""Reads that admit topics and partitions while they run.

A running read selects by pattern, not by a list of names fixed at its start, so a topic that
appears later qualifies like one that was there. Start positions are resolved once, when a read
begins for the first time, and stored; each micro-batch adds the topic-partitions it meets for
the first time, which are read from their oldest message on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.start import fetch_committed, resolve_start
from tidemark.operators.topics import may_be_extra
from tidemark.options import GroupOptions
from tidemark.plans.bounded import settle
from tidemark.plans.scratch import exists
from tidemark.schemas import NO_OFFSET, STARTS, TOPIC_LOG, TP
from tidemark.streaming.tracker import start_batches
from tidemark.streaming.versions import previous_version, write_version

ADMITTED = "admitted"


def subscribed(topic: Column, core: Sequence[str], options: GroupOptions) -> Column:
    """Does a group read this topic? Core topics always, others by pattern."""
    extra = may_be_extra(topic, options.whitelist, options.blacklist)
    return topic.isin(list(core)) | extra if core else extra


def stored_starts(
    spark: SparkSession,
    path: str,
    bounds: DataFrame,
    commits: DataFrame,
    group_id: str,
    default: str = "newest",
) -> DataFrame:
    """The start positions of a read: resolved and written on its first start, read back on
    every later one. Commits and bounds of the time of a restart play no part, so messages that
    arrived in between are not skipped."""
    target = f"{path.rstrip('/')}/first"
    if not exists(spark, f"{target}/_SUCCESS"):
        starts = resolve_start(fetch_committed(commits, bounds, group_id), bounds, default)
        starts.write.mode("overwrite").parquet(target)
    return spark.read.schema(STARTS).parquet(target)


def discovered(
    spark: SparkSession,
    source: str,
    core: Sequence[str],
    options: GroupOptions,
    schema=TOPIC_LOG,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of a stored log's folder: every subscribed topic that is or will be there."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.parquet(source).select(*schema.names)
    return log.where(subscribed(F.col("topic"), core, options))


def from_starts(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages from their start position on; all of a topic-partition without one."""
    side = settle(starts.select(*TP, "resolved_offset")).df
    begun = F.col("resolved_offset").isNull() | (F.col("offset") >= F.col("resolved_offset"))
    return messages.join(side, TP, "left").where(begun).select(*messages.columns)


def admitted(starts: DataFrame, batch: DataFrame) -> DataFrame:
    """Start rows of the topic-partitions of a micro-batch that ``starts`` does not have."""
    seen = batch.groupBy(*TP).agg(F.min("offset").alias("oldest"))
    return seen.join(settle(starts.select(*TP)).df, TP, "left_anti").select(
        *TP,
        F.lit(NO_OFFSET).cast("bigint").alias("state_offset"),
        F.lit("").alias("metadata"),
        F.lit(-2).cast("bigint").alias("initial_offset"),
        F.col("oldest").alias("resolved_offset"),
        F.lit(ADMITTED).alias("how"),
    )


def resume_stream(
    spark: SparkSession,
    source: str,
    core: Sequence[str],
    options: GroupOptions,
    bounds: DataFrame,
    commits: DataFrame,
    path: str,
    schema=TOPIC_LOG,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of a group's topics from its committed positions, restartable.

    The positions are stored below ``path`` on the first start; after that the query's
    checkpoint knows which files have been read, and the stored positions still hold back what
    lay before them. Topic-partitions unknown then are read whole.
    """
    starts = stored_starts(spark, path, bounds, commits, options.group_id, options.initial)
    return from_starts(discovered(spark, source, core, options, schema, max_files), starts)


def run_admitting(
    messages: DataFrame,
    path: str,
    starts: DataFrame,
    step: Callable[[DataFrame, DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``step(batch, starts, batch_id)`` per micro-batch, with starts that grow.

    Version ``n`` of the starts, below ``path``/starts, is version ``n - 1`` and what batch ``n``
    admitted; a repeated batch writes the same version again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = previous_version(starts, f"{path}/starts", batch_id)
            grown = before.unionByName(admitted(before, batch))
            step(batch, write_version(grown, f"{path}/starts", batch_id), batch_id)
        finally:
            batch.unpersist()

    return start_batches(messages, run, checkpoint, trigger)
