"""Where reading of each topic-partition starts, and the read from there."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import next_offset
from tidemark.options import INITIAL, OptionError
from tidemark.plans.bounded import settle
from tidemark.schemas import NO_OFFSET, TP

_PUSHED_TOPICS = 500


def log_bounds(topic_log: DataFrame) -> DataFrame:
    """Retained range per topic-partition: first offset and next offset to be written."""
    return topic_log.groupBy(*TP).agg(
        F.min("offset").alias("oldest"), (F.max("offset") + 1).alias("newest")
    )


def high_water_marks(topic_log: DataFrame) -> DataFrame:
    """Next offset to be written, per topic-partition."""
    return topic_log.groupBy(*TP).agg((F.max("offset") + 1).alias("high_water_mark"))


def latest_commits(commits: DataFrame, group_id: str | None = None) -> DataFrame:
    """The newest commit of each topic-partition of each group (or of one group)."""
    if group_id is not None:
        commits = commits.where(F.col("group_id") == group_id)
    return newest_commits(commits).select("group_id", *TP, "offset", "metadata")


def newest_commits(commits: DataFrame) -> DataFrame:
    """The newest commit record per group and topic-partition; ties go to the later batch, then
    generation, then offset.

    The newest time is a number, so it is found by a hash aggregation with one row per group and
    topic-partition. Only the records at that time, usually one each, are then compared in full.
    """
    key = ["group_id", *TP]
    times = settle(commits.groupBy(*key).agg(F.max("committed_at").alias("__newest"))).df
    alike = commits.join(times, key).where(F.col("committed_at").eqNullSafe(F.col("__newest")))
    rest = [c for c in commits.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct("batch_id", "generation", "offset"))
    return alike.groupBy(*key).agg(last.alias("c")).select(*key, "c.*").select(commits.columns)


def fetch_committed(
    commits: DataFrame,
    subs: DataFrame,
    group_id: str,
    retained_after=None,
) -> DataFrame:
    """Committed offset and metadata of every subscribed topic-partition.

    Without a commit the offset is -1 and the metadata empty. So it is where the newest
    commit's own retention ended before ``retained_after``; older commits do not come back.
    """
    newest = newest_commits(commits.where(F.col("group_id") == group_id))
    if retained_after is not None:
        ends = F.timestamp_millis(F.unix_millis("committed_at") + F.col("retention_ms"))
        newest = newest.where((F.col("retention_ms") < 0) | (ends >= F.lit(retained_after)))
    return with_defaults(newest.select(*TP, "offset", "metadata"), subs)


def with_defaults(committed: DataFrame, subs: DataFrame) -> DataFrame:
    """Every subscribed topic-partition with its commit, or offset -1 and empty metadata."""
    return (
        subs.select(*TP)
        .distinct()
        .join(committed, TP, "left")
        .select(
            *TP,
            F.coalesce("offset", F.lit(NO_OFFSET).cast("bigint")).alias("offset"),
            F.coalesce("metadata", F.lit("")).alias("metadata"),
        )
    )


def resolve_start(committed: DataFrame, bounds: DataFrame, default: str = "newest") -> DataFrame:
    """Start position of each topic-partition in ``committed``.

    A commit inside the retained range wins. Without one, or with one outside the range,
    reading starts at ``default``; in the second case the state offset becomes -1 while
    the metadata is kept. ``initial_offset`` may be symbolic, ``resolved_offset`` never is.
    """
    if default not in INITIAL:
        raise OptionError("default must be oldest or newest")
    symbolic = F.lit(INITIAL[default]).cast("bigint")
    edge = F.coalesce(default, F.lit(0))
    rows = committed.join(bounds.select(*TP, "oldest", "newest"), TP, "left")
    inside = F.col("offset").between(
        F.coalesce("oldest", F.lit(0)), F.coalesce("newest", F.lit(0))
    )
    how = (
        F.when(F.col("offset") <= -1, "default").when(inside, "committed").otherwise("out_of_range")
    )
    lost = F.col("how") == "out_of_range"
    state_offset = F.when(lost, F.lit(NO_OFFSET)).otherwise(F.col("offset")).cast("bigint")
    return (
        rows.withColumn("how", how)
        .withColumn("state_offset", state_offset)
        .select(
            *TP,
            "state_offset",
            "metadata",
            next_offset("state_offset", symbolic).alias("initial_offset"),
            next_offset("state_offset", edge).cast("bigint").alias("resolved_offset"),
            "how",
        )
    )


def read_from(topic_log: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages of the started topic-partitions from their resolved offset onward.

    The start table is settled first. While it is small, its topics and its lowest offset
    also become literal predicates, which reach the scan as partition and row-group filters.
    """
    side = settle(starts.select(*TP, "resolved_offset"))
    log = topic_log
    if side.is_small:
        topics = pc.unique(side.table["topic"]).to_pylist()
        if side.table.num_rows:
            log = log.where(F.col("offset") >= pc.min(side.table["resolved_offset"]).as_py())
        if len(topics) <= _PUSHED_TOPICS:
            log = log.where(F.col("topic").isin(topics))
    return (
        log.join(side.df, TP)
        .where(F.col("offset") >= F.col("resolved_offset"))
        .select(*topic_log.columns)
    )


def resume_scan(
    topic_log: DataFrame,
    committed: DataFrame,
    bounds: DataFrame | None = None,
    default: str = "oldest",
) -> DataFrame:
    """Messages a group still has to process: resolve the starts, then read from them."""
    ranges = log_bounds(topic_log) if bounds is None else bounds
    starts = resolve_start(with_defaults(committed, ranges), ranges, default)
    return read_from(topic_log, starts)
