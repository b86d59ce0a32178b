"""Topic logs, groups and commands derived from the given tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.progress import MARK, RESET
from tidemark.operators.start import log_bounds
from tidemark.plans.bounded import settle
from tidemark.plans.scratch import scratch_path
from tidemark.schemas import TP
from tidemark.sources.topic_log import as_topic_log, write_topic_log

# The derivation rules, shared with the SQL of the checks.
LOG_PARTITIONS = 4
LOST_OFFSETS = 20
FIRST_DAY = "2024-01-01"
MEMBER_COUNT = 100
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a topic log: topic = event type, four partitions by user."""
    return as_topic_log(
        table(spark, sf_dir, "events"),
        topic=F.col("event_type"),
        partition=F.pmod("user_id", F.lit(LOG_PARTITIONS)),
        order=["event_id"],
        keep=[
            F.col("user_id").alias("key_id"),
            F.col("props").alias("payload"),
            F.col("value").alias("amount"),
            "ts",
        ],
    )


@dataclass
class _Stored:
    """Logs already written in a session, by session and table folder."""

    paths: dict = field(default_factory=dict)


_STORED = _Stored()


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stored table, written once per session.

    A topic log is a table that is read many times, so offsets are numbered once and
    later reads get column pruning and offset filters at the scan.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED.paths:
        path, log = scratch_path(spark, "event-log"), event_log(spark, sf_dir)
        write_topic_log(log, path, numbered=True)
        _STORED.paths[key] = (path, log.schema)
    path, schema = _STORED.paths[key]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stored_log_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of :func:`stored_log`."""
    stored_log(spark, sf_dir)
    return _STORED.paths[(spark.sparkContext.applicationId, sf_dir)][0]


def event_count(spark: SparkSession, sf_dir: str) -> int:
    """One more than the largest event number."""
    return (table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0) + 1


def growing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log in which partitions appear after a third of the events and topics after
    two thirds."""
    events, n = table(spark, sf_dir, "events"), event_count(spark, sf_dir)
    third = F.col("event_id") * 3
    late_topic = (third >= 2 * n) & (F.col("user_id") % 5 == 0)
    late_partition = (third >= n) & (F.col("user_id") % 7 == 0)
    log = as_topic_log(
        events,
        topic=F.when(late_topic, F.concat(F.lit("late-"), "event_type")).otherwise(F.col("event_type")),
        partition=F.pmod("user_id", F.lit(LOG_PARTITIONS)) + F.when(late_partition, LOG_PARTITIONS).otherwise(0),
        order=["event_id"],
    )
    return log.select(*TP, "offset", "event_id")


def attempts(log: DataFrame, n: int) -> DataFrame:
    """Commit attempts of three members in ten batches each, with equal batch numbers. One member
    is still in an older generation, and one belongs to none."""
    member = (F.col("key_id") % 3).cast("int")
    batch = F.floor(F.col("event_id") * 10 / n).cast("bigint")
    return (
        log.groupBy(
            F.concat(F.lit("m"), member.cast("string")).alias("member_id"),
            F.when(member == 1, 2).otherwise(3).cast("int").alias("generation"),
            batch.alias("batch_id"),
            *TP,
        )
        .agg((F.max("offset") + 1).alias("offset"), F.max("ts").alias("committed_at"))
        .withColumn("metadata", F.concat("member_id", F.lit("/"), F.col("batch_id").cast("string")))
        .withColumn("retention_ms", F.lit(-1).cast("bigint"))
    )


def bounds(log: DataFrame) -> DataFrame:
    """Retained range: partition 0 has lost its first offsets."""
    lost = F.when(F.col("partition") == 0, F.lit(LOST_OFFSETS)).otherwise(0).cast("bigint")
    return log_bounds(log).withColumn("oldest", lost)


def committed(bounds: DataFrame) -> DataFrame:
    """Commits: out of range in partition 0, half way, at the end, none in partition 3."""
    offset = (
        F.when(F.col("partition") == 0, F.lit(LOST_OFFSETS // 2))
        .when(F.col("partition") == 1, F.floor(F.col("newest") / 2))
        .otherwise(F.col("newest"))
        .cast("bigint")
    )
    return bounds.where(F.col("partition") < LOG_PARTITIONS - 1).select(
        *TP, offset.alias("offset"), F.concat(F.lit("ck-"), "topic").alias("metadata")
    )


def commands(log: DataFrame) -> DataFrame:
    """One command per message: marks, late marks and resets."""
    is_reset = F.col("offset") % 7 == 3
    late = F.col("offset") % 5 == 0
    return log.select(
        F.col("event_id").alias("seq"),
        *TP,
        F.when(is_reset, RESET).otherwise(MARK).alias("op"),
        F.when(is_reset, F.col("offset") - 2)
        .when(late, F.col("offset") - 3)
        .otherwise(F.col("offset"))
        .alias("offset"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("metadata"),
    )


def commits(log: DataFrame) -> DataFrame:
    """One commit record per message, of three groups."""
    return log.select(
        F.concat(F.lit("g"), (F.col("key_id") % 3).cast("string")).alias("group_id"),
        F.concat(F.lit("m"), (F.col("key_id") % 7).cast("string")).alias("member_id"),
        (F.col("key_id") % 5).cast("int").alias("generation"),
        *TP,
        (F.col("offset") + 1).alias("offset"),
        "payload",
        F.col("payload").alias("metadata"),
        F.lit(-1).cast("bigint").alias("retention_ms"),
        F.col("ts").alias("committed_at"),
        F.col("event_id").alias("batch_id"),
    ).drop("payload")


def deliveries(log: DataFrame) -> DataFrame:
    """Every message once, and some again to the next consumer."""
    consumer = F.concat(F.lit("c"), (F.col("key_id") % 3).cast("string"))
    again = F.concat(F.lit("c"), ((F.col("key_id") + 1) % 3).cast("string"))
    who = F.when(F.col("offset") % 7 == 3, F.array(consumer, again)).otherwise(F.array(consumer))
    return log.select(*TP, "offset", F.explode(who).alias("consumer_id"))


def wide_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic-partitions of a log with one partition per user."""
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_type").alias("topic"), F.col("user_id").cast("int").alias("partition"))
        .distinct()
    )


def _day_and_member(events: DataFrame) -> DataFrame:
    return events.select(
        F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY)).cast("int").alias("generation"),
        F.concat(F.lit("m"), (F.col("user_id") % MEMBER_COUNT).cast("string")).alias("member_id"),
        F.col("event_type").alias("topic"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generation per day; its members read the topics their users sent to that day."""
    return _day_and_member(table(spark, sf_dir, "events")).distinct()


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed attempts, from the number of error events of a member's day."""
    errors = F.count(F.when(F.col("topic") == "error", 1))
    stage = (
        F.when(F.col("n") % 9 == 1, "refresh")
        .when(F.col("n") % 9 == 3, "release")
        .when(F.col("n") % 9 == 5, "rebalance")
        .when(F.col("n") % 9 == 7, "subscribe")
    )
    return (
        _day_and_member(table(spark, sf_dir, "events"))
        .groupBy("generation", "member_id")
        .agg(errors.alias("n"))
        .select("generation", "member_id", stage.alias("stage"))
        .where(F.col("stage").isNotNull())
    )


def order_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier owns a share of each order priority."""
    names = F.array(*(F.lit(p) for p in PRIORITIES))
    return table(spark, sf_dir, "supplier").select(
        F.explode(names).alias("o_orderpriority"), "s_suppkey"
    )


def small(df: DataFrame) -> DataFrame:
    """A derived per-partition table, evaluated once where it is within the size limit."""
    return settle(df).df


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once and read back, for a table that is read several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
