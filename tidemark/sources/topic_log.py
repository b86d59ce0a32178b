"""Topic logs stored as Parquet: derive, write, read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import seed_value
from tidemark.operators.start import read_from
from tidemark.plans.ordering import with_position
from tidemark.schemas import TOPIC_LOG, TP

MAX_TOPIC_LIST = 100_000


def as_topic_log(
    df: DataFrame,
    topic: Column,
    partition: Column,
    order: Sequence[str],
    keep: Sequence[str | Column] = (),
    slices: int | None = None,
) -> DataFrame:
    """Number the rows of any table along ``order`` as offsets of their topic-partition."""
    rows = df.select(
        topic.alias("topic"), partition.cast("int").alias("partition"), *order, *keep
    )
    placed = with_position(rows, TP, order, "offset", slices=slices)
    rest = [c for c in placed.columns if c not in (*TP, "offset")]
    return placed.select(*TP, "offset", *rest)


def write_topic_log(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    by_topic: bool = True,
    numbered: bool = False,
) -> None:
    """Store a log, one folder per topic, sorted so that offset filters skip row groups.

    ``numbered`` says that ``df`` comes straight from :func:`as_topic_log`: its tasks
    already hold their rows in offset order, so they are not sorted again. With very many
    topics pass ``by_topic=False`` to avoid one folder for each.
    """
    rows = df if numbered else df.sortWithinPartitions(*TP, "offset")
    writer = rows.write.mode(mode)
    (writer.partitionBy("topic") if by_topic else writer).parquet(path)


def topic_list(topics: DataFrame | Sequence[str]) -> list[str]:
    """Topic names as a list. A selection longer than ``MAX_TOPIC_LIST`` is an error."""
    if not isinstance(topics, DataFrame):
        return sorted(set(topics))
    rows = topics.select("topic").distinct().limit(MAX_TOPIC_LIST + 1).collect()
    if len(rows) > MAX_TOPIC_LIST:
        raise ValueError(f"more than {MAX_TOPIC_LIST} topics selected")
    return sorted(r.topic for r in rows)


def read_topics(
    spark: SparkSession,
    source: str,
    topics: DataFrame | Sequence[str],
    starts: DataFrame | None = None,
    stream: bool = False,
    schema=TOPIC_LOG,
    max_files: int | None = None,
) -> DataFrame:
    """All messages of the topics as one table or stream, from their start positions.

    The topics become a literal list, so only their folders are read.
    """
    if stream:
        reader = spark.readStream.schema(schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = spark.read.schema(schema)
    log = reader.parquet(source).select(*schema.names)
    log = log.where(F.col("topic").isin(topic_list(topics)))
    return log if starts is None else read_from(log, starts)


def merge_streams(*logs: DataFrame) -> DataFrame:
    """Several logs (or streams) as one."""
    out = logs[0]
    for other in logs[1:]:
        out = out.unionByName(other)
    return out


def seed(spark: SparkSession, n: int, topics: Sequence[str], partitions: int = 4) -> DataFrame:
    """Numbered test messages, the same ones for every topic, spread by key."""
    text = seed_value("id")
    rows = spark.range(n).select(
        "id",
        F.explode(F.array(*(F.lit(t) for t in topics))).alias("topic"),
        text.cast("binary").alias("key"),
        text.cast("binary").alias("value"),
    )
    spread = F.pmod(F.xxhash64("key"), F.lit(partitions))
    log = as_topic_log(rows, F.col("topic"), spread, ["id"], ["key", "value"])
    return log.select(*TP, "offset", "key", "value", F.current_timestamp().alias("timestamp"))
