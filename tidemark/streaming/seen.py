"""Redelivery removal with a state as small as the gaps.

What has been delivered of a topic-partition is kept as disjoint intervals of offsets: one, from
its first message on, plus one for every gap. Each micro-batch is laid over these intervals along
the offsets, sliced (``plans/ordering.py``) so that a topic-partition with most of the messages is
spread over many tasks. An offset is new if no interval or message before it reaches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.bounded import by_shuffle, settle
from tidemark.plans.ordering import running, with_reach
from tidemark.schemas import TP
from tidemark.streaming.tracker import start_batches
from tidemark.streaming.versions import previous_version, write_version

#: Delivered offsets ``low`` to ``high`` - 1.
INTERVALS = "topic string, partition int, low bigint, high bigint"


def unseen(messages: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages that no interval of ``seen`` covers, each offset once, and the intervals
    after them.

    Rows whose topic, partition or offset is null have no identity and are an error.
    """
    offsets = messages.select(*TP, "offset").distinct()
    if offsets.where(" OR ".join(f"{c} IS NULL" for c in (*TP, "offset"))).take(1):
        raise ValueError("null topic, partition or offset")
    rows = seen.select(*TP, "low", "high", F.lit(0).alias("kind")).unionByName(
        offsets.select(*TP, F.col("offset").alias("low"), (F.col("offset") + 1).alias("high"), F.lit(1).alias("kind"))
    )
    # Stored however few they are: batch after batch, they would take the driver's memory in every plan.
    reached = settle(with_reach(rows, TP, ["low", "kind"], "high", "reach"), max_rows=0).rows
    beyond = F.col("reach").isNull() | (F.col("low") >= F.col("reach"))
    new = reached.where((F.col("kind") == 1) & beyond).select(*TP, F.col("low").alias("offset"))
    fresh = messages.join(by_shuffle(new), [*TP, "offset"], "left_semi").dropDuplicates([*TP, "offset"])
    # An interval starts where nothing before it reaches or touches it.
    begins = (F.col("reach").isNull() | (F.col("low") > F.col("reach"))).cast("int")
    islands = running(reached, TP, ["low", "kind"], {"island": begins})
    after = islands.groupBy(*TP, "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return fresh, after.drop("island")


def dedup_by_intervals(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write each (topic, partition, offset) of a stream once: new messages of a micro-batch to
    ``path``/messages, the intervals after it to ``path``/seen. A repeated micro-batch writes
    the same versions again."""
    nothing = stream.sparkSession.createDataFrame([], INTERVALS)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = previous_version(nothing, f"{path}/seen", batch_id)
            fresh, after = unseen(batch, before)
            write_version(fresh, f"{path}/messages", batch_id)
            write_version(after, f"{path}/seen", batch_id)
        finally:
            batch.unpersist()

    return start_batches(stream, step, checkpoint, trigger)
