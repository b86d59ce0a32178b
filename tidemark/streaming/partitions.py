"""Partitions mode on a stream: handlers with a running state over micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.delivery import Handler, for_each_partition
from tidemark.schemas import TP
from tidemark.streaming.tracker import start_batches
from tidemark.streaming.versions import previous_version, write_version


def run_partitions(
    messages: DataFrame,
    handler: Handler,
    schema,
    path: str,
    checkpoint: str,
    carry: Mapping[str, Column],
    slices: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``handler`` by topic-partition, in order of offsets.

    A topic-partition arrives as contiguous segments in separate tasks. ``carry`` names sums over
    its messages; each segment starts with their value over all messages before it, those of
    earlier micro-batches included. The output of a micro-batch is written once, to
    ``path``/output, the sums after it to ``path``/sums; a repeated micro-batch starts from the
    sums before it and writes both again.
    """
    one = messages.groupBy(*TP).agg(*(F.sum(e).alias(name) for name, e in carry.items()))
    nothing = messages.sparkSession.createDataFrame([], one.schema)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = previous_version(nothing, f"{path}/sums", batch_id)
            out = for_each_partition(
                batch, handler, schema, carry=carry, split=True, slices=slices, before=before
            )
            write_version(out, f"{path}/output", batch_id)
            now = batch.groupBy(*TP).agg(*(F.sum(e).alias(name) for name, e in carry.items()))
            after = before.unionByName(now).groupBy(*TP).agg(*(F.sum(n).alias(n) for n in carry))
            write_version(after.select(before.columns), f"{path}/sums", batch_id)
        finally:
            batch.unpersist()

    return start_batches(messages, step, checkpoint, trigger)
