"""A group's read from end to end, by its options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.delivery import Handler, for_each_partition
from tidemark.operators.start import fetch_committed, log_bounds, read_from, resolve_start
from tidemark.operators.topics import select_topics, topics_of
from tidemark.options import PARTITIONS, GroupOptions
from tidemark.plans.bounded import settle
from tidemark.schemas import TOPIC_LOG
from tidemark.sources.topic_log import topic_list


def read_group(
    spark: SparkSession,
    source: str,
    core: Sequence[str],
    commits: DataFrame,
    options: GroupOptions,
    handler: Handler | None = None,
    out_schema=None,
    schema=TOPIC_LOG,
) -> DataFrame:
    """Messages a group has not processed yet, from a stored log.

    In multiplex mode all topic-partitions come out as one table. In partitions mode each
    is handed to ``handler`` with its start position, and its output comes out.
    """
    partitioned = options.mode == PARTITIONS
    if partitioned != (handler is not None):
        raise ValueError("partitions mode needs a handler, multiplex mode takes none")
    log = spark.read.schema(schema).parquet(source).select(*schema.names)
    selected = select_topics(topics_of(log), core, options.whitelist, options.blacklist)
    log = log.where(F.col("topic").isin(topic_list(selected)))
    bounds = settle(log_bounds(log)).rows
    committed = fetch_committed(commits, bounds, options.group_id)
    starts = settle(resolve_start(committed, bounds, options.initial)).rows
    messages = read_from(log, starts)
    if not partitioned:
        return messages
    return for_each_partition(messages, handler, out_schema, starts=starts)
