"""Streams of new topics, and of deliveries without repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.topics import may_be_extra
from tidemark.plans.bounded import settle
from tidemark.schemas import TP


def watch_topics(
    catalog_stream: DataFrame,
    core: Sequence[str],
    known: DataFrame,
    whitelist: str | None,
    blacklist: str | None = None,
) -> DataFrame:
    """Topics of a catalog stream that qualify by pattern and are not read yet, each once."""
    found = catalog_stream.select("topic").where(
        may_be_extra(F.col("topic"), whitelist, blacklist)
    )
    if core:
        found = found.where(~F.col("topic").isin(list(core)))
    unread = found.join(settle(known.select("topic").distinct()).df, "topic", "left_anti")
    return unread.dropDuplicates(["topic"])


def dedup_deliveries(
    stream: DataFrame, ttl: str | None = None, event_time: str = "timestamp"
) -> DataFrame:
    """Each (topic, partition, offset) once.

    Without ``ttl`` every key is remembered; with it, repeats are recognised within that
    time, and the state stays bounded.
    """
    key = [*TP, "offset"]
    if ttl is None:
        return stream.dropDuplicates(key)
    return stream.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark(key)
