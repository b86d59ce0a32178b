"""Handing messages to user code, and checking what was delivered."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import message_line
from tidemark.plans.bounded import settle
from tidemark.plans.ordering import ROWS_PER_SLICE, SLICE, Slices, shuffle_width, split_points
from tidemark.schemas import TP


@dataclass(frozen=True)
class PartitionInfo:
    """What a handler knows about the messages it is given.

    ``segment`` numbers the contiguous pieces a topic-partition was split into (0 if it
    was not split), ``entry`` holds the carried sums of everything before this piece.
    """

    topic: str
    partition: int
    initial_offset: int | None = None
    segment: int = 0
    entry: dict = field(default_factory=dict)


Handler = Callable[[PartitionInfo, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def for_each_partition(
    df: DataFrame,
    handler: Handler,
    schema,
    starts: DataFrame | None = None,
    carry: Mapping[str, Column] | None = None,
    split: bool = False,
    slices: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Hand each topic-partition to ``handler`` as its own stream, ordered by offset.

    Messages arrive in Arrow batches, so a stream is never held in memory as a whole.
    Without ``split`` a topic-partition is one stream in one task, as a handler with state
    of its own needs. With ``split`` it arrives as contiguous segments that run in separate
    tasks, so one large topic-partition does not bind the job to one executor; ``carry``
    names sums over the messages, and each segment starts with their values so far. ``before``
    has values per topic-partition that these sums go on from.
    """
    carry = dict(carry or {})
    if carry and not split:
        raise ValueError("carry needs split=True")
    rows = df
    if starts is not None:
        rows = rows.join(settle(starts.select(*TP, "initial_offset")).df, TP, "left")
    else:
        rows = rows.withColumn("initial_offset", F.lit(None).cast("bigint"))
    if split:
        width = slices or shuffle_width(df)
        points = split_points(rows, ["offset"], width, 1 if slices else ROWS_PER_SLICE)
        rows = _with_entries(Slices(["offset"], points).add(rows), carry, before)
    else:
        rows = rows.withColumn(SLICE, F.lit(0))
    # A literal segment number must not become a partitioning key: it is constant.
    keys = [*TP, SLICE] if split else TP
    ordered = rows.repartition(*keys).sortWithinPartitions(*TP, SLICE, "offset")
    visible, entries = df.columns, [f"__e_{name}" for name in carry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, pieces in itertools.groupby(_pieces(batches), key=lambda p: p[0]):
            key, first = next(pieces)
            head = first.iloc[0]
            start = head["initial_offset"]
            info = PartitionInfo(
                topic=key[0],
                partition=int(key[1]),
                initial_offset=None if pd.isna(start) else int(start),
                segment=int(key[2]),
                entry={c[4:]: head[c] for c in entries},
            )
            stream = itertools.chain([first], (p[1] for p in pieces))
            yield from handler(info, (p[visible].reset_index(drop=True) for p in stream))

    return ordered.mapInPandas(run, schema)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Cut batches where the topic-partition or segment changes."""
    names = [*TP, SLICE]
    for batch in batches:
        if not len(batch):
            continue
        changed = np.zeros(len(batch), dtype=bool)
        for name in names:
            values = batch[name].to_numpy()
            changed[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(changed).tolist(), len(batch)]
        for lo, hi in zip(edges, edges[1:]):
            piece = batch.iloc[lo:hi]
            yield tuple(piece[n].iloc[0] for n in names), piece


def _with_entries(
    rows: DataFrame, carry: Mapping[str, Column], before: DataFrame | None = None
) -> DataFrame:
    """Attach to each segment the carried sums of the segments before it."""
    if not carry:
        return rows
    earlier = W.partitionBy(*TP).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(*TP, SLICE).agg(*(F.sum(e).alias(f"__s_{n}") for n, e in carry.items()))
    entries = sums.select(
        *TP,
        SLICE,
        *(F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__e_{n}") for n in carry),
    )
    if before is not None:
        past = before.select(*TP, *(F.col(n).alias(f"__p_{n}") for n in carry))
        entries = entries.join(past, TP, "left").select(
            *TP,
            SLICE,
            *((F.col(f"__e_{n}") + F.coalesce(f"__p_{n}", F.lit(0))).alias(f"__e_{n}") for n in carry),
        )
    return rows.join(settle(entries).df, [*TP, SLICE])


def format_lines(df: DataFrame, with_key: bool = True) -> DataFrame:
    """One text line per message."""
    return df.select(message_line(key="key" if with_key else None).alias("value"))


def write_lines(df: DataFrame, path: str, with_key: bool = True, mode: str = "errorifexists") -> None:
    """Write messages as text lines."""
    format_lines(df, with_key).write.mode(mode).text(path)


def take_messages(df: DataFrame, n: int, per_partition: bool = False) -> DataFrame:
    """The first ``n`` messages: overall, or of every topic-partition.

    Per topic-partition, each task keeps at most ``n`` candidates before the shuffle.
    """
    if not per_partition:
        return df.orderBy(*TP, "offset").limit(n)
    inside = W.partitionBy(*TP).orderBy("offset")
    ranked = df.withColumn("__rank", F.row_number().over(inside))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def delivery_audit(deliveries: DataFrame) -> DataFrame:
    """How often, and to which consumers, each message was delivered."""
    return deliveries.groupBy(*TP, "offset").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sort_array(F.collect_set("consumer_id")).alias("consumers"),
    )


def audit_totals(deliveries: DataFrame) -> DataFrame:
    """Delivered, distinct and repeated messages over all topic-partitions."""
    per_message = deliveries.groupBy(*TP, "offset").agg(F.count(F.lit(1)).alias("n"))
    return per_message.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("delivered"),
        F.count(F.lit(1)).alias("distinct_messages"),
        F.count(F.when(F.col("n") > 1, 1)).alias("repeated_messages"),
    )


def distinct_deliveries(deliveries: DataFrame) -> DataFrame:
    """Each message once."""
    return deliveries.dropDuplicates([*TP, "offset"])
