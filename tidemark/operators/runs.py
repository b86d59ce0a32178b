"""Owned partitions as runs of consecutive numbers.

A member that owns 40,000 partitions of a topic in one stretch is one row (first, last), and what
it gains and loses is found by a sweep over the ends of runs. Both steps number rows inside
(member, topic, slice), so a member that owns most partitions is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bounded import settle
from tidemark.plans.ordering import running, with_position, with_previous

RUN_KEYS = ("member_id", "topic")


def runs_of(owned: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Longest runs (``keys``, first, last) of the partitions in ``owned``; repeats count once."""
    rows = settle(owned.select(*keys, "partition").distinct()).rows
    placed = with_position(rows, keys, ["partition"], "_position")
    # Inside a run partition and position grow alike.
    stretch = (F.col("partition") - F.col("_position")).alias("_stretch")
    return (
        placed.groupBy(*keys, stretch)
        .agg(F.min("partition").alias("first"), F.max("partition").alias("last"))
        .drop("_stretch")
    )


def partitions_of(runs: DataFrame) -> DataFrame:
    """One row per partition of the runs."""
    kept = [c for c in runs.columns if c not in ("first", "last")]
    return runs.select(*kept, F.explode(F.sequence("first", "last")).alias("partition"))


def _ends(runs: DataFrame, keys: Sequence[str], mine: int, other: int) -> DataFrame:
    def end(at, sign: int):
        return F.struct(
            at.cast("bigint").alias("at"),
            F.lit(sign * mine).alias("mine"),
            F.lit(sign * other).alias("other"),
        )

    ends = F.array(end(F.col("first"), 1), end(F.col("last").cast("bigint") + 1, -1))
    return runs.select(*keys, F.explode(ends).alias("e")).select(*keys, "e.*")


def run_difference(
    mine: DataFrame, other: DataFrame, keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Runs of what ``mine`` covers and ``other`` does not. Runs of one side may not overlap."""
    ends = _ends(mine, keys, 1, 0).unionByName(_ends(other, keys, 0, 1))
    turns = ends.groupBy(*keys, "at").agg(F.sum("mine").alias("mine"), F.sum("other").alias("other"))
    turns = settle(turns).rows
    covered = {"_mine": F.col("mine"), "_other": F.col("other")}
    swept = settle(running(turns, keys, ["at"], covered).select(*keys, "at", "_mine", "_other")).rows
    before = with_previous(swept, keys, ["at"], ["at", "_mine", "_other"], "_from")
    return before.where((F.col("_from._mine") > 0) & (F.col("_from._other") == 0)).select(
        *keys,
        F.col("_from.at").cast("int").alias("first"),
        (F.col("at") - 1).cast("int").alias("last"),
    )


def rebalance_runs(
    previous: DataFrame, current: DataFrame, keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Claimed, released and current partitions as runs (``keys``, change, first, last).

    Both sides are assignments with one row per owned partition.
    """
    before = settle(runs_of(previous, keys)).rows
    now = settle(runs_of(current, keys)).rows
    changes = {
        "claimed": run_difference(now, before, keys),
        "released": run_difference(before, now, keys),
        "current": now,
    }
    out = None
    for change, runs in changes.items():
        rows = runs.select(*keys, F.lit(change).alias("change"), "first", "last")
        out = rows if out is None else out.unionByName(rows)
    return out
