"""What members gain and lose between assignments.

Everything is computed on flat rows (generation, member, topic, partition), so a member
that owns a large share of all partitions is spread over tasks. The nested form with one
map per event is built from those rows on request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    REBALANCE_ERROR,
    REBALANCE_OK,
    REBALANCE_START,
    partition_diff,
)
from tidemark.plans.bounded import JoinSide, by_shuffle, settle
from tidemark.plans.ordering import with_previous

# Where a rebalance attempt can fail.
STAGES = ("refresh", "release", "rebalance", "subscribe")

_OWNED = ["member_id", "topic", "partition"]


def flat_difference(mine: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows of ``mine`` without an equal key in ``other``; duplicates are kept."""
    return mine.join(by_shuffle(other.select(*keys)), list(keys), "left_anti")


def claimed_rows(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Topic-partitions a member owns now and did not own before."""
    return flat_difference(current, previous, _OWNED)


def released_rows(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Topic-partitions a member owned before and does not own now."""
    return flat_difference(previous, current, _OWNED)


def rebalance_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Claimed, released and current partitions per (member, topic).

    A topic without a difference keeps its row with empty arrays. ``in_previous`` and
    ``in_current`` tell on which side the topic was assigned.
    """
    keys = ["member_id", "topic"]
    parts = F.sort_array(F.collect_set("partition"))
    before = previous.groupBy(*keys).agg(parts.alias("before"))
    now = current.groupBy(*keys).agg(parts.alias("now"))
    nothing = F.array().cast("array<int>")
    return before.join(now, keys, "full").select(
        *keys,
        partition_diff("now", "before").alias("claimed"),
        partition_diff("before", "now").alias("released"),
        F.coalesce("now", nothing).alias("current"),
        F.col("before").isNotNull().alias("in_previous"),
        F.col("now").isNotNull().alias("in_current"),
    )


def rebalance_attempts(
    assignments: DataFrame, failures: DataFrame | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Every attempt of every member with its failure ``stage`` (null: it succeeded) and
    the generation its base assignment comes from (null: empty base).

    A failed refresh happens before ownership is given up, so such an attempt is passed
    over. Every other failure leaves the member without partitions.
    """
    keys = ["generation", "member_id"]
    seen = assignments.select(*keys)
    if members is not None:
        seen = seen.unionByName(members.select(*keys))
    if failures is None:
        attempts = seen.distinct().withColumn("stage", F.lit(None).cast("string"))
    else:
        failed = failures.groupBy(*keys).agg(F.min("stage").alias("stage"))
        attempts = seen.distinct().join(failed, keys, "full")
    counted = settle(attempts.where(F.coalesce(F.col("stage") != "refresh", F.lit(True))))
    if counted.is_small:
        order = W.partitionBy("member_id").orderBy("generation")
        previous = F.lag(F.struct("generation", "stage")).over(order)
        before = counted.rows.withColumn("previous", previous)
    else:
        before = with_previous(
            counted.rows, ["member_id"], ["generation"], ["generation", "stage"]
        )
    base = F.when(
        F.col("previous").isNotNull() & F.col("previous.stage").isNull(), F.col("previous.generation")
    )
    return before.select(*keys, "stage", base.alias("base_generation"))


def rebalance_headers(attempts: DataFrame) -> DataFrame:
    """The notifications themselves, without their partitions.

    An attempt that gets past the release of its partitions starts with a notification,
    and ends with an OK or an error.
    """
    notified = F.col("stage").isNull() | F.col("stage").isin("rebalance", "subscribe")
    outcome = F.when(F.col("stage").isNull(), REBALANCE_OK).otherwise(REBALANCE_ERROR)
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.lit(REBALANCE_START).alias("type")),
        F.struct(F.lit(1).alias("step"), outcome.alias("type")),
    )
    return (
        attempts.where(notified)
        .select("generation", "member_id", F.explode(steps).alias("s"))
        .select("generation", "member_id", "s.step", "s.type")
    )


def rebalance_rows(
    assignments: DataFrame, failures: DataFrame | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Partitions of every notification: one row per (event, change, topic, partition).

    ``change`` is claimed, released or current. A start notification has no rows, because
    ownership has been given up by then; an error carries its base assignment as current.
    """
    owned = settle_owned(assignments)
    return attempt_rows(owned, settle(rebalance_attempts(owned.rows, failures, members)).df)


def distinct_owned(assignments: DataFrame) -> DataFrame:
    """Owned partitions, each once."""
    return assignments.select("generation", *_OWNED).distinct()


def settle_owned(assignments: DataFrame) -> JoinSide:
    """Owned partitions, each once, evaluated."""
    return settle(distinct_owned(assignments))


def attempt_rows(owned: JoinSide, attempts: DataFrame) -> DataFrame:
    """The rows of :func:`rebalance_rows` for some of the attempts over ``owned``."""
    succeeded = attempts.where(F.col("stage").isNull())
    failed = attempts.where(F.col("stage").isin("rebalance", "subscribe"))
    base = owned.df.withColumnRenamed("generation", "base_generation")

    now = owned.rows.join(succeeded, ["generation", "member_id"])
    before = base.join(succeeded, ["base_generation", "member_id"])
    claimed = now.join(base, ["base_generation", *_OWNED], "left_anti")
    released = before.join(owned.df, ["generation", *_OWNED], "left_anti")
    kept = base.join(failed, ["base_generation", "member_id"])

    def rows(df: DataFrame, type_: str, change: str) -> DataFrame:
        return df.select(
            "generation",
            "member_id",
            F.lit(type_).alias("type"),
            F.lit(change).alias("change"),
            "topic",
            "partition",
        )

    return (
        rows(now, REBALANCE_OK, "current")
        .unionByName(rows(claimed, REBALANCE_OK, "claimed"))
        .unionByName(rows(released, REBALANCE_OK, "released"))
        .unionByName(rows(kept, REBALANCE_ERROR, "current"))
    )


def rebalance_events(
    assignments: DataFrame, failures: DataFrame | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Notifications with one map of topic to partitions per change.

    In an OK every current topic is a key of ``claimed`` and every topic of the base a key
    of ``released``, also where nothing changed.
    """
    parts = F.sort_array(F.collect_set("partition"))
    by_member = assignments.groupBy("generation", "member_id", "topic").agg(parts.alias("parts"))
    owned = settle(by_member)
    attempts = settle(rebalance_attempts(owned.rows, failures, members)).df
    base = owned.df.withColumnRenamed("generation", "base_generation")
    keys = ["generation", "member_id", "topic"]
    now = (
        attempts.where(F.col("stage").isNull())
        .join(owned.df, ["generation", "member_id"])
        .select(*keys, F.col("parts").alias("now"))
    )
    before = attempts.join(base, ["base_generation", "member_id"]).select(
        *keys, F.col("parts").alias("before")
    )
    by_topic = now.join(before, keys, "full")

    def as_map(has: str, value: Column) -> Column:
        entry = F.when(F.col(has).isNotNull(), F.struct("topic", value.alias("partitions")))
        return F.map_from_entries(F.collect_list(entry))

    maps = by_topic.groupBy("generation", "member_id").agg(
        as_map("now", partition_diff("now", "before")).alias("claimed"),
        as_map("before", partition_diff("before", "now")).alias("released"),
        as_map("now", F.col("now")).alias("now"),
        as_map("before", F.col("before")).alias("before"),
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<int>>"))
    ok, error = F.col("type") == REBALANCE_OK, F.col("type") == REBALANCE_ERROR
    return (
        rebalance_headers(attempts)
        .join(maps, ["generation", "member_id"], "left")
        .select(
            "generation",
            "member_id",
            "step",
            "type",
            F.coalesce(F.when(ok, F.col("claimed")), empty).alias("claimed"),
            F.coalesce(F.when(ok, F.col("released")), empty).alias("released"),
            F.coalesce(
                F.when(ok, F.col("now")).when(error, F.col("before")), empty
            ).alias("current"),
        )
    )
