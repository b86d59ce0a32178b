"""Distribute the items of each group over the owners entitled to that group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import range_owner
from tidemark.operators.topics import require_topics, unknown_topics
from tidemark.options import ROUND_ROBIN
from tidemark.plans.bounded import JoinSide, settle
from tidemark.plans.ordering import with_position

_POS, _INDEX, _ITEMS, _OWNERS = "__pos", "__index", "__items", "__owners"


def _ranked_owners(owners: DataFrame, group: list[str], owner: str) -> JoinSide:
    """Owners with their position in ascending order; a repeated owner counts once."""
    side = settle(owners.select(*group, owner).distinct())
    if side.is_small:
        inside = W.partitionBy(*group).orderBy(owner)
        position = (F.row_number().over(inside) - 1).cast("bigint")
        return JoinSide(side.rows.select(*group, owner, position.alias(_POS)), side.table)
    return JoinSide(with_position(side.rows, group, [owner], _POS), None)


def _place(placed: DataFrame, ranked: JoinSide, group, round_robin: bool) -> DataFrame:
    """Attach the owner to items that carry their index, group size and owner count."""
    if round_robin:
        position = F.col(_INDEX) % F.col(_OWNERS)
    else:
        position = range_owner(_INDEX, _ITEMS, _OWNERS)
    return placed.withColumn(_POS, position).join(ranked.df, [*group, _POS])


def _sizes(ranked: JoinSide, group: list[str]) -> DataFrame:
    return ranked.rows.groupBy(*group).agg(F.count(F.lit(1)).alias(_OWNERS))


def _assign(items, owners, group, item, owner, round_robin: bool) -> DataFrame:
    group, item = _as_list(group), _as_list(item)
    ranked = _ranked_owners(owners, group, owner)
    sizes = _sizes(ranked, group)
    placed = with_position(items, group, item, _INDEX, size=_ITEMS, per_group=sizes)
    return _place(placed, ranked, group, round_robin).select(*items.columns, owner)


def assign_range(items, owners, group, item, owner) -> DataFrame:
    """Give each owner one contiguous run of its group's items, in ``item`` order.

    Both the positions of the items and the owner of a position are computed, so owners
    are attached by an equi-join on (group, position) rather than by a range condition.
    Owners without a share do not appear.
    """
    return _assign(items, owners, group, item, owner, round_robin=False)


def assign_round_robin(items, owners, group, item, owner) -> DataFrame:
    """Deal the items of each group out to its owners in turn."""
    return _assign(items, owners, group, item, owner, round_robin=True)


def _as_list(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def assign(
    members: DataFrame,
    catalog: DataFrame,
    strategy: str = "range",
    on_unknown: str = "raise",
) -> DataFrame:
    """Topic-partitions of every member, for all topics (and generations) at once.

    ``members`` lists the topics of each member. Only ``roundrobin`` deals in turn; any
    other strategy name means range. A topic missing from the catalog fails the whole
    assignment, or with ``on_unknown="skip"`` is left out (see ``unknown_topics``).
    """
    if on_unknown == "raise":
        require_topics(members, catalog)
    # A partition has the same index in every generation: rank once, then expand.
    group = [c for c in ("generation", "topic") if c in members.columns]
    ranked = _ranked_owners(members, group, "member_id")
    partitions = catalog.select("topic", "partition").distinct()
    indexed = with_position(partitions, ["topic"], ["partition"], _INDEX, size=_ITEMS)
    placed = indexed.join(ranked.bounded(_sizes(ranked, group)), "topic")
    out = _place(placed, ranked, group, strategy == ROUND_ROBIN)
    return out.select(*group[:-1], "member_id", "topic", "partition")


def unknown_member_topics(members: DataFrame, catalog: DataFrame) -> DataFrame:
    """Member rows whose topic the catalog does not have."""
    missing = unknown_topics(members, catalog)
    return members.join(missing, "topic", "left_semi")


def subscriptions(assignments: DataFrame, member: str | None = None) -> DataFrame:
    """Ascending partitions per topic, of one member or per member (and generation)."""
    if member is not None:
        assignments = assignments.where(F.col("member_id") == member).drop("member_id")
    keys = [c for c in ("generation", "member_id", "topic") if c in assignments.columns]
    parts = F.sort_array(F.collect_set("partition"))
    return assignments.groupBy(*keys).agg(parts.alias("partitions"))


def nested_assignments(assignments: DataFrame) -> DataFrame:
    """One row per member (and generation) with a map of topic to partitions."""
    by_topic = subscriptions(assignments)
    keys = [c for c in ("generation", "member_id") if c in by_topic.columns]
    entries = F.map_from_entries(F.collect_list(F.struct("topic", "partitions")))
    return by_topic.groupBy(*keys).agg(entries.alias("topics"))
