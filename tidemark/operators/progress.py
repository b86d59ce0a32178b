"""Per-partition progress: folds of mark and reset commands.

Commands carry ``seq``, the order in which they were issued; it must be unique inside
a topic-partition. Two rules decide what a command does to the current position:

* ``partition``: the stored value is offset + 1; a mark must move strictly forward, a
  reset may stay or move back.
* ``stash``: the raw offset is stored; marks and resets both win ties; an absent key
  reads as offset 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import topic_partition_key
from tidemark.operators.start import with_defaults
from tidemark.operators.topics import only_subscribed
from tidemark.plans.bounded import JoinSide, is_small, settle
from tidemark.plans.ordering import SLICE, Slices
from tidemark.schemas import NO_OFFSET, TP

# The two commands.
MARK, RESET = "mark", "reset"

_TURN = "struct<seq:bigint,op:string,high:bigint,low:bigint>"


@dataclass(frozen=True)
class Rule:
    """How command offsets are stored, and which mark of several equal ones wins."""

    shift: int
    last_mark_wins: bool


RULES = {
    "partition": Rule(shift=1, last_mark_wins=False),
    "stash": Rule(shift=0, last_mark_wins=True),
}


def initial_state(subs: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """Clean state of subscribed topic-partitions, from their committed offsets if given."""
    if committed is not None:
        return with_defaults(committed, subs).withColumn("dirty", F.lit(False))
    return subs.select(*TP).distinct().select(
        *TP,
        F.lit(NO_OFFSET).cast("bigint").alias("offset"),
        F.lit("").alias("metadata"),
        F.lit(False).alias("dirty"),
    )


def with_admitted(state: DataFrame, rows: DataFrame) -> DataFrame:
    """A state that also has the topic-partitions of ``rows``: new ones at -1."""
    fresh = rows.select(*TP).distinct().join(settle(state.select(*TP)).df, TP, "left_anti")
    return state.unionByName(initial_state(fresh))


def state_from_starts(starts: DataFrame) -> DataFrame:
    """Clean state of topic-partitions whose start was resolved."""
    return starts.select(
        *TP, F.col("state_offset").alias("offset"), "metadata", F.lit(False).alias("dirty")
    )


def _updated(state: DataFrame, winners: DataFrame) -> DataFrame:
    """State with the winning (offset, metadata) of each topic-partition applied."""
    won = F.col("w").isNotNull()
    return state.join(winners.select(*TP, "w"), TP, "left").select(
        *TP,
        F.when(won, F.col("w.offset")).otherwise(F.col("offset")).alias("offset"),
        F.when(won, F.col("w.metadata")).otherwise(F.col("metadata")).alias("metadata"),
        (F.col("dirty") | won).alias("dirty"),
    )


def mark_offsets(state: DataFrame, commands: DataFrame) -> DataFrame:
    """Apply the marks only. The highest offset wins, the first one if there are several."""
    return _apply_extreme(state, commands, MARK)


def reset_offsets(state: DataFrame, commands: DataFrame) -> DataFrame:
    """Apply the resets only. The lowest offset wins, the last one if there are several."""
    return _apply_extreme(state, commands, RESET)


def _apply_extreme(state: DataFrame, commands: DataFrame, op: str) -> DataFrame:
    """With one kind of command only the extreme offset matters.

    It is aggregated without the metadata, which is then read for the rows at that offset.
    """
    rule = RULES["partition"]
    found = F.max(_stored(rule)) if op == MARK else F.min(_stored(rule))
    chosen = commands.where(F.col("op") == op)
    extreme = settle(chosen.groupBy(*TP).agg(found.alias("final")))
    final, offset = F.col("final"), F.col("offset")
    moving = state.join(extreme.df, TP).where(final > offset if op == MARK else final <= offset)
    finals = _extreme_finals(moving, op)
    finals = extreme.bounded(finals) if extreme.is_small else settle(finals).rows
    return _updated(state, _winners(chosen, finals, rule))


def _extreme_finals(moving: DataFrame, op: str) -> DataFrame:
    return moving.select(
        *TP,
        "final",
        F.lit(0).cast("bigint").alias("after_seq"),
        F.lit(True).alias("from_first"),
        F.lit(op == MARK).alias("marks_count"),
        F.lit(op == RESET).alias("resets_count"),
    )


def apply_commands(
    state: DataFrame, commands: DataFrame, rule: str = "partition", slices: int | None = None
) -> DataFrame:
    """Apply marks and resets in ``seq`` order. Unsubscribed topic-partitions are ignored.

    A few commands (by measured size, and unless ``slices`` is given) are applied one by
    one. Beyond that, the order of the commands is never materialised. Going back from the
    last command, let ``high`` be the highest mark and ``low`` the lowest reset seen so far. A mark
    above ``low`` leaves the position at ``low`` whatever came before it, and a reset
    below ``high`` leaves it at ``high``: only the latest such turning command matters.
    Highest mark and lowest reset are plain aggregates, so

    1. they are aggregated per slice of ``seq`` and scanned back over the slices, which
       finds the one slice per topic-partition that holds the turning command;
    2. the turning command is found inside that slice;
    3. the final position is known, and its metadata is that of a command with exactly
       this value, found by an equi-join.

    Every step reads the commands with map-side aggregation or a filter by a small side;
    none shuffles them by topic-partition.
    """
    if slices is None and is_small(commands.select("seq", *TP, "op", "offset", "metadata")):
        return _fold_in_order(state, commands, RULES[rule])
    finals, recent = _final_positions(state, commands, RULES[rule], slices)
    return _updated(state, _winners(commands.where(recent), finals, RULES[rule]))


def _fold_in_order(state: DataFrame, commands: DataFrame, rule: Rule) -> DataFrame:
    """Apply a bounded number of commands one by one, in one job."""
    steps = commands.groupBy(*TP).agg(
        F.array_sort(F.collect_list(F.struct("seq", "op", "offset", "metadata"))).alias("steps")
    )

    def step(now: Column, command: Column) -> Column:
        target = command["offset"] + F.lit(rule.shift)
        forward = target >= now["offset"] if rule.last_mark_wins else target > now["offset"]
        wins = ((command["op"] == MARK) & forward) | (
            (command["op"] == RESET) & (target <= now["offset"])
        )
        moved = F.struct(
            target.alias("offset"), command["metadata"].alias("metadata"), F.lit(True).alias("dirty")
        )
        return F.when(wins, moved).otherwise(now)

    start = F.struct("offset", "metadata", "dirty")
    after = F.when(F.col("steps").isNull(), start).otherwise(F.aggregate("steps", start, step))
    return (
        state.join(steps, TP, "left")
        .select(*TP, after.alias("s"))
        .select(*TP, "s.offset", "s.metadata", "s.dirty")
    )


def _stored(rule: Rule) -> Column:
    return F.col("offset") + F.lit(rule.shift)


def _final_positions(
    state: DataFrame, commands: DataFrame, rule: Rule, slices: int | None
) -> tuple[DataFrame, Column]:
    """Final position of each topic-partition with what can have set it, and a predicate
    that all commands after the turning ones meet."""
    plain = commands.where(F.col("op").isin(MARK, RESET)).select(
        *TP, "seq", "op", _stored(rule).alias("v")
    )
    cut = Slices.of(plain, ["seq"], slices)
    steps = cut.add(plain)
    mark = F.when(F.col("op") == MARK, F.col("v"))
    reset = F.when(F.col("op") == RESET, F.col("v"))

    back = W.partitionBy(*TP).orderBy(F.desc(SLICE)).rowsBetween(W.unboundedPreceding, -1)
    scanned = (
        steps.groupBy(*TP, SLICE)
        .agg(F.max(mark).alias("high"), F.min(reset).alias("low"))
        .select(
            "*",
            F.max("high").over(back).alias("later_high"),
            F.min("low").over(back).alias("later_low"),
        )
    )
    turns = F.greatest("high", "later_high") > F.least("low", "later_low")
    summary = settle(
        scanned.groupBy(*TP).agg(
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max(F.when(turns, F.col(SLICE))).alias("turn_slice"),
            F.max_by("later_high", F.when(turns, F.col(SLICE))).alias("later_high"),
            F.max_by("later_low", F.when(turns, F.col(SLICE))).alias("later_low"),
        )
    )
    keys = summary.df
    first = last = None
    if summary.is_small:
        turned = pc.min_max(summary.table["turn_slice"]).as_py()
        first, last = turned["min"], turned["max"]
    if summary.is_small and first is None:
        keys = keys.withColumn("k", F.lit(None).cast(_TURN))
    else:
        inside = steps if first is None else cut.add(plain.where(cut.within(first, last)))
        keys = keys.join(_turning_commands(inside, summary, mark, reset), TP, "left")

    has_turn = F.col("k").isNotNull()
    high = F.when(has_turn, F.col("k.high")).otherwise(F.col("high"))
    low = F.when(has_turn, F.col("k.low")).otherwise(F.col("low"))
    placed = state.join(
        keys.select(*TP, "k", high.alias("high"), low.alias("low")), TP
    ).withColumns(
        {
            "comes_down": F.coalesce(
                F.when(has_turn, F.col("k.op") == MARK).otherwise(F.col("offset") > F.col("low")),
                F.lit(False),
            ),
            "goes_up": F.coalesce(
                F.when(has_turn, F.col("k.op") == RESET).otherwise(F.col("offset") < F.col("high")),
                F.lit(False),
            ),
        }
    )
    final = (
        F.when(F.col("comes_down"), F.col("low"))
        .when(F.col("goes_up"), F.col("high"))
        .otherwise(F.col("offset"))
    )
    placed = placed.withColumn("final", final)
    at_high = F.coalesce(F.col("high") == F.col("final"), F.lit(False))
    at_low = F.coalesce(F.col("low") == F.col("final"), F.lit(False))
    finals = (
        placed.select(
            *TP,
            "final",
            F.coalesce("k.seq", F.lit(-(2**63)).cast("bigint")).alias("after_seq"),
            F.col("k").isNull().alias("from_first"),
            (at_high if rule.last_mark_wins else F.col("goes_up")).alias("marks_count"),
            at_low.alias("resets_count"),
        )
        .where("marks_count OR resets_count")
    )
    # At most one narrow row per row of the summary: the same bound holds.
    finals = summary.bounded(finals) if summary.is_small else settle(finals).rows
    every_key_turns = first is not None and not summary.table["turn_slice"].null_count
    return finals, cut.within(first) if every_key_turns else F.lit(True)


def _turning_commands(
    steps: DataFrame, summary: JoinSide, mark: Column, reset: Column
) -> DataFrame:
    """The turning command of each topic-partition, with high and low of what follows it."""
    where = summary.rows.where(F.col("turn_slice").isNotNull()).select(
        *TP, F.col("turn_slice").alias(SLICE), "later_high", "later_low"
    )
    back = W.partitionBy(*TP).orderBy(F.desc("seq")).rowsBetween(W.unboundedPreceding, -1)
    inside = (
        steps.join(summary.bounded(where), [*TP, SLICE])
        .withColumn("high", F.greatest(F.max(mark).over(back), "later_high"))
        .withColumn("low", F.least(F.min(reset).over(back), "later_low"))
    )
    is_turn = ((F.col("op") == MARK) & (F.col("v") > F.col("low"))) | (
        (F.col("op") == RESET) & (F.col("v") < F.col("high"))
    )
    return (
        inside.where(is_turn)
        .groupBy(*TP)
        .agg(F.max_by(F.struct("seq", "op", "high", "low"), "seq").alias("k"))
    )


def _winners(commands: DataFrame, finals: DataFrame, rule: Rule) -> DataFrame:
    """The last command that set each final position."""
    hits = (
        commands.withColumn("final", _stored(rule))
        .join(finals, [*TP, "final"])
        .where(F.col("from_first") | (F.col("seq") > F.col("after_seq")))
    )
    is_mark = (F.col("op") == MARK) & F.col("marks_count")
    is_reset = (F.col("op") == RESET) & F.col("resets_count")
    entry = F.struct("seq", F.col("final").alias("offset"), "metadata")
    pick_mark = F.max_by if rule.last_mark_wins else F.min_by
    newer = (F.col("m").isNull()) | (F.col("r.seq") > F.col("m.seq"))
    return (
        hits.groupBy(*TP)
        .agg(
            pick_mark(entry, F.when(is_mark, F.col("seq"))).alias("m"),
            F.max_by(entry, F.when(is_reset, F.col("seq"))).alias("r"),
        )
        .select(
            *TP,
            F.when(F.col("r").isNotNull() & newer, F.col("r")).otherwise(F.col("m")).alias("w"),
        )
        .where(F.col("w").isNotNull())
    )


def stash_offsets(
    commands: DataFrame, stash: DataFrame | None = None, slices: int | None = None
) -> DataFrame:
    """Fold commands by the stash rule, from an empty stash or on top of ``stash``."""
    keys = settle(commands.select(*TP).distinct()).rows
    if stash is None:
        before = keys.select(
            *TP,
            F.lit(0).cast("bigint").alias("offset"),
            F.lit("").alias("metadata"),
            F.lit(False).alias("dirty"),
        )
    else:
        present = stash.select(*TP, "offset", "metadata").withColumn("dirty", F.lit(True))
        before = keys.join(present, TP, "full").select(
            *TP,
            F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"),
            F.coalesce("metadata", F.lit("")).alias("metadata"),
            F.coalesce("dirty", F.lit(False)).alias("dirty"),
        )
    after = apply_commands(before, commands, "stash", slices)
    return after.where("dirty").drop("dirty")


def stash_marks(commands: DataFrame) -> DataFrame:
    """Stash of marks only: the highest non-negative offset, the last of several."""
    marks = commands.where((F.col("op") == MARK) & (F.col("offset") >= 0))
    highest = settle(marks.groupBy(*TP).agg(F.max("offset").alias("final")))
    winners = _winners(marks, _extreme_finals(highest.df, MARK), RULES["stash"])
    return winners.select(*TP, "w.offset", "w.metadata")


def stash_map(stash: DataFrame) -> DataFrame:
    """Stashed offset per ``topic-partition`` key."""
    return stash.select(topic_partition_key().alias("key"), "offset")


def apply_stash(state: DataFrame, stash: DataFrame, op: str = MARK) -> DataFrame:
    """Mark (or reset) every stashed offset once. Unsubscribed entries are dropped.

    The stash counts as emptied afterwards: start a new one.
    """
    if op not in (MARK, RESET):
        raise ValueError("op must be mark or reset")
    target = F.col("c.offset") + 1
    wins = target > F.col("offset") if op == MARK else target <= F.col("offset")
    after = F.struct(target.alias("offset"), F.col("c.metadata").alias("metadata"))
    entries = stash.select(*TP, F.struct("offset", "metadata").alias("c"))
    moved = state.join(entries, TP).where(wins)
    return _updated(state, moved.select(*TP, after.alias("w")))


def dirty(state: DataFrame) -> DataFrame:
    """Topic-partitions changed since their last successful commit."""
    return state.where("dirty")


def snapshot(state: DataFrame, subs: DataFrame | None = None) -> DataFrame:
    """Offset, metadata and dirty flag of every topic-partition (of the subscribed ones)."""
    rows = state.select(*TP, "offset", "metadata", "dirty")
    return rows if subs is None else only_subscribed(rows, subs)


def mark_committed(state: DataFrame, results: DataFrame) -> DataFrame:
    """Clear the dirty flag of what was committed without error and has not moved since."""
    done = results.where(F.col("error").isNull()).select(*TP, F.col("offset").alias("committed"))
    return state.join(done, TP, "left").select(
        *TP,
        "offset",
        "metadata",
        (F.col("dirty") & ~F.coalesce(F.col("offset") == F.col("committed"), F.lit(False))).alias(
            "dirty"
        ),
    )
