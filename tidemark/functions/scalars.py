"""Column functions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notification codes and their names.
NOTIFICATION_NAMES = {
    1: "rebalance start",
    2: "rebalance OK",
    3: "rebalance error",
}
UNKNOWN_NOTIFICATION = "unknown"
REBALANCE_START = NOTIFICATION_NAMES[1]
REBALANCE_OK = NOTIFICATION_NAMES[2]
REBALANCE_ERROR = NOTIFICATION_NAMES[3]

# Text formats.
SEED_FORMAT = "PLAINDATA-%08d"
LINE_FORMAT = "%s/%d/%d\t%s"
KEYED_LINE_FORMAT = "%s/%d/%d\t%s\t%s"


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def topic_partition_key(topic="topic", partition="partition") -> Column:
    """``topic-partition`` as text."""
    return F.concat_ws("-", _c(topic), _c(partition).cast("string"))


def next_offset(offset, fallback) -> Column:
    """The committed offset, or ``fallback`` when there is none."""
    return F.when(_c(offset) > -1, _c(offset)).otherwise(_c(fallback))


def notification_name(code) -> Column:
    """Name of a notification code."""
    out = None
    for value, name in NOTIFICATION_NAMES.items():
        is_code = _c(code) == value
        out = F.when(is_code, name) if out is None else out.when(is_code, name)
    return out.otherwise(UNKNOWN_NOTIFICATION)


def message_line(topic="topic", partition="partition", offset="offset", value="value", key=None):
    """One text line per message, optionally with its key."""
    text = F.coalesce(_c(value).cast("string"), F.lit(""))
    head = [_c(topic), _c(partition), _c(offset)]
    if key is None:
        return F.format_string(LINE_FORMAT, *head, text)
    key_text = F.coalesce(_c(key).cast("string"), F.lit(""))
    return F.format_string(KEYED_LINE_FORMAT, *head, key_text, text)


def range_bound(position, items, owners) -> Column:
    """First item position of the owner at ``position`` (range assignment)."""
    share = _c(items).cast("double") / _c(owners).cast("double")
    return F.floor(_c(position).cast("double") * share + F.lit(0.5))


def range_owner(item, items, owners) -> Column:
    """Position of the owner whose range holds the item at position ``item``.

    Inverse of :func:`range_bound`. The closed form can be off by one where doubles
    round, so it is checked against the exact bounds of its neighbours.
    """
    share = _c(items).cast("double") / _c(owners).cast("double")
    guess = F.ceil((_c(item).cast("double") + F.lit(0.5)) / share) - 1
    return (
        F.when(_c(item) < range_bound(guess, items, owners), guess - 1)
        .when(_c(item) >= range_bound(guess + 1, items, owners), guess + 1)
        .otherwise(guess)
        .cast("bigint")
    )


def seed_value(index) -> Column:
    """Test message text for a running number."""
    return F.format_string(SEED_FORMAT, _c(index))


def partition_diff(mine, other) -> Column:
    """Elements of ``mine`` that are not in ``other``; order and duplicates are kept."""
    nothing = F.array().cast("array<int>")
    mine, other = F.coalesce(_c(mine), nothing), F.coalesce(_c(other), nothing)
    # Set difference is linear, but drops duplicates; those are rare and looked up one by one.
    has_duplicates = F.size(F.array_distinct(mine)) < F.size(mine)
    kept = F.filter(mine, lambda x: ~F.array_contains(other, x))
    return F.when(has_duplicates, kept).otherwise(F.array_except(mine, other))
