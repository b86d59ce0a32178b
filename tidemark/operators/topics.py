"""Which topics a group reads: explicit topics plus whitelist minus blacklist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bounded import settle


def catalog(topic_log: DataFrame) -> DataFrame:
    """Every topic-partition of a log."""
    return topic_log.select("topic", "partition").distinct()


def topics_of(table: DataFrame) -> DataFrame:
    """Distinct topics of any table with a topic column."""
    return table.select("topic").distinct()


def may_be_extra(topic: Column, whitelist: str | None, blacklist: str | None) -> Column:
    """Does a topic qualify by pattern? The blacklist wins; no whitelist admits nothing.

    Patterns are found anywhere in the name and follow Java syntax.
    """
    if whitelist is None:
        return F.lit(False)
    allowed = topic.rlike(whitelist)
    return allowed & ~topic.rlike(blacklist) if blacklist is not None else allowed


def select_topics(
    catalog: DataFrame,
    core: Sequence[str],
    whitelist: str | None = None,
    blacklist: str | None = None,
) -> DataFrame:
    """Selected topics with their ``origin``: core topics (patterns do not apply), then
    catalog topics that are not core and qualify by pattern."""
    spark = catalog.sparkSession
    names = sorted(set(core))
    core_df = spark.createDataFrame([(n, "core") for n in names], "topic string, origin string")
    if whitelist is None:
        return core_df
    extra = topics_of(catalog).where(may_be_extra(F.col("topic"), whitelist, blacklist))
    if names:
        extra = extra.where(~F.col("topic").isin(names))
    return core_df.unionByName(extra.withColumn("origin", F.lit("extra")))


def require_topics(wanted: DataFrame, catalog: DataFrame) -> None:
    """Raise if a wanted topic is not in the catalog."""
    missing = unknown_topics(wanted, catalog).limit(10).collect()
    if missing:
        raise ValueError("unknown topics: " + ", ".join(sorted(r.topic for r in missing)))


def unknown_topics(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Wanted topics the catalog does not have."""
    return topics_of(wanted).join(topics_of(catalog), "topic", "left_anti")


def only_subscribed(df: DataFrame, subs: DataFrame) -> DataFrame:
    """Rows of subscribed topic-partitions (or topics, if ``subs`` has no partition)."""
    keys = [c for c in ("topic", "partition") if c in subs.columns]
    return df.join(settle(subs.select(*keys).distinct()).df, keys, "left_semi")


def not_subscribed(df: DataFrame, subs: DataFrame) -> DataFrame:
    """The rows :func:`only_subscribed` ignores."""
    keys = [c for c in ("topic", "partition") if c in subs.columns]
    return df.join(settle(subs.select(*keys).distinct()).df, keys, "left_anti")
