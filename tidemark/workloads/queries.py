"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as fn
from tidemark.operators import assign as A
from tidemark.operators import commit as C
from tidemark.operators.commit_log import CommitLog
from tidemark.operators import delivery as D
from tidemark.operators import progress as P
from tidemark.operators import rebalance as R
from tidemark.operators import runs as RUNS
from tidemark.operators import start as ST
from tidemark.operators import topics as TO
from tidemark.options import GroupOptions
from tidemark.plans import group_read as GR
from tidemark.plans.bounded import settle
from tidemark.plans.ordering import slice_count, split_points, with_position
from tidemark.plans.scratch import scratch_path
from tidemark.schemas import TP
from tidemark.sources.topic_log import as_topic_log, merge_streams, read_topics, write_topic_log
from tidemark.sources import zones as Z
from tidemark.streaming import admission, notifications, partitions, seen, tracker, versions, watch
from tidemark.workloads import tables as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the SQL of the checks.
CORE, WHITELIST, BLACKLIST = ["click", "gone"], "e", "^v"
GROUP, MEMBER, GENERATION = "g1", "m1", 3


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def out(df: DataFrame) -> DataFrame:
    """Names that are not reserved words in other engines."""
    for name, short in (("partition", "part"), ("offset", "off")):
        if name in df.columns:
            df = df.withColumnRenamed(name, short)
    return df


# --- reading -----------------------------------------------------------------


@query
def resume_scan(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    ranges = W.small(W.bounds(log))
    left = ST.resume_scan(log, W.committed(ranges), ranges, "oldest")
    return out(left.select(*TP, "offset", "event_id"))


@query
def offset_range_read(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    ranges = W.small(W.bounds(log))
    starts = ST.resolve_start(ST.with_defaults(W.committed(ranges), ranges), ranges, "newest")
    return out(ST.read_from(log, starts).select(*TP, "offset", "payload", "amount"))


@query
def multiplexed_read(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    topics = TO.select_topics(TO.catalog(log), CORE, WHITELIST, BLACKLIST)
    path = W.stored_log_path(spark, sf_dir)
    read = read_topics(spark, path, topics, schema=log.schema)
    return out(read.select(*TP, "offset", "key_id", "payload", "amount"))


@query
def group_read(spark, sf_dir):
    """The whole way of a group: topics, committed offsets, start positions, messages."""
    log = W.stored_log(spark, sf_dir)
    options = GroupOptions(GROUP, initial="oldest", whitelist=WHITELIST, blacklist=BLACKLIST)
    path = W.stored_log_path(spark, sf_dir)
    read = GR.read_group(spark, path, CORE, W.commits(log), options, schema=log.schema)
    return out(read.select(*TP, "offset", "event_id"))


def _running(info: D.PartitionInfo, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    count, cents = int(info.entry["count"]), int(info.entry["cents"])
    for batch in batches:
        amounts = (batch["amount"] * 100).round().astype("int64")
        yield pd.DataFrame(
            {
                "topic": info.topic,
                "partition": info.partition,
                "offset": batch["offset"],
                "running_count": count + pd.RangeIndex(1, len(batch) + 1),
                "running_cents": cents + amounts.cumsum(),
            }
        )
        count, cents = count + len(batch), cents + int(amounts.sum())


_RUNNING = "topic string, partition int, offset bigint, running_count bigint, running_cents bigint"


def _carried() -> dict:
    return {"count": F.lit(1), "cents": F.round(F.col("amount") * 100).cast("bigint")}


@query
def partitioned_read(spark, sf_dir):
    log = W.stored_log(spark, sf_dir).select(*TP, "offset", "amount")
    return out(D.for_each_partition(log, _running, _RUNNING, carry=_carried(), split=True))


def _extent(info: D.PartitionInfo, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first, last, count = None, None, 0
    for batch in batches:
        first = int(batch["offset"].iloc[0]) if first is None else first
        last, count = int(batch["offset"].iloc[-1]), count + len(batch)
    yield pd.DataFrame([[info.topic, info.partition, info.initial_offset, first, last, count]])


@query
def partition_streams(spark, sf_dir):
    """Handlers that see their start position; gaps are found from the segments' ends."""
    log = W.stored_log(spark, sf_dir).select(*TP, "offset")
    ranges = W.small(W.bounds(log))
    starts = ST.resolve_start(ST.with_defaults(W.committed(ranges), ranges), ranges, "oldest")
    schema = "topic string, partition int, initial_offset bigint, first bigint, last bigint, n bigint"
    read = ST.read_from(log, starts)
    segments = D.for_each_partition(read, _extent, schema, starts=starts, split=True)
    extent = F.max("last") - F.min("first") + 1
    per_partition = segments.groupBy(*TP, "initial_offset").agg(
        F.sum("n").alias("messages"), (extent - F.sum("n")).alias("breaks")
    )
    return out(per_partition)


@query
def topic_catalog(spark, sf_dir):
    return out(TO.catalog(W.stored_log(spark, sf_dir)))


@query
def log_ranges(spark, sf_dir):
    return out(ST.log_bounds(W.stored_log(spark, sf_dir)))


@query
def high_water_marks(spark, sf_dir):
    return out(ST.high_water_marks(W.stored_log(spark, sf_dir)))


@query
def topic_write(spark, sf_dir):
    docs = as_topic_log(
        W.table(spark, sf_dir, "documents"),
        topic=F.col("lang"),
        partition=F.pmod("doc_id", F.lit(W.LOG_PARTITIONS)),
        order=["doc_id"],
        keep=[F.col("source").alias("key"), F.col("text").alias("value")],
    )
    path = scratch_path(spark, "document-log")
    write_topic_log(docs, path, numbered=True)
    stored = spark.read.schema(docs.schema).parquet(path)
    return out(stored.select(*TP, "offset", "doc_id", "key", "value"))


@query
def message_lines(spark, sf_dir):
    log = W.stored_log(spark, sf_dir).withColumn("value", F.col("payload"))
    return D.format_lines(log, with_key=False).select(F.col("value").alias("line"))


@query
def message_lines_keyed(spark, sf_dir):
    log = W.stored_log(spark, sf_dir).withColumns(
        {"value": F.col("payload"), "key": F.concat(F.lit("u"), F.col("key_id").cast("string"))}
    )
    return D.format_lines(log, with_key=True).select(F.col("value").alias("line"))


@query
def first_messages(spark, sf_dir):
    return out(D.take_messages(W.stored_log(spark, sf_dir), 100).select(*TP, "offset", "event_id"))


@query
def first_messages_per_partition(spark, sf_dir):
    taken = D.take_messages(W.stored_log(spark, sf_dir), 10, per_partition=True)
    return out(taken.select(*TP, "offset", "event_id"))


# --- topics ------------------------------------------------------------------


@query
def topic_selection(spark, sf_dir):
    catalog = TO.catalog(W.stored_log(spark, sf_dir))
    return TO.select_topics(catalog, CORE, WHITELIST, BLACKLIST)


@query
def topic_union(spark, sf_dir):
    catalog = TO.catalog(W.stored_log(spark, sf_dir))
    return TO.select_topics(catalog, CORE, "i", None).select("topic")


@query
def known_topics(spark, sf_dir):
    topics = TO.topics_of(W.stored_log(spark, sf_dir))
    selected = TO.select_topics(topics, CORE, WHITELIST, BLACKLIST)
    known = topics.join(W.small(selected), "topic", "left")
    is_core, is_extra = F.col("origin") == "core", F.col("origin") == "extra"
    return known.select(
        "topic",
        F.coalesce(is_core, F.lit(False)).alias("is_core"),
        F.coalesce(is_extra, F.lit(False)).alias("is_extra"),
    )


def _some_subs(log: DataFrame) -> DataFrame:
    ranges = W.bounds(log)
    return ranges.where((F.col("topic") != "view") & (F.col("partition") != 2)).select(*TP)


@query
def subscribed_commands(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(TO.only_subscribed(W.commands(log), _some_subs(log)))


@query
def unknown_topics(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    wanted = TO.select_topics(TO.catalog(log), CORE, WHITELIST, BLACKLIST)
    return TO.unknown_topics(wanted, log)


# --- start positions ---------------------------------------------------------


@query
def committed_offsets(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(ST.fetch_committed(W.commits(log), TO.catalog(log), GROUP))


@query
def latest_commits(spark, sf_dir):
    return out(ST.latest_commits(W.commits(W.stored_log(spark, sf_dir))))


def _starts(spark, sf_dir, default):
    ranges = W.small(W.bounds(W.stored_log(spark, sf_dir)))
    subs = ST.fetch_committed(
        W.committed(ranges).select(
            F.lit(GROUP).alias("group_id"),
            F.lit(GENERATION).alias("generation"),
            *TP,
            "offset",
            "metadata",
            F.lit(-1).alias("retention_ms"),
            F.lit(0).alias("committed_at"),
            F.lit(0).alias("batch_id"),
        ),
        ranges,
        GROUP,
    )
    return ST.resolve_start(subs, ranges, default)


@query
def start_positions_oldest(spark, sf_dir):
    return out(_starts(spark, sf_dir, "oldest"))


@query
def start_positions_newest(spark, sf_dir):
    return out(_starts(spark, sf_dir, "newest"))


@query
def out_of_range_starts(spark, sf_dir):
    lost = _starts(spark, sf_dir, "oldest").where(F.col("how") == "out_of_range")
    return out(lost.select(*TP, "metadata"))


# --- progress ----------------------------------------------------------------


def _state(log: DataFrame) -> DataFrame:
    ranges = W.small(W.bounds(log))
    return P.initial_state(ranges, W.committed(ranges))


@query
def mark_fold(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.mark_offsets(_state(log), W.commands(log)))


@query
def reset_fold(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.reset_offsets(_state(log), W.commands(log)))


@query
def mixed_fold(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.apply_commands(_state(log), W.commands(log)))


@query
def mixed_fold_sliced(spark, sf_dir):
    """The fold as it runs on logs of any size."""
    log = W.stored_log(spark, sf_dir)
    return out(P.apply_commands(_state(log), W.commands(log), slices=slice_count(log)))


@query
def stash_fold_sliced(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.stash_offsets(W.commands(log), slices=slice_count(log)))


@query
def mixed_fold_by_user(spark, sf_dir):
    """Many short command lists: one topic-partition per event type and user."""
    wide = W.stored_log(spark, sf_dir).withColumn("partition", F.col("key_id").cast("int"))
    commands = W.commands(wide)
    return out(P.apply_commands(settle(P.initial_state(commands)).rows, commands))


@query
def stash_fold(spark, sf_dir):
    return out(P.stash_offsets(W.commands(W.stored_log(spark, sf_dir))))


@query
def stash_marks(spark, sf_dir):
    return out(P.stash_marks(W.commands(W.stored_log(spark, sf_dir))))


@query
def stash_map(spark, sf_dir):
    stash = P.stash_marks(W.commands(W.stored_log(spark, sf_dir)))
    return P.stash_map(stash).select("key", F.col("offset").alias("off"))


def _stash(log: DataFrame) -> DataFrame:
    ranges = W.small(W.bounds(log))
    return ranges.select(
        *TP,
        F.floor(F.col("newest") / 3).cast("bigint").alias("offset"),
        F.concat(F.lit("st-"), "topic").alias("metadata"),
    )


@query
def stash_applied_mark(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.apply_stash(_state(log), _stash(log), P.MARK))


@query
def stash_applied_reset(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return out(P.apply_stash(_state(log), _stash(log), P.RESET))


@query
def state_snapshot(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    state = P.mark_offsets(_state(log), W.commands(log))
    return out(P.snapshot(state, _some_subs(log)))


@query
def commit_rows(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    state = P.mark_offsets(_state(log), W.commands(log))
    rows = C.commit_rows(state, GROUP, MEMBER, GENERATION, batch_id=7)
    return out(rows.drop("committed_at"))


@query
def acknowledged_state(spark, sf_dir):
    """Commits that fail in partition 2, and a position that moved meanwhile in 1."""
    log = W.stored_log(spark, sf_dir)
    state = P.mark_offsets(_state(log), W.commands(log))
    moved = F.when(F.col("partition") == 1, F.col("offset") - 1).otherwise(F.col("offset"))
    error = F.when(F.col("partition") == 2, "refused")
    results = P.dirty(state).select(*TP, moved.alias("offset"), error.alias("error"))
    return out(P.mark_committed(state, results))


@query
def error_rows(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    ignored = TO.not_subscribed(W.commands(log), _some_subs(log))
    stale = C.stale_commits(W.commits(log), W.commits(log))
    return out(
        C.errors_of(
            C.error_rows(ignored, "mark", F.concat(F.lit("not subscribed: "), "op")),
            C.error_rows(stale, "commit", "illegal generation"),
        )
    )


# --- deliveries --------------------------------------------------------------


@query
def delivery_audit(spark, sf_dir):
    audit = D.delivery_audit(W.deliveries(W.stored_log(spark, sf_dir)))
    return out(audit.withColumn("consumers", F.array_join("consumers", ",")))


@query
def delivery_totals(spark, sf_dir):
    return D.audit_totals(W.deliveries(W.stored_log(spark, sf_dir)))


@query
def distinct_deliveries(spark, sf_dir):
    once = D.distinct_deliveries(W.deliveries(W.stored_log(spark, sf_dir)))
    return out(once.select(*TP, "offset"))


@query
def multiplex_union(spark, sf_dir):
    """Two logs as one stream: events, and conversations by role."""
    turns = as_topic_log(
        W.table(spark, sf_dir, "conversations"),
        topic=F.col("role"),
        partition=F.pmod("conv_id", F.lit(W.LOG_PARTITIONS)),
        order=["conv_id", "turn"],
        keep=[F.col("text").alias("payload")],
    )
    columns = [*TP, "offset", "payload"]
    return out(merge_streams(W.stored_log(spark, sf_dir).select(*columns), turns.select(*columns)))


# --- assignment --------------------------------------------------------------


@query
def range_assignment(spark, sf_dir):
    orders = W.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    owners = W.order_owners(spark, sf_dir)
    return A.assign_range(orders, owners, ["o_orderpriority"], "o_orderkey", "s_suppkey")


@query
def round_robin_assignment(spark, sf_dir):
    orders = W.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    owners = W.order_owners(spark, sf_dir)
    return A.assign_round_robin(orders, owners, ["o_orderpriority"], "o_orderkey", "s_suppkey")


def _assignments(spark, sf_dir, strategy="range"):
    return A.assign(W.members(spark, sf_dir), W.wide_catalog(spark, sf_dir), strategy, "skip")


@query
def group_assignment_range(spark, sf_dir):
    return out(_assignments(spark, sf_dir))


@query
def group_assignment_round_robin(spark, sf_dir):
    return out(_assignments(spark, sf_dir, "roundrobin"))


@query
def subscriptions(spark, sf_dir):
    subs = A.subscriptions(_assignments(spark, sf_dir))
    text = F.array_join(F.col("partitions").cast("array<string>"), ",")
    return subs.select("generation", "member_id", "topic", text.alias("partitions"))


@query
def ordering_rules(spark, sf_dir):
    """Bytewise position of each user name among the users of its topic."""
    users = (
        W.stored_log(spark, sf_dir)
        .select("topic", F.concat(F.lit("u"), F.col("key_id").cast("string")).alias("name"))
        .distinct()
    )
    return with_position(users, ["topic"], ["name"], "pos")


# --- rebalance ---------------------------------------------------------------


def _previous_day(assignments: DataFrame) -> DataFrame:
    return assignments.withColumn("generation", F.col("generation") + 1)


@query
def partition_difference(spark, sf_dir):
    """Partitions a member owns in a generation and did not own in the one before."""
    now = settle(_assignments(spark, sf_dir)).rows
    keys = ["generation", "member_id", "topic", "partition"]
    return out(R.flat_difference(now, _previous_day(now), keys))


def _by_generation(df: DataFrame) -> DataFrame:
    """Make the generation part of the member, to compare all generations at once."""
    return df.withColumn("member_id", F.concat_ws("@", "member_id", "generation"))


@query
def rebalance_success(spark, sf_dir):
    now = settle(_assignments(spark, sf_dir)).rows
    before, after = _by_generation(_previous_day(now)), _by_generation(now)
    gained = R.claimed_rows(before, after).withColumn("change", F.lit("claimed"))
    lost = R.released_rows(before, after).withColumn("change", F.lit("released"))
    return out(gained.unionByName(lost).drop("generation"))


@query
def rebalance_by_topic(spark, sf_dir):
    now = settle(_assignments(spark, sf_dir)).rows
    diff = R.rebalance_diff(_by_generation(_previous_day(now)), _by_generation(now))

    def text(name: str):
        return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)

    return diff.select(
        "member_id",
        "topic",
        text("claimed"),
        text("released"),
        text("current"),
        "in_previous",
        "in_current",
    )


@query
def rebalance_runs(spark, sf_dir):
    """What members gain, lose and own, as runs of consecutive partitions."""
    now = settle(_assignments(spark, sf_dir)).rows
    runs = RUNS.rebalance_runs(_by_generation(_previous_day(now)), _by_generation(now))
    return runs.withColumnsRenamed({"first": "first_part", "last": "last_part"})


@query
def rebalance_history(spark, sf_dir):
    rows = R.rebalance_rows(
        _assignments(spark, sf_dir), W.failures(spark, sf_dir), W.members(spark, sf_dir)
    )
    return out(rows)


@query
def rebalance_notifications(spark, sf_dir):
    attempts = R.rebalance_attempts(
        _assignments(spark, sf_dir), W.failures(spark, sf_dir), W.members(spark, sf_dir)
    )
    return R.rebalance_headers(attempts)


# --- scalar functions --------------------------------------------------------


@query
def scalar_functions(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    return log.select(
        "event_id",
        fn.topic_partition_key().alias("tp_key"),
        fn.next_offset(F.col("offset") - 10, F.lit(-2).cast("bigint")).alias("next_off"),
        fn.notification_name(F.col("offset") % 5).alias("name"),
        fn.range_bound("offset", F.col("key_id") + 1, F.lit(7)).alias("bound"),
        fn.seed_value("event_id").alias("seed_value"),
    )


# --- streaming ---------------------------------------------------------------

_PARTS = 3


def _replay(df: DataFrame, order: str, start: Callable) -> None:
    """Write a table in parts along ``order``; after each part, run the stream over the
    folder until it is caught up and stop it. Every run but the first is a restart.

    ``start(stream, checkpoint)`` starts the query. The cuts lie between different values of
    ``order``, however few there are for the rows; nulls come first.
    """
    spark = df.sparkSession
    df = W.stored(df, "replayed")
    path, checkpoint = scratch_path(spark, "replay"), scratch_path(spark, "checkpoint")
    column, low = F.col(order), None
    for high in [*split_points(df.select(order).distinct(), [order], _PARTS), None]:
        part = df if low is None else df.where(column >= low)
        part = part if high is None else part.where(column.isNull() | (column < high))
        part.write.mode("append").parquet(path)
        start(spark.readStream.schema(df.schema).parquet(path), checkpoint).awaitTermination()
        low = high


def _to_table(sink: str, mode: str = "append"):
    """Start a stream that appends to the Parquet folder ``sink``."""

    def start(stream: DataFrame, checkpoint: str):
        writer = stream.writeStream.format("parquet").outputMode(mode)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)

    return start


@query
def stream_mixed_fold(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    initial, path = W.small(_state(log)), scratch_path(spark, "offset-state")
    _replay(W.commands(log), "seq", lambda s, cp: tracker.track_offsets(s, initial, path, cp))
    return out(versions.current_version(spark, path))


@query
def stream_mark_fold(spark, sf_dir):
    path = scratch_path(spark, "marks")

    def start(stream: DataFrame, checkpoint: str):
        writer = tracker.track_marks(stream).writeStream.outputMode("complete")
        writer = writer.foreachBatch(lambda df, n: versions.write_version(df, path, n) and None)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _replay(W.commands(W.stored_log(spark, sf_dir)), "seq", start)
    return out(versions.current_version(spark, path))


@query
def stream_marked_state(spark, sf_dir):
    """Marks from a given state, in Spark's own aggregation state, over restarts."""
    log, path = W.stored_log(spark, sf_dir), scratch_path(spark, "marked")
    initial = tracker.stored_positions(_state(log), scratch_path(spark, "positions"))

    def start(stream: DataFrame, checkpoint: str):
        writer = tracker.track_marks(stream, initial).writeStream.outputMode("complete")
        writer = writer.foreachBatch(lambda df, n: versions.write_version(df, path, n) and None)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _replay(W.commands(log), "seq", start)
    return out(versions.current_version(spark, path))


@query
def stream_auto_commit(spark, sf_dir):
    log = W.stored_log(spark, sf_dir).select(*TP, "offset", "event_id")
    initial = W.small(P.initial_state(log))
    state, commits = scratch_path(spark, "group-state"), scratch_path(spark, "commits")
    options = GroupOptions(group_id=GROUP, initial="oldest")

    def start(stream: DataFrame, checkpoint: str):
        return tracker.auto_commit(
            stream,
            lambda batch, n: None,
            initial,
            options,
            MEMBER,
            GENERATION,
            state,
            commits,
            checkpoint,
            trigger={"availableNow": True},
        )

    _replay(log, "event_id", start)
    return out(ST.latest_commits(CommitLog(commits).valid(spark)))


@query
def stream_topic_watch(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    sink = scratch_path(spark, "new-topics")
    known = TO.select_topics(TO.catalog(log), CORE)

    def start(stream: DataFrame, checkpoint: str):
        new = watch.watch_topics(stream, CORE, known, WHITELIST, BLACKLIST)
        return _to_table(sink)(new, checkpoint)

    _replay(log.select("topic", "event_id"), "event_id", start)
    return spark.read.schema("topic string").parquet(sink)


def _generations(spark, sf_dir) -> DataFrame:
    nothing = F.lit(None)
    owned = _assignments(spark, sf_dir).withColumn("stage", nothing.cast("string"))
    columns = owned.columns
    failed = W.failures(spark, sf_dir).withColumns(
        {"topic": nothing.cast("string"), "partition": nothing.cast("int")}
    )
    present = W.members(spark, sf_dir).select("generation", "member_id").distinct()
    present = present.withColumns(
        {
            "topic": nothing.cast("string"),
            "partition": nothing.cast("int"),
            "stage": nothing.cast("string"),
        }
    )
    return owned.unionByName(failed).unionByName(present).select(*columns)


@query
def stream_rebalance(spark, sf_dir):
    rows = _generations(spark, sf_dir)
    path = scratch_path(spark, "notifications")
    _replay(
        rows, "generation", lambda s, cp: notifications.rebalance_stream(s, path, cp)
    )
    return out(spark.read.parquet(f"{path}/partitions").drop(versions.VERSION))


@query
def stream_rebalance_parts(spark, sf_dir):
    """Attempts cut by the micro-batches: about half of the rows arrive a generation later."""
    rows = W.stored(_generations(spark, sf_dir).distinct(), "generations")
    sizes = rows.groupBy("generation", "member_id").agg(F.count(F.lit(1)).cast("int").alias("expected"))
    late = F.pmod(F.xxhash64("topic", "partition", "stage"), F.lit(2)).cast("int")
    rows = rows.join(sizes, ["generation", "member_id"]).withColumn("due", F.col("generation") + late)
    path = scratch_path(spark, "attempts")
    _replay(rows, "due", lambda s, cp: notifications.rebalance_stream(s, path, cp))
    return out(spark.read.parquet(f"{path}/partitions").drop(versions.VERSION))


@query
def stream_dedup(spark, sf_dir):
    sink = scratch_path(spark, "deduplicated")
    sent = W.deliveries(W.stored_log(spark, sf_dir))

    def start(stream: DataFrame, checkpoint: str):
        return _to_table(sink)(watch.dedup_deliveries(stream), checkpoint)

    _replay(sent, "offset", start)
    return out(spark.read.schema(sent.schema).parquet(sink).select(*TP, "offset"))


@query
def stream_resume(spark, sf_dir):
    log = W.stored_log(spark, sf_dir)
    sink, checkpoint = scratch_path(spark, "resumed"), scratch_path(spark, "checkpoint")
    options = GroupOptions(group_id=GROUP, initial="oldest", whitelist=WHITELIST, blacklist=BLACKLIST)
    stream = admission.resume_stream(
        spark,
        W.stored_log_path(spark, sf_dir),
        CORE,
        options,
        W.small(ST.log_bounds(log)),
        W.commits(log),
        scratch_path(spark, "starts"),
        schema=log.schema,
    )
    _to_table(sink)(stream, checkpoint).awaitTermination()
    return out(spark.read.schema(log.schema).parquet(sink).select(*TP, "offset", "event_id"))


def _grow(spark, sf_dir, start: Callable) -> None:
    """Append the growing log by thirds to one folder, as a partitioned table. After each part
    run ``start(path, log of what is there, checkpoint)`` until it is caught up."""
    log, n = W.growing_log(spark, sf_dir), W.event_count(spark, sf_dir)
    path, checkpoint = scratch_path(spark, "growing"), scratch_path(spark, "checkpoint")
    stored = W.small(log)
    for part in range(3):
        third = (F.col("event_id") * 3 >= part * n) & (F.col("event_id") * 3 < (part + 1) * n)
        write_topic_log(stored.where(third), path, mode="append")
        here = spark.read.schema(log.schema).parquet(path).select(*log.columns)
        start(path, here, checkpoint).awaitTermination()


def _half_commits(bounds: DataFrame) -> DataFrame:
    """The group has committed half of partition 0 of every topic, and nothing else."""
    return bounds.where("partition = 0").select(
        F.lit(GROUP).alias("group_id"),
        F.lit(GENERATION).alias("generation"),
        *TP,
        F.floor(F.col("newest") / 2).alias("offset"),
        F.lit("").alias("metadata"),
        F.lit(-1).cast("bigint").alias("retention_ms"),
        F.lit(0).alias("committed_at"),
        F.lit(0).alias("batch_id"),
    )


@query
def stream_resume_restarts(spark, sf_dir):
    """A read that starts at the newest message and is stopped and started twice. Partitions and
    topics appear in between; bounds and commits move on, and must not count again."""
    sink, starts = scratch_path(spark, "resumed"), scratch_path(spark, "starts")
    options = GroupOptions(group_id=GROUP, initial="newest", whitelist=WHITELIST, blacklist=BLACKLIST)

    def start(path: str, here: DataFrame, checkpoint: str):
        ranges = W.small(ST.log_bounds(here))
        stream = admission.resume_stream(
            spark, path, CORE, options, ranges, _half_commits(ranges), starts, schema=here.schema
        )
        return _to_table(sink)(stream, checkpoint)

    _grow(spark, sf_dir, start)
    return out(spark.read.schema("topic string, partition int, offset bigint, event_id bigint").parquet(sink))


@query
def stream_admission(spark, sf_dir):
    """Start positions that grow by what appears while the read runs."""
    path = scratch_path(spark, "admitted")
    options = GroupOptions(group_id=GROUP, initial="newest", whitelist=WHITELIST, blacklist=BLACKLIST)

    def start(source: str, here: DataFrame, checkpoint: str):
        ranges = W.small(ST.log_bounds(here))
        starts = admission.stored_starts(spark, path, ranges, _half_commits(ranges), GROUP, "newest")
        messages = admission.discovered(spark, source, CORE, options, here.schema)
        known = starts.where(admission.subscribed(F.col("topic"), CORE, options))
        return admission.run_admitting(
            messages, path, known, lambda *_: None, checkpoint, {"availableNow": True}
        )

    _grow(spark, sf_dir, start)
    grown = versions.current_version(spark, f"{path}/starts")
    return out(grown.select(*TP, "resolved_offset", "how"))


@query
def stream_admitted_marks(spark, sf_dir):
    """Progress of a stream whose partitions were all unknown at first."""
    nothing = spark.createDataFrame([], "topic string, partition int, offset bigint, metadata string, dirty boolean")
    state = scratch_path(spark, "offset-state")

    def start(source: str, here: DataFrame, checkpoint: str):
        log = spark.readStream.schema(here.schema).parquet(source)
        marks = log.select(
            F.col("event_id").alias("seq"), *TP, F.lit(P.MARK).alias("op"), "offset", F.lit("").alias("metadata")
        )
        return tracker.track_offsets(marks, nothing, state, checkpoint, admit=True)

    _grow(spark, sf_dir, start)
    return out(versions.current_version(spark, state))


@query
def stream_dedup_intervals(spark, sf_dir):
    """The same deliveries, remembered as intervals of offsets."""
    path = scratch_path(spark, "deduplicated")
    sent = W.deliveries(W.stored_log(spark, sf_dir))
    # The replay goes along a scrambled order, so that there are gaps to remember.
    mixed = sent.withColumn("place", F.col("offset") * 7919 % 1009)
    _replay(mixed, "place", lambda s, cp: seen.dedup_by_intervals(s, path, cp))
    return out(versions.all_versions(spark, f"{path}/messages").select(*TP, "offset"))


@query
def stream_partitioned_read(spark, sf_dir):
    """Running sum per topic-partition, by a handler, over several micro-batches."""
    path = scratch_path(spark, "partition-streams")
    log = W.stored_log(spark, sf_dir).select(*TP, "offset", "amount", "event_id")

    def start(stream: DataFrame, checkpoint: str):
        return partitions.run_partitions(stream, _running, _RUNNING, path, checkpoint, _carried())

    _replay(log, "event_id", start)
    return out(versions.all_versions(spark, f"{path}/output"))


# --- zone map ----------------------------------------------------------------


def _zoned(spark, sf_dir) -> tuple[str, DataFrame]:
    """The event log, appended in three parts to a log with a zone map."""
    log, path = W.stored_log(spark, sf_dir), scratch_path(spark, "zoned-log")
    n = W.event_count(spark, sf_dir)
    for part in range(3):
        third = (F.col("event_id") * 3 >= part * n) & (F.col("event_id") * 3 < (part + 1) * n)
        Z.append_zoned(log.where(third), path, rows_per_file=max(n // 30, 1))
    return path, log


@query
def zoned_read(spark, sf_dir):
    path, log = _zoned(spark, sf_dir)
    ranges = W.small(W.bounds(log))
    starts = ST.resolve_start(ST.with_defaults(W.committed(ranges), ranges), ranges, "oldest")
    return out(Z.read_zoned(spark, path, starts, log.schema).select(*TP, "offset", "event_id"))


@query
def zoned_ranges(spark, sf_dir):
    path, _ = _zoned(spark, sf_dir)
    return out(Z.zone_bounds(Z.zones_of(spark, path)))


# --- commit log --------------------------------------------------------------


def _member_commits(spark, sf_dir) -> tuple[CommitLog, DataFrame]:
    """A commit log to which three members wrote, and the error rows. Two batches come twice."""
    log = CommitLog(scratch_path(spark, "commit-log"))
    rows = W.attempts(W.stored_log(spark, sf_dir), W.event_count(spark, sf_dir))
    rows = settle(rows.withColumn("group_id", F.lit(GROUP))).rows
    registry = [(GROUP, 2, "m0"), (GROUP, 2, "m1"), (GROUP, 3, "m0"), (GROUP, 3, "m1")]
    members = spark.createDataFrame(registry, "group_id string, generation int, member_id string")
    log.open_generation(members, F.to_timestamp(F.lit("2000-01-01 00:00:00")))
    errors = []
    for part in ("batch_id < 4", "batch_id >= 4", "batch_id in (2, 5)"):
        for member in ("m0", "m1", "m2"):
            mine = rows.where(part).where(F.col("member_id") == member)
            again = log.write(mine, f"run-of-{member}")
            if "in" not in part:
                errors.append(again.errors)
    return log, C.errors_of(*errors)


@query
def member_commits(spark, sf_dir):
    """What is stored: batches of equal number of other members stay, repeats leave one copy."""
    log, _ = _member_commits(spark, sf_dir)
    return out(log.commits(spark).select("member_id", "batch_id", "generation", *TP, "offset", "metadata"))


@query
def refused_commits(spark, sf_dir):
    _, errors = _member_commits(spark, sf_dir)
    return out(errors)


@query
def compacted_commits(spark, sf_dir):
    """Newest commits, read from a snapshot and the epochs after it."""
    log = CommitLog(scratch_path(spark, "commit-log"))
    rows = W.attempts(W.stored_log(spark, sf_dir), W.event_count(spark, sf_dir))
    rows = settle(rows.where("generation = 3").withColumn("group_id", F.lit(GROUP))).rows
    for low in (0, 3, 5, 8):
        log.write(rows.where(f"batch_id >= {low} and batch_id < {low} + 3"), f"run-{low}")
        log.compact(spark)
    return out(ST.latest_commits(log.valid(spark), GROUP))
