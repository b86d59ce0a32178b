import random

import pytest
from pyspark.sql import functions as F

from tests.model import partition_rule
from tidemark import schemas as S
from tidemark.operators.commit_log import CommitLog
from tidemark.operators import rebalance
from tidemark.operators import start as ST
from tidemark.options import GroupOptions
from tidemark.schemas import TP
from tidemark.streaming import notifications, tracker, versions, watch
from tidemark.streaming.notifications import GENERATION_PARTS, GENERATIONS, rebalance_stream
from tidemark.workloads import queries


def run(query):
    query.awaitTermination()


def test_offsets_are_tracked_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(3)
    keys = [("t", p) for p in range(5)]
    state = {k: (rng.randint(-1, 10), "base", False) for k in keys[:4]}
    initial = spark.createDataFrame([(*k, *v) for k, v in state.items()], S.OFFSET_STATE)
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "state", "cp"))
    seq = 0
    for _ in range(3):
        commands = [
            (*rng.choice(keys), rng.choice(["mark", "reset"]), rng.randint(-1, 12), f"m{seq + i}")
            for i in range(40)
        ]
        rows = [(seq + i, t, p, op, o, m) for i, (t, p, op, o, m) in enumerate(commands)]
        rng.shuffle(rows)
        spark.createDataFrame(rows, S.COMMANDS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(S.COMMANDS).parquet(source)
        run(tracker.track_offsets(stream, initial, path, checkpoint))
        state, seq = partition_rule(state, commands), seq + 40
        got = versions.current_version(spark, path).collect()
        assert {(r.topic, r.partition): (r.offset, r.metadata, r.dirty) for r in got} == state
    assert versions.last_batch(spark, path) == 2


def messages(spark, path, offsets):
    rows = [("t", p, o) for p in range(2) for o in offsets]
    spark.createDataFrame(rows, "topic string, partition int, offset bigint").write.mode("append").parquet(path)
    return spark.readStream.schema("topic string, partition int, offset bigint").parquet(path)


def test_commits_follow_the_handler(spark, tmp_path):
    source, state, commits, checkpoint = (str(tmp_path / n) for n in ("in", "state", "commits", "cp"))
    initial = spark.createDataFrame([("t", p, -1, "", False) for p in range(2)], S.OFFSET_STATE)
    options = GroupOptions(group_id="g", initial="oldest")
    seen = []

    def process(batch, batch_id):
        seen.extend((r.partition, r.offset) for r in batch.collect())
        return tracker.marks_of(batch.where("partition = 1"), "done")

    def start(stream, handler):
        return tracker.auto_commit(
            stream, handler, initial, options, "m", 1, state, commits, checkpoint,
            commit_every=2, trigger={"availableNow": True},
        )

    def committed():
        subs = spark.createDataFrame([("t", 0), ("t", 1)], S.CATALOG)
        rows = ST.fetch_committed(CommitLog(commits).valid(spark), subs, "g").collect()
        return {r.partition: (r.offset, r.metadata) for r in rows}

    def fails(batch, batch_id):
        raise RuntimeError("handler failed")

    with pytest.raises(Exception, match="handler failed"):
        run(start(messages(spark, source, range(5)), fails))
    run(start(spark.readStream.schema("topic string, partition int, offset bigint").parquet(source), process))
    assert not (tmp_path / "commits").exists()  # the first of two micro-batches does not commit
    run(start(messages(spark, source, range(5, 9)), process))
    assert committed() == {0: (-1, ""), 1: (9, "done")}
    run(start(messages(spark, source, range(9, 12)), process))
    assert committed()[1] == (9, "done")
    after = tracker.release(spark, options, "m", 1, state, commits)
    assert committed()[1] == (12, "done") and after.where("dirty").count() == 0
    assert sorted(seen) == [(p, o) for p in range(2) for o in range(12)]


def test_commit_retry_is_bounded():
    calls = []

    def commit():
        calls.append(1)
        if len(calls) < 4:
            raise IOError("busy")

    tracker.commit_with_retry(commit, 3, pause=0)
    assert len(calls) == 4
    calls.clear()
    with pytest.raises(IOError):
        tracker.commit_with_retry(commit, 2, pause=0)
    assert len(calls) == 3


def test_new_topics_are_reported_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    known = spark.createDataFrame([("topic-known",)], "topic string")
    for names in (["topic-a", "topic-core", "topic-known", "x"], ["topic-a", "topic-b", "topic-c"]):
        spark.createDataFrame([(n, 0) for n in names], S.CATALOG).write.mode("append").parquet(source)
        stream = spark.readStream.schema(S.CATALOG).parquet(source)
        new = watch.watch_topics(stream, ["topic-core"], known, "topic-", "c$")
        run(new.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    assert sorted(r.topic for r in spark.read.schema("topic string").parquet(sink).collect()) == ["topic-a", "topic-b"]


def test_notifications_carry_the_base_over_batches(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [
        [(1, "m", "t", 0, None), (1, "m", "t", 1, None), (1, "n", None, None, None)],
        [(2, "m", "t", 1, None), (2, "m", "t", 2, None), (2, "n", None, None, "refresh")],
        [(3, "m", None, None, "subscribe"), (3, "n", "t", 0, None)],
        [(4, "m", "t", 5, None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, GENERATIONS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(GENERATIONS).parquet(source)
        run(rebalance_stream(stream, path, checkpoint))
    events = spark.read.parquet(f"{path}/events").where("step = 1").collect()
    assert sorted((r.generation, r.member_id, r.type) for r in events) == [
        (1, "m", "rebalance OK"), (1, "n", "rebalance OK"), (2, "m", "rebalance OK"),
        (3, "m", "rebalance error"), (3, "n", "rebalance OK"), (4, "m", "rebalance OK"),
    ]
    parts = spark.read.parquet(f"{path}/partitions").collect()
    got = sorted((r.generation, r.member_id, r.change, r.partition) for r in parts)
    assert got == [
        (1, "m", "claimed", 0), (1, "m", "claimed", 1), (1, "m", "current", 0), (1, "m", "current", 1),
        (2, "m", "claimed", 2), (2, "m", "current", 1), (2, "m", "current", 2), (2, "m", "released", 0),
        (3, "m", "current", 1), (3, "m", "current", 2), (3, "n", "claimed", 0), (3, "n", "current", 0),
        (4, "m", "claimed", 5), (4, "m", "current", 5),
    ]


def test_attempts_arrive_in_parts(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    attempts = {
        (1, "m"): [("t", 0, None), ("t", 1, None)],
        (2, "m"): [("t", 1, None), ("t", 2, None), ("t", 3, None)],
        (1, "n"): [(None, None, None)],
        (3, "m"): [(None, None, "subscribe")],
    }
    rows = [(*key, *row, len(own)) for key, own in attempts.items() for row in own]
    by_batch = [[rows[0], rows[5]], [rows[0], rows[2]], [rows[1], rows[3]], [rows[6]], [rows[4], rows[2]]]
    finished = []
    for part in by_batch:
        spark.createDataFrame(part, GENERATION_PARTS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(GENERATION_PARTS).parquet(source)
        run(rebalance_stream(stream, path, checkpoint))
        events = spark.read.parquet(f"{path}/events").where("step = 1").collect()
        finished.append(sorted((r.generation, r.member_id, r.type) for r in events))
    one, two = (1, "n", "rebalance OK"), (1, "m", "rebalance OK")
    last = [two, one, (2, "m", "rebalance OK"), (3, "m", "rebalance error")]
    assert finished == [[one], [one], [two, one], [two, one], last]
    parts = spark.read.parquet(f"{path}/partitions").collect()
    got = sorted((r.generation, r.member_id, r.change, r.partition) for r in parts)
    assert got == [
        (1, "m", "claimed", 0), (1, "m", "claimed", 1), (1, "m", "current", 0), (1, "m", "current", 1),
        (2, "m", "claimed", 2), (2, "m", "claimed", 3), (2, "m", "current", 1), (2, "m", "current", 2),
        (2, "m", "current", 3), (2, "m", "released", 0),
        (3, "m", "current", 1), (3, "m", "current", 2), (3, "m", "current", 3),
    ]
    assert spark.read.parquet(versions.version_path(f"{path}/held", 4)).isEmpty()


def test_marks_start_from_positions(spark, tmp_path):
    rng = random.Random(12)
    state = {("t", p): (rng.randint(-1, 20), f"base{p}", False) for p in range(4)}
    initial = spark.createDataFrame([(*k, *v[:2]) for k, v in state.items()], S.COMMITTED)
    source, positions, out, checkpoint = (str(tmp_path / n) for n in ("in", "positions", "out", "cp"))
    seq = 0
    for _ in range(3):
        marks = [("t", rng.randint(0, 5), "mark", rng.randint(0, 25), f"m{seq + i}") for i in range(12)]
        rows = [(seq + i, t, p, op, o, m) for i, (t, p, op, o, m) in enumerate(marks)]
        spark.createDataFrame(rows, S.COMMANDS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(S.COMMANDS).parquet(source)
        tracked = tracker.track_marks(stream, tracker.stored_positions(initial, positions))
        write = lambda df, n: versions.write_version(df, out, n) and None
        run(tracked.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        state, seq = partition_rule(state, marks), seq + 12
        # A restart takes the stored positions, whatever it is given.
        initial = initial.withColumn("offset", F.col("offset") + 100)
        got = versions.current_version(spark, out).collect()
        assert {(r.topic, r.partition): (r.offset, r.metadata, r.dirty) for r in got} == state


def test_repeats_within_a_time_limit(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "topic string, partition int, offset bigint, timestamp timestamp"
    rows = spark.range(50).selectExpr("'t' AS topic", "0 AS partition", "id % 20 AS offset", "timestamp'2024-01-01' AS timestamp")
    rows.write.parquet(source)
    stream = watch.dedup_deliveries(spark.readStream.schema(schema).parquet(source), ttl="1 hour")
    run(stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    got = spark.read.schema(schema).parquet(sink)
    assert sorted(r.offset for r in got.select(*TP, F.col("offset")).collect()) == list(range(20))


def test_attempts_are_found_once_in_a_batch(spark, tmp_path, monkeypatch):
    """Those of earlier batches are the base of new ones, and are not joined again."""
    calls, joined = [], []
    found, joins = notifications.rebalance_attempts, notifications.attempt_rows
    for module in (notifications, rebalance):
        monkeypatch.setattr(module, "rebalance_attempts", lambda *a: calls.append(1) or found(*a))
    monkeypatch.setattr(notifications, "attempt_rows", lambda o, a: joined.append(a.count()) or joins(o, a))
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for generation in (1, 2):
        rows = [(generation, m, "t", p, None, 2) for m in "ab" for p in (generation, generation + 1)]
        spark.createDataFrame(rows, GENERATION_PARTS).write.mode("append").parquet(source)
        run(rebalance_stream(spark.readStream.schema(GENERATION_PARTS).parquet(source), path, checkpoint))
    got = versions.all_versions(spark, f"{path}/partitions").where("member_id = 'a'").collect()
    assert sorted((r.generation, r.change, r.partition) for r in got) == [
        (1, "claimed", 1), (1, "claimed", 2), (1, "current", 1), (1, "current", 2),
        (2, "claimed", 3), (2, "current", 2), (2, "current", 3), (2, "released", 1),
    ]
    assert len(calls) == 2 and joined == [2, 2]


def test_a_replayed_table_is_computed_once(spark, tmp_path):
    read, sink = spark.sparkContext.accumulator(0), str(tmp_path / "out")

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    queries._replay(spark.range(300).mapInPandas(counted, "id long"), "id", queries._to_table(sink))
    assert spark.read.parquet(sink).distinct().count() == 300 and read.value == 300


def test_a_replay_is_cut_between_few_values(spark, tmp_path):
    """However many rows share a value; rows without a value are not lost."""
    rows = spark.range(20_000).selectExpr("id", "nullif(id % 6, 5) AS day")
    seen = []

    def start(stream, checkpoint):
        keep = lambda df, n: seen.append((n, [tuple(r) for r in df.groupBy("day").count().collect()]))
        return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    queries._replay(rows, "day", start)
    assert [n for n, _ in seen] == [0, 1, 2]
    assert [{day for day, _ in days} for _, days in seen] == [{None, 0}, {1}, {2, 3, 4}]
    assert sum(n for _, days in seen for _, n in days) == 20_000


def test_replayed_attempts_are_held_over_the_cuts(spark, tmp_path, monkeypatch):
    events = spark.range(20_000).selectExpr(
        "id AS event_id",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 5)) AS ts",
        "id * 7 % 900 AS user_id",
        "element_at(array('click', 'view', 'error'), int(id % 3) + 1) AS event_type",
        "0D AS value",
        "'' AS props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    held, write = [], notifications.write_version

    def counted(df, path, batch_id):
        stored = write(df, path, batch_id)
        if path.endswith("/held"):
            held.append((batch_id, stored.count()))
        return stored

    monkeypatch.setattr(notifications, "write_version", counted)
    got = queries.stream_rebalance_parts(spark, str(tmp_path))
    assert [n for n, _ in held] == [0, 1, 2]
    assert [rows > 0 for _, rows in held] == [True, True, False]
    want = queries.rebalance_history(spark, str(tmp_path))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
