import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import scalars as fn
from tidemark.operators import commit as C
from tidemark.operators import delivery as D
from tidemark.operators import progress as P
from tidemark.operators import start as ST
from tidemark.operators import topics as TO
from tidemark.options import GroupOptions, OptionError
from tidemark.sources import kafka
from tidemark.sources import topic_log as TL


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("logs") / "log")
    TL.write_topic_log(TL.seed(spark, 500, ["topic-a", "topic-b"]), path)
    return TL.read_topics(spark, path, ["topic-a", "topic-b"]), path


def test_seeded_log(log):
    df, _ = log
    assert df.count() == 1000
    rows = df.where("topic = 'topic-a'").orderBy("value").collect()
    assert [bytes(r.value).decode() for r in rows] == [f"PLAINDATA-{i:08d}" for i in range(500)]
    assert all(r.key == r.value for r in rows)
    for r in ST.log_bounds(df).collect():
        assert r.oldest == 0
    counts = {(r.topic, r.partition): r["count"] for r in df.groupBy("topic", "partition").count().collect()}
    assert {(r.topic, r.partition): r.high_water_mark for r in ST.high_water_marks(df).collect()} == counts


def test_topic_patterns(spark):
    catalog = spark.createDataFrame([(f"topic-{c}", 0) for c in "abcd"] + [("other", 0)], S.CATALOG)

    def selected(core, white=None, black=None):
        return sorted((r.topic, r.origin) for r in TO.select_topics(catalog, core, white, black).collect())

    assert selected([], r"topic-\w+", "[bcd]$") == [("topic-a", "extra")]
    assert selected(["topic-b"], r"topic-\w+", "[bcd]$") == [("topic-a", "extra"), ("topic-b", "core")]
    assert selected(["topic-b", "topic-b"], None, "a") == [("topic-b", "core")]
    assert selected(["gone"], "the") == [("gone", "core"), ("other", "extra")]


def test_start_positions(spark):
    bounds = spark.createDataFrame([("t", p, 1000, 3000) for p in range(6)], S.BOUNDS)
    committed = [("t", 0, 2000, "first"), ("t", 1, 200, "first"), ("t", 2, -1, ""), ("t", 3, 3000, ""), ("t", 4, 3001, "x"), ("t", 5, 1000, "")]
    committed = spark.createDataFrame(committed, S.COMMITTED)
    got = {r.partition: tuple(r)[2:] for r in ST.resolve_start(committed, bounds, "oldest").collect()}
    assert got == {
        0: (2000, "first", 2000, 2000, "committed"),
        1: (-1, "first", -2, 1000, "out_of_range"),
        2: (-1, "", -2, 1000, "default"),
        3: (3000, "", 3000, 3000, "committed"),
        4: (-1, "x", -2, 1000, "out_of_range"),
        5: (1000, "", 1000, 1000, "committed"),
    }
    newest = {r.partition: (r.initial_offset, r.resolved_offset) for r in ST.resolve_start(committed, bounds).collect()}
    assert newest[1] == newest[2] == newest[4] == (-1, 3000)
    state = P.state_from_starts(ST.resolve_start(committed, bounds))
    assert state.where("partition = 1").first()[2:] == (-1, "first", False)
    with pytest.raises(OptionError):
        ST.resolve_start(committed, bounds, "latest")


def test_next_offset(spark):
    df = spark.createDataFrame([(-2,), (-1,), (0,), (100,)], "o bigint")
    for fallback in (-2, -1):
        got = [r.n for r in df.select(fn.next_offset("o", F.lit(fallback)).alias("n")).collect()]
        assert got == [fallback, fallback, 0, 100]


def test_read_from_filters_at_the_scan(spark, log):
    df, path = log
    rows = [("topic-a", p, -1, "", 50 + p, 50 + p, "committed") for p in range(4)]
    starts = spark.createDataFrame(rows, S.STARTS)
    read = ST.read_from(df, starts)
    want = {(r.topic, r.partition, r.offset) for r in df.collect() if r.topic == "topic-a" and r.offset >= 50 + r.partition}
    assert {(r.topic, r.partition, r.offset) for r in read.collect()} == want
    plan = read.select("offset")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,50)" in plan and "PartitionFilters: [isnotnull(topic" in plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    through = TL.read_topics(spark, path, ["topic-a"], starts)
    assert through.count() == len(want)


def test_commit_write_is_idempotent_and_dirty_only(spark, tmp_path):
    path = str(tmp_path / "commits")
    state = spark.createDataFrame([("t", 0, 5, "a", True), ("t", 1, 7, "b", False), ("t", 2, 9, "c", True)], S.OFFSET_STATE)
    for _ in range(2):
        results = C.commit_offsets(state, path, "g", "m", 4, batch_id=3)
    C.commit_offsets(state.withColumn("dirty", F.lit(False)), path, "g", "m", 4, batch_id=3)
    stored = C.read_commits(spark, path)
    assert sorted(tuple(r) for r in stored.select("partition", "offset", "metadata", "generation", "retention_ms", "batch_id").collect()) == [(0, 5, "a", 4, -1, 3), (2, 9, "c", 4, -1, 3)]
    assert P.mark_committed(state, results).where("dirty").count() == 0
    later = spark.createDataFrame([("t", 0, 6, "a2", True)], S.OFFSET_STATE)
    C.commit_offsets(later, path, "g", "m", 5, batch_id=4)
    C.commit_offsets(later, path, "other", "m", 5, batch_id=4)
    subs = spark.createDataFrame([("t", p) for p in range(3)], S.CATALOG)
    got = ST.fetch_committed(C.read_commits(spark, path), subs, "g").collect()
    assert {r.partition: (r.offset, r.metadata) for r in got} == {0: (6, "a2"), 1: (-1, ""), 2: (9, "c")}
    old = C.commit_rows(later, "g", "m", 4)
    stale = C.stale_commits(old, C.read_commits(spark, path))
    errors = C.errors_of(C.error_rows(stale, "commit", "illegal generation")).collect()
    assert [tuple(r) for r in errors] == [("commit", "t", 0, 6, "illegal generation")]
    rejected = C.error_rows(stale, "commit", "illegal generation")
    assert C.commit_results(old, rejected).first()[3] == "illegal generation"


def test_expired_commits_are_not_fetched(spark):
    at = datetime(2024, 1, 1)
    rows = [("g", "m", 1, "t", 0, 5, "", 1000, at, 1), ("g", "m", 1, "t", 1, 6, "", -1, at, 1)]
    commits = spark.createDataFrame(rows, S.COMMITS)
    subs = spark.createDataFrame([("t", 0), ("t", 1)], S.CATALOG)
    got = ST.fetch_committed(commits, subs, "g", retained_after=datetime(2024, 1, 2)).collect()
    assert {r.partition: r.offset for r in got} == {0: -1, 1: 6}


def test_an_older_commit_does_not_come_back(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [("g", "m", 1, "t", 0, 31, "", -1, old, 1), ("g", "m", 1, "t", 0, 84, "", 10, new, 2)]
    commits = spark.createDataFrame(rows, S.COMMITS)
    subs = spark.createDataFrame([("t", 0)], S.CATALOG)
    assert ST.fetch_committed(commits, subs, "g", retained_after=datetime(2024, 1, 3)).first().offset == -1


def test_lines(log, tmp_path, spark):
    df, _ = log
    one = df.where("topic = 'topic-a' AND partition = 1 AND offset = 3")
    text = bytes(one.first().value).decode()
    assert D.format_lines(one, with_key=False).first().value == f"topic-a/1/3\t{text}"
    assert D.format_lines(one).first().value == f"topic-a/1/3\t{text}\t{text}"
    D.write_lines(one, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 1


def test_partition_handlers_see_ordered_streams(spark, log):
    df, _ = log

    def handle(info, batches):
        import pandas as pd

        offsets = [o for b in batches for o in b["offset"]]
        ordered = offsets == list(range(offsets[0], offsets[0] + len(offsets)))
        yield pd.DataFrame([[info.topic, info.partition, info.initial_offset, info.segment, len(offsets), ordered]])

    schema = "topic string, partition int, initial bigint, segment int, n bigint, ordered boolean"
    rows = [("topic-a", p, -1, "", -2, 0, "default") for p in range(4)]
    whole = D.for_each_partition(df, handle, schema, starts=spark.createDataFrame(rows, S.STARTS)).collect()
    assert len(whole) == 8 and all(r.ordered and r.segment == 0 for r in whole)
    assert {r.initial for r in whole if r.topic == "topic-a"} == {-2}
    split = D.for_each_partition(df, handle, schema, split=True, slices=5).collect()
    assert len(split) == 40 and all(r.ordered for r in split)
    assert sum(r.n for r in split) == sum(r.n for r in whole) == 1000
    with pytest.raises(ValueError):
        D.for_each_partition(df, handle, schema, carry={"n": F.lit(1)})


def test_handler_that_stops_early(spark, log):
    def first(info, batches):
        yield next(batches).head(1)[["topic", "partition", "offset"]]

    got = D.for_each_partition(log[0], first, "topic string, partition int, offset bigint").collect()
    assert len(got) == 8 and all(r.offset == 0 for r in got)


def test_first_messages(log):
    df, _ = log
    assert [tuple(r)[:3] for r in D.take_messages(df, 3).collect()] == [("topic-a", 0, o) for o in range(3)]
    each = D.take_messages(df, 2, per_partition=True).collect()
    assert sorted((r.topic, r.partition, r.offset) for r in each) == [(t, p, o) for t in ("topic-a", "topic-b") for p in range(4) for o in range(2)]


def test_options():
    options = GroupOptions()
    assert (options.strategy, options.mode, options.commit_retries) == ("range", "multiplex", 3)
    assert (options.retention_ms, options.initial_offset) == (-1, -1)
    assert GroupOptions(strategy="sticky").strategy == "range"
    assert GroupOptions(commit_retention_ms=5).retention_ms == 5
    for bad in ({"mode": "x"}, {"initial": "x"}, {"commit_retries": -1}, {"commit_interval_ms": 0}, {"whitelist": "("}):
        with pytest.raises(OptionError):
            GroupOptions(**bad)


def test_kafka_options(spark):
    starts = spark.createDataFrame([("b", 0, -1, "", -1, 9, "default"), ("a", 1, 5, "", 5, 5, "committed")], S.STARTS)
    options = kafka.kafka_read_options("h:9092", ["b", "a"], starts, max_offsets_per_trigger=10)
    assert json.loads(options.pop("startingOffsets")) == {"a": {"1": 5}, "b": {"0": -1}}
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka.kafka_read_options("h", ["a"], initial="oldest")["startingOffsets"] == "earliest"
    assert kafka.kafka_read_options("h", ["a"])["startingOffsets"] == "latest"
    assert "startingOffsets" not in kafka.kafka_read_options("h", ["a"], stream=False)
    assert kafka.kafka_write_options("h", "t") == {"kafka.bootstrap.servers": "h", "topic": "t"}
    with pytest.raises(OptionError):
        kafka.kafka_read_options("h", ["a"], initial="x")
