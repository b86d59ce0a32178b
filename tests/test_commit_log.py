"""Commits of several members: batches that survive each other, fenced generations, snapshots."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import progress as P
from tidemark.operators import start as ST
from tidemark.operators.commit import commit_offsets, read_commits
from tidemark.operators.commit_log import ILLEGAL_GENERATION, UNKNOWN_MEMBER, CommitLog
from tidemark.streaming import tracker

MEMBERS = "group_id string, generation int, member_id string"


def second(n):
    return F.timestamp_seconds(F.lit(n))


def rows(spark, *commits):
    """Commits (member, generation, partition, offset, second, batch) of group g."""
    full = [("g", m, g, "t", p, o, f"{m}{o}", -1, b) for m, g, p, o, _, b in commits]
    ddl = (
        "group_id string, member_id string, generation int, topic string, partition int, offset bigint, "
        "metadata string, retention_ms bigint, batch_id bigint"
    )
    times = {(m, o): t for m, _, _, o, t, _ in commits}
    df = spark.createDataFrame(full, ddl)
    at = F.create_map(*(F.lit(x) for (m, o), t in times.items() for x in (f"{m}{o}", t)))
    return df.withColumn("committed_at", F.timestamp_seconds(at[F.col("metadata")]))


def opened(spark, log, generation, members, at):
    log.open_generation(spark.createDataFrame([("g", generation, m) for m in members], MEMBERS), second(at))


def newest(spark, log):
    return {(r.partition): (r.offset, r.metadata) for r in ST.latest_commits(log.valid(spark), "g").collect()}


def test_equal_batches_of_members_and_writers_stay(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    for member, writer in (("a", "one"), ("b", "one"), ("a", "two"), ("a", "one"), ("b", "one")):
        log.write(rows(spark, (member, 1, 0, 5, 10, 0), (member, 1, 1, 6, 10, 0)), writer)
    kept = sorted((r.member_id, r.writer, r.partition) for r in log.commits(spark).collect())
    assert kept == [(m, w, p) for m, w in (("a", "one"), ("a", "two"), ("b", "one")) for p in (0, 1)]


def test_calls_without_a_batch_number_do_not_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "commits")
    for p in (0, 1, 0):
        state = spark.createDataFrame([("t", p, 3, "", True)], S.OFFSET_STATE)
        commit_offsets(state, path, "g", "m", 1)
    assert read_commits(spark, path).count() == 3


def test_stale_and_unknown_members_are_refused(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    opened(spark, log, 4, ["a", "b"], 0)
    opened(spark, log, 5, ["a"], 100)
    first = log.write(rows(spark, ("a", 5, 0, 7, 110, 0), ("a", 4, 1, 8, 110, 0), ("b", 5, 2, 9, 110, 0), ("a", 6, 3, 1, 110, 0)), "w")
    why = {r.partition: r.error for r in first.results.collect()}
    assert why == {0: None, 1: ILLEGAL_GENERATION, 2: UNKNOWN_MEMBER, 3: ILLEGAL_GENERATION}
    assert sorted((r.ctx, r.partition, r.message) for r in first.errors.collect()) == [
        ("commit", 1, ILLEGAL_GENERATION), ("commit", 2, UNKNOWN_MEMBER), ("commit", 3, ILLEGAL_GENERATION),
    ]
    state = spark.createDataFrame([("t", 0, 7, "", True), ("t", 1, 8, "", True), ("t", 2, 9, "", True)], S.OFFSET_STATE)
    assert {r.partition: r.dirty for r in P.mark_committed(state, first.results).collect()} == {0: False, 1: True, 2: True}
    assert newest(spark, log) == {0: (7, "a7")}


def test_what_a_member_writes_after_its_generation_ended_is_not_read(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    opened(spark, log, 1, ["a"], 0)
    log.write(rows(spark, ("a", 1, 0, 5, 50, 0), ("a", 1, 1, 5, 150, 1)), "w")  # judged before 100, written after
    opened(spark, log, 2, ["b"], 100)
    log.write(rows(spark, ("b", 2, 0, 4, 120, 0)), "w")
    assert newest(spark, log) == {0: (4, "b4")}


def test_without_generations_older_ones_than_stored_are_refused(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    assert log.write(rows(spark, ("a", 3, 0, 5, 1, 0)), "w").errors.count() == 0
    late = log.write(rows(spark, ("b", 2, 0, 9, 2, 0), ("a", 3, 1, 6, 2, 1)), "w")
    assert [r.message for r in late.errors.collect()] == [ILLEGAL_GENERATION]
    assert newest(spark, log) == {0: (5, "a5"), 1: (6, "a6")}


def test_null_groups_members_and_generations_are_refused(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    given = rows(spark, ("a", 3, 0, 5, 1, 0), ("a", 3, 1, 6, 1, 0), ("a", 3, 2, 7, 1, 0), ("a", 3, 3, 8, 1, 0))
    for p, name in ((0, "group_id"), (1, "member_id"), (2, "generation")):
        given = given.withColumn(name, F.when(F.col("partition") != p, F.col(name)))
    refused = {r.partition: r.message for r in log.write(given, "w").errors.collect()}
    assert refused == {0: UNKNOWN_MEMBER, 1: UNKNOWN_MEMBER, 2: ILLEGAL_GENERATION}
    assert log.commits(spark).count() == 1


def test_snapshots_equal_the_whole_history(spark, tmp_path):
    rng = random.Random(4)
    log, model, offset = CommitLog(str(tmp_path / "log")), {}, 0
    for step in range(9):
        batch = []
        for p in rng.sample(range(6), 3):
            offset += 1
            batch.append(("a", 1, p, offset, 10 + step, step))
            model[p] = (offset, f"a{offset}")
        log.write(rows(spark, *batch), "w")
        if step % 2:
            log.compact(spark)
        assert newest(spark, log) == model
    # A reader takes one record per topic-partition and the last two epochs, not the history.
    assert log.commits(spark).count() <= 6 + 3 * 4
    assert read_commits(spark, str(tmp_path / "log" / "commits")).count() == 27


def test_a_writer_in_the_epoch_before_is_not_overlooked(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    log.write(rows(spark, ("a", 1, 0, 5, 1, 0)), "w")
    epoch = next((tmp_path / "log" / "commits").glob("epoch=*")).name
    log.compact(spark)
    from tidemark.operators.commit import write_commits

    write_commits(rows(spark, ("a", 1, 1, 6, 2, 1)), str(tmp_path / "log" / "commits" / epoch), "slow")
    assert newest(spark, log) == {0: (5, "a5"), 1: (6, "a6")}
    log.compact(spark)
    assert newest(spark, log) == {0: (5, "a5"), 1: (6, "a6")}


def test_newest_times_need_no_sorted_aggregation_of_the_log(spark, tmp_path):
    path = str(tmp_path / "commits")
    rows(spark, *(("a", 1, p, o, o, 0) for p in range(3) for o in range(20))).write.parquet(path)
    commits = spark.read.parquet(path)
    plan = ST.newest_commits(commits)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("BroadcastHashJoin")[-1], plan
    assert {r.partition: r.offset for r in ST.newest_commits(commits).collect()} == {0: 19, 1: 19, 2: 19}


def test_retry_leaves_alone_what_it_cannot_mend():
    calls = []

    def commit():
        calls.append(1)
        raise ValueError("wrong argument")

    with pytest.raises(ValueError):
        tracker.commit_with_retry(commit, 5, pause=0)
    assert len(calls) == 1
