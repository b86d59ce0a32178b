"""The shape of plans, and the ways taken beyond the size limits."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import delivery as D
from tidemark.operators import rebalance as R
from tidemark.operators import start as ST
from tidemark.options import GroupOptions
from tidemark.plans import bounded
from tidemark.plans.group_read import read_group
from tidemark.plans.ordering import with_position
from tidemark.sources import topic_log as TL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once_to_be_numbered(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.range(200_000).selectExpr("if(id % 3 > 0, 'hot', concat('g', id % 50)) AS g", "id").write.parquet(path)
    plan = plan_of(with_position(spark.read.parquet(path), ["g"], ["id"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(g" in plan and "__slice" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_null_groups_are_an_error(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "g string, id bigint")
    with pytest.raises(ValueError, match="null"):
        with_position(df, ["g"], ["id"])


def test_first_messages_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "log")
    TL.write_topic_log(TL.seed(spark, 50, ["a"]), path)
    plan = plan_of(D.take_messages(TL.read_topics(spark, path, ["a"]), 2, per_partition=True))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_many_starts_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "settle", lambda df: bounded.settle(df, max_rows=3))
    path = str(tmp_path / "log")
    TL.write_topic_log(TL.seed(spark, 200, ["a", "b"]), path)
    log = TL.read_topics(spark, path, ["a", "b"])
    starts = [(t, p, -1, "", 5, 5, "committed") for t in "ab" for p in range(4)]
    read = ST.read_from(log, spark.createDataFrame(starts, S.STARTS))
    assert read.count() == log.where("offset >= 5").count()


def test_histories_of_any_size_are_the_same(spark, monkeypatch):
    rng = random.Random(2)
    owned = [(g, f"m{m}", "t", p) for g in range(12) for m in range(6) for p in range(8) if rng.random() < 0.4]
    stages = [(g, f"m{m}", rng.choice(R.STAGES)) for g in range(12) for m in range(6) if rng.random() < 0.3]
    assignments = spark.createDataFrame(owned, S.ASSIGNMENTS)
    failures = spark.createDataFrame(stages, S.FAILURES)
    small = sorted(tuple(r) for r in R.rebalance_rows(assignments, failures).collect())
    monkeypatch.setattr(R, "settle", lambda df: bounded.settle(df, max_rows=5))
    assert sorted(tuple(r) for r in R.rebalance_rows(assignments, failures).collect()) == small
    # The flat rows and the maps tell the same.
    nested = set()
    for r in R.rebalance_events(assignments, failures).collect():
        for change in ("claimed", "released", "current"):
            nested |= {(r.generation, r.member_id, r.type, change, t, p) for t, ps in r[change].items() for p in ps}
    assert nested == set(small)


def test_group_read_by_mode(spark, tmp_path):
    path = str(tmp_path / "log")
    TL.write_topic_log(TL.seed(spark, 300, ["topic-a", "topic-b"]), path)
    commits = spark.createDataFrame([("g", "m", 1, "topic-a", 0, 10, "", -1, None, 0)], S.COMMITS)
    options = GroupOptions("g", initial="oldest", whitelist=r"topic-\w+", blacklist="[bcd]$")
    got = read_group(spark, path, [], commits, options)
    log = TL.read_topics(spark, path, ["topic-a"])
    assert got.count() == log.where("partition <> 0 OR offset >= 10").count()

    def count(info, batches):
        import pandas as pd

        yield pd.DataFrame([[info.topic, info.partition, info.initial_offset, sum(map(len, batches))]])

    options = GroupOptions("g", mode="partitions", initial="oldest")
    schema = "topic string, partition int, initial bigint, n bigint"
    rows = read_group(spark, path, ["topic-a"], commits, options, count, schema).collect()
    assert {r.partition: r.initial for r in rows} == {0: 10, 1: -2, 2: -2, 3: -2}
    assert sum(r.n for r in rows) == got.count()
    with pytest.raises(ValueError):
        read_group(spark, path, ["topic-a"], commits, options)


def test_large_differences_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Owned partitions in order take few bytes in files and many in memory."""
    path = str(tmp_path / "owned")
    rows = spark.range(0, 300_000, 1, 1).selectExpr(
        "cast(1 + id div 150000 AS int) AS generation", "concat('m', id div 30000 % 5) AS member_id", "'t' AS topic",
        "cast(id % 150000 AS int) AS partition",
    )
    rows.write.parquet(path)
    owned = spark.read.parquet(path)
    before = owned.where("generation = 1 AND partition >= 10")
    for got, n in ((R.claimed_rows(before, owned), 20), (R.released_rows(owned, before), 20)):
        assert got.count() == n
        assert "BroadcastHashJoin" not in plan_of(got) and "SortMergeJoin" in plan_of(got)
    monkeypatch.setattr(R, "settle", lambda df: bounded.settle(df, max_rows=1000))
    history = R.rebalance_rows(owned)
    anti = [line for line in plan_of(history).splitlines() if "LeftAnti" in line]
    assert len(anti) == 2 and all("SortMergeJoin" in line for line in anti)
    assert {(r.change, r["count"]) for r in history.groupBy("change").count().collect()} == {("current", 300_000), ("claimed", 150_000)}


def test_a_side_beyond_the_limit_is_joined_by_shuffle(spark):
    rows = spark.range(50)
    for most, kind in ((100, "BroadcastHashJoin"), (10, "SortMergeJoin")):
        assert kind in plan_of(spark.range(10).join(bounded.settle(rows, max_rows=most).df, "id"))
