"""Streams that restart, admit, remember, and call a handler once."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import delivery as D
from tidemark.operators import start as ST
from tidemark.operators.commit_log import CommitLog
from tidemark.options import GroupOptions
from tidemark.plans.ordering import with_reach
from tidemark.sources import zones as Z
from tidemark.streaming import partitions, seen, tracker, versions

LOG = "topic string, partition int, offset bigint"
NOW = {"availableNow": True}


def append(spark, path, rows, ddl=LOG):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(ddl).parquet(path)


def auto(spark, tmp_path, stream, handler, options, initial, **more):
    paths = [str(tmp_path / n) for n in ("state", "commits", "checkpoint")]
    tracker.auto_commit(stream, handler, initial, options, "m", 1, *paths, trigger=NOW, **more).awaitTermination()
    return paths


def test_a_handler_does_its_work_once_per_message(spark, tmp_path):
    handled = spark.sparkContext.accumulator(0)

    def work(info, batches):
        for batch in batches:
            handled.add(len(batch))
            yield pd.DataFrame({"topic": info.topic, "partition": info.partition, "offset": [int(batch["offset"].max())]})

    def handler(batch, batch_id):
        done = D.for_each_partition(batch.select(*S.TP, "offset"), work, LOG, split=True, slices=3)
        return done.select(F.lit(0).cast("bigint").alias("seq"), *S.TP, F.lit("mark").alias("op"), "offset", F.lit("").alias("metadata"))

    initial = spark.createDataFrame([("t", p, -1, "", False) for p in range(3)], S.OFFSET_STATE)
    stream = append(spark, str(tmp_path / "in"), [("t", p, o) for p in range(3) for o in range(50)])
    state, commits, _ = auto(spark, tmp_path, stream, handler, GroupOptions(group_id="g"), initial)
    assert handled.value == 150
    assert {r.offset for r in CommitLog(commits).valid(spark).collect()} == {50}


def test_errors_of_a_stream_appear_once_per_batch(spark, tmp_path):
    initial = spark.createDataFrame([("t", 0, -1, "", False)], S.OFFSET_STATE)
    stream = append(spark, str(tmp_path / "in"), [("t", 0, 4), ("u", 0, 1)])
    log = CommitLog(str(tmp_path / "commits"))
    log.open_generation(spark.createDataFrame([("g", 2, "n")], "group_id string, generation int, member_id string"), F.timestamp_seconds(F.lit(0)))
    options = GroupOptions(group_id="g", return_errors=True)
    state, _, checkpoint = auto(spark, tmp_path, stream, lambda b, n: None, options, initial)
    again = auto(spark, tmp_path / "again", stream, lambda b, n: None, options, initial)
    errors = versions.all_versions(spark, f"{state}-errors")
    assert sorted((r.ctx, r.topic, r.message) for r in errors.collect()) == [
        ("commit", "t", "illegal generation"), ("mark", "u", "not subscribed: mark"),
    ]
    # Refused commits leave the state dirty; without a registry they go through.
    assert [(r.offset, r.dirty) for r in versions.current_version(spark, state).collect()] == [(5, True)]
    assert [(r.offset, r.dirty) for r in versions.current_version(spark, again[0]).collect()] == [(5, False)]


def test_release_is_stored_and_repeats_nothing(spark, tmp_path):
    initial = spark.createDataFrame([("t", 0, -1, "", False)], S.OFFSET_STATE)
    stream = append(spark, str(tmp_path / "in"), [("t", 0, 4)])
    options = GroupOptions(group_id="g")
    state, commits, _ = auto(spark, tmp_path, stream, lambda b, n: None, options, initial, commit_every=2)
    for _ in range(2):
        after = tracker.release(spark, options, "m", 1, state, commits)
        assert after.where("dirty").count() == 0
    assert versions.current_version(spark, state).where("dirty").count() == 0
    stream = append(spark, str(tmp_path / "in"), [("t", 0, 7)])
    auto(spark, tmp_path, stream, lambda b, n: None, options, initial, commit_every=2)
    assert sorted(r.offset for r in CommitLog(commits).commits(spark).collect()) == [5, 8]


def test_unknown_partitions_join_the_state(spark, tmp_path):
    initial = spark.createDataFrame([("t", 0, 3, "x", False)], S.OFFSET_STATE)
    stream = append(spark, str(tmp_path / "in"), [("t", 0, 1), ("t", 1, 0), ("new", 0, 5)])
    state, commits, _ = auto(spark, tmp_path, stream, lambda b, n: None, GroupOptions(group_id="g"), initial, admit=True)
    got = {(r.topic, r.partition): (r.offset, r.metadata) for r in versions.current_version(spark, state).collect()}
    assert got == {("t", 0): (3, "x"), ("t", 1): (1, ""), ("new", 0): (6, "")}


@pytest.mark.parametrize("slices", [None, 6])
def test_reach_is_the_maximum_so_far(spark, slices):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), i, rng.randint(0, 500)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    got = {(r.g, r.i): r.reach for r in with_reach(df, ["g"], ["i"], "v", slices=slices).collect()}
    top = {}
    for g, i, v in rows:
        assert got[(g, i)] == top.get(g)
        top[g] = max(v, top.get(g, v))


def test_intervals_remember_what_was_delivered(spark, tmp_path):
    rng = random.Random(2)
    sent = [("t", p, o) for p in (0, 1) for o in range(300) if (o + p) % 50] * 2 + [("u", 0, 2**40)]
    rng.shuffle(sent)
    path, source, checkpoint = (str(tmp_path / n) for n in ("out", "in", "cp"))
    known, width = set(), len(sent) // 3 + 1
    for low in range(0, len(sent), width):
        part = sent[low : low + width]
        seen.dedup_by_intervals(append(spark, source, part), path, checkpoint).awaitTermination()
        known |= set(part)
        kept = versions.current_version(spark, f"{path}/seen").collect()
        covered = [(r.topic, r.partition, o) for r in kept for o in range(r.low, r.high)]
        assert len(covered) == len(known) and set(covered) == known
    delivered = [tuple(r) for r in versions.all_versions(spark, f"{path}/messages").select(*S.TP, "offset").collect()]
    assert sorted(delivered) == sorted(known)
    # In the end one interval per stretch between gaps.
    assert len(kept) == 6 + 6 + 1


def test_null_offsets_have_no_identity(spark):
    nothing = spark.createDataFrame([], seen.INTERVALS)
    with pytest.raises(ValueError):
        seen.unseen(spark.createDataFrame([("t", 0, None)], LOG), nothing)
    fresh, after = seen.unseen(spark.createDataFrame([], LOG), nothing)
    assert fresh.count() == 0 and after.count() == 0


def test_a_group_behind_in_one_partition_opens_its_files_only(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("t", p, o) for p in range(4) for o in range(1000)]
    Z.append_zoned(spark.createDataFrame(rows, LOG), path, rows_per_file=200)
    Z.append_zoned(spark.createDataFrame([("t", 1, o) for o in range(1000, 1200)], LOG), path, rows_per_file=200)
    zones = Z.zones_of(spark, path)
    assert {(r.partition, r.oldest, r.newest) for r in Z.zone_bounds(zones).collect()} == {(0, 0, 1000), (1, 0, 1200), (2, 0, 1000), (3, 0, 1000)}
    assert zones.where("append = 0").select("file").distinct().count() >= 15
    starts = spark.createDataFrame([("t", 0, 1000), ("t", 1, 900), ("t", 2, 1000), ("t", 3, 1000)], "topic string, partition int, resolved_offset bigint")
    schema = spark.createDataFrame([], LOG).schema
    read = Z.read_zoned(spark, path, starts, schema)
    opened = {f.rsplit("/", 1)[1] for f in read.inputFiles()}
    wanted = {r.file for r in zones.where("partition = 1 AND last_offset >= 900").collect()}
    assert opened == wanted and len(opened) <= 3
    assert sorted(r.offset for r in read.collect()) == list(range(900, 1200))
    done = starts.withColumn("resolved_offset", F.lit(5000).cast("bigint"))
    assert Z.read_zoned(spark, path, done, schema).count() == 0


def test_sums_go_on_over_micro_batches(spark, tmp_path):
    def totals(info, batches):
        n, total = int(info.entry["n"]), int(info.entry["total"])
        for batch in batches:
            running = total + batch["offset"].cumsum()
            yield pd.DataFrame({"topic": info.topic, "partition": info.partition, "offset": batch["offset"], "n": n + pd.RangeIndex(1, len(batch) + 1), "total": running})
            n, total = n + len(batch), int(running.iloc[-1])

    path, source, checkpoint = (str(tmp_path / n) for n in ("out", "in", "cp"))
    for part in range(3):
        stream = append(spark, source, [("t", p, o) for p in range(part + 1) for o in range(part * 40, part * 40 + 40)])
        partitions.run_partitions(
            stream, totals, f"{LOG}, n bigint, total bigint", path, checkpoint, {"n": F.lit(1), "total": F.col("offset")}, slices=4
        ).awaitTermination()
    rows = versions.all_versions(spark, f"{path}/output").collect()
    for p in range(3):
        n = total = 0
        for r in sorted((r for r in rows if r.partition == p), key=lambda r: r.offset):
            n, total = n + 1, total + r.offset
            assert (r.n, r.total) == (n, total)
        assert n == 120 - 40 * p


def test_zoned_log_answers_the_catalog(spark, tmp_path):
    path = str(tmp_path / "log")
    Z.append_zoned(spark.createDataFrame([("a", 0, 5), ("b", 1, 7)], LOG), path)
    zones = Z.zones_of(spark, path)
    assert {tuple(r) for r in Z.zone_catalog(zones).collect()} == {("a", 0), ("b", 1)}
    assert ST.high_water_marks(spark.createDataFrame([("a", 0, 5)], LOG)).first().high_water_mark == 6
