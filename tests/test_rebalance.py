import random

from tidemark import schemas as S
from tidemark.functions import scalars as fn
from tidemark.operators import rebalance as R
from tidemark.operators import runs as RUNS

# Two assignments of one member.
PREVIOUS = {"a": [1, 2, 3], "b": [4, 5], "c": [1, 2]}
CURRENT = {"a": [3, 4], "b": [1, 2, 3, 4], "d": [3, 4]}


def flat(owned, *head):
    return [(*head, t, p) for t, ps in owned.items() for p in ps]


def owned_df(spark, owned):
    return spark.createDataFrame(flat(owned, "m"), "member_id string, topic string, partition int")


def test_difference_per_topic_keeps_empty_topics(spark):
    diff = R.rebalance_diff(owned_df(spark, PREVIOUS), owned_df(spark, CURRENT)).collect()
    claimed = {r.topic: r.claimed for r in diff if r.in_current}
    released = {r.topic: r.released for r in diff if r.in_previous}
    assert claimed == {"a": [4], "b": [1, 2, 3], "d": [3, 4]}
    assert released == {"a": [1, 2], "b": [5], "c": [1, 2]}
    same = R.rebalance_diff(owned_df(spark, CURRENT), owned_df(spark, CURRENT)).collect()
    assert {r.topic: (r.claimed, r.released) for r in same} == {t: ([], []) for t in CURRENT}


def test_array_difference(spark):
    rng = random.Random(31)
    draw = lambda: None if rng.random() < 0.1 else [rng.randint(0, 9) for _ in range(rng.randint(0, 8))]
    pairs = [(draw(), draw()) for _ in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, m array<int>, o array<int>")
    got = {r.i: r.d for r in df.select("i", fn.partition_diff("m", "o").alias("d")).collect()}
    assert got == {i: [x for x in m or [] if x not in (o or [])] for i, (m, o) in enumerate(pairs)}


def test_first_assignment_then_a_change(spark):
    assignments = flat(PREVIOUS, 1, "m") + flat(CURRENT, 2, "m")
    events = R.rebalance_events(spark.createDataFrame(assignments, S.ASSIGNMENTS))
    got = [
        (r.generation, r.type, r.claimed, r.released, r.current)
        for r in events.orderBy("generation", "step").collect()
    ]
    assert got == [
        (1, "rebalance start", {}, {}, {}),
        (1, "rebalance OK", PREVIOUS, {}, PREVIOUS),
        (2, "rebalance start", {}, {}, {}),
        (
            2,
            "rebalance OK",
            {"a": [4], "b": [1, 2, 3], "d": [3, 4]},
            {"a": [1, 2], "b": [5], "c": [1, 2]},
            CURRENT,
        ),
    ]


def test_failures_by_stage(spark):
    assignments = [(g, "m", "t", p) for g in range(1, 8) for p in (0, g)]
    failures = [(2, "m", "rebalance"), (4, "m", "refresh"), (6, "m", "release")]
    events = R.rebalance_events(
        spark.createDataFrame(assignments, S.ASSIGNMENTS),
        spark.createDataFrame(failures, S.FAILURES),
    )
    got = {(r.generation, r.type): (r.claimed, r.released, r.current) for r in events.collect()}
    start = ({}, {}, {})
    assert got == {
        (1, "rebalance start"): start,
        (1, "rebalance OK"): ({"t": [0, 1]}, {}, {"t": [0, 1]}),
        (2, "rebalance start"): start,
        (2, "rebalance error"): ({}, {}, {"t": [0, 1]}),
        (3, "rebalance start"): start,
        (3, "rebalance OK"): ({"t": [0, 3]}, {}, {"t": [0, 3]}),
        # 4 fails before anything is released: 5 compares with 3.
        (5, "rebalance start"): start,
        (5, "rebalance OK"): ({"t": [5]}, {"t": [3]}, {"t": [0, 5]}),
        # 6 fails while releasing, without a notification: 7 starts from nothing.
        (7, "rebalance start"): start,
        (7, "rebalance OK"): ({"t": [0, 7]}, {}, {"t": [0, 7]}),
    }


def test_an_empty_assignment_is_not_an_error(spark):
    assignments = spark.createDataFrame([(1, "a", "t", 0)], S.ASSIGNMENTS)
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "generation int, member_id string")
    events = R.rebalance_events(assignments, members=members)
    got = {(r.generation, r.member_id): (r.released, r.current) for r in events.where("step = 1").collect()}
    assert got == {(1, "a"): ({}, {"t": [0]}), (1, "b"): ({}, {}), (2, "a"): ({"t": [0]}, {})}


def test_notification_names(spark):
    df = spark.range(5).select(fn.notification_name("id").alias("n"))
    assert [r.n for r in df.collect()] == ["unknown", "rebalance start", "rebalance OK", "rebalance error", "unknown"]


def expanded(df):
    return sorted(map(tuple, RUNS.partitions_of(df).collect()))


def test_runs_against_sets(spark):
    rng = random.Random(8)
    sides = []
    for _ in range(2):
        owned = {(m, t, p) for m in "mn" for t in "ab" for p in rng.sample(range(60), 30)}
        owned.add(("only", f"t{len(sides)}", 7))
        rows = sorted(owned) + sorted(owned)[:20]  # some twice
        sides.append((owned, spark.createDataFrame(rows, "member_id string, topic string, partition int")))
    (old, before), (new, now) = sides
    runs = RUNS.rebalance_runs(before, now).collect()
    for change, want in (("claimed", new - old), ("released", old - new), ("current", new)):
        got = [(r.member_id, r.topic, p) for r in runs if r.change == change for p in range(r.first, r.last + 1)]
        assert sorted(got) == sorted(want)
        ends = {(r.member_id, r.topic, r.last + 1) for r in runs if r.change == change}
        assert not ends & {(r.member_id, r.topic, r.first) for r in runs if r.change == change}
    assert expanded(RUNS.runs_of(now)) == sorted(new)
    assert RUNS.rebalance_runs(before.limit(0), now.limit(0)).isEmpty()


def test_wide_assignments_are_few_runs(spark):
    wide = lambda lo, hi: spark.range(lo, hi).selectExpr("'m' AS member_id", "'t' AS topic", "CAST(id AS INT) AS partition")
    got = sorted((r.change, r.first, r.last) for r in RUNS.rebalance_runs(wide(0, 60000), wide(20000, 80000)).collect())
    assert got == [("claimed", 60000, 79999), ("current", 20000, 79999), ("released", 0, 19999)]
    [diff] = R.rebalance_diff(wide(0, 60000), wide(20000, 80000)).collect()
    assert diff.claimed == list(range(60000, 80000)) and diff.released == list(range(20000))
