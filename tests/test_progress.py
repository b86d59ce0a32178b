import itertools
import random

import pytest

from tests.model import partition_rule, stash_rule
from tidemark import schemas as S
from tidemark.operators import progress as P


def state_df(spark, state):
    rows = [(t, p, o, m, d) for (t, p), (o, m, d) in state.items()]
    return spark.createDataFrame(rows, S.OFFSET_STATE)


def commands_df(spark, commands, first_seq=0):
    rows = [(first_seq + i, t, p, op, o, m) for i, (t, p, op, o, m) in enumerate(commands)]
    return spark.createDataFrame(rows, S.COMMANDS)


def state_of(df):
    return {(r.topic, r.partition): (r.offset, r.metadata, r.dirty) for r in df.collect()}


def stash_of(df):
    return {(r.topic, r.partition): (r.offset, r.metadata) for r in df.collect()}


def many_keys(count):
    return [(f"t{i % 37:02d}", i // 37) for i in range(count)]


def mixed_profiles(rng, keys):
    """Commands whose length, offset span and share of resets differ from key to key."""
    out = []
    for key in keys:
        n, span = rng.choice([1, 2, 4, 9, 30]), rng.choice([2, 3, 6, 12, 1000])
        resets = rng.choice([0.0, 0.2, 0.5, 0.8, 1.0])
        for _ in range(n):
            op = "reset" if rng.random() < resets else "mark"
            out.append((*key, op, rng.randint(-1, span)))
    rng.shuffle(out)
    return [(*c, f"m{i}") for i, c in enumerate(out)]


@pytest.mark.parametrize("slices", [1, 5, 64])
def test_folds_equal_the_sequential_model(spark, slices):
    rng = random.Random(slices)
    keys = many_keys(500)
    commands = mixed_profiles(rng, keys)
    state = {k: (rng.randint(-1, 12), "base", rng.random() < 0.3) for k in keys if rng.random() < 0.8}
    df = commands_df(spark, commands).cache()
    got = P.apply_commands(state_df(spark, state), df, "partition", slices)
    assert state_of(got) == partition_rule(state, commands)
    assert state_of(P.apply_commands(state_df(spark, state), df)) == partition_rule(state, commands)
    assert stash_of(P.stash_offsets(df, slices=slices)) == stash_rule({}, commands)
    stash = {k: (rng.randint(0, 12), "old") for k in keys[::3]}
    stash_df = spark.createDataFrame([(t, p, o, m) for (t, p), (o, m) in stash.items()], S.STASH)
    assert stash_of(P.stash_offsets(df, stash_df, slices)) == stash_rule(stash, commands)
    df.unpersist()


def test_single_op_folds_equal_the_sequential_model(spark):
    rng = random.Random(1)
    keys = many_keys(300)
    commands = mixed_profiles(rng, keys)
    state = {k: (rng.randint(-1, 12), "base", False) for k in keys[50:]}
    df = commands_df(spark, commands).cache()
    marks = [c for c in commands if c[2] == "mark"]
    rewinds = [c for c in commands if c[2] == "reset"]
    assert state_of(P.mark_offsets(state_df(spark, state), df)) == partition_rule(state, marks)
    assert state_of(P.reset_offsets(state_df(spark, state), df)) == partition_rule(state, rewinds)
    assert stash_of(P.stash_marks(df)) == stash_rule({}, marks)
    df.unpersist()


def test_acknowledgement_equals_its_rule_on_random_states(spark):
    """Clean only what was committed without error at the position it still has."""
    rng = random.Random(17)
    state = {k: (rng.randint(0, 3), "m", rng.random() < 0.7) for k in many_keys(200)}
    results = {k: (rng.randint(0, 3), rng.choice([None, "refused"])) for k in list(state)[::2] + [("gone", 1)]}
    df = spark.createDataFrame([(*k, *v) for k, v in results.items()], S.COMMIT_RESULTS)
    want = {
        k: (o, m, d and not (k in results and results[k] == (o, None))) for k, (o, m, d) in state.items()
    }
    assert state_of(P.mark_committed(state_df(spark, state), df)) == want


def test_stash_is_applied_once_per_entry(spark):
    state = {("t", 0): (5, "old", False), ("t", 1): (9, "old", False), ("t", 2): (1, "old", False)}
    stash = spark.createDataFrame([("t", 0, 5, "s"), ("t", 1, 8, "s"), ("u", 0, 99, "s")], S.STASH)
    marked = P.apply_stash(state_df(spark, state), stash, P.MARK)
    assert state_of(marked) == {**state, ("t", 0): (6, "s", True)}
    reset = P.apply_stash(state_df(spark, state), stash, P.RESET)
    assert state_of(reset) == {**state, ("t", 1): (9, "s", True)}
    with pytest.raises(ValueError):
        P.apply_stash(state_df(spark, state), stash, "erase")


def test_snapshot_of_subscribed_partitions(spark):
    rng = random.Random(23)
    keys = many_keys(60)
    commands = mixed_profiles(rng, keys)
    state = {k: (rng.randint(-1, 12), "base", False) for k in keys}
    after = partition_rule(state, commands)
    folded = P.apply_commands(state_df(spark, state), commands_df(spark, commands))
    assert state_of(P.snapshot(folded)) == after
    subs = spark.createDataFrame(keys[::3], S.CATALOG)
    assert state_of(P.snapshot(folded, subs)) == {k: after[k] for k in keys[::3]}


def test_fold_with_a_large_summary_takes_the_shuffled_way(spark, monkeypatch):
    from tidemark.plans import bounded

    monkeypatch.setattr(P, "settle", lambda df: bounded.settle(df, max_rows=5))
    rng = random.Random(11)
    keys = many_keys(120)
    commands = mixed_profiles(rng, keys)
    state = {k: (rng.randint(-1, 12), "base", False) for k in keys[10:]}
    got = P.apply_commands(state_df(spark, state), commands_df(spark, commands), slices=8)
    assert state_of(got) == partition_rule(state, commands)


def test_fold_never_shuffles_all_commands(spark, tmp_path):
    """Every exchange of the fold follows an aggregation or a filter by a small side."""
    path = str(tmp_path / "commands")
    spark.range(5000).selectExpr(
        "id AS seq", "'t' AS topic", "cast(id % 3 AS int) AS partition",
        "if(id % 4 = 0, 'reset', 'mark') AS op", "id % 50 AS offset", "concat('m', id) AS metadata",
    ).write.parquet(path)
    commands = spark.read.parquet(path)
    state = spark.createDataFrame([("t", p, -1, "", False) for p in range(3)], S.OFFSET_STATE)
    plan = P.apply_commands(state, commands, slices=16)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = [x for x in lines[i + 1 :] if x.strip()][:12]
            depth = next((j for j, x in enumerate(below) if "FileScan" in x), None)
            if depth is not None:
                assert any("partial_" in x or "BroadcastHashJoin" in x for x in below[:depth]), plan


@pytest.mark.parametrize("rule", sorted(P.RULES))
def test_every_short_sequence(spark, rule):
    """All sequences of up to four commands on three offsets, from every position, in one to
    three slices: each is a topic-partition of its own."""
    kinds = list(itertools.product(["mark", "reset"], range(3)))
    rng, commands, starts = random.Random(3), [], {}
    for length in range(1, 5):
        for steps in itertools.product(kinds, repeat=length):
            key = (f"t{length}", len(starts))
            starts[key] = (rng.randint(-1, 4), "base", False)
            commands.extend((i, *key, op, offset, f"m{i}") for i, (op, offset) in enumerate(steps))
    df = spark.createDataFrame(commands, S.COMMANDS).cache()
    in_order = [(t, p, op, o, m) for _, t, p, op, o, m in sorted(commands)]
    for slices in (1, 2, 3):
        if rule == "partition":
            assert state_of(P.apply_commands(state_df(spark, starts), df, rule, slices)) == partition_rule(starts, in_order)
        else:
            stash = {k: v[:2] for k, v in starts.items() if v[0] >= 0}
            stash_df = spark.createDataFrame([(*k, *v) for k, v in stash.items()], S.STASH)
            assert stash_of(P.stash_offsets(df, stash_df, slices)) == stash_rule(stash, in_order)
    df.unpersist()


def test_a_repeated_command_wins_once(spark):
    state = {("t", 0): (1, "old", False)}
    df = commands_df(spark, [("t", 0, "mark", 5, "m"), ("t", 0, "mark", 9, "n")])
    assert state_of(P.apply_commands(state_df(spark, state), df.union(df))) == {("t", 0): (10, "n", True)}
    assert state_of(P.apply_commands(state_df(spark, state), df.limit(0))) == state
