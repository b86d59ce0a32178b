import pytest

from tidemark import schemas as S
from tidemark.operators import assign as A

# Members, partitions, owners by range, owners in turn.
CASES = [
    (["M1", "M2", "M3"], [0, 1, 2], {"M1": [0], "M2": [1], "M3": [2]}, {"M1": [0], "M2": [1], "M3": [2]}),
    (["M3", "M1", "M2"], [0, 1, 2], {"M1": [0], "M2": [1], "M3": [2]}, {"M1": [0], "M2": [1], "M3": [2]}),
    (["M1", "M2", "M3"], [0, 1], {"M1": [0], "M3": [1]}, {"M1": [0], "M2": [1]}),
    (["M1", "M2", "M3"], [0], {"M2": [0]}, {"M1": [0]}),
    (["M1", "M2", "M3"], [0, 1, 2, 3], {"M1": [0], "M2": [1, 2], "M3": [3]}, {"M1": [0, 3], "M2": [1], "M3": [2]}),
    (["M1", "M2", "M3"], [0, 2, 4, 6, 8], {"M1": [0, 2], "M2": [4], "M3": [6, 8]}, {"M1": [0, 6], "M2": [2, 8], "M3": [4]}),
]


def owned(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.topic, r.member_id), []).append(r.partition)
    return {k: sorted(v) for k, v in out.items()}


def test_small_tables_by_both_strategies(spark):
    members = [(f"t{i}", m) for i, c in enumerate(CASES) for m in c[0]]
    catalog = [(f"t{i}", p) for i, c in enumerate(CASES) for p in c[1]]
    members = spark.createDataFrame(members, "topic string, member_id string")
    catalog = spark.createDataFrame(catalog, S.CATALOG)
    for strategy, column in (("range", 2), ("roundrobin", 3), ("something else", 2)):
        want = {(f"t{i}", m): p for i, c in enumerate(CASES) for m, p in c[column].items()}
        assert owned(A.assign(members, catalog, strategy)) == want


def test_range_bounds_for_many_sizes(spark):
    """Every (items, owners) size pair as a group of its own, against the bounds by definition."""
    sizes = [(p, m) for p in range(1, 40) for m in range(1, 30)]
    items = [(f"{p}/{m}", i) for p, m in sizes for i in range(p)]
    owners = [(f"{p}/{m}", o) for p, m in sizes for o in range(m)]
    got = A.assign_range(
        spark.createDataFrame(items, "g string, item int"),
        spark.createDataFrame(owners, "g string, owner int"),
        "g",
        "item",
        "owner",
    )
    want = set()
    for p, m in sizes:
        for o in range(m):
            lo, hi = int(o * (p / m) + 0.5), int((o + 1) * (p / m) + 0.5)
            want |= {(f"{p}/{m}", i, o) for i in range(lo, hi)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(items) and set(rows) == want


def test_members_listing_a_topic_twice_count_once(spark):
    members = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b")], "topic string, member_id string")
    catalog = spark.createDataFrame([("t", p) for p in range(4)], S.CATALOG)
    assert owned(A.assign(members, catalog)) == {("t", "a"): [0, 1], ("t", "b"): [2, 3]}


def test_nested_assignment_of_two_members(spark):
    catalog = [("one", p) for p in range(4)] + [("two", p) for p in range(3)] + [("three", 0), ("three", 1)]
    catalog = spark.createDataFrame(catalog, S.CATALOG)
    members = spark.createDataFrame(
        [("b", "three"), ("b", "one"), ("a", "one"), ("a", "two")], "member_id string, topic string"
    )

    def nested(strategy):
        return {r.member_id: r.topics for r in A.nested_assignments(A.assign(members, catalog, strategy)).collect()}

    assert nested("range") == {
        "a": {"one": [0, 1], "two": [0, 1, 2]},
        "b": {"one": [2, 3], "three": [0, 1]},
    }
    assert nested("roundrobin") == {
        "a": {"one": [0, 2], "two": [0, 1, 2]},
        "b": {"one": [1, 3], "three": [0, 1]},
    }
    subs = A.subscriptions(A.assign(members, catalog), "a")
    assert {r.topic: r.partitions for r in subs.collect()} == {"one": [0, 1], "two": [0, 1, 2]}


def test_unknown_topics_fail_the_assignment(spark):
    members = spark.createDataFrame([("a", "t"), ("a", "gone")], "member_id string, topic string")
    catalog = spark.createDataFrame([("t", 0)], S.CATALOG)
    with pytest.raises(ValueError, match="gone"):
        A.assign(members, catalog)
    assert owned(A.assign(members, catalog, on_unknown="skip")) == {("t", "a"): [0]}
    assert [r.topic for r in A.unknown_member_topics(members, catalog).collect()] == ["gone"]


def test_many_owners_take_the_shuffled_way(spark, monkeypatch):
    from tidemark.plans import bounded

    monkeypatch.setattr(A, "settle", lambda df: bounded.settle(df, max_rows=10))
    items = spark.range(500).selectExpr("if(id % 3 = 0, 'x', 'y') AS g", "id AS item")
    owners = spark.range(120).selectExpr("if(id % 2 = 0, 'x', 'y') AS g", "concat('o', id) AS owner")
    fast = A.assign_round_robin(items, owners, "g", "item", "owner")
    placed = {}
    for g in ("x", "y"):
        ranked = sorted(r.owner for r in owners.collect() if r.g == g)
        for i, item in enumerate(sorted(r.item for r in items.collect() if r.g == g)):
            placed[(g, item)] = ranked[i % len(ranked)]
    assert {(r.g, r.item): r.owner for r in fast.collect()} == placed


def test_null_groups_are_refused(spark):
    items = spark.createDataFrame([("t", 1), (None, 2)], "topic string, item int")
    owners = spark.createDataFrame([("t", "m")], "topic string, owner string")
    with pytest.raises(ValueError, match="null in group columns"):
        A.assign_range(items, owners, ["topic"], "item", "owner").collect()
