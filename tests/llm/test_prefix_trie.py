"""The prefix trie against plain dictionaries, and its defined cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidemark.llm import prefix_trie, queries
from tidemark.llm.common import table
from tidemark.llm.sql import CHECKS

DDL = "conv_id long, turn long, role string, text string, conv string, n long, path string"


def trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            given[conv].append((turn is not None, turn or 0, mark, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c > 0 else -1)
        path = tuple(turns.get(base, [])[:h] + own[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    have = got(queries.op11_prefix_trie(spark, sf_dir))
    assert have == trie(rows)
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    asked = duck.execute(CHECKS["op11_prefix_trie"])
    names = [d[0] for d in asked.description]
    order = [names.index(c) for c in queries.op11_prefix_trie(spark, sf_dir).columns]
    assert have == sorted(tuple(-1 if r[i] is None else r[i] for i in order) for r in asked.fetchall())


def shared_prefixes(rng, convs):
    rows = []
    for c in convs:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb", "é" * 256, "z" * 7]) if turn else "hello"))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_boundary_nodes_merge(spark, shards):
    rng = random.Random(shards)
    rows = shared_prefixes(rng, range(-150, 700))
    # One path is shared by many conversations, and one conversation is long.
    rows += [(c, t, "user", "same") for c in range(1000, 1400, 100) for t in range(2)]
    rows += [(c, t, "user", "same") for c in range(1001, 1400) if c % 100 for t in range(6)]
    rows += [(5000, t, "user", str(t // 2)) for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(prefix_trie.nodes(df, shards)) == trie(rows)


def test_long_runs_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "JOINED_IDS", 3)
    rows = [(c, t, "user", "x") for c in range(500) for t in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(prefix_trie.nodes(df, 4)) == trie(rows)


def test_defined_cases(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "b"), (-7, 3, None, "x" * 200000),
        (-7, 3, "user", None), (2, 0, "", ""), (100, None, "s", ""), (101, 5, "s", "t"),
    ]
    wide = spark.createDataFrame([(*r, "c", 1, "p") for r in rows], DDL)
    assert got(prefix_trie.nodes(wide)) == trie(rows)
    assert prefix_trie.nodes(wide.limit(0)).count() == 0
    alone = [(7, 0, "user", "a")]
    assert got(prefix_trie.nodes(wide.where("conv_id = 101").replace(101, 7).selectExpr("conv_id", "0L AS turn", "'user' AS role", "'a' AS text"))) == trie(alone)


def test_median_insertion_balances_siblings():
    paths = [i.to_bytes(prefix_trie.SYMBOL, "big") for i in range(1, 1024)]
    shard = prefix_trie.Shard(paths, list(range(1023)), [1] * 1023, ["x"] * 1023)
    deepest, open_ = 0, [(shard.eq[0], 1)]
    while open_:
        node, level = open_.pop()
        if node:
            deepest = max(deepest, level)
            open_ += [(shard.lo[node], level + 1), (shard.hi[node], level + 1)]
    assert deepest == 10
