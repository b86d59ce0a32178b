"""Chat formatting: canonical arguments, schemas, and the whole query against SQL."""

import itertools
import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chats, queries
from tidemark.llm.chats import Field
from tidemark.llm.sql import CHECKS

TURNS = "conv_id long, turn long, role string, text string"


def test_query_equals_sql(spark, sf_dir):
    got = queries.op3_chat_formatting(spark, sf_dir)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    asked = duck.execute(CHECKS["op3_chat_formatting"])
    assert got.columns == [d[0] for d in asked.description]
    assert sorted(map(tuple, got.collect())) == sorted(asked.fetchall())


def test_equal_arguments_give_equal_bytes(spark):
    rng = random.Random(5)
    value = {"b": [1, {"z": "é\n", "a": None}], "a": {"y": True, "x": 1.5}, "c": 'q"\\', "d": {}}

    def shuffled(v):
        if isinstance(v, dict):
            return {k: shuffled(v[k]) for k in rng.sample(sorted(v), len(v))}
        return [shuffled(x) for x in v] if isinstance(v, list) else v

    texts = [json.dumps(shuffled(value), indent=rng.choice([None, 2])) for _ in range(30)]
    rows = spark.createDataFrame([(t,) for t in texts], "a string").select(chats.canonical(F.col("a")).alias("c")).collect()
    assert len({r.c for r in rows}) == 1
    assert rows[0].c == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_validation_against_a_plain_check(spark):
    """All objects over a few values, against the same rules in Python."""
    schema = {
        "n": Field("bigint", least=2), "s": Field("string", max_length=3, required=False),
        "d": Field("double", required=False), "b": Field("boolean", required=False), "l": Field("array", required=False),
        "o": Field("object", required=False),
    }
    values = [1, 2, 2.5, "abc", "abcd", True, None, [1], [], {"n": 1}, {}]

    def fits(given):
        number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
        kinds = {
            "n": lambda v: number(v) and isinstance(v, int) and v >= 2, "s": lambda v: isinstance(v, str) and len(v) <= 3,
            "d": number, "b": lambda v: isinstance(v, bool), "l": lambda v: isinstance(v, list), "o": lambda v: isinstance(v, dict),
        }
        return "n" in given and all(k in kinds and kinds[k](v) for k, v in given.items())

    objects = [{"n": v} for v in values] + [{"n": 2, k: v} for k, v in itertools.product([*"sdblo", "other"], values)] + [{"s": "a"}, {}]
    df = spark.createDataFrame([(json.dumps(o),) for o in objects], "a string").coalesce(1)
    got = [r.v for r in df.select(chats.validated(F.col("a"), schema).alias("v")).collect()]
    assert got == [fits(o) for o in objects]


@pytest.mark.parametrize("text", [None, "", "oops", "[1]", "1", '{"n":2,"n":2}', '{"n":2'])
def test_arguments_that_are_no_object_do_not_fit(spark, text):
    row = spark.createDataFrame([(text,)], "a string").select(
        chats.validated(F.col("a"), {"n": "bigint"}).alias("v"), chats.canonical(F.col("a")).alias("c")
    ).first()
    assert row.v is False and (row.c is None if text is None else json.dumps(row.c))


def test_defined_cases_of_turns(spark):
    long = "x" * 200_000
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", None), (1, 3, "user", long), (1, 3, "user", long),
        (1, 4, "assistant", "late"), (1, 4, "assistant", "early"), (1, None, "user", "x"), (None, 0, "user", "x"),
        (1, 5, None, "x"), (1, 7, "user", None), (2, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS depth", "2 AS call_id", "3 AS _result", "4 AS json")
    got = {(r.conv_id, r.turn): (r.depth, r.status, json.loads(r.json)["result"]) for r in chats.linked(*chats.calls_of(df), chats.TOOLS).collect()}
    assert got == {
        (1, 0): (0, "open", None), (1, 1): (1, "linked", None), (1, 3): (2, "invalid", "early"), (1, 7): (0, "invalid", None),
        (2, 0): (0, "invalid", None),
    }
    assert chats.linked(*chats.calls_of(df.limit(0)), chats.TOOLS).count() == 0
