import bisect
import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import bounded
from tidemark.plans.ordering import SLICE, running, split_points, with_position, with_previous, with_slices


def expected_positions(rows, group, order):
    seen, out = {}, set()
    for row in sorted(rows, key=lambda r: tuple(r[i] for i in order)):
        key = tuple(row[i] for i in group)
        out.add((*row, seen.get(key, 0)))
        seen[key] = seen.get(key, 0) + 1
    return out


@pytest.mark.parametrize("slices", [1, 2, 64])
def test_positions_with_one_hot_group(spark, slices):
    rng = random.Random(slices)
    ids = rng.sample(range(10**9), 3000)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 40)}", i) for i in ids]
    df = spark.createDataFrame(rows, "g string, id bigint")
    got = with_position(df, ["g"], ["id"], "pos", size="n", slices=slices).collect()
    assert {(r.g, r.id, r.pos) for r in got} == expected_positions(rows, [0], [1])
    sizes = {}
    for g, _ in rows:
        sizes[g] = sizes.get(g, 0) + 1
    assert all(r.n == sizes[r.g] for r in got)


def test_positions_along_strings_dates_and_several_columns(spark):
    rng = random.Random(5)
    names = [f"n{rng.randint(0, 10**6)},\"{i}\"" for i in range(800)]
    day = datetime.date(2024, 1, 1)
    rows = [(f"g{i % 3}", n, i % 7, day + datetime.timedelta(days=i)) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "g string, name string, k int, d date")
    by_name = with_position(df, ["g"], ["name"], "pos").collect()
    assert {tuple(r) for r in by_name} == expected_positions(rows, [0], [1])
    by_day = with_position(df, ["g"], ["d"], "pos").collect()
    assert {tuple(r) for r in by_day} == expected_positions(rows, [0], [3])
    by_both = with_position(df, ["g"], ["k", "name"], "pos").collect()
    assert {tuple(r) for r in by_both} == expected_positions(rows, [0], [2, 1])


def test_slices_are_a_binary_search_and_balanced(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).alias("x"))
    points = split_points(df, ["x"], 16)
    got = with_slices(df, ["x"], 16).collect()
    assert all(r[SLICE] == bisect.bisect_right(points, r.x) for r in got)
    counts = [0] * 16
    for r in got:
        counts[r[SLICE]] += 1
    assert max(counts) < 2 * 20_000 / 16
    assert with_slices(spark.range(0).select(F.col("id").alias("x")), ["x"], 4).count() == 0


def test_running_sums_and_previous_rows(spark):
    rng = random.Random(9)
    rows = [("a" if rng.random() < 0.5 else f"g{i % 9}", i, rng.randint(-5, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i bigint, v bigint")
    sums, last, want = {}, {}, set()
    for g, i, v in rows:
        sums[g] = sums.get(g, 0) + v
        want.add((g, i, v, sums[g], last.get(g)))
        last[g] = i
    got = running(df, ["g"], ["i"], {"total": F.col("v")}, slices=32)
    got = with_previous(got, ["g"], ["i"], ["i"], slices=32)
    assert {
        (r.g, r.i, r.v, r.total, r.previous.i if r.previous else None) for r in got.collect()
    } == want


def test_large_sides_are_written_not_broadcast(spark):
    df = spark.range(1000).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    small, large = bounded.settle(df), bounded.settle(df, max_rows=999)
    wide = bounded.settle(df, max_bytes=1000)
    assert small.is_small and not large.is_small and not wide.is_small
    assert small.df.count() == large.df.count() == wide.df.count() == 1000
    plan = large.df.join(spark.range(10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan and "strategy=broadcast" not in plan


@pytest.mark.parametrize("expression", [
    "timestamp_micros(id * 1234567)",
    "cast(timestamp_micros(id * 1234567) AS timestamp_ntz)",
    "cast(id AS decimal(20, 3))",
    "id / 3",
    "date_add(date'2000-01-01', cast(id % 5000 AS int))",
    "concat('x\"', id)",
    "cast(cast(id AS string) AS binary)",
])
def test_every_order_type_is_cut(spark, expression):
    df = spark.range(5000).selectExpr(f"{expression} AS x")
    cut = with_slices(df, ["x"], 8).groupBy(SLICE).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rows = sorted(cut.collect(), key=lambda r: r[SLICE])
    assert [r[SLICE] for r in rows] == list(range(8))
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
