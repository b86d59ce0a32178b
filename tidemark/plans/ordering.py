"""Ordered computation over groups of any size.

A window over a whole group runs in one task, so a group that holds a third of a
table would be sorted by one executor. Here each group is cut along its order
columns at split points shared by all groups. Rows are ranked inside a
(group, slice) pair, and a small table of slice totals carries the running values
from slice to slice. The slice of a row depends on its order value alone, so a
task that is run again after an executor is lost gives the same answer.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.bounded import settle

SLICE = "__slice"
MIN_SLICES, MAX_SLICES = 64, 8192
ROWS_PER_SLICE = 1024
_SLICES_PER_TASK = 4
_SAMPLES_PER_SLICE = 24


def shuffle_width(df: DataFrame) -> int:
    """The session's number of shuffle partitions: the knob sized to the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slice_count(df: DataFrame) -> int:
    """Number of slices: some per shuffle partition."""
    return min(max(_SLICES_PER_TASK * shuffle_width(df), MIN_SLICES), MAX_SLICES)


def split_points(
    df: DataFrame, order: Sequence[str], slices: int, rows_per_slice: int = 1
) -> list:
    """At most ``slices - 1`` ascending order values that cut ``df`` about evenly, fewer if
    a slice would get less than ``rows_per_slice`` rows.

    Order values whose hash falls in a fixed share of the hash range are sampled: some per
    slice, whatever the size of ``df``. They only steer the balance of the slices; results
    do not depend on them.
    """
    if slices <= 1:
        return []
    values = df.select(*order)
    total = values.count()
    slices = min(slices, total // rows_per_slice)
    if slices <= 1:
        return []
    every = max(1, total // (slices * _SAMPLES_PER_SLICE))
    if every > 1:
        values = values.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
    rows = sorted(tuple(r) for r in values.dropna().distinct().collect())
    step = max(1, len(rows) // slices)
    picked = rows[step::step][: slices - 1]
    return [r[0] for r in picked] if len(order) == 1 else [dict(zip(order, r)) for r in picked]


def _as_json(value) -> str:
    """Text of a split point in the form ``from_json`` reads."""
    return base64.b64encode(value).decode() if isinstance(value, (bytes, bytearray)) else str(value)


@dataclass(frozen=True)
class Slices:
    """A cut of tables along ``order`` at fixed ``points``."""

    order: Sequence[str]
    points: list

    @staticmethod
    def of(df: DataFrame, order: Sequence[str], slices: int | None = None) -> Slices:
        if slices is None:
            return Slices(
                list(order), split_points(df, order, slice_count(df), ROWS_PER_SLICE)
            )
        return Slices(list(order), split_points(df, order, slices))

    def add(self, df: DataFrame) -> DataFrame:
        """Add the column ``SLICE``: the number of points at or below the order value.

        A binary search over a constant array, written out as one expression per halving,
        so that it stays in generated code. Null order values fall into slice 0.
        """
        if not self.points:
            return df.withColumn(SLICE, F.lit(0))
        if len(self.order) == 1:
            value, element = F.col(self.order[0]), df.schema[self.order[0]].dataType
        else:
            value, element = F.struct(*self.order), df.select(*self.order).schema
        table = F.from_json(F.lit(json.dumps(self.points, default=_as_json)), T.ArrayType(element))
        found, steps = F.lit(0), []
        for bit in reversed(range(len(self.points).bit_length())):
            probe = found + F.lit(1 << bit)
            below = F.get(table, probe - 1) <= value
            steps.append(F.when(below, probe).otherwise(found).alias(f"{SLICE}{bit}"))
            found = F.col(f"{SLICE}{bit}")
        return df.select("*", *steps).select(*df.columns, found.alias(SLICE))

    def within(self, first: int, last: int | None = None) -> Column:
        """Predicate on the (single) order column that holds for all rows of the slices
        ``first`` to ``last``; it reaches the scan, unlike one on the computed slice."""
        column, inside = F.col(self.order[0]), F.lit(True)
        if first > 0:
            inside = column >= F.lit(self.points[first - 1])
        if last is not None and last < len(self.points):
            inside = inside & (column < F.lit(self.points[last]))
        return inside


def with_slices(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add the column ``SLICE`` to ``df``."""
    return Slices.of(df, order, slices).add(df)


def _side(bases: DataFrame, group: Sequence[str]) -> DataFrame:
    """Slice totals as a join side. Null groups would not join, so they are an error."""
    side = settle(bases)
    if side.is_small:
        missing = any(side.table[c].null_count for c in group)
    else:
        nulls = [F.col(c).isNull() for c in group]
        missing = bool(side.rows.where(reduce(Column.__or__, nulls)).take(1))
    if missing:
        raise ValueError(f"null in group columns {list(group)}")
    return side.df


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    position: str | None = None,
    size: str | None = None,
    per_group: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Running sums and zero-based positions along ``order`` inside each ``group``.

    ``position`` names the position column, ``size`` the column with the row count of
    the group. ``per_group`` is a table keyed by ``group`` whose columns are attached
    to the rows (inner join); it is joined to the slice totals, which are few, and only
    those are joined to the rows.
    Group columns must not be null, and ``order`` must be unique inside a group.
    """
    group = list(group)
    order = list(order)
    keyed = with_slices(df, order, slices)
    cells = [*group, SLICE]
    totals = keyed.groupBy(*cells).agg(
        F.count(F.lit(1)).alias("__n"),
        *(F.sum(expr).alias(f"__t_{name}") for name, expr in sums.items()),
    )
    earlier = (
        W.partitionBy(*group).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    )
    bases = totals.select(
        *cells,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(W.partitionBy(*group)).alias("__size"),
        *(F.sum(f"__t_{name}").over(earlier).alias(f"__b_{name}") for name in sums),
    )
    extra: list[str] = []
    if per_group is not None:
        extra = [c for c in per_group.columns if c not in group]
        # Null groups stay until they are refused below.
        known = per_group.withColumn("__known", F.lit(True))
        refused = reduce(Column.__or__, [F.col(c).isNull() for c in group])
        bases = bases.join(known, group, "left").where(F.col("__known") | refused).drop("__known")

    local = W.partitionBy(*cells).orderBy(*order)
    so_far = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = keyed.select(
        "*",
        F.row_number().over(local).alias("__rank"),
        *(F.sum(expr).over(so_far).alias(f"__r_{name}") for name, expr in sums.items()),
    )
    out = [F.col(c) for c in df.columns]
    if position:
        out.append((F.col("__before") + F.col("__rank") - 1).cast("bigint").alias(position))
    if size:
        out.append(F.col("__size").alias(size))
    for name in sums:
        whole = F.coalesce(F.col(f"__b_{name}"), F.lit(0)) + F.coalesce(
            F.col(f"__r_{name}"), F.lit(0)
        )
        out.append(whole.alias(name))
    out.extend(F.col(c) for c in extra)
    return ranked.join(_side(bases, group), cells).select(*out)


def with_position(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    size: str | None = None,
    per_group: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Zero-based position of each row along ``order`` inside its ``group``."""
    return running(df, group, order, {}, name, size, per_group, slices)


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    name: str = "previous",
    slices: int | None = None,
) -> DataFrame:
    """Struct of the ``values`` of the row before, along ``order`` inside ``group``."""
    group, order = list(group), list(order)
    keyed = with_slices(df, order, slices)
    cells = [*group, SLICE]
    # The first row has no row before, so no field may be declared free of nulls.
    entry = F.struct(*(F.when(F.col(order[0]).isNotNull(), F.col(v)).alias(v) for v in values))
    last = keyed.groupBy(*cells).agg(F.max_by(entry, F.struct(*order)).alias("__last"))
    bases = last.select(
        *cells, F.lag("__last").over(W.partitionBy(*group).orderBy(SLICE)).alias("__before")
    )
    local = keyed.withColumn("__local", F.lag(entry).over(W.partitionBy(*cells).orderBy(*order)))
    return local.join(_side(bases, group), cells).select(
        *df.columns, F.coalesce("__local", "__before").alias(name)
    )


def with_reach(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "reach",
    slices: int | None = None,
) -> DataFrame:
    """Largest ``value`` of the rows before, along ``order`` inside ``group``; null at the first."""
    group, order = list(group), list(order)
    keyed = with_slices(df, order, slices)
    cells = [*group, SLICE]
    earlier = W.partitionBy(*group).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    tops = keyed.groupBy(*cells).agg(F.max(value).alias("__top"))
    bases = tops.select(*cells, F.max("__top").over(earlier).alias("__before"))
    inside = W.partitionBy(*cells).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = keyed.withColumn("__local", F.max(value).over(inside))
    return local.join(_side(bases, group), cells).select(
        *df.columns, F.greatest("__before", "__local").alias(name)
    )
