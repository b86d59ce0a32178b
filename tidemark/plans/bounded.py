"""Size checks that decide between a broadcast join and a shuffle join.

Join sides such as start positions or fold summaries hold one row per
topic-partition. That is usually small, but nothing proves it, so the side is
measured first. Within a row and byte limit it becomes a local relation that is safe
to broadcast; beyond it, it is written to the checkpoint folder (so it is computed
once) and Spark joins it by shuffle, with adaptive skew handling.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.scratch import scratch_path

MAX_ROWS = 200_000
MAX_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class JoinSide:
    """An evaluated table; ``table`` holds its rows when they are within the limit."""

    rows: DataFrame
    table: pa.Table | None

    @property
    def is_small(self) -> bool:
        return self.table is not None

    @property
    def df(self) -> DataFrame:
        """The rows as a join side: broadcast while small, never beyond the limit."""
        return F.broadcast(self.rows) if self.is_small else by_shuffle(self.rows)

    def bounded(self, derived: DataFrame) -> DataFrame:
        """Mark a table derived from these rows, with at most as many of them, likewise."""
        return F.broadcast(derived) if self.is_small else derived


def by_shuffle(df: DataFrame) -> DataFrame:
    """Mark a join side that Spark must not broadcast by itself.

    Spark goes by the size of the files, and a stored table that Parquet encodes well, such as
    owned partitions in order, takes more than a hundred times that in the driver's memory.
    """
    return df.hint("merge")


def settle(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> JoinSide:
    """Evaluate ``df`` once, so that it can be joined or read several times.

    Its rows are counted and measured on the executors; only a table within both limits
    is fetched. A larger one is written to the checkpoint folder.
    """
    spark = df.sparkSession
    held = df.persist()
    try:
        rows, size = held.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
        if rows <= max_rows and (size or 0) <= max_bytes:
            table = held.toArrow()
            return JoinSide(spark.createDataFrame(table, schema=df.schema), table)
        path = scratch_path(spark, "side")
        held.write.parquet(path)
        return JoinSide(spark.read.schema(df.schema).parquet(path), None)
    finally:
        held.unpersist()


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Is ``df`` within both limits? Its rows are counted first, which for a stored table
    takes only file footers; their size is measured only if they are few."""
    if df.count() > max_rows:
        return False
    return (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes."""
    total = F.lit(8 * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return total.cast("bigint")
