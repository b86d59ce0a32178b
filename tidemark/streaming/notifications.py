"""Rebalance notifications as assignments arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.rebalance import attempt_rows, distinct_owned, rebalance_attempts, rebalance_headers
from tidemark.plans.bounded import JoinSide, settle
from tidemark.streaming.tracker import start_batches
from tidemark.streaming.versions import previous_version, write_version

# One row per owned partition; a row without topic stands for an attempt that ended
# without partitions, or failed at the named stage.
GENERATIONS = "generation int, member_id string, topic string, partition int, stage string"

# The same, for attempts that arrive in parts: every row carries the number of different rows
# that its attempt has.
GENERATION_PARTS = f"{GENERATIONS}, expected int"

_KEYS = ["generation", "member_id"]


def split_ready(rows: DataFrame) -> DataFrame:
    """Adds ``ready``: has the row's attempt arrived whole, and every earlier one of its member?

    An attempt is whole once as many different rows are there as it expects (null: at once).
    """
    attempts = rows.groupBy(*_KEYS).agg(
        F.max("expected").alias("_expected"), F.count(F.lit(1)).alias("_n")
    )
    open_ = attempts.where(F.col("_n") < F.col("_expected"))
    first_open = open_.groupBy("member_id").agg(F.min("generation").alias("_open"))
    ready = F.col("_open").isNull() | (F.col("generation") < F.col("_open"))
    return rows.join(first_open, "member_id", "left").select(*rows.columns, ready.alias("ready"))


def stored_owned(rows: DataFrame, path: str, batch_id: int) -> JoinSide:
    """Owned partitions of a batch, each once, stored however few: batches of a size that the driver
    may hold would take memory there in every plan and broadcast that joins them, one after another."""
    return JoinSide(write_version(distinct_owned(rows), path, batch_id), None)


def rebalance_stream(
    generations: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the notifications of arriving generations.

    ``path``/events receives the notifications, ``path``/partitions their partitions,
    ``path``/last the newest attempt of each member, which is the base of its next one.

    Without a column ``expected`` each micro-batch must hold whole attempts. With it
    (``GENERATION_PARTS``) an attempt may arrive in parts: its rows, and those of later attempts
    of the member, are held in ``path``/held until it is whole. Attempts of a member begin to
    arrive in order; rows of an attempt beyond the expected number come too late.
    """
    spark = generations.sparkSession
    nothing = spark.createDataFrame([], GENERATIONS)
    in_parts = "expected" in generations.columns
    nothing_held = spark.createDataFrame([], GENERATION_PARTS)

    def admitted(batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of the attempts that are whole now; the others are kept for the next batch."""
        held = previous_version(nothing_held, f"{path}/held", batch_id)
        rows = held.unionByName(batch.select(*held.columns)).distinct()
        split = write_version(split_ready(rows), f"{path}/arrived", batch_id)
        write_version(split.where(~F.col("ready")).drop("ready"), f"{path}/held", batch_id)
        return split.where("ready").select(*nothing.columns)

    def step(batch: DataFrame, batch_id: int) -> None:
        if not in_parts:  # parts are read once, and stored when they are whole
            batch.persist()
        try:
            whole = admitted(batch, batch_id) if in_parts else batch
            last = previous_version(nothing, f"{path}/last", batch_id)
            rows = last.unionByName(whole)
            old = last.select(*_KEYS).distinct()
            owned = rows.where(F.col("topic").isNotNull() & F.col("stage").isNull())
            owned = stored_owned(owned, f"{path}/owned", batch_id)
            failed = rows.where(F.col("stage").isNotNull()).select(*_KEYS, "stage")
            members = rows.select(*_KEYS)
            attempts = settle(rebalance_attempts(owned.rows, failed, members)).df
            new = settle(attempts.join(old, _KEYS, "left_anti")).df
            write_version(rebalance_headers(new), f"{path}/events", batch_id)
            write_version(attempt_rows(owned, new), f"{path}/partitions", batch_id)
            newest = attempts.groupBy("member_id").agg(F.max("generation").alias("generation"))
            write_version(rows.join(newest, _KEYS).select(*rows.columns), f"{path}/last", batch_id)
        finally:
            batch.unpersist()

    return start_batches(generations, step, checkpoint, trigger)
