"""Progress kept across micro-batches, and its automatic commit."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.commit import commit_rows, error_rows
from tidemark.operators.commit_log import CommitLog, CommitOutcome
from tidemark.operators.progress import MARK, apply_commands, mark_committed, with_admitted
from tidemark.operators.topics import not_subscribed
from tidemark.options import GroupOptions
from tidemark.plans.scratch import exists
from tidemark.schemas import TP
from tidemark.streaming.versions import (
    current_version,
    last_batch,
    previous_version,
    write_version,
)

log = logging.getLogger(__name__)

_COMMAND = ["seq", *TP, "op", "offset", "metadata"]

BatchHandler = Callable[[DataFrame, int], DataFrame | None]


def stored_positions(initial: DataFrame, path: str) -> DataFrame:
    """Write positions (topic, partition, offset, metadata) to ``path`` once, and read them as a
    stream. A restart reads what the first start has written."""
    spark = initial.sparkSession
    rows = initial.select(*TP, "offset", "metadata")
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def track_marks(commands: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Highest mark per topic-partition of a stream of commands, in update mode.

    Uses Spark's own aggregation state; a late mark below the position changes nothing.

    ``initial`` is a stream of the positions before the first mark (:func:`stored_positions`).
    Then topic-partitions are those of ``initial``, marks at or below a position there change
    neither it nor its metadata, and ``dirty`` tells whether a mark has moved it. It does not
    matter whether positions or marks arrive first.
    """
    marks = commands.where(F.col("op") == MARK).select(
        *TP, (F.col("offset") + 1).alias("offset"), "metadata", "seq", F.lit(True).alias("dirty")
    )
    if initial is not None:
        positions = initial.select(
            *TP, "offset", "metadata", F.lit(0).cast("bigint").alias("seq"), F.lit(False).alias("dirty")
        )
        marks = marks.unionByName(positions)
    # Of equal positions the one not moved by a mark wins, then the earliest mark.
    best = F.max_by(
        F.struct("offset", "metadata", "dirty"), F.struct("offset", ~F.col("dirty"), -F.col("seq"))
    )
    known = F.bool_or(~F.col("dirty"))
    out = marks.groupBy(*TP).agg(best.alias("s"), known.alias("known"))
    if initial is None:
        return out.select(*TP, "s.offset", "s.metadata")
    return out.where("known").select(*TP, "s.offset", "s.metadata", "s.dirty")


def track_offsets(
    commands: DataFrame,
    initial: DataFrame,
    path: str,
    checkpoint: str,
    rule: str = "partition",
    trigger: dict | None = None,
    admit: bool = False,
) -> StreamingQuery:
    """Apply a stream of marks and resets; versions of the state are written to ``path``.

    Inside a micro-batch commands are applied in ``seq`` order, across micro-batches in
    the order of arrival. ``initial`` is the state before the first command. With ``admit``
    topic-partitions that the state does not have join it at -1 with their first command.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = previous_version(initial, path, batch_id)
            if admit:
                before = write_version(
                    with_admitted(before, batch), f"{path.rstrip('/')}-admitted", batch_id
                )
            write_version(apply_commands(before, batch, rule), path, batch_id)
        finally:
            batch.unpersist()

    return start_batches(commands, step, checkpoint, trigger)


def start_batches(
    stream: DataFrame, step: Callable, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    """Run ``step(batch, batch_id)`` for every micro-batch; by default until caught up."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def marks_of(messages: DataFrame, metadata: str = "") -> DataFrame:
    """Commands that mark every message; only the last of each topic-partition matters."""
    return messages.groupBy(*TP).agg(F.max("offset").alias("offset")).select(
        F.lit(0).cast("bigint").alias("seq"),
        *TP,
        F.lit(MARK).alias("op"),
        "offset",
        F.lit(metadata).alias("metadata"),
    )


def commit_with_retry(commit: Callable[[], CommitOutcome], retries: int, pause: float = 0.1):
    """Run ``commit``, again up to ``retries`` times if it fails; the last failure is raised.

    What another attempt cannot mend (a query that does not fit the tables, a wrong argument)
    is raised at once.
    """
    for attempt in range(retries + 1):
        try:
            return commit()
        except (AnalysisException, TypeError, ValueError):
            raise
        except Exception as error:
            if attempt == retries:
                raise
            log.warning("commit error: %s; retrying", error)
            time.sleep(pause)


def writer_of(checkpoint: str) -> str:
    """Name of a streaming query as a writer of commits: the same after each restart."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def auto_commit(
    messages: DataFrame,
    handler: BatchHandler,
    initial: DataFrame,
    options: GroupOptions,
    member_id: str,
    generation: int,
    state_path: str,
    commits_path: str,
    checkpoint: str,
    commit_every: int = 1,
    trigger: dict | None = None,
    admit: bool = False,
) -> StreamingQuery:
    """Process a stream and commit what was processed.

    ``handler(batch, batch_id)`` does the work and returns commands; ``None`` marks every
    message of the batch. Its commands are written down once and folded from there, so the
    handler's work is not repeated. Offsets are committed only after it, so a failing handler
    commits nothing. The commit runs with every ``commit_every``-th micro-batch; call
    :func:`release` after the stream has ended to commit the rest.

    Commits go to the :class:`CommitLog` at ``commits_path``. Refused ones leave their
    topic-partitions dirty. With ``options.return_errors`` commands outside the subscription and
    refused commits are stored as error rows, one version per micro-batch at
    ``state_path``-errors. With ``admit`` topic-partitions that the state does not have yet join
    it at -1 when their first message arrives.
    """
    at, writer = state_path.rstrip("/"), writer_of(checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            commands = handler(batch, batch_id)
            commands = write_version(
                (marks_of(batch) if commands is None else commands).select(*_COMMAND),
                f"{at}-commands",
                batch_id,
            )
            before = previous_version(initial, state_path, batch_id)
            if admit:
                before = write_version(with_admitted(before, batch), f"{at}-admitted", batch_id)
            folded = apply_commands(before, commands)
            refused = None
            if (batch_id + 1) % commit_every:
                write_version(folded, state_path, batch_id)
            else:
                pending = write_version(folded, f"{at}-pending", batch_id)
                outcome = _commit(
                    pending, options, member_id, generation, commits_path, batch_id, writer
                )
                write_version(mark_committed(pending, outcome.results), state_path, batch_id)
                refused = outcome.errors
            if options.return_errors:
                why = F.concat(F.lit("not subscribed: "), "op")
                errors = error_rows(not_subscribed(commands, before), "mark", why)
                errors = errors if refused is None else errors.unionByName(refused)
                write_version(errors, f"{at}-errors", batch_id)
        finally:
            batch.unpersist()

    every = {"processingTime": f"{options.commit_interval_ms} milliseconds"}
    return start_batches(messages, step, checkpoint, trigger or every)


def _commit(
    state: DataFrame,
    options: GroupOptions,
    member_id: str,
    generation: int,
    commits_path: str,
    batch_id: int,
    writer: str,
) -> CommitOutcome:
    rows = commit_rows(
        state, options.group_id, member_id, generation, options.retention_ms, batch_id
    )
    return commit_with_retry(
        lambda: CommitLog(commits_path).write(rows, writer), options.commit_retries
    )


def release(
    spark: SparkSession,
    options: GroupOptions,
    member_id: str,
    generation: int,
    state_path: str,
    commits_path: str,
) -> DataFrame:
    """Commit what is still dirty in the newest state; store and return the state after it.

    It is a batch of a writer of its own, so it replaces no commit of the stream, and a stream
    that starts again goes on from the stored state.
    """
    at, batch_id = state_path.rstrip("/"), last_batch(spark, state_path)
    pending = write_version(current_version(spark, state_path), f"{at}-pending", batch_id)
    writer = f"release-{writer_of(state_path)}"
    outcome = _commit(pending, options, member_id, generation, commits_path, batch_id, writer)
    return write_version(mark_committed(pending, outcome.results), state_path, batch_id)
