"""A group's commit log, written by many members, with a fence around generations.

The log has two tables below its path: ``commits``, append-only by (group, member, writer, batch),
and ``generations``, one row per member of an opened generation. A commit is refused on the write
path unless its member belongs to the newest generation of its group. Between that test and the
write a newer generation may open; what a slow member then still writes is ignored by readers,
because it was committed after its generation had ended. Both tests are equi-joins on the group.

Old commits are folded into a snapshot, the newest commit per group and topic-partition. Batches
lie in numbered epochs; snapshot ``v`` covers the epochs up to ``v``, writers use epoch ``v + 2``,
and readers take snapshot ``v`` with the epochs after it. So a reader's volume does not grow with
the history, and a writer that still uses the epoch before is not overlooked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.commit import commit_results, error_rows, write_commits
from tidemark.operators.start import newest_commits
from tidemark.plans.bounded import settle
from tidemark.plans.scratch import numbered
from tidemark.schemas import COMMIT_LOG, GENERATIONS, TP

#: Why a commit is refused.
UNKNOWN_MEMBER, ILLEGAL_GENERATION = "unknown member", "illegal generation"


@dataclass(frozen=True)
class CommitLog:
    """The commit log below ``path``."""

    path: str

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    # --- generations ---

    def open_generation(self, members: DataFrame, at: Column | None = None) -> None:
        """Open generations: ``members`` has group_id, generation and member_id. Opening one
        again replaces it."""
        rows = members.select(
            "group_id",
            F.col("generation").cast("int").alias("generation"),
            "member_id",
            (F.current_timestamp() if at is None else at).alias("opened_at"),
        ).distinct()
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("group_id", "generation")
            .parquet(self._at("generations"))
        )

    def generations(self, spark: SparkSession) -> DataFrame:
        """Members of all opened generations; none before the first."""
        return _read(spark, self._at("generations"), GENERATIONS)

    def _tenures(self, spark: SparkSession) -> DataFrame:
        """(group_id, generation, opened_at, closed_at): a generation ends when a newer one opens.

        Some rows per group and generation, not per commit.
        """
        opened = self.generations(spark).groupBy("group_id", "generation").agg(
            F.min("opened_at").alias("opened_at")
        )
        later = Window.partitionBy("group_id").orderBy("generation").rowsBetween(
            1, Window.unboundedFollowing
        )
        return opened.withColumn("closed_at", F.min("opened_at").over(later))

    # --- writing ---

    def judged(self, rows: DataFrame) -> DataFrame:
        """Commit rows with ``refusal``: null, or why the row must not be stored.

        A group without opened generations is bound by what it has committed: nothing older
        than its newest stored generation is taken.
        """
        spark = rows.sparkSession
        registry = self.generations(spark)
        current = registry.groupBy("group_id").agg(F.max("generation").alias("_current"))
        committed = self.commits(spark).groupBy("group_id").agg(
            F.max("generation").alias("_committed")
        )
        bounds = settle(current.join(committed, "group_id", "full")).df
        members = registry.join(
            current.withColumnRenamed("_current", "generation"), ["group_id", "generation"]
        )
        known = settle(members.select("group_id", "member_id").distinct()).df
        # Null groups and members have no generation: they are refused like unknown ones.
        judged = rows.join(bounds, "group_id", "left").join(
            known.withColumn("_known", F.lit(True)), ["group_id", "member_id"], "left"
        )
        fenced = F.col("_current").isNotNull()
        older = F.col("generation") < F.coalesce("_committed", "generation")
        refusal = (
            F.when(F.col("group_id").isNull() | F.col("member_id").isNull(), UNKNOWN_MEMBER)
            .when(F.col("generation").isNull(), ILLEGAL_GENERATION)
            .when(fenced & (F.col("generation") != F.col("_current")), ILLEGAL_GENERATION)
            .when(fenced & F.col("_known").isNull(), UNKNOWN_MEMBER)
            .when(~fenced & older, ILLEGAL_GENERATION)
        )
        return judged.select(*rows.columns, refusal.alias("refusal"))

    def write(self, rows: DataFrame, writer: str | None = None) -> CommitOutcome:
        """Store the rows that are not refused, as one batch of ``writer``.

        The rows and the judgement are evaluated once; what the outcome reports is what was
        stored.
        """
        held = settle(self.judged(rows)).rows
        accepted = held.where(F.col("refusal").isNull()).drop("refusal")
        epoch = self.version(rows.sparkSession) + 2
        write_commits(accepted, self._at(f"commits/epoch={epoch}"), writer)
        return CommitOutcome(accepted, held.where(F.col("refusal").isNotNull()))

    # --- reading ---

    def version(self, spark: SparkSession) -> int:
        """Number of the newest snapshot, 0 before the first."""
        return max(numbered(spark, self._at("snapshot"), "version"), default=0)

    def commits(self, spark: SparkSession, up_to: int | None = None) -> DataFrame:
        """The newest snapshot and all commits stored after it (in epochs ``up_to`` a number)."""
        folded = self.version(spark)
        log = _read(spark, self._at("commits"), f"{COMMIT_LOG}, epoch int")
        after = F.col("epoch") > folded
        tail = log.where(after if up_to is None else after & (F.col("epoch") <= up_to)).drop("epoch")
        if not folded:
            return tail
        return tail.unionByName(_read(spark, self._at(f"snapshot/version={folded}"), COMMIT_LOG))

    def valid(self, spark: SparkSession, up_to: int | None = None) -> DataFrame:
        """Commits made while their generation lasted (all, where none was ever opened)."""
        tenures = settle(self._tenures(spark).drop("opened_at")).df
        kept = self.commits(spark, up_to).join(tenures, ["group_id", "generation"], "left")
        ended = F.col("closed_at").isNotNull() & (F.col("committed_at") >= F.col("closed_at"))
        return kept.where(~ended).drop("closed_at")

    def compact(self, spark: SparkSession) -> None:
        """Make the next snapshot, from the last one and the epoch that no writer uses any more.

        What no reader would take any more (commits after the end of their generation) is left
        out of it. Folded epochs and older snapshots can be deleted at any time.
        """
        following = self.version(spark) + 1
        settled = self.valid(spark, up_to=following)
        newest_commits(settled).write.mode("overwrite").parquet(
            self._at(f"snapshot/version={following}")
        )


@dataclass(frozen=True)
class CommitOutcome:
    """What became of a batch of commits."""

    accepted: DataFrame
    refused: DataFrame

    @property
    def results(self) -> DataFrame:
        """Result per topic-partition, for ``mark_committed``: refused ones carry their error."""
        return commit_results(self.accepted, self.refused.withColumn("message", F.col("refusal")))

    @property
    def errors(self) -> DataFrame:
        """The refused commits as error rows."""
        return error_rows(self.refused, "commit", F.col("refusal"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
