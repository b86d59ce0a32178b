"""Shared steps: stored intermediate tables, folds, bounded label samples, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table written once below ``spark.checkpoint.dir`` and read back, so that a lost
    executor or a second reader never recomputes it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo 5; fold 0 is held out from learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def held_out() -> Column:
    """Is the row held out from learning? A null id is."""
    return F.coalesce(fold() == 0, F.lit(True))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int, allowed: Column | None = None
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents for each of the labels
    0 and 1, chosen by a hash of the id. The chosen ids are at most 2 * per_class rows, which
    bounds the broadcast."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null")
    if allowed is not None:
        rows = rows.where(allowed)
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fitted(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """Run ``fit`` over a bounded sample in one task and return the model it packs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        rows = pa.Table.from_batches(held) if held else None
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(rows)], pa.binary())})

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(row[0]) if row else fit(None)  # an empty table has no task


def digest(spans: Iterable[tuple]) -> str:
    """Lowercase hex SHA-256 of kind:start:end, comma-joined."""
    return hashlib.sha256(joined_spans(spans).encode()).hexdigest()


def joined_spans(spans: Iterable[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
