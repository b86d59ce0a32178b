"""Packing by shortest-pack-first over the histogram of lengths.

Documents are tokenised once and cut into pieces of at most ``LIMIT`` tokens. Lengths are placed
longest first, each on the shortest pack that it fits, for all pieces of a length at once: a pack
is a pattern of lengths with a count, and placing splits the counts. The patterns depend on the
histogram alone, which has at most ``LIMIT`` rows at any size of the corpus. Each placement
covers a range of ranks within its length; pieces get their rank by counts per (length, slice)
and are joined back to the patterns by it.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; an
empty table gives no pieces; other columns are ignored. Whole texts are tokenised.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import pieces, vocabulary

__all__ = ["LIMIT", "pack", "patterns", "pieces", "ranked", "vocabulary"]

LIMIT = 2048

_PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_PIECE_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def patterns(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, last rank + 1, first sequence, offset) by shortest pack
    first. Packs of one pattern have consecutive numbers, so a placement is a range of them."""
    packs: dict[int, list[tuple[int, int]]] = {}  # used tokens -> [(first sequence, count)]
    used: list[int] = []
    placed, fresh = [], 0

    def reopen(total: int, first: int, count: int) -> None:
        if total < limit and count:
            if total not in packs:
                packs[total] = []
                heapq.heappush(used, total)
            packs[total].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if used and used[0] + length <= limit:
                total = used[0]
                first, count = packs[total].pop()
                take = min(count, left)
                reopen(total, first + take, count - take)
                if not packs[total]:
                    del packs[heapq.heappop(used)]
                placed.append((length, rank, rank + take, first, total))
                reopen(total + length, first, take)
                rank, left = rank + take, left - take
                continue
            # No pack fits: a new one is the shortest until it is full, so new packs fill one by one.
            each = limit // length
            full, rest = divmod(left, each)
            for slot in range(each):
                count = full + (slot < rest)
                if count:
                    placed.append((length, rank, rank + count, fresh, slot * length))
                    rank += count
            reopen(each * length, fresh, full)
            reopen(rest * length, fresh + full, 1 if rest else 0)
            fresh += full + (rest > 0)
            left = 0
    return placed


def ranked(rows: DataFrame, spread: int | None = None) -> DataFrame:
    """Adds ``rank`` from 0 within each length. A length is cut into slices by a hash of the
    document, so that one holding most pieces is spread over many tasks."""
    n = spread or max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n)))
    counts = sliced.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_slice").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    # All-equal rows are interchangeable, so ties do no harm.
    return (
        sliced.withColumn("_at", F.row_number().over(inside) - 1)
        .join(bases, ["length", "_slice"])
        .withColumn("rank", F.col("_at") + F.col("_base"))
        .drop("_slice", "_at", "_base")
    )


def pack(documents: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = stored(pieces(documents, tokenizer, limit).select(*_PIECES), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = np.asarray(sorted(patterns(histogram, limit)), np.int64).reshape(-1, 5)
    numbered = stored(ranked(cut), "ranked")  # a rank is fixed before sequences are read off it
    shared = documents.sparkSession.sparkContext.broadcast(placed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        width = np.int64(1) << np.int64(50)
        starts = rows[:, 0] * width + rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank"))
            at = np.searchsorted(starts, length * width + rank, side="right") - 1
            columns = [batch.column(c) for c in _PIECES]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])], names=[*_PIECES, "sequence_id", "offset"]
            )

    return numbered.select(*_PIECES, "rank").mapInArrow(run, f"{_PIECE_DDL}, sequence_id bigint, offset bigint")
