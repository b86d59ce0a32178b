"""Packing by bounded-space online best-fit.

Documents are tokenised once; only those longer than ``LIMIT`` are cut, into pieces of ``LIMIT``
tokens and a rest. Every task packs a stream of pieces as they come: each goes into the open bin
with the least free space that still holds it. A fixed number of bins is open; their free spaces
are the set bits of one number, so the best fit is the lowest set bit from the piece's length on.
When a new bin would be one too many, the fullest closes.

A task's stream ends with some bins open. Their pieces go on to a next round with fewer tasks, so
that only the last round's open bins stay as they are, whatever the number of tasks. A piece's
task follows from its row number in the stored table, not from a key, so repeated documents spread
evenly and a task run again after a lost executor sees the same stream.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; rows
with a null id are packed too; an empty table gives no pieces; other columns are ignored. Whole
texts are tokenised.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import pieces, vocabulary

LIMIT = 4096
#: Bins open at a time in a task.
OPEN_BINS = 256
#: Sequences that a task fills, about.
TASK_SEQUENCES = 1024
#: Every round has so many times fewer tasks than the one before.
NARROWING = 16

__all__ = ["LIMIT", "OPEN_BINS", "BestFit", "pack", "vocabulary"]

_PLACED = "row long, bin long, offset long, closed boolean"
_SCHEMA = pa.schema([("row", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_())])


class BestFit:
    """Bins of ``limit`` tokens of which at most ``most`` are open."""

    def __init__(self, limit: int = LIMIT, most: int = OPEN_BINS):
        self.limit, self.most = limit, most
        self.spaces = 0  # bit f: some open bin has f tokens free
        self.bins: dict[int, list[int]] = {}  # free tokens -> numbers of open bins
        self.count = self.fresh = 0

    def _open(self, number: int, free: int) -> None:
        held = self.bins.setdefault(free, [])
        held.append(number)
        self.spaces |= 1 << free
        self.count += 1

    def _take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            del self.bins[free]
            self.spaces &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """(bin, offset there, bins closed by this) for a piece of ``length`` <= limit tokens."""
        closed = []
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.fresh, self.limit
            self.fresh += 1
            if self.count >= self.most and length < self.limit:
                closed.append(self._take((self.spaces & -self.spaces).bit_length() - 1))
        if free > length:
            self._open(number, free - length)
        else:
            closed.append(number)
        return number, self.limit - free, closed

    def still_open(self) -> list[int]:
        return [n for held in self.bins.values() for n in held]


def _packed(rows: DataFrame, tasks: int, limit: int, most: int, base: int, last: bool) -> DataFrame:
    """(row, bin, offset, closed) of a round; in the last one every bin ends closed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, first = BestFit(limit, most), base + (TaskContext.get().partitionId() << 32)
        waiting: dict[int, list[tuple[int, int]]] = {}

        def put(numbers: Iterable[int], closed: bool) -> pa.RecordBatch:
            out = [(row, first + n, offset, closed) for n in numbers for row, offset in waiting.pop(n)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _SCHEMA.types)] if out else [pa.array([], t) for t in _SCHEMA.types], schema=_SCHEMA)

        for batch in batches:
            done: list[int] = []
            for row, length in zip(batch.column("row").to_pylist(), batch.column("length").to_pylist()):
                number, offset, closed = fit.place(length)
                waiting.setdefault(number, []).append((row, offset))
                done += closed
            yield put(done, True)
        yield put(fit.still_open(), last)

    # The stream of a task: hash of the row number, so every task sees a mix of lengths.
    dealt = rows.select("row", "length").repartition(tasks, F.xxhash64(F.lit(base), "row")).sortWithinPartitions(F.xxhash64(F.lit(base), "row"), "row")
    return dealt.mapInArrow(run, _PLACED)


def pack(documents: DataFrame, tokenizer: str, limit: int = LIMIT, most: int = OPEN_BINS) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = pieces(documents, tokenizer, limit).drop("doc_tokens").withColumn("row", F.monotonically_increasing_id())
    cut = stored(cut, "pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-total // (limit * TASK_SEQUENCES)), 1)
    rounds, rows, base = [], cut, 0
    while True:
        placed = stored(_packed(rows, tasks, limit, most, base, tasks == 1), "placed")
        rounds.append(placed.where("closed"))
        if tasks == 1:
            break
        rows = cut.join(placed.where("not closed").select("row"), "row", "left_semi")
        base += 1 << 54
        tasks = -(-tasks // NARROWING)
    everywhere = rounds[0]
    for other in rounds[1:]:
        everywhere = everywhere.unionByName(other)
    return cut.join(everywhere, "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )
