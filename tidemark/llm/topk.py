"""Exact top-k search with a bit-sliced index.

Every attribute (dimension) of a block of vectors is kept as bit slices: bitmap b holds bit b of
the attribute, counted from its least value in the block, for all vectors of the block. The score
of a query is a weighted sum of attributes; it is added up for all vectors at once with bitmap
arithmetic: each signed digit of a weight puts the attribute's slices, or their complements, into
columns by place value, and full adders reduce every column to one slice. The top rows are then
selected from the most significant slice downward; rows equal to the boundary are resolved by id,
and the few rows found are read out with their exact scores.

Slices are made once for each block and written. Queries travel to the blocks, and a block is
read once per task and held while its queries stream past, so a task's memory is one block. A
block is copied only as long as there are fewer blocks than tasks. The best rows of each block
are merged per query.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part, nor
do rows without id, nor those with a component so large that a score could leave 64 bits (beyond
the root of 2^62 / dimension after scaling). A query's partners are the vectors of its own
dimension. Ties go to the smaller id. Of several rows with the same query id the one with the
least vector asks; repeated rows are partners each, but never of their own id. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Numbers (rows times dimension) of an index block, about, and its least number of rows.
INDEX_NUMBERS, INDEX_ROWS = 1 << 22, 1024

_KEY = ["dims", "block"]
_SLICED = "dims int, block long, ids binary, low binary, bits binary, slices binary"
_FOUND = "query_id long, vec_id long, score long"
_WORD = (1 << 64) - 1


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, q): whole numbers floor(scale * x) of the vectors that take part."""
    x = F.col("embedding")
    scaled = lambda v: F.lit(scale) * v.cast("double")
    largest = F.sqrt(F.lit(2.0**62) / F.greatest(F.size(x), F.lit(1)))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(scaled(v)) < largest))
    whole = F.transform(x, lambda v: F.floor(scaled(v)).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select(F.col("vec_id").cast("long"), whole.alias("q"))


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least value and number of bits of each attribute, [slice, word] bitmaps of all attributes
    one after the other) of [row, dimension] whole numbers."""
    rows, dims = values.shape
    low = values.min(axis=0, initial=np.iinfo(np.int64).max) if rows else np.zeros(dims, np.int64)
    above = (values - low).astype(np.uint64)
    bits = np.array([int(a).bit_length() for a in above.max(axis=0, initial=0)], np.int64)
    out = np.zeros((int(bits.sum()), -(-rows // 64) * 8), np.uint8)
    at = 0
    for d in range(dims):
        for b in range(bits[d]):
            packed = np.packbits(((above[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            out[at, : len(packed)] = packed
            at += 1
    return low, bits, out.view(np.uint64)


def digits(weight: int) -> Iterator[tuple[int, int]]:
    """(place, 1 or -1) of the non-adjacent form of a whole number."""
    place = 0
    while weight:
        if weight & 1:
            digit = 2 - (weight & 3)
            weight -= digit
            yield place, digit
        weight >>= 1
        place += 1


class Block:
    """The bit slices of some vectors in order of their ids."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, bits: np.ndarray, slices: np.ndarray):
        self.ids, self._low, self._bits = ids, low, bits
        self._words = -(-len(ids) // 64)
        self._slices, self._turned = slices, ~slices
        self._first = np.concatenate(([0], np.cumsum(bits)))
        self._all = np.zeros(self._words * 64, np.uint8)
        self._all[: len(ids)] = 1

    def sums(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(slices of the weighted sum of each vector, least first, and a constant to add)."""
        columns: list[list[np.ndarray]] = []
        constant = 0
        for d in np.flatnonzero(weights):
            weight, width, first = int(weights[d]), int(self._bits[d]), self._first[d]
            constant += weight * int(self._low[d])
            for place, digit in digits(weight):
                # -x is the complement of x less the largest number of that width.
                source = self._slices if digit > 0 else self._turned
                if digit < 0:
                    constant -= ((1 << width) - 1) << place
                while len(columns) < place + width:
                    columns.append([])
                for b in range(width):
                    columns[place + b].append(source[first + b])
        out = []
        for place, column in enumerate(columns):
            while len(column) > 1:
                a, b = column.pop(), column.pop()
                half = a ^ b
                carry = a & b
                if column:
                    c = column.pop()
                    carry |= half & c
                    half ^= c
                column.append(half)
                if place + 1 == len(columns):
                    columns.append([])
                columns[place + 1].append(carry)
            out.append(column[0] if column else np.zeros(self._words, np.uint64))
        return out, constant

    def best(self, query_id: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k highest sums among rows of other ids; ties at the boundary are
        taken in order of ids."""
        total, constant = self.sums(weights)
        others = self._all.copy()
        lo, hi = np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, side="right")
        others[lo:hi] = 0
        rows = best_rows(total, np.packbits(others, bitorder="little").view(np.uint64), k)
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        scores = np.full(len(rows), constant & _WORD, np.uint64)
        for place, slice_ in enumerate(total[:64]):
            scores += ((slice_[word] >> bit) & np.uint64(1)) << np.uint64(place)  # modulo 2^64
        return self.ids[rows], scores.view(np.int64)


def _ones(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(total: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the allowed rows with the k highest sums: slices are walked from the most
    significant downward; ties at the boundary are taken by row number."""
    sure, open_, count = np.zeros_like(allowed), allowed, 0
    for slice_ in reversed(total):
        high = open_ & slice_
        n = int(np.bitwise_count(high).sum())
        if count + n > k:
            open_ = high
        elif n:
            sure |= high
            count += n
            open_ = open_ & ~high
            if count == k:
                break
    return np.concatenate((_ones(sure), _ones(open_)[: k - count]))


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dims, block, rows in zip(batch["dims"].to_pylist(), batch["block"].to_pylist(), batch["rows"]):
            ids = rows.values.field("vec_id").to_numpy(zero_copy_only=False)
            values = rows.values.field("q").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
            order = np.argsort(ids, kind="stable")
            parts = (ids[order], *slices_of(values[order]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([block], pa.int64()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)],
                names=["dims", "block", "ids", "low", "bits", "slices"],
            )


def _numbers(column: Column | pa.Array, at: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(column[at].as_buffer(), kind)


def search(vectors: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best partners of each row whose id is divisible
    by ``every``."""
    spark = vectors.sparkSession
    # More than k equal rows add nothing to any answer, so a row repeated without end stays small.
    rows = quantised(vectors, scale).groupBy("vec_id", "q").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    rows = stored(rows.withColumn("dims", F.size("q")), "quantised")
    # One row per length of vectors: no more than the longest vector has components.
    room = F.greatest(F.floor(F.lit(INDEX_NUMBERS) / F.greatest(F.col("dims"), F.lit(1))), F.lit(INDEX_ROWS))
    blocks = rows.groupBy("dims").agg(F.sum("n").alias("n")).select("dims", F.ceil(F.col("n") / room).cast("long").alias("blocks"))
    total = blocks.agg(F.sum("blocks")).first()[0] or 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    copies = max(-(-tasks // total), 1)

    placed = rows.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).join(F.broadcast(blocks), "dims")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "q", "_"), "blocks"))
    index = stored(
        placed.repartition(int(total), *_KEY).groupBy(*_KEY).agg(F.collect_list(F.struct("vec_id", "q")).alias("rows")).mapInArrow(_sliced, _SLICED),
        "slices",
    )
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = asked.withColumn("dims", F.size("q")).join(F.broadcast(blocks), "dims")
    # Blocks and queries in one stream per (block, copy): the block first, then its queries.
    nothing = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    copy = lambda numbers: F.explode(numbers).alias("copy")
    held = index.select(
        *_KEY, copy(F.sequence(F.lit(0), F.lit(copies - 1))), F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<long>").alias("q"), "ids", "low", "bits", "slices",
    )
    wanted = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        *_KEY, F.pmod(F.xxhash64("vec_id"), F.lit(copies)).cast("int").alias("copy"), "vec_id", "q", *nothing("ids", "low", "bits", "slices")
    )
    lanes = max(int(total) * copies, 1)
    stream = held.unionByName(wanted).repartition(lanes, *_KEY, "copy").sortWithinPartitions(*_KEY, "copy", F.asc_nulls_first("vec_id"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            found = []
            for at, query in enumerate(batch["vec_id"].to_pylist()):
                if query is None:
                    ids, low, bits = (_numbers(batch[c], at) for c in ("ids", "low", "bits"))
                    slices = _numbers(batch["slices"], at, np.uint64).reshape(int(bits.sum()), -(-len(ids) // 64))
                    block = Block(ids, low, bits, slices)
                else:
                    weights = batch["q"][at].values.to_numpy(zero_copy_only=False)
                    ids, scores = block.best(query, weights, k)
                    found.append((np.full(len(ids), query), ids, scores))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    best = stream.select("vec_id", "q", "ids", "low", "bits", "slices").mapInArrow(run, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
