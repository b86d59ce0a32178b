"""Words and hashes of whole texts as numpy arrays, one slice of an Arrow batch at a time.

A *word* is a run of characters other than blank and U+0009-U+000D. Those are ASCII, so words
are found on the UTF-8 bytes. Every substring hash comes from one running polynomial over the
bytes of a slice (modulo 2^64, then mixed), so affixes and n-grams cost one subtraction each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about so many bytes, which bounds a worker's memory; one
#: longer text forms a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64
_STEP, _BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, _U), np.ones(1, _U)]

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
SOLID = ~WHITE
#: ASCII letters and all bytes of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_STEP, _BACK)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about `size` bytes of text each."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    begin, held = 0, 0
    for row, n in enumerate(lengths.tolist()):
        if row > begin and held + n > size:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += n
    if len(lengths) > begin:
        yield batch.slice(begin)


class Texts:
    """Bytes, document bounds and words of some texts (null counts as empty). `inside` tells
    which bytes belong to words, by default all that are not white."""

    def __init__(self, column: pa.Array, lower: bool = False, inside: np.ndarray = SOLID):
        column = pc.fill_null(column, "").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
        self.data = LOWER[data] if lower else data
        self.bounds = offsets - offsets[0]
        self.n = len(column)
        self._sums = None
        solid = inside[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        cuts = self.bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(solid))]
        first[cuts] = solid[cuts]
        last[cuts - 1] = solid[cuts - 1]
        self.solid = solid
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.word_bounds = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.word_bounds))

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each document are flagged."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def per_doc_words(self, flags: np.ndarray) -> np.ndarray:
        """How many words of each document are flagged."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.word_bounds[1:]] - sums[self.word_bounds[:-1]]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range; equal bytes give equal hashes in any slice."""
        ahead, back = _power(len(self.data) + 1)
        if self._sums is None:
            with np.errstate(over="ignore"):
                terms = (self.data.astype(_U) + _U(1)) * ahead[: len(self.data)]
                self._sums = np.concatenate((np.zeros(1, _U), np.cumsum(terms, dtype=_U)))
        with np.errstate(over="ignore"):
            h = (self._sums[end] - self._sums[start]) * back[start]
            return mixed(h + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def windows(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words inside a document, and the first word of each."""
        count = len(words) - size + 1
        if count <= 0:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[: count] == self.doc[size - 1 :])
        return joined(words, at, size), at


def joined(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` consecutive word hashes from each place on; order counts."""
    with np.errstate(over="ignore"):
        h = np.full(len(at), _U(size), _U)
        for i in range(size):
            h = mixed(h * _STEP + words[at + i])
    return h


def repeated(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(in a group of two or more, not first of its group), groups being equal (doc, value)."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    group = same.copy()
    group[:-1] |= same[1:]
    in_group, later = np.empty(len(d), bool), np.empty(len(d), bool)
    in_group[order], later[order] = group, same
    return in_group, later
