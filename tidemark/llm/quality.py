"""Quality rules: word and character n-gram logistic regression beside fixed counts.

The counts (words, symbols, repeated lines, repeated 3-word windows) decide what fails at
once. The rest is scored by a logistic regression on hashed words, word pairs and character
trigrams, as relative frequencies, trained on labelled rows and calibrated on labelled rows
it was not trained on. Texts are scored in Arrow batches; a text passes with a calibrated
probability of at least ``keep``.

Defined cases: a null or empty text has no words and fails the base rule; documents without
labels, or labels of one class only, give probability 0.5 (kept); repeated rows are scored
each; other columns are ignored. Whole texts are read, in slices of bounded size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import logistic
from tidemark.llm.common import fitted, labelled_sample
from tidemark.llm.textkit import Texts, repeated, slices

#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Hash sizes of the two feature spaces, and the fixed point of the stored weights.
WORD_BITS, GRAM_BITS, POINT = 18, 18, 1 << 24
#: Scale of relative frequencies.
SCALE = 30.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, score double"
)


@dataclass
class Model:
    """Integer weights, so that a sum does not depend on the slice a text came in."""

    words: np.ndarray
    grams: np.ndarray
    bias: float
    slope: float
    offset: float


def _word_features(texts: Texts, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each word and each word pair, and the first word's index."""
    pairs, at = texts.windows(hashes, 2)
    shift = np.uint64(64 - WORD_BITS)
    return (
        np.concatenate((hashes >> shift, pairs >> shift)).astype(np.int64),
        np.concatenate((np.arange(len(hashes)), at)),
    )


def _gram_features(texts: Texts) -> np.ndarray:
    """Feature of the character trigram (of bytes) at each place."""
    d = texts.data.astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.int64)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)


def _gram_bounds(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    first = np.minimum(texts.bounds[:-1], max(len(texts.data) - 2, 0))
    return first, np.maximum(first, texts.bounds[1:] - 2)


def _linear(model: Model, texts: Texts, hashes: np.ndarray) -> np.ndarray:
    feature, word = _word_features(texts, hashes)
    by_word = np.bincount(texts.doc[word], model.words[feature].astype(float), minlength=texts.n)
    count = np.maximum(np.bincount(texts.doc[word], minlength=texts.n), 1)
    sums = np.concatenate(([0], np.cumsum(model.grams[_gram_features(texts)])))
    first, last = _gram_bounds(texts)
    by_gram = (sums[last] - sums[first]) / np.maximum(last - first, 1)
    return SCALE * (by_word / count + by_gram) / POINT + model.bias


def counts(texts: Texts, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document."""
    starts = (texts.data & 0xC0) != 0x80
    windows, at = texts.windows(hashes, 3)
    again, _ = repeated(texts.doc[at], windows)
    covered = np.zeros(len(hashes) + 3, bool)
    for i in range(3):
        covered[at[again] + i] = True
    breaks = np.flatnonzero(texts.data == 10)
    begin = np.sort(np.concatenate((texts.bounds[:-1], breaks + 1)))
    stop = np.sort(np.concatenate((breaks, texts.bounds[1:])))
    solid = np.concatenate(([0], np.cumsum(texts.solid)))
    full = solid[stop] > solid[begin]
    begin, stop = begin[full], stop[full]
    line_doc = np.searchsorted(texts.bounds, begin, side="right") - 1
    _, later = repeated(line_doc, texts.hashes(begin, stop))
    return {
        "n_words": np.diff(texts.word_bounds),
        "word_chars": texts.per_doc(texts.solid & starts),
        "n_symbols": texts.per_doc(_SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_doc[later], minlength=texts.n),
        "n_repeat_words": texts.per_doc_words(covered[: len(hashes)]),
    }


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(doc, feature, value, n) of each slice: what training sees of the texts."""
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    for part in slices(batch, "text"):
        texts = Texts(part.column("text"))
        feature, word = _word_features(texts, texts.word_hashes())
        grams = _gram_features(texts)
        first, last = _gram_bounds(texts)
        spans = last - first
        place = np.repeat(first - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
        size = 1 << WORD_BITS
        key = np.concatenate(
            (texts.doc[word] * (2 * size) + feature, np.repeat(np.arange(texts.n), spans) * (2 * size) + size + grams[place])
        )
        found, count = np.unique(key, return_counts=True)
        doc, feature = found // (2 * size), found % (2 * size)
        total = np.stack((np.bincount(texts.doc[word], minlength=texts.n), spans))
        yield doc, feature, SCALE * count / np.maximum(total[(feature >= size).astype(int), doc], 1), texts.n


def _fit(sample: pa.Table | None) -> bytes:
    size = 1 << WORD_BITS
    empty = Model(np.zeros(size, np.int32), np.zeros(1 << GRAM_BITS, np.int32), 0.0, 1.0, 0.0)
    if sample is None or not sample.num_rows:
        return pickle.dumps(empty)
    sample = sample.sort_by("doc_id")
    label = np.asarray(sample.column("label"), dtype=np.int64)
    docs, features, values, seen = [], [], [], 0
    for doc, feature, value, n in _rows(sample.column("text").combine_chunks()):
        docs.append(doc + seen)
        features.append(feature.astype(np.int32))
        values.append(value.astype(np.float32))
        seen += n
    doc, feature, value = map(np.concatenate, (docs, features, values))
    aside = np.arange(len(label)) % 4 == 3
    learn = ~aside[doc]
    place = np.cumsum(~aside) - 1
    weights, bias = logistic.fit_sparse(place[doc[learn]], feature[learn], value[learn], label[~aside], 2 * size)
    score = np.bincount(doc, value * weights[feature], minlength=len(label)) + bias
    slope, offset = logistic.calibrate(score[aside], label[aside])
    whole = np.round(weights * POINT).astype(np.int64)
    return pickle.dumps(Model(whole[:size], whole[size:], bias, slope, offset))


def train(documents: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model:
    """Fit on at most ``per_class`` labelled documents of each quality label (chosen by a hash of
    the id); every fourth of them only calibrates."""
    return pickle.loads(fitted(labelled_sample(documents, labels, "quality", per_class), _fit))


def score(documents: DataFrame, model: Model, keep: float = 0.5) -> DataFrame:
    """Base counts, base verdict, probability and verdict of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted_model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"))
                hashes = texts.word_hashes()
                base = counts(texts, hashes)
                failed = (base["n_words"] < MIN_WORDS) | (
                    100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"]
                )
                p = logistic.sigmoid(fitted_model.slope * _linear(fitted_model, texts, hashes) + fitted_model.offset)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), **{k: pa.array(v, pa.int64()) for k, v in base.items()},
                     "base_failed": failed, "kept": ~failed & (p >= keep), "score": p}
                )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
