"""Language of code-switched text by a linear-chain conditional random field.

Every word of a text is a place of a chain whose labels are languages. Its features are the
word itself (lexicon), its beginnings and endings, and its byte trigrams, all hashed; the
transition weights between neighbouring words are learned too. Words get label probabilities by
forward-backward, and a text the language with the highest mean probability. Chains are cut
after ``CHAIN`` words, so that any length of text is covered in bounded memory.

Training takes documents of known language, a bounded number of each. Since they are mostly in
one language, half of the training chains are spliced from two documents, which is where the
transition weights come from.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any training
row every other text is ``und`` too; repeated rows are labelled each; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fitted, held_out
from tidemark.llm.textkit import LETTERS, Texts, slices

CHAIN = 64
BITS = 16
#: Words of the training sample, at most about so many of each language.
TRAIN_WORDS = 60_000
UNKNOWN = "und"

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, n_switches bigint"


@dataclass
class Model:
    languages: list[str]
    emissions: np.ndarray
    transitions: np.ndarray


def _features(texts: Texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into words, hashed feature) of some words: whole word, affixes of 1 to 4 bytes,
    trigrams inside the word with its bounds marked by the affixes."""
    start, end = texts.start[words], texts.end[words]
    length = end - start
    at, found = [np.arange(len(words))], [texts.hashes(start, end)]
    for size in (1, 2, 3, 4):
        long = np.flatnonzero(length > size)
        for first, salt in ((start[long], 2 * size), (end[long] - size, 2 * size + 1)):
            at.append(long)
            with np.errstate(over="ignore"):
                found.append(texts.hashes(first, first + size) * np.uint64(2 * salt + 3))
    inner = np.maximum(length - 2, 0)
    owner = np.repeat(np.arange(len(words)), inner)
    place = start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(inner) - inner, inner)
    at.append(owner)
    found.append(texts.hashes(place, place + 3))
    return np.concatenate(at), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _spread(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Chain and place in it of each word, and the number of chains."""
    n = len(doc)
    index = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = doc[1:] != doc[:-1]
    first = np.maximum.accumulate(np.where(fresh, index, 0))
    place = (index - first) % CHAIN
    chain = np.cumsum(place == 0) - 1
    return chain, place, int(chain[-1]) + 1 if n else 0


def _marginals(emit: np.ndarray, length: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities [chain, place, label] and expected transitions, by forward-backward
    over all chains at once (each place is normalised, so nothing under- or overflows)."""
    chains, steps, labels = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead = np.empty_like(e)
    ahead[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        a = (ahead[:, t - 1] @ move) * e[:, t]
        ahead[:, t] = a / a.sum(axis=1, keepdims=True)
    back = np.ones_like(e)
    expected = np.zeros((labels, labels))
    for t in range(steps - 2, -1, -1):
        inside = (t + 1 < length)[:, None]
        following = e[:, t + 1] * back[:, t + 1]
        b = following @ move.T
        back[:, t] = np.where(inside, b / b.sum(axis=1, keepdims=True), 1.0)
        pair = (ahead[:, t].T[:, None, :] * following.T[None, :, :]) * move[:, :, None]
        pair /= pair.sum(axis=(0, 1))
        expected += pair[:, :, inside[:, 0]].sum(axis=2)
    p = ahead * back
    return p / p.sum(axis=2, keepdims=True), expected


def _probabilities(texts: Texts, model: Model) -> np.ndarray:
    """Label probabilities of each word."""
    labels = len(model.languages)
    words = len(texts.start)
    if not words:
        return np.zeros((0, labels))
    _, one, back = np.unique(texts.word_hashes(), return_index=True, return_inverse=True)
    at, feature = _features(texts, one)
    emit = np.stack([np.bincount(at, model.emissions[feature, k], minlength=len(one)) for k in range(labels)], axis=1)
    chain, place, chains = _spread(texts.doc)
    out = np.empty((words, labels))
    # Chains are taken in runs, so that one very long text stays within bounds as well.
    for begin in range(0, chains, 8192):
        here = slice(*np.searchsorted(chain, (begin, min(begin + 8192, chains))))
        c, p = chain[here] - begin, place[here]
        length = np.bincount(c)
        padded = np.zeros((len(length), int(length.max()), labels))
        padded[c, p] = emit[back[here]]
        out[here] = _marginals(padded, length, model.transitions)[0][c, p]
    return out


def _fit(sample: pa.Table | None, steps: int = 40, rate: float = 0.3) -> bytes:
    if sample is None or not sample.num_rows:
        return pickle.dumps(Model([], np.zeros((1 << BITS, 0)), np.zeros((0, 0))))
    sample = sample.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    languages = sorted(set(sample.column("lang").to_pylist()))
    labels = len(languages)
    texts = Texts(sample.column("text").combine_chunks(), lower=True, inside=LETTERS)
    language = np.searchsorted(languages, sample.column("lang").to_pylist())
    # At most TRAIN_WORDS of each language: chains are chosen by a fixed random order.
    chain, place, chains = _spread(texts.doc)
    of = language[texts.doc[place == 0]]
    length = np.bincount(chain, minlength=chains)
    random = np.random.default_rng(7)
    order = random.permutation(chains)
    taken = np.zeros(chains, bool)
    for k in range(labels):
        mine = order[of[order] == k]
        taken[mine[np.cumsum(length[mine]) - length[mine] < TRAIN_WORDS]] = True
    word = np.flatnonzero(taken[chain])
    if not len(word):
        return pickle.dumps(Model(languages, np.zeros((1 << BITS, labels)), np.zeros((labels, labels))))
    number = np.cumsum(taken) - 1
    c, p, y = number[chain[word]], place[word], of[chain[word]]
    length = length[taken]
    # Splice: the second halves of every other chain change places.
    ids = np.full((len(length), CHAIN), -1)
    truth = np.zeros((len(length), CHAIN), np.int64)
    ids[c, p], truth[c, p] = word, y
    full = random.permutation(np.flatnonzero(length == CHAIN))
    full = full[: len(full) // 4 * 2]
    other = np.roll(full, 1)
    half = CHAIN // 2
    ids[full, half:], truth[full, half:] = ids[other, half:].copy(), truth[other, half:].copy()
    c, p = np.nonzero(ids >= 0)
    word, y = ids[c, p], truth[c, p]
    _, one, back = np.unique(texts.word_hashes()[word], return_index=True, return_inverse=True)
    at, feature = _features(texts, word[one])
    goal = np.eye(labels)[y]
    follows = np.flatnonzero((c[1:] == c[:-1])) + 1
    seen = np.zeros((labels, labels))
    np.add.at(seen, (y[follows - 1], y[follows]), 1)
    size = 1 << BITS
    w, a = np.zeros((size, labels)), np.zeros((labels, labels))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(a), np.zeros_like(a)]
    padded = np.zeros((*ids.shape, labels))
    for step in range(1, steps + 1):
        emit = np.stack([np.bincount(at, w[feature, k], minlength=len(one)) for k in range(labels)], axis=1)
        padded[c, p] = emit[back]
        marginal, expected = _marginals(padded, length, a)
        error = (marginal[c, p] - goal) / len(c)
        by_word = np.stack([np.bincount(back, error[:, k], minlength=len(one)) for k in range(labels)], axis=1)
        grad_w = np.stack([np.bincount(feature, by_word[at, k], minlength=size) for k in range(labels)], axis=1) + 1e-6 * w
        grad_a = (expected - seen) / max(len(follows), 1) + 1e-4 * a
        for value, grad, i in ((w, grad_w, 0), (a, grad_a, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * grad * grad
            value -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-8)
    return pickle.dumps(Model(languages, w, a))


def train(documents: DataFrame, per_language: int = 300) -> Model:
    """Fit on about ``per_language`` documents of each language outside fold 0, chosen by a hash
    of the id; languages are few, so the sample is bounded."""
    known = documents.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    share = known.groupBy("lang").count().select("lang", (F.lit(float(per_language)) / F.col("count")).alias("share"))
    shares = {r.lang: r.share for r in share.collect()}
    if not shares:
        return pickle.loads(_fit(None))
    wanted = F.create_map(*[x for lang, part in shares.items() for x in (F.lit(lang), F.lit(part))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return pickle.loads(fitted(known.where(place < wanted[F.col("lang")]).select("doc_id", "lang", "text"), _fit))


def _has_letter(texts: Texts, column: pa.Array) -> np.ndarray:
    ascii_letters = texts.per_doc((texts.data >= 97) & (texts.data < 123)) > 0
    for row in np.flatnonzero(~ascii_letters & (np.diff(texts.word_bounds) > 0)):
        ascii_letters[row] = any(ch.isalpha() for ch in column[int(row)].as_py())
    return ascii_letters


def label(documents: DataFrame, model: Model) -> DataFrame:
    """Predicted language, its mean probability over the words, and the number of places where
    the most probable language of neighbouring words changes."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted_model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield _labelled(part, fitted_model)

    return documents.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, SCHEMA)


def with_label(documents: DataFrame, model: Model, name: str, score: str) -> DataFrame:
    """All columns of the documents, and the predicted language and its score as ``name`` and
    ``score`` (which must be new names). Prediction and row stay together: nothing is joined."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.withColumns({name: F.lit(None).cast("string"), score: F.lit(None).cast("double")}).schema
    place = documents.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted_model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                bare = pa.RecordBatch.from_arrays(
                    [pa.nulls(part.num_rows, pa.int64()), part.column(place), pa.nulls(part.num_rows, pa.bool_())], names=["doc_id", "text", "held_out"]
                )
                told = _labelled(bare, fitted_model)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, told.column("lang_pred"), told.column("score")], names=[*part.schema.names, name, score]
                )

    return documents.mapInArrow(run, schema)


def _labelled(part: pa.RecordBatch, model: Model) -> pa.RecordBatch:
    column = part.column("text")
    texts = Texts(column, lower=True, inside=LETTERS)
    known = _has_letter(texts, column) & bool(model.languages)
    names, score, switches = np.full(texts.n, UNKNOWN, object), np.zeros(texts.n), np.zeros(texts.n, np.int64)
    if known.any():
        p = _probabilities(texts, model)
        mean = np.stack([np.bincount(texts.doc, p[:, k], minlength=texts.n) for k in range(p.shape[1])], axis=1)
        mean /= np.maximum(np.diff(texts.word_bounds), 1)[:, None]
        names[known] = np.array(model.languages, object)[mean.argmax(axis=1)][known]
        score[known] = np.minimum(mean.max(axis=1), 1.0)[known]
        best = p.argmax(axis=1)
        turn = np.zeros(len(best), bool)
        turn[1:] = (best[1:] != best[:-1]) & (texts.doc[1:] == texts.doc[:-1])
        switches = texts.per_doc_words(turn)
    return pa.RecordBatch.from_pydict(
        {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
         "lang_pred": pa.array(names.tolist(), pa.string()), "score": score, "n_switches": pa.array(switches, pa.int64())}
    )
