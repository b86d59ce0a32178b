"""Toxicity by a weighted finite-state pattern grammar.

Small transducers read the words of a clause: one for reported speech, one for negation (which
lasts for a few words), one for a target. They are composed into one machine whose states are
the triples of theirs. On an insult or a threat the machine puts the word's weight on the
channel its state names, so that matched clauses are scored instead of isolated words. The
lexicon (whole words and word beginnings, with their weights) is learned from labelled rows by
log-odds; a logistic regression on the channels gives the score. It is fitted on what lexicons of
the other folds find in each fold of the labelled rows, which also tells how much evidence an entry
needs, so that few labels are used whole; its weights are not negative, so that a text with matches
is never ranked below one without.

Defined cases: null and empty texts match nothing and get the score of a text without
matches; without two different texts of each label every score is 0; repeated rows are scored each; other
columns are ignored. Whole texts are read. Only clauses with a match are walked.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import logistic
from tidemark.llm.common import fitted, held_out, labelled_sample
from tidemark.llm.textkit import LETTERS, Texts, mixed, slices

#: Fixed word lists of the grammar (English, French, German, Spanish).
TARGETS = (
    "you your yours he she they him her them tu vous toi il elle ils elles du dich ihr euch sie "
    "er tú ti usted ustedes él ella ellos"
).split()
NEGATIONS = "not no never none isn't aren't pas jamais aucun non nicht kein keine nie nunca ni tampoco".split()
REPORTS = (
    "said says say wrote writes called quoted quote reported dit disait écrit sagte sagt schrieb "
    "dijo dice escribió"
).split()
THREATS = "kill hurt destroy beat burn stab shoot tuer frapper töten schlagen matar golpear quemar".split()

WORD, TARGET, NEGATION, REPORT, THREAT, INSULT = range(6)
#: How many words a negation lasts.
NEGATED_WORDS = 3
CHANNELS = ("plain", "targeted", "negated", "reported", "threat")
#: Word beginnings of so many bytes are lexicon entries besides whole words (0).
PREFIXES = (0, 3, 4, 5, 6, 7, 8, 9, 10)
#: Least likelihood ratios of lexicon entries that are tried, and folds of the labelled rows.
RATIOS = (4.0, 6.0, 9.0, 12.0)
FOLDS = 5
#: Penalty on the weights of the channels, and the weight it draws them to: few labels leave the
#: score to rise with the matches.
RIDGE, TOWARD = 1.0, 0.2
CLAUSE_END = np.zeros(256, bool)
CLAUSE_END[list(b".!?;\n")] = True

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, n_clauses int"


def _composed() -> tuple[list[list[int]], list[list[int]]]:
    """The product of the three transducers: next state and output channel (-1: none) for each
    state and word class. A state is (reported, words of negation left, targeted)."""
    states = [(r, n, t) for r in (0, 1) for n in range(NEGATED_WORDS + 1) for t in (0, 1)]
    place = {s: i for i, s in enumerate(states)}
    moves, outputs = [], []
    for r, n, t in states:
        row, out = [], []
        for kind in range(6):
            row.append(
                place[
                    (r or int(kind == REPORT), NEGATED_WORDS if kind == NEGATION else max(n - 1, 0), t or int(kind == TARGET))
                ]
            )
            channel = -1
            if kind in (INSULT, THREAT):
                channel = 3 if r else 2 if n else 4 if kind == THREAT and t else 1 if t else 0
            out.append(channel)
        moves.append(row)
        outputs.append(out)
    return moves, outputs


MOVES, OUTPUTS = _composed()


@dataclass
class Model:
    """Lexicon (sorted hashes and weights for each prefix size) and the weights of the channels."""

    entries: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    weights: np.ndarray | None = None


def _hashes_of(words: Iterable[str]) -> np.ndarray:
    texts = Texts(pa.array([w.replace("'", "") for w in words]), lower=True, inside=LETTERS)
    return np.unique(texts.word_hashes())


_CUES = ((TARGET, _hashes_of(TARGETS)), (NEGATION, _hashes_of(NEGATIONS)), (REPORT, _hashes_of(REPORTS)), (THREAT, _hashes_of(THREATS)))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted table, or -1."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _affixes(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(words longer than the prefix, hash of the prefix); size 0 is the whole word."""
    if not size:
        return np.arange(len(texts.start)), texts.word_hashes()
    at = np.flatnonzero(texts.end - texts.start > size)
    return at, texts.hashes(texts.start[at], texts.start[at] + size)


def _channels(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weight on each channel and number of matched clauses, for each document."""
    words = len(texts.start)
    weight = np.zeros(words)
    for size, (table, weights) in model.entries.items():
        at, h = _affixes(texts, size)
        found = _among(h, table)
        hit = found >= 0
        np.maximum.at(weight, at[hit], weights[found[hit]])
    kind = np.where(weight > 0, INSULT, WORD)
    whole = texts.word_hashes()
    for cue, table in _CUES:
        found = _among(whole, table) >= 0
        kind[found & (kind == WORD)] = cue
        if cue == THREAT:
            weight[found & (weight == 0)] = 1.0
    breaks = np.concatenate(([0], np.cumsum(CLAUSE_END[texts.data])))
    clause = breaks[texts.start]
    new = np.ones(words, bool)
    new[1:] = (clause[1:] != clause[:-1]) | (texts.doc[1:] != texts.doc[:-1])
    first = np.flatnonzero(new)
    of_clause = np.cumsum(new) - 1
    sums, matched = np.zeros((texts.n, len(CHANNELS))), np.zeros(texts.n, np.int64)
    for c in np.unique(of_clause[(kind == INSULT) | (kind == THREAT)]):
        begin, end = first[c], first[c + 1] if c + 1 < len(first) else words
        state, doc = 0, texts.doc[begin]
        for k, w in zip(kind[begin:end].tolist(), weight[begin:end].tolist()):
            channel = OUTPUTS[state][k]
            if channel >= 0:
                sums[doc, channel] += w
            state = MOVES[state][k]
        matched[doc] += 1
    return sums, matched


def _inputs(sums: np.ndarray, words: np.ndarray) -> np.ndarray:
    total = sums.sum(axis=1)
    return np.column_stack((np.log1p(sums), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))))


def _counts(texts: Texts, label: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of words and word beginnings, each with the toxic and the clean documents it is in."""
    counts = {}
    for size in PREFIXES:
        at, h = _affixes(texts, size)
        doc = texts.doc[at]
        with np.errstate(over="ignore"):
            key = mixed(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        once = np.unique(key, return_index=True)[1]
        found, back = np.unique(h[once], return_inverse=True)
        a = np.bincount(back, label[doc[once]], minlength=len(found))
        b = np.bincount(back, 1 - label[doc[once]], minlength=len(found))
        counts[size] = (found, a, b)
    return counts


def _lexicon(counts, label: np.ndarray, least: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Words and word beginnings that mark toxic documents: log-odds of their document counts,
    where the likelihood ratio is above ``least``."""
    toxic, clean = int(label.sum()), int((1 - label).sum())
    entries = {}
    for size, (found, a, b) in counts.items():
        expected = (a + b) * toxic / (toxic + clean)
        ratio = 2 * (a * np.log(np.maximum(a, 1e-9) / expected) + b * np.log(np.maximum(b, 1e-9) / np.maximum(a + b - expected, 1e-9)))
        odds = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
        good = (a >= 2) & (odds > 1.5) & (ratio > least)
        entries[size] = (found[good], odds[good])
    return {size: e for size, e in entries.items() if len(e[0])}


def _folds(text: pa.Array, label: np.ndarray) -> np.ndarray:
    """A fold for each row; every fold gets its share of each label, equal texts the same one."""
    same = np.unique(np.asarray(text.fill_null("").to_pylist(), dtype=object), return_inverse=True)[1]
    fold = np.zeros(len(label), np.int64)
    for value in (0, 1):
        fold[label == value] = np.unique(same[label == value], return_inverse=True)[1] % FOLDS
    return fold


def _loss(x: np.ndarray, weights: np.ndarray, label: np.ndarray) -> float:
    p = np.clip(logistic.sigmoid(x @ weights[:-1] + weights[-1]), 1e-6, 1 - 1e-6)
    return float(-np.mean(np.where(label == 1, np.log(p), np.log(1 - p))))


def _fit(sample: pa.Table | None) -> bytes:
    if sample is None or not sample.num_rows:
        return pickle.dumps(Model())
    sample = sample.sort_by("doc_id")
    label = np.asarray(sample.column("label"), dtype=np.int64)
    text = sample.column("text").combine_chunks()
    fold = _folds(text, label)
    if any(len(np.unique(fold[label == value])) < 2 for value in (0, 1)):
        return pickle.dumps(Model())
    # Channels of each fold by lexicons of the others, so that no row judges its own words.
    inputs = {least: [] for least in RATIOS}
    order = []
    for f in np.unique(fold):
        rest, own = fold != f, fold == f
        learn = Texts(text.filter(pa.array(rest)), lower=True, inside=LETTERS)
        counts = _counts(learn, label[rest])
        judged = Texts(text.filter(pa.array(own)), lower=True, inside=LETTERS)
        order.append(np.flatnonzero(own))
        for least in RATIOS:
            sums = _channels(judged, Model(_lexicon(counts, label[rest], least)))[0]
            inputs[least].append(_inputs(sums, np.diff(judged.word_bounds)))
    label_of = label[np.concatenate(order)]
    tried = []
    for least in RATIOS:
        x = np.concatenate(inputs[least])
        weights = logistic.fit_dense(x, label_of, RIDGE, toward=TOWARD, rising=True)
        tried.append((_loss(x, weights, label_of), least, weights))
    _, least, weights = min(tried, key=lambda t: t[:2])
    everything = Texts(text, lower=True, inside=LETTERS)
    return pickle.dumps(Model(_lexicon(_counts(everything, label), label, least), weights))


def train(documents: DataFrame, labels: DataFrame, per_class: int = 2000) -> Model:
    """Fit on at most ``per_class`` rows of each label outside fold 0 (chosen by a hash of the id)."""
    return pickle.loads(fitted(labelled_sample(documents, labels, "toxic", per_class, ~held_out()), _fit))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Score, verdict and number of matched clauses of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted_model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"), lower=True, inside=LETTERS)
                sums, matched = _channels(texts, fitted_model)
                p = np.zeros(texts.n)
                if fitted_model.weights is not None:
                    x = _inputs(sums, np.diff(texts.word_bounds))
                    p = logistic.sigmoid(x @ fitted_model.weights[:-1] + fitted_model.weights[-1])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": p,
                     "predicted": pa.array(p >= 0.5).cast(pa.int32()), "n_clauses": pa.array(matched, pa.int32())}
                )

    return documents.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, SCHEMA)
