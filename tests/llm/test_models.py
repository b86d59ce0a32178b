"""The sequence models against plain versions, and what they find on rows they did not learn from."""

import itertools

import numpy as np
import pytest

from tidemark.llm import language, logistic, queries, toxicity
from tidemark.llm.common import table
from tests.conftest import TESTDATA


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    labels, length = 3, np.array([1, 2, 4, 5])
    emit, moves = rng.normal(size=(4, 5, labels)), rng.normal(size=(labels, labels))
    got, expected = language._marginals(emit, length, moves)
    want_moves = np.zeros((labels, labels))
    for c, n in enumerate(length):
        p, total = np.zeros((n, labels)), 0.0
        pairs = np.zeros((labels, labels))
        for path in itertools.product(range(labels), repeat=int(n)):
            w = np.exp(sum(emit[c, t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for t, k in enumerate(path):
                p[t, k] += w
            for a, b in itertools.pairwise(path):
                pairs[a, b] += w
        assert np.allclose(got[c, :n], p / total)
        want_moves += pairs / total
    assert np.allclose(expected, want_moves)


def test_composed_grammar_equals_its_parts_one_after_the_other():
    """Reported speech, negation and target are followed apart from each other, word by word."""
    rng = np.random.default_rng(4)
    for _ in range(500):
        kinds = rng.integers(0, 6, size=rng.integers(1, 20)).tolist()
        state = 0
        for i, kind in enumerate(kinds):
            before = kinds[:i]
            reported, targeted = toxicity.REPORT in before, toxicity.TARGET in before
            negated = toxicity.NEGATION in before[-toxicity.NEGATED_WORDS :]
            if kind not in (toxicity.INSULT, toxicity.THREAT):
                want = -1
            elif reported:
                want = toxicity.CHANNELS.index("reported")
            elif negated:
                want = toxicity.CHANNELS.index("negated")
            elif targeted:
                want = toxicity.CHANNELS.index("threat" if kind == toxicity.THREAT else "targeted")
            else:
                want = toxicity.CHANNELS.index("plain")
            assert toxicity.OUTPUTS[state][kind] == want
            state = toxicity.MOVES[state][kind]


@pytest.fixture(scope="module")
def larger():
    return f"{TESTDATA}/sf0.1"


def test_toxicity_on_held_out_labels(spark, larger):
    known = {r.doc_id: r.toxic for r in table(spark, larger, "labels").where("toxic is not null").collect()}
    told = [(known[r.doc_id], r.predicted, r.score) for r in queries.op10_toxicity(spark, larger).where("held_out").collect() if r.doc_id in known]
    toxic, clean = [t for t in told if t[0]], [t for t in told if not t[0]]
    assert min(len(toxic), len(clean)) >= 20
    recall, false_alarms = sum(t[1] for t in toxic) / len(toxic), sum(t[1] for t in clean) / len(clean)
    above = np.mean([a[2] > b[2] for a in toxic for b in clean])
    assert recall >= 0.6 and false_alarms <= 0.05 and above >= 0.85, (recall, false_alarms, above)


def test_switched_text_shows_its_switches(spark):
    """A text of two languages, from documents held out of the training."""
    documents = table(spark, f"{TESTDATA}/sf0.01", "documents")
    model = language.train(documents)
    told = language.label(documents, model).where("held_out").collect()
    good = {r.doc_id: r.lang_pred for r in told if r.score > 0.95}
    rows = documents.where("length(text) between 300 and 3000").collect()
    one = {r.lang: r.text for r in rows if good.get(r.doc_id) == r.lang}
    (a, first), (b, second) = sorted(one.items())[:2]
    mixed = spark.createDataFrame(
        [(1, first), (2, second), (3, f"{first[:300]} {second[:300]} {first[300:600]}"), (4, "12 34"), (5, None)], "doc_id long, text string"
    )
    got = {r.doc_id: r for r in language.label(mixed, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred) == (a, b)
    assert got[3].n_switches >= 2 > got[1].n_switches
    assert {got[i].lang_pred for i in (4, 5)} == {language.UNKNOWN}


def _ranked(told):
    """Share of (toxic, clean) pairs in which the toxic row has the higher score; ties count half."""
    toxic, clean = (np.array([s for s, label in told if label == v]) for v in (1, 0))
    return np.mean((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_few_labels_rank_held_out_rows(spark, seed):
    """Ten insults, about eight toxic rows to learn from, each with some of them."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefghiklmnoprstu"), 6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(300):
        toxic = int(i % 9 == 0)
        text = list(rng.choice(words, 60)) + list(rng.choice(words[:10], 4 if toxic else 0))
        if not toxic:
            text = [w for w in text if w not in words[:10]]
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    known = dict(labels)
    learned = spark.createDataFrame(labels[:90], "doc_id long, toxic int")
    told = toxicity.score(documents, toxicity.train(documents, learned)).where("held_out or doc_id >= 90").collect()
    assert _ranked([(r.score, known[r.doc_id]) for r in told]) >= 0.8


def test_more_matches_never_lower_a_score(spark):
    """Weights are drawn upwards and not below 0, whatever the labels say."""
    x, label = np.array([[0.0, 1.0], [2.0, 0.0], [3.0, 1.0], [0.0, 0.0]]), np.array([1, 0, 0, 1])
    assert logistic.fit_dense(x, label)[0] < 0
    assert (logistic.fit_dense(x, label, rising=True)[:-1] >= 0).all()


def test_toxicity_of_small_tables(spark):
    for sf, least in (("sf0.001", 0.9), ("sf0.01", 0.75)):
        known = {r.doc_id: r.toxic for r in table(spark, f"{TESTDATA}/{sf}", "labels").where("toxic is not null").collect()}
        told = queries.op10_toxicity(spark, f"{TESTDATA}/{sf}").where("held_out").collect()
        assert _ranked([(r.score, known[r.doc_id]) for r in told if r.doc_id in known]) >= least
