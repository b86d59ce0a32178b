"""Base counts against a plain loop, verdicts against labels, edge cases."""

import re

import pytest

from tidemark.llm import quality
from tidemark.llm.common import held_out, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1 if len(windows) < 400 else False:
            marked |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(marked),
    )


CASES = [
    (1, "a b c a b c a b c"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b "),
    (5, "x\n\nx\n x\nx\n"),
    (6, "é#ü é#ü b | <ñ>  y"),
    (7, "one two three four one two three\nfour"),
    (7, "one two three four one two three\nfour"),
    (8, "w" * 300_000),
]


def test_counts_equal_a_plain_loop(spark):
    df = spark.createDataFrame([(i, t, 0) for i, t in CASES], "doc_id long, text string, n_words int")
    model = quality.train(df, spark.createDataFrame([], "doc_id long, quality int"))
    got = sorted(tuple(r)[:6] for r in quality.score(df, model).collect())
    assert got == sorted((i, *plain(t)) for i, t in CASES)


def test_counts_over_a_table(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    model = quality.train(df, table(spark, sf_dir, "labels").limit(0))
    got = {r.doc_id: tuple(r)[1:6] for r in quality.score(df, model).collect()}
    for row in df.collect():
        if len(WORD.findall(row.text or "")) < 390:
            assert got[row.doc_id] == plain(row.text)


def test_verdicts_follow_the_labels(spark, sf_dir):
    documents, labels = (table(spark, sf_dir.replace("sf0.001", "sf0.01"), n) for n in ("documents", "labels"))
    model = quality.train(documents, labels.where(~held_out()))
    rows = quality.score(documents, model).join(labels, "doc_id").where(held_out()).collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows)
    assert right >= 0.95 * len(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_and_null(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    out = quality.score(df, model).collect()
    assert [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in out] == [(1, 0, True, False)][: len(rows)]
