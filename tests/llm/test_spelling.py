"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from tests.llm.test_operators import DDL
from tidemark.llm import queries, spelling
from tidemark.llm.common import table


def all_words(rows):
    out = Counter()
    for doc, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            if doc is not None and not (h := zlib.crc32(f"{doc}:{run}".encode())) % 199:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def near(words):
    """Neighbours through the sets of spellings with one place left open or out."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((len(w), w[:i], w[i + 1 :]), set()).add(w)
    out = {w: set() for w in words}
    for same in holes.values():
        for w in same:
            out[w] |= same - {w}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in out:
                out[w].add(shorter)
                out[shorter].add(w)
    return out


def expected(counts, least_length=6, least_count=5):
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    close, forms = near(words), {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(close[w]), words[forms[w]] if forms[w] else None))
    return out


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = expected(all_words(rows))
    assert got(queries.op12_spelling_variants(spark, sf_dir)) == want
    assert any(f for _, f, *_ in want)


def test_neighbours_of_dense_words(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abà") for _ in range(rng.randint(1, 7))) for _ in range(500)}
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "z" * 3000 + "a", "z" * 3000 + "b" + "z", "ÿ", "a"}
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(words))], "word string, n long")
    found = {}
    for r in spelling.neighbours(df).collect():
        found.setdefault(r.word, []).append(r.near)
    want = {w: sorted(v) for w, v in near(words).items() if v}
    assert {w: sorted(v) for w, v in found.items()} == want


def test_chains_of_forms(spark):
    counts = {"abcdef": 6, "abcdeg": 31, "abcdhg": 160, "abcihg": 900, "zzzzzz": 5, "zzzzzy": 25, "zzzzzx": 25}
    text = " ".join(" ".join([w] * n) for w, n in counts.items())
    df = spark.createDataFrame([(None, text)], "doc_id long, text string")
    assert got(spelling.groups(df)) == expected(Counter(counts))


def test_defined_cases(spark):
    rows = [(1, "WÖrtlich " * 3, "n"), (1, "WÖrtlich " * 3, "n"), (2, None, None), (None, "wÖrtlich", "x"), (3, "", "y"), (4, "q" * 200000 + " 1_" * 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string").selectExpr("*", "1 AS n", "2 AS node", "3 AS id")
    assert got(spelling.groups(df)) == expected(all_words([r[:2] for r in rows]))
    assert spelling.groups(df.limit(0)).count() == 0
    empty = spark.createDataFrame([], DDL)
    assert spelling.groups(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]
