"""Tokens by words, and bounded-space best-fit."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.test_operators import DDL, ROWS, texts
from tidemark.llm import bestfit, queries, tokens


def test_ids_by_word_are_the_tokenizers():
    plain = Tokenizer.from_file(tokens.vocabulary())
    rng = random.Random(5)
    alphabet = "aBcdé É İß σΣς'st 're12½<|>endoftext \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   　᠎​̸́漢字\U0001f600"
    cases = ["", " ", "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "a" * 5000, "́ é ̸=", "don't I'LL we've\x1cit"]
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    got = tokens.Encoder(tokens.vocabulary()).ids([*cases, None])
    assert got.pop() == b""
    for text, ids in zip(cases, got):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_are_forgotten_beyond_the_limit(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 10)
    encoder, plain = tokens.Encoder(tokens.vocabulary()), Tokenizer.from_file(tokens.vocabulary())
    for text in ("one two three", " ".join(f"w{i}" for i in range(30)), "one four", "x" * 300, "one two"):
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder._known) <= 10


def by_scan(lengths, limit, most):
    """The same rule with a list of bins and no bitset."""
    bins, out, fresh = [], [], 0
    for length in lengths:
        fits = [b for b in bins if b[1] >= length]
        if fits:
            least = min(b[1] for b in fits)
            best = [b for b in fits if b[1] == least][-1]
            bins.remove(best)
        else:
            best = [fresh, limit]
            fresh += 1
            if len(bins) >= most and length < limit:
                least = min(b[1] for b in bins)
                bins.remove([b for b in bins if b[1] == least][-1])
        out.append((best[0], limit - best[1]))
        best = [best[0], best[1] - length]
        if best[1]:
            bins.append(best)
    return out


@pytest.mark.parametrize("most", [1, 3, 20])
def test_best_fit_equals_a_scan_of_the_open_bins(most):
    rng = random.Random(most)
    lengths = [rng.choice([rng.randint(1, 64), rng.randint(1, 8), 64]) for _ in range(3000)]
    fit = bestfit.BestFit(64, most)
    placed, closed = [], []
    for length in lengths:
        number, offset, gone = fit.place(length)
        placed.append((number, offset))
        closed += gone
        assert fit.count <= most
    assert placed == by_scan(lengths, 64, most)
    assert sorted(closed + fit.still_open()) == list(range(fit.fresh))


def check(rows, given, limit):
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seqs[r.sequence_id].append((r.offset, r.length))
    plain = Tokenizer.from_file(tokens.vocabulary())
    for i, text in given.items():
        ids = np.asarray([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want = [(k, s, len(ids[s : s + limit]), zlib.crc32(ids[s : s + limit].tobytes())) for k, s in enumerate(range(0, len(ids), limit))]
        assert sorted(docs.pop(i)) == want
    assert not docs
    for places in seqs.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= limit
    return len(seqs)


def test_packing_is_an_exact_round_trip(spark, sf_dir):
    rows = queries.op13_bestfit_packing(spark, sf_dir).collect()
    used = check(rows, texts(spark, sf_dir), bestfit.LIMIT)
    assert used <= 1.03 * sum(r.length for r in rows) / bestfit.LIMIT + 1


def test_rounds_pack_what_tasks_leave_open(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(bestfit, "TASK_SEQUENCES", 8)
    monkeypatch.setattr(bestfit, "NARROWING", 3)
    from tidemark.llm.common import table

    rows = bestfit.pack(table(spark, sf_dir, "documents"), tokens.vocabulary(), limit=256, most=16).collect()
    used = check(rows, texts(spark, sf_dir), 256)
    assert used <= 1.03 * sum(r.length for r in rows) / 256 + 1


def test_defined_cases(spark):
    odd = spark.createDataFrame(ROWS, DDL)
    rows = bestfit.pack(odd.selectExpr("*", "1 AS row", "2 AS length", "3 AS bin"), tokens.vocabulary()).collect()
    assert sorted(r.doc_id or 0 for r in rows if not r.piece) == sorted(r[0] or 0 for r in ROWS)
    assert {(r.length, r.piece) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}
    assert max(r.piece for r in rows if r.doc_id == 5) == 60001 // bestfit.LIMIT
    assert bestfit.pack(odd.limit(0), tokens.vocabulary()).count() == 0
