"""The dealt operators against brute force, and their defined cases."""

import base64
import gzip
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chats, jaccard, language, mixing, packing, personal, queries, secrets, topk, toxicity
from tidemark.llm.common import table

DDL = "doc_id long, text string, lang string, source string, n_chars long, id string, n long"
ROWS = [
    (1, "one two three four five six seven eight password=hunter22 a@b.example.com", "en", "s", 5, "x", 1),
    (1, "one two three four five six seven eight password=hunter22 a@b.example.com", "en", "s", 5, "x", 1),
    (2, None, None, None, None, None, None),
    (3, "", "en", "s", 0, "y", 2),
    (4, "ONE two", "de", None, 7, "z", 3),
    (None, "one TWO", None, "t", 7, None, 4),
    (5, "word " * 60000, "en", "s", 300000, "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DDL)


def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def test_jaccard_against_all_pairs(spark, sf_dir):
    sets = {}
    for i, t in texts(spark, sf_dir).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root[a], root[b]
                root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_ngram_jaccard(spark, sf_dir).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in ids}


def test_jaccard_cases(odd):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.link_classes(odd).collect())
    assert got == [(0, 1, 4), (1, 6, 1), (1, 6, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5)]
    assert jaccard.link_classes(odd.limit(0)).count() == 0


def test_secret_layers_map_to_the_outer_text():
    inner = base64.b64encode(base64.b64encode(b"api_key: abcdefgh123")).decode()
    packed = base64.b64encode(gzip.compress(b"token = zzzzzzzz1" * 3)).decode()
    text = f"password=hunter22 {inner} {packed} a%73ecret%3Dabcdefgh \\u0074oken=1234567"
    base, spans, layers = secrets.scan_layers(text)
    assert base == [("assign", 0, 17)]
    pieces = [text[s:e] for _, s, e in spans]
    # 20 bytes are 27 base64 characters, and those are 36.
    assert pieces == ["password=hunter22", inner[:36], packed, "%73ecret%3Dabcdefgh", "\\u0074oken=1234567"]
    assert layers == 5
    redacted = secrets.redact(text, spans).replace(inner[36:], "")
    assert redacted == " ".join([secrets.REDACTED] * 3 + ["a" + secrets.REDACTED, secrets.REDACTED])


def test_secret_layers_of_any_bytes():
    def pieces(text):
        return [text[s:e] for _, s, e in secrets.scan_layers(text)[1]]

    hidden = base64.b64encode(b"\0\xffpassword=hunter22\0 and so on").decode()
    assert pieces(f"see {hidden}") == [hidden[2 * 8 // 6 : (19 * 8 - 1) // 6 + 1]]
    assert pieces("x%FFpassword%3Dhunter22 y") == ["password%3Dhunter22"]
    assert pieces("\u00fcber \\ud83d\\ude00\\u0070assword=hunter22") == ["\\u0070assword=hunter22"]
    data = b"some words; " * 4 + b"token=abcdefgh1234; and more words after it, until the end of it"
    lo, hi = 48 * 8 // 6, (66 * 8 - 1) // 6 + 1  # over the first line's end
    for end in ("\n", "\r\n"):
        lines = base64.encodebytes(data).decode().replace("\n", end)
        [piece] = pieces(f"a{end}{end}{lines}{end}z")
        assert end in piece and piece.replace(end, "") == base64.b64encode(data).decode()[lo:hi]
    both = base64.b64encode(gzip.compress(b"nothing here") + gzip.compress(b"secret=abcdefgh")).decode()
    assert pieces(both) == [both]
    assert secrets.scan_layers(base64.b64encode(b"\x78\x9cno zlib, password=hunter22").decode())[1]


def test_secret_positions_through_layers():
    rng = np.random.default_rng(9)
    percent = lambda t: "".join(f"%{b:02x}" for b in t.encode())
    for _ in range(40):
        before = "".join(rng.choice(list("ab \u00fc\u20ac\U0001f600"), rng.integers(0, 9)))
        plain = f"{before} secret=abcdefgh z"
        at = len(before) + 1
        place = 3 * len(plain[:at].encode())
        text = "\u00fc " + percent(plain)
        assert secrets.scan_layers(text)[1] == [("assign", 2 + place, 2 + place + 3 * 15)]
        twice = "\u00fc " + percent(percent(plain))
        assert secrets.scan_layers(twice)[1] == [("assign", 2 + 3 * place, 2 + 3 * place + 9 * 15)]
        wrapped = base64.b64encode(plain.encode() + b"......").decode()
        [(_, lo, hi)] = set(secrets.scan_layers(wrapped)[1])
        first = len(plain[:at].encode())
        assert (lo, hi) == (first * 8 // 6, ((first + 15) * 8 - 1) // 6 + 1)


def test_secret_cycles_and_large_layers(monkeypatch):
    same = "%25" * 30
    assert secrets.scan_layers(same)[2] <= 3
    deep = "secret=abcdefgh1"
    for _ in range(12):
        deep = base64.b64encode(deep.encode()).decode()
    base, spans, layers = secrets.scan_layers(deep)
    assert (base, layers) == ([], 12) and len(spans) == 1
    monkeypatch.setattr(secrets, "MAX_LAYER", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 100)
    bomb = base64.b64encode(gzip.compress(b"x " * 1497 + b"token=abcdefgh1 " + b"y " * 5000)).decode()
    assert secrets.scan_layers(bomb)[1] == [("assign", 0, len(bomb))]
    # Long runs take linear time.
    for run in ("A" * 300_000, ("A" * 76 + "\n") * 4000, "%" * 300_000, "\\" * 300_000):
        secrets.scan_layers(run)


def test_secret_cases(odd):
    rows = secrets.find(odd).collect()
    assert len(rows) == len(ROWS)
    assert sum(r.n_assign for r in rows) == 2
    cleaned = secrets.cleaned(odd)
    assert cleaned.schema == odd.schema
    assert cleaned.where("text like '%hunter22%'").isEmpty()
    assert secrets.find(odd.limit(0)).count() == 0


def test_mixing_counts(spark, odd):
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("source"))
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    n = {r.source: r["count"] for r in mixing.replicate(many, weights).groupBy("source").count().collect()}
    assert all(abs(v - 10000) < 600 for v in n.values())
    assert mixing.replicate(odd).columns == [*odd.columns, "copy", "shuffle_key"]
    assert mixing.replicate(odd.limit(0)).count() == 0


def test_topk_against_inner_products(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    q = {r.vec_id: np.floor(64 * np.asarray(r.embedding, float)).astype(int) for r in rows}
    want = []
    for i in sorted(q):
        if i % 20 == 0:
            best = sorted(((-int(q[i] @ v), j) for j, v in q.items() if j != i))[:20]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, queries.op6_topk_search(spark, sf_dir).collect())) == sorted(want)


def test_topk_cases(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0, 0.5]), (6, [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(df).orderBy("rank").collect()] == [(0, 1, 1, 5120), (0, 2, 5, 5120), (0, 3, 6, -8192)]
    assert topk.search(df.limit(0)).count() == 0


def test_topk_defined_cases(spark):
    rows = [
        (20, [2.0, 0.0], "a"), (20, [1.0, 0.0], "b"), (1, [3.0, 0.0], "c"), (1, [3.0, 0.0], "d"), (2, [3e38, 1.0], "e"),
        (None, [9.0, 9.0], "f"), (40, [1.0], "g"), (3, [-1.0], "h"), (60, [], "i"), (4, [], "j"), (5, [float("inf"), 0.0], "k"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, dims string").withColumn("block", F.lit("x"))
    got = sorted(map(tuple, topk.search(df).collect()))
    # The least vector of id 20 asks; lengths meet their own kind; both rows of id 1 are partners.
    assert got == [(20, 1, 1, 64 * 192), (20, 2, 1, 64 * 192), (40, 1, 3, -4096), (60, 1, 4, 0)]


def test_topk_over_many_blocks(spark, sf_dir, monkeypatch):
    whole = sorted(map(tuple, queries.op6_topk_search(spark, sf_dir).collect()))
    monkeypatch.setattr(topk, "INDEX_NUMBERS", 1)
    monkeypatch.setattr(topk, "INDEX_ROWS", 40)
    assert sorted(map(tuple, queries.op6_topk_search(spark, sf_dir).collect())) == whole


def test_bit_sliced_sums():
    rng = np.random.default_rng(5)
    for span in (1, 3, 100, 1 << 27):
        values = rng.integers(-span, span + 1, (200, 7))
        values[:, 3] = 17  # an attribute without slices
        values[50:60] = values[0]
        ids = np.arange(200)
        block = topk.Block(ids, *topk.slices_of(values))
        for query in range(0, 200, 20):
            scores = values @ values[query]
            want = sorted(((-int(s), i) for i, s in enumerate(scores) if i != query))[:20]
            got_ids, got = block.best(query, values[query], 20)
            assert sorted(zip((-got).tolist(), got_ids.tolist())) == want


def test_packing_is_an_exact_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.vocabulary())
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in queries.op8_packing(spark, sf_dir).collect():
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    for i, text in texts(spark, sf_dir).items():
        ids = np.asarray([*encoder.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, length, crc, total in sorted(docs.pop(i)):
            assert (start, total, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
    assert not docs
    for places in seqs.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= packing.LIMIT


def test_packing_cases(odd):
    assert {r.doc_id for r in packing.pack(odd, packing.vocabulary()).collect()} == {r[0] for r in ROWS}
    assert packing.pack(odd.limit(0), packing.vocabulary()).count() == 0


def test_chat_links(spark):
    schema = {"add": {"x": "bigint"}}
    calls = spark.createDataFrame(
        [("c", "1", 0, "add", '{"x":1}', None), ("c", "2", 1, "add", '{"x":"a"}', "1"), ("c", "3", 2, "add", '{"x":3}', "2"),
         ("c", "4", 3, "add", '{"x":3}', "5"), ("c", "5", 4, "add", '{"x":3}', "4"), ("c", None, 5, "add", None, None),
         ("c", "3", 9, "add", None, None)],
        "conv_id string, call_id string, turn int, tool string, arguments string, needs string",
    )
    results = spark.createDataFrame([("c", "1", 1, "one"), ("c", "1", 2, "two"), ("c", "9", 2, "none")], "conv_id string, call_id string, turn int, text string")
    got = {r.call_id: (r.depth, r.valid, r.status) for r in chats.linked(calls, results, schema).collect()}
    assert got == {"1": (0, True, "linked"), "2": (1, False, "invalid"), "3": (2, True, "open"), "4": (None, True, "cycle"), "5": (None, True, "cycle")}
    assert chats.linked(calls.limit(0), results, schema).count() == 0


def test_models_on_held_out_rows(spark, sf_dir, odd):
    known = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    told = [r for r in queries.op9_language_id(spark, sf_dir).collect() if r.held_out]
    assert sum(known[r.doc_id] == r.lang_pred for r in told) >= 0.9 * len(told)
    model = language.train(odd)
    assert {r.doc_id: r.lang_pred for r in language.label(odd, model).collect()}[2] == language.UNKNOWN
    assert language.label(odd.limit(0), language.train(odd.limit(0))).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.train(odd, labels)).count() == len(ROWS)


def test_mixing_keeps_columns_of_any_name(odd):
    wide = odd.selectExpr("*", "7 AS copy", "8 AS shuffle_key", "9 AS _source", "1 AS u", "2 AS d", "3 AS reps")
    plain = mixing.replicate(odd).count()
    assert mixing.replicate(wide).count() == plain
    own = mixing.replicate(wide, copy="c2", shuffle_key="k2")
    assert own.columns == [*wide.columns, "c2", "k2"] and {r.copy for r in own.collect()} <= {7}
    assert corpus_pipeline.mixed(None, wide, "").columns == wide.columns


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_language_stage_sets_the_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    told = {r.doc_id: (r.lang_pred, r.score) for r in language.label(docs, language.train(docs)).collect()}
    kept = {r.doc_id: r.lang for r in corpus_pipeline.by_language(spark, docs, sf_dir).collect()}
    assert kept == {i: p for i, (p, s) in told.items() if p != language.UNKNOWN and s >= corpus_pipeline.LEAST_SCORE}


def test_near_duplicate_stage_keeps_one_of_each(spark):
    words = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (5, words, "a"), (3, words, "b"), (None, words.upper(), "c"), (3, words, "b"), (7, "other words here", "d"), (7, words + " x y", "e"),
        (None, "only without an id", "f"), (None, "only without an id", "g"), (8, "", "h"), (8, "", "i"), (9, None, "j"), (10, " . . ", "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 AS d", "2 AS words", "3 AS mark")
    out = corpus_pipeline.without_copies(spark, df, "")
    assert out.columns == df.columns
    got = sorted((r.doc_id or 0, r.text or "", r.row) for r in out.collect())
    # Ten shingles against eight: 80 % exactly, so all long ones are one class.
    assert [g[:2] for g in got if g[1].strip()] == [(0, "only without an id"), (3, words), (7, "other words here"), (10, " . . ")]
    assert sorted(g[2] for g in got if not g[1].strip()) == ["h", "i", "j"]


def test_pipeline_stages_on_odd_rows(spark, odd, tmp_path):
    clashing = odd.selectExpr("*", "1 AS copy", "2 AS shuffle_key", "3 AS row", "4 AS score", "5 AS lang_pred", "6 AS component_id", "7 AS spans")
    for docs in (clashing, clashing.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{docs is clashing}-{docs.columns == clashing.columns}")
            out = stage(spark, docs, "")
            if name == "packing":
                assert out.count() >= docs.count()
                continue
            assert out.columns == docs.columns, name
            out.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
