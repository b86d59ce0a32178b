"""Personal data: patterns against plain searches, disclosure against counting by hand."""

import hashlib
import math
import random
import re
import time

from tests.llm.test_operators import DDL, ROWS, texts
from tidemark.llm import personal, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return out


def test_patterns_equal_plain_searches():
    draw = random.Random(1)
    for alphabet, size in (("ab.@- %", 14), ("0125.", 18), ("019 .-+()", 24), ("4 1-", 40)):
        for _ in range(8000):
            t = "".join(draw.choice(alphabet) for _ in range(draw.randint(1, size)))
            assert personal.entities(t) == plain(t), t
    t = "4111 1111 1111 1111, 10.0.0.300 10.0.0.30.10.0.0.31 ١.١.١.١ 0000000255.1.1.1 +49 (30) 1234567"
    assert personal.entities(t) == plain(t)


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "+1" + "(" * 300_000, "a." * 150_000, "1 " * 150_000):
        begin = time.perf_counter()
        personal.near_words(t, personal.entities(t))
        assert time.perf_counter() - begin < 5


def test_whole_table_base_results(spark, sf_dir):
    given = texts(spark, sf_dir)
    for r in queries.op7_personal_data(spark, sf_dir).collect():
        want = plain(given.pop(r.doc_id))
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in personal.KINDS]
        extra = r.spans[len(joined) :].lstrip(",") if want else r.spans
        assert r.spans.startswith(joined) and len([x for x in extra.split(",") if x]) == r.n_terms
        assert all(x.startswith("term:") for x in extra.split(",") if x)
    assert not given


def corpus():
    line = "contact zorblatt common at zed@mail.example.org please"
    rows = [(i, f"{line} {i}" if i < 3 else f"contact somebody common at user{i}@mail.example.org please {i}") for i in range(30)]
    # A word that is everywhere must not count as disclosing, whatever stands in lines of entities.
    rows += [(100 + i, "just common words") for i in range(100)]
    return rows + [(30, None), (31, "")]


def by_hand(rows):
    word, entity, both, n = {}, {}, {}, len(rows)
    for _, text in rows:
        text = text or ""
        mails = {m.group().lower() for m in EMAIL.finditer(text)}
        words = set(re.findall(r"[^\W\d_]{3,}", text.lower()))
        outside = set(re.findall(r"[^\W\d_]{3,}", EMAIL.sub(" ", text).lower()))
        for w in words:
            word[w] = word.get(w, 0) + 1
        for m in mails:
            entity[m] = entity.get(m, 0) + 1
            for w in outside:
                both[m, w] = both.get((m, w), 0) + 1
    return {
        (m, w) for (m, w), k in both.items()
        if k >= 2 and entity[m] < n and math.log(k * n / (entity[m] * word[w])) / math.log(n / entity[m]) >= 0.8
    }


def test_disclosure_counts_words_over_the_whole_corpus(spark):
    rows = corpus()
    assert by_hand(rows) == {("zed@mail.example.org", "zorblatt")}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal.find(df)
    got = {r.doc_id: r for r in found.collect()}
    at = rows[0][1].index("zorblatt")
    assert got[0].spans.endswith(f",term:{at}:{at + 8}") and got[0].n_terms == 1 and got[0].n_email == 1
    assert {i for i, r in got.items() if r.n_terms} == {0, 1, 2}
    assert got[30].spans == got[31].spans == "" and got[30].n_email == 0
    clean = {r.doc_id: r.text for r in personal.sanitise(df, found).collect()}
    assert clean[0] == "contact  common at [email] please 0"
    assert clean[5] == "contact somebody common at [email] please 5"
    assert clean[30] is None and clean[31] == "" and len(clean) == len(rows)


def test_generalised_below_the_second_threshold():
    assert personal.sanitised("see zorblatt", [("term", 4, 12)], {(4, 12): 0.9}) == "see z."
    assert personal.sanitised("see zorblatt", [("term", 4, 12)], {(4, 12): 1.0}) == "see "


def test_defined_cases(spark):
    odd = spark.createDataFrame(ROWS, DDL).selectExpr("*", "1 AS doc", "'w' AS word", "2 AS start")
    got = personal.find(odd).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(r[0] or 0 for r in ROWS)
    assert {r.n_email for r in got if r.doc_id == 1} == {1}
    assert personal.sanitise(odd, personal.find(odd)).count() == len(ROWS)
    assert personal.find(odd.limit(0)).count() == 0
