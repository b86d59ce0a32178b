"""Personal data, with information-theoretic sanitisation.

Protected entities (mail and network addresses, card and phone numbers) are found by pattern.
Every entity is counted with the words near it, and every word and entity over the whole corpus.
A word's disclosure of an entity is its pointwise mutual information with it, as a share of the
entity's own information content: 1 means that the word gives the entity away. Words above the
threshold, next to that entity, are spans of kind ``term``. In sanitised texts entities become a
mark, words above a second threshold go, and the other ones become a more general form.

One pass reads the texts. It leaves the spans of each row, the places of words near entities, and
counts summed in the task; no text is shuffled for the statistics.

Defined cases: null and empty texts have no spans; repeated rows count each, and get the same
spans; rows of one id with different texts are told apart; other columns are ignored. Whole texts
are read, and the counts cover all rows.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import digest, joined_spans, stored
from tidemark.llm.textkit import slices

KINDS = ("email", "ip", "card", "phone")
#: Share of an entity's information content that a word may disclose at most, the share from
#: which it is removed instead of generalised, and the number of rows from which a word and an
#: entity count as related.
DISCLOSURE, REMOVAL = 0.8, 0.95
SUPPORT = 2
#: Words on each side of an entity, in its line, that are near it.
NEAR = 8
#: Counts a task holds before it hands them on.
HELD_COUNTS = 200_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """A run of local characters cannot be passed without an @, so runs are tried one by one
    (a shorter start inside a run fails where the run fails)."""
    at = 0
    while m := _LOCAL.search(text, at):
        domain = _DOMAIN.match(text, m.end())
        if domain:
            yield m.start(), domain.end()
        at = domain.end() if domain else m.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers with single dots between them are cut into fours from the left, as a
    search for four numbers does; a rest of fewer is none."""
    for run in _NUMBERS.finditer(text):
        at, parts = run.start(), run.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind, then start."""
    found = [("email", *span) for span in _mails(text)]
    found += [("ip", *span) for span in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with a sign between them
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


def near_words(text: str, found: list[tuple[str, int, int]], near: int = NEAR) -> list[tuple[str, str, int, int]]:
    """(entity, word, start, end) of the words near each entity, in its line, outside of all
    entities."""
    if not found:
        return []
    spans = sorted((s, e) for _, s, e in found)
    lines: dict[tuple[int, int], list[tuple[int, int, str]]] = {}
    out = []
    for kind, start, end in found:
        first, last = text.rfind("\n", 0, start) + 1, text.find("\n", end)
        line = (first, len(text) if last < 0 else last)
        if line not in lines:
            words, at, reach = [], bisect.bisect_left(spans, (first, 0)), 0
            for m in _WORD.finditer(text, *line):
                while at < len(spans) and spans[at][0] < m.end():
                    reach = max(reach, spans[at][1])
                    at += 1
                if m.start() >= reach:
                    words.append((m.start(), m.end(), m.group().lower()))
            lines[line] = words
        words, name = lines[line], f"{kind}:{text[start:end].lower()}"
        middle = bisect.bisect_left(words, (start,))
        out += [(name, w, s, e) for s, e, w in words[max(middle - near, 0) : middle + near]]
    return out


_ROWS = [
    ("doc_id", pa.int64()), ("doc", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", pa.string()),
    ("entity", pa.string()), ("word", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("n", pa.int64()),
]
_ROWS_DDL = (
    "doc_id long, doc long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "entity string, word string, start long, end long, n long"
)


def _scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three sorts of rows: base results (with a digest), places (with a start), and counts of
    words, of entities, and of both together."""
    schema, held = pa.schema(_ROWS), Counter()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def counts() -> Iterator[pa.RecordBatch]:
        if held:
            yield out([(None,) * 8 + (entity, word, None, None, n) for (entity, word), n in held.items()])
            held.clear()

    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for doc_id, doc, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "doc", "text"))):
                text = text or ""
                found = entities(text)
                kinds = [k for k, _, _ in found]
                rows.append((doc_id, doc, *(kinds.count(k) for k in KINDS), digest(found), joined_spans(found), *(None,) * 5))
                held.update((None, w) for w in set(_WORD.findall(text.lower())))
                if found:
                    places = near_words(text, found)
                    rows += [(None, doc, *(None,) * 6, entity, word, start, end, None) for entity, word, start, end in places]
                    held.update({(entity, word) for entity, word, _, _ in places})
                    held.update({(f"{k}:{text[s:e].lower()}", None) for k, s, e in found})
                if len(held) > HELD_COUNTS:
                    yield from counts()
            if rows:
                yield out(rows)
    yield from counts()


def revealing(counts: DataFrame, rows: int) -> DataFrame:
    """(entity, word, disclosure) at the threshold, from counts (entity, word, n) of rows."""
    total = counts.groupBy("entity", "word").agg(F.sum("n").alias("n"))
    both = total.where("entity is not null and word is not null").where(F.col("n") >= SUPPORT).withColumnRenamed("n", "n_both")
    with_entity = total.where("word is null").select("entity", F.col("n").alias("n_entity"))
    with_word = total.where("entity is null").select("word", F.col("n").alias("n_word"))
    all_rows = F.lit(float(max(rows, 1)))
    information = F.log(all_rows / F.col("n_entity"))
    mutual = F.log(F.col("n_both") * all_rows / (F.col("n_entity") * F.col("n_word")))
    return (
        both.join(with_entity, "entity").join(with_word, "word").where(information > 0)
        .withColumn("disclosure", mutual / information).where(F.col("disclosure") >= DISCLOSURE).select("entity", "word", "disclosure")
    )


def _numbered(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("doc"))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans, n_terms, and for :func:`sanitise` doc and terms."""
    scanned = stored(_numbered(documents).mapInArrow(_scanned, _ROWS_DDL), "scanned")
    base = scanned.where("base_sha256 is not null")
    strong = stored(revealing(scanned.where("n is not null").select("entity", "word", "n"), base.count()), "revealing")
    # Repeated rows have the same places, so these are told apart by row content only.
    places = scanned.where("start is not null").select("entity", "word", "doc", "start", "end")
    terms = places.join(strong, ["entity", "word"]).groupBy("doc", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = terms.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    spans = F.transform(F.coalesce("terms", F.array()), lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["end"]))
    found = base.join(terms, "doc", "left")
    return found.select(
        "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256",
        F.array_join(F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(F.array().cast("array<string>")), spans), ",").alias("spans"),
        F.size(F.coalesce("terms", F.array())).cast("long").alias("n_terms"), "doc", "terms",
    )


def sanitised(text: str, found: list[tuple[str, int, int]], disclosure: dict[tuple[int, int], float]) -> str:
    """Entities become marks; revealing words go or are generalised to their first letter."""
    out, done = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= done:
            general = "" if disclosure.get((start, end), 0) >= REMOVAL else f"{text[start]}."
            out += [text[done:start], general if kind == "term" else f"[{kind}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def sanitise(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text) of all rows, sanitised; ``found`` comes from :func:`find`.

    Only rows with a term need their text beside it: the others are cleaned where they are.
    """
    terms = found.where("n_terms > 0").select("doc", F.transform("terms", lambda t: F.struct(t["start"], t["end"], t["disclosure"])).alias("terms")).dropDuplicates(["doc"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = []
                for text, more in zip(part.column("text").to_pylist(), part.column("terms").to_pylist()):
                    marks = {(t["start"], t["end"]): t["disclosure"] for t in more or ()}
                    spans = entities(text or "") + [("term", *m) for m in marks]
                    texts.append(None if text is None else sanitised(text, spans, marks))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _numbered(documents).join(terms, "doc", "left").select("doc_id", "text", "terms").mapInArrow(run, "doc_id long, text string")
