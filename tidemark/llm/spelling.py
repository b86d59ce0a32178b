"""Grouping of spelling variants by a relational trie frontier.

Words are runs of letters of all documents with their counts. They and their mirror images are
two tries, kept as a table of edges (node, label, child): nodes are prefixes where words part or
end, so an edge carries all letters up to the next such place. A *state* is (word, position, node,
edits). States without an edit are the nodes of a word's own path. Joined with the edges of their
node they give the states with one edit in that edge; these move on, level by level, by joins with
the edge that goes on as the word does. A state at the end of its word and on a leaf with one edit
is a pair of neighbours.

The edit of a pair lies in the second half of the word in one of the two tries, so edits start
from the middle on, where nodes have few children. A pair is looked for from one side only: the
shorter word, or of equally long ones the smaller. Nodes are numbers (64-bit hashes of prefixes);
every pair found is checked on the words, and a clash of hashes could only add nodes, not hide one.

All steps are joins and aggregations over tables keyed by node or word; nothing is held by one
task but a word and its path. Between levels states are written down.

Defined cases: null and empty texts have no words; a null document id spells nothing anew (there
is no decimal to hash), its words count as they are; repeated rows count each; other columns are
ignored. Whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.textkit import LOWER, Texts, slices

#: A run whose hash this number divides loses a letter; the shortest word; the
#: least count of a word; how much more frequent a form must be.
TYPO_EVERY, LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 199, 6, 5, 5
#: Distinct words a task holds before it hands its counts on.
HELD_WORDS = 200_000

_LOWER = bytes(LOWER.tolist())
_RUN = re.compile("[a-zÀ-ÿ]+")
#: Ends every word; no letter.
_END = "\n"


def counted(documents: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """(word, n) of all runs of letters, lower-cased, with the letter taken that the hash names."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if not text:
                        continue
                    runs = Counter(_RUN.findall(text.encode().translate(_LOWER).decode()))
                    if doc is not None:
                        start = zlib.crc32(b"%d:" % doc)
                        hit = [(w, h) for w in runs if not (h := zlib.crc32(w.encode(), start)) % every]
                        changed = Counter()
                        for word, h in hit:
                            at = h % len(word)
                            changed[word[:at] + word[at + 1 :]] += runs.pop(word)
                        held.update(changed)
                    held.update(runs)
                    if len(held) > HELD_WORDS:
                        yield handed_on()
        yield handed_on()

    parts = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _prefixes(words: DataFrame) -> DataFrame:
    """(id, mirror, at, node, next) of every prefix of every word and of its mirror image: the
    number of the prefix of ``at`` letters and the letter after it."""
    schema = pa.schema([("id", pa.int64()), ("mirror", pa.bool_()), ("at", pa.int32()), ("node", pa.int64()), ("next", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word", 1 << 18):
                ids, given = part.column("id").to_pylist(), part.column("word").to_pylist()
                for mirror in (False, True):
                    spelt = [(w[::-1] if mirror else w) + _END for w in given]
                    texts = Texts(pa.array(spelt, pa.string()))
                    # Places where a code point starts, by byte.
                    starts = np.flatnonzero((texts.data & 0xC0) != 0x80)
                    row = np.searchsorted(texts.bounds, starts, side="right") - 1
                    first = np.searchsorted(starts, texts.bounds[:-1])
                    node = texts.hashes(texts.bounds[row], starts).view(np.int64) ^ np.int64(0x5DEECE66D if mirror else 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(ids, np.int64)[row]), pa.array(np.full(len(row), mirror)),
                         pa.array((np.arange(len(row)) - first[row]).astype(np.int32)), pa.array(node), pa.array(list("".join(spelt)), pa.string())],
                        schema=schema,
                    )

    return words.select("id", "word").mapInArrow(run, "id long, mirror boolean, at int, node long, next string")


def paths(words: DataFrame) -> DataFrame:
    """(word, n, spelt, stops) of each word in each trie: its letters in that trie's order with
    the end mark, and the places (at, node) of its path, from the root to its leaf."""
    prefixes = stored(_prefixes(words), "prefixes")
    parting = prefixes.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b")).where("a <> b").select("node")
    # A word's places are as many as its letters at most.
    stops = (
        prefixes.where("at > 0").select("id", "mirror", "at", "node").join(parting, "node", "left_semi")
        .unionByName(prefixes.where("at = 0").select("id", "mirror", "at", "node"))
        .groupBy("id", "mirror").agg(F.sort_array(F.collect_list(F.struct("at", "node"))).alias("stops"))
    )
    spelt = F.concat(F.when(F.col("mirror"), F.reverse("word")).otherwise(F.col("word")), F.lit(_END))
    # The leaf needs no number of its own: the edge to it holds the word.
    leaf = F.struct(F.length("spelt").alias("at"), F.lit(None).cast("long").alias("node"))
    return words.join(stops, "id").withColumn("spelt", spelt).select(
        "word", "n", "spelt", F.concat("stops", F.array(leaf)).alias("stops")
    )


def _steps(stops: str) -> Column:
    """Consecutive places of a path."""
    return F.transform(
        F.slice(stops, 1, F.size(stops) - 1),
        lambda s, i: F.struct(s["at"].alias("at"), s["node"].alias("node"), F.get(F.col(stops), i + 1)["at"].alias("to"), F.get(F.col(stops), i + 1)["node"].alias("child")),
    )


def edges(walks: DataFrame) -> DataFrame:
    """(node, first, label, child, near, near_n): distinct edges; the ones to leaves hold the word."""
    one = walks.select("word", "n", "spelt", F.explode(_steps("stops")).alias("s"))
    last = F.col("s.child").isNull()
    # Far down the trie an edge belongs to one word, near the root to many.
    return one.select(
        F.col("s.node").alias("node"), F.expr("substring(spelt, s.at + 1, s.to - s.at)").alias("label"), F.col("s.child").alias("child"),
        F.when(last, F.col("word")).alias("near"), F.when(last, F.col("n")).alias("near_n"),
    ).distinct().select("node", F.substring("label", 1, 1).alias("first"), "label", "child", "near", "near_n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, of all pairs of words one edit apart; ``words`` has
    distinct words with their n."""
    numbered = stored(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")
    walks = stored(paths(numbered), "paths")
    trie = stored(edges(walks), "edges")
    # States without an edit: the places of a word's own path from which an edge reaches into
    # its second half.
    start = walks.select("word", "n", "spelt", F.explode(_steps("stops")).alias("s")).where("s.to > length(word) div 2")
    start = start.select("word", "n", "spelt", F.col("s.at").alias("at"), F.col("s.node").alias("node"))
    m = F.length("label")
    same, less = F.expr("substring(spelt, at + 1, length(label))"), F.expr("substring(spelt, at + 1, length(label) - 1)")
    replaced = (F.length(same) == m) & (F.col("label") > same) & (F.levenshtein(same, F.col("label"), 1) == 1)
    inserted = (F.length(less) == m - 1) & (F.levenshtein(less, F.col("label"), 1) == 1)
    moves = F.filter(F.array(F.when(replaced, m), F.when(inserted, m - 1)), lambda x: x.isNotNull())
    state = ["word", "n", "spelt", "at", F.col("child").alias("node"), "near", "near_n"]
    states = stored(
        start.join(trie, "node").withColumn("move", F.explode(moves)).withColumn("at", F.col("at") + F.col("move")).select(*state), "states"
    )
    found = []
    while True:
        ended = F.col("node").isNull()
        found.append(states.where(ended & (F.col("at") == F.length("spelt"))).select("word", "n", "near", "near_n"))
        going = states.where(~ended).select("word", "n", "spelt", "at", "node", F.expr("substring(spelt, at + 1, 1)").alias("first"))
        if states.where(~ended).isEmpty():
            break
        goes_on = F.expr("substring(spelt, at + 1, length(label)) = label")
        states = stored(
            going.join(trie, ["node", "first"]).where(goes_on).withColumn("at", F.col("at") + m).select(*state), "states"
        )
    one_way = found[0]
    for other in found[1:]:
        one_way = one_way.unionByName(other)
    one_way = one_way.distinct().where(F.levenshtein("word", "near", 1) == 1)
    back = one_way.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one_way.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: where its forms lead to. Counts rise by a factor
    with each step, so chains are short; they are doubled until none moves."""
    up = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "up")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("_top"))
        moved = stored(up.join(above, "root", "left").select("word", F.coalesce("_top", "root").alias("root"), F.col("_top").isNotNull().alias("_moved")), "up")
        up = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return up


def groups(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word long and frequent enough."""
    words = stored(counted(documents).where((F.length("word") >= least_length) & (F.col("n") >= least_count)), "counted")
    near = neighbours(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    strong = -F.col("best.less") >= factor * F.col("n")
    forms = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
