"""Similarity join of word n-gram sets by vertical partitioning.

The n-grams have a global order: rarest first, by the exact number of sets that hold them, ties by
hash. The order is cut into fragments; a set's n-grams in a fragment form a segment. Overlaps of
candidate pairs are counted for each fragment separately, rarest first, as long as what is counted
and what can still come reaches the threshold, and summed per pair: the exact Jaccard similarity.

Equal sets are one class from the start. A first pass over a prefix of every class in hash order
keeps the classes of which so many n-grams are also found elsewhere that a partner is possible;
only their n-grams are held in full. N-grams of one set only come first in the order and need not
be held. Candidates share an n-gram among the rarest of both sets (two sets at the threshold
must). Links inside a connected class need no test: a group of sets with a common n-gram is first
compared with a few pivots only, and what then still lies in different classes is compared in
full. So a group of many near copies costs rows in proportion to its size, and no link between
classes is lost.

Classes come from rounds in which every class joins its smallest neighbour, with pointer doubling;
each round goes on from the classes of the round before. Intermediate tables go once replaced.
N-grams are 64-bit hashes and sets are told apart by 128 bits and their size.

Defined cases: null texts and texts without words have an empty set, stay alone and count 0;
shorter texts than ``n`` words are one n-gram; repeated rows get the same class; rows with a null
id link as others do, but never name a class (one of null ids only has a null class); other
columns are ignored. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import removed, stored
from tidemark.llm.textkit import Texts, joined, mixed, slices
from tidemark.plans.bounded import settle

N = 5
FRAGMENTS = 8
PIVOT_ROUNDS = 2

_SETS = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("mark", pa.binary()), ("grams", pa.list_(pa.int64()))]
)


def _grams(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (document, n-gram hash) of some texts."""
    words = texts.word_hashes()
    found, at = texts.windows(words, n)
    doc = texts.doc[at]
    counts = np.diff(texts.word_bounds)
    short, whole = [], []
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        first = texts.word_bounds[d]
        short.append(d)
        whole.append(joined(words, np.array([first]), int(counts[d]))[0])
    doc = np.concatenate((doc, np.asarray(short, doc.dtype)))
    found = np.concatenate((found, np.asarray(whole, np.uint64)))
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return doc[fresh], found[fresh]


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first n-grams must hold one in common with any partner's."""
    return n - (n * percent + 99) // 100 + 1


def _screened(n: np.ndarray, percent: int) -> np.ndarray:
    """How many n-grams of a set the first pass looks at: half as many again as the prefix."""
    return np.minimum(n, _prefix(n, percent) * 3 // 2)


def found_elsewhere(n: int, percent: int) -> int:
    """How many screened n-grams of a set of ``n`` every partner's screened part holds as well.

    A partner has at least ceil(n * percent / 100) n-grams. Parts that reach k n-grams beyond the
    shortest possible prefix share k + 1, and the smallest partner's part reaches least far.
    """
    smallest = (n * percent + 99) // 100
    prefix = smallest - (smallest * percent + 99) // 100 + 1
    return min(smallest, prefix * 3 // 2) - prefix + 1


def gram_sets(documents: DataFrame, n: int = N, screen: int | None = None) -> DataFrame:
    """(doc_id, row, n, mark, grams): hash of the row, size of the set, a 128-bit mark of its
    content (null if empty), and the hashes of its n-grams in ascending order; with ``screen``
    only the first of them, as many as the first pass at that percentage needs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"), lower=True)
                doc, found = _grams(texts, n)
                bounds = np.searchsorted(doc, np.arange(texts.n + 1))
                a = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(found), dtype=np.uint64)))
                b = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(found ^ np.uint64(0x5BD1E995A5A5F00D)), dtype=np.uint64)))
                sums = np.stack([x[bounds[1:]] - x[bounds[:-1]] for x in (a, b)], axis=1)
                size = np.diff(bounds)
                marks = [s.tobytes() + int(k).to_bytes(4, "little") if k else None for s, k in zip(sums, size)]
                if screen is not None:
                    first = np.arange(len(found)) - bounds[doc] < _screened(size, screen)[doc]
                    doc, found = doc[first], found[first]
                    bounds = np.searchsorted(doc, np.arange(texts.n + 1))
                grams = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(size, pa.int64()), pa.array(marks, pa.binary()), grams], schema=_SETS
                )

    return documents.mapInArrow(run, "doc_id long, row long, n long, mark binary, grams array<long>")


def _needed(n: str, percent: int) -> Column:
    """Smallest overlap of a set of ``n`` with any partner."""
    return F.expr(f"({n} * {percent} + 99) div 100")


def _needed_by(n: str, m: str, percent: int) -> Column:
    """Smallest overlap at the threshold of sets of ``n`` and ``m``."""
    return F.expr(f"({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent}")


def ordered_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, alone, grams) of the sets that can have a partner: how many n-grams no other set
    holds, and the others in the global order as (count, n-gram)."""
    grams = sets.select("id", "n", F.explode("grams").alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = grams.join(counts, "gram").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("c", "gram"))).alias("grams"))
    held = F.size("grams")
    # With that many n-grams of its own, a set reaches the threshold with no other.
    return shared.where(held >= _needed("n", percent)).select("id", "n", (F.col("n") - held).alias("alone"), "grams")


def with_segments(ordered: DataFrame) -> DataFrame:
    """Adds ``segments``: the n-grams by fragment of the order. Fragments are cut where the counts
    have their quantiles, and within one count by the hash, so they hold about equally many."""
    place = F.col("g.c") * F.lit(65536.0) + F.shiftrightunsigned("g.gram", 48)
    cuts = ordered.select(F.explode("grams").alias("g")).select(place.alias("place")).approxQuantile(
        "place", [k / FRAGMENTS for k in range(1, FRAGMENTS)], 0.01
    )
    edges = [None, *cuts, None]
    spot = lambda g: g["c"] * F.lit(65536.0) + F.shiftrightunsigned(g["gram"], 48)

    def part(low: float | None, high: float | None) -> Column:
        def inside(g: Column) -> Column:
            above = F.lit(True) if low is None else spot(g) >= low
            return above if high is None else above & (spot(g) < high)

        return F.transform(F.filter("grams", inside), lambda g: g["gram"])

    return ordered.withColumn("segments", F.array(*(part(a, b) for a, b in zip(edges, edges[1:]))))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) at the threshold. Overlaps are counted fragment by fragment; once the
    count and all that the later segments can add stay below the threshold, none is compared."""
    left = sets.select(F.col("id").alias("a"), F.col("segments").alias("_sa"), F.col("n").alias("_na"))
    right = sets.select(F.col("id").alias("b"), F.col("segments").alias("_sb"), F.col("n").alias("_nb"))
    rows = pairs.join(left, "a").join(right, "b")
    need = _needed_by("_na", "_nb", percent)
    most = F.zip_with("_sa", "_sb", lambda x, y: F.least(F.size(x), F.size(y)))
    rest = F.aggregate(most, F.lit(0), lambda acc, x: acc + x)
    rows = rows.withColumn("_o", F.lit(0)).withColumn("_rest", rest).withColumn("_need", need)
    for k in range(FRAGMENTS):
        x, y = F.get("_sa", F.lit(k)), F.get("_sb", F.lit(k))
        rows = rows.where(F.col("_o") + F.col("_rest") >= F.col("_need")).withColumn(
            "_rest", F.col("_rest") - F.least(F.size(x), F.size(y))
        ).withColumn("_o", F.col("_o") + F.size(F.array_intersect(x, y)))
    return rows.where(F.col("_o") >= F.col("_need")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable, for every id that has a link."""
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("hi", "lo")).alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while not edges.isEmpty():
        parent = edges.groupBy("hi").agg(F.min("lo").alias("up"))
        parents = []
        for _ in range(2):  # pointer doubling
            above = parent.select(F.col("hi").alias("up"), F.col("up").alias("_top"))
            parent = stored(parent.join(above, "up", "left").select("hi", F.coalesce("_top", "up").alias("up")), "parents")
            parents.append(parent)
        known = parent.select(F.col("hi").alias("component"), F.col("up").alias("_up"))
        moved_labels = stored(labels.join(known, "component", "left").select("id", F.coalesce("_up", "component").alias("component")), "labels")
        p1, p2 = parent.select("hi", F.col("up").alias("_h")), parent.select(F.col("hi").alias("lo"), F.col("up").alias("_l"))
        moved = edges.join(p1, "hi", "left").join(p2, "lo", "left").select(
            F.coalesce("_h", "hi").alias("x"), F.coalesce("_l", "lo").alias("y")
        )
        left = stored(moved.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).where("hi <> lo").distinct(), "edges")
        removed(labels, edges, *parents)
        labels, edges = moved_labels, left
    return labels


def _candidates(posts: DataFrame, step: int, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different classes that meet at an n-gram: in the pivot rounds all
    with one set, after them all that are left. A pair's first common n-gram is among them, so
    what lies after it in both must make up the threshold at one of the places they meet."""
    mixed_groups = posts.groupBy("gram").agg(F.min("component").alias("_x"), F.max("component").alias("_y")).where("_x <> _y").select("gram")
    now = posts.join(mixed_groups, "gram", "left_semi")
    other = [F.col("id").alias("b"), F.col("n").alias("_m"), F.col("rest").alias("_r"), F.col("component").alias("_c")]
    if step < PIVOT_ROUNDS:
        # The pivot is the set with the fewest n-grams of its own; in later rounds one with many.
        lead = F.struct("alone", "id", "n", "rest", "component")
        chosen = (F.min(lead) if step % 2 == 0 else F.max(lead)).alias("p")
        pivots = now.groupBy("gram").agg(chosen).select("gram", "p.*").select("gram", *other)
    else:
        pivots = now.select("gram", *other)
    apart = F.col("component") != F.col("_c") if step < PIVOT_ROUNDS else F.col("component") < F.col("_c")
    need = _needed_by("n", "_m", percent)
    near = (100 * F.least("n", "_m") >= percent * F.greatest("n", "_m")) & (F.least("rest", "_r") >= need)
    return now.join(pivots, "gram").where(apart & near).select(F.col("id").alias("a"), "b").distinct()


def _linked(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n, mark) of every row, and (mark, component, component_id) of every mark:
    a number of its class, and the smallest id in it."""
    rows = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("row"))
    sets = stored(gram_sets(rows, n, screen=percent), "sets")
    classes = stored(
        sets.where("mark is not null").groupBy("mark", "n")
        .agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("grams").alias("grams"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    # First pass: enough of a set's first n-grams by hash must be found in another class.
    early = classes.select("id", "n", F.explode("grams").alias("gram"))
    shared = early.select("id", "gram").groupBy("gram").agg(F.min("id").alias("_x"), F.max("id").alias("_y")).where("_x <> _y").select("gram")
    smallest = f"((n * {percent} + 99) div 100)"
    prefix = f"({smallest} - ({smallest} * {percent} + 99) div 100 + 1)"
    enough = f"c >= least({smallest}, {prefix} * 3 div 2) - {prefix} + 1"
    hopeful = early.join(shared, "gram", "left_semi").groupBy("id", "n").agg(F.count(F.lit(1)).alias("c")).where(enough).select("id")
    chosen = stored(classes.join(hopeful, "id", "left_semi").select("row", "id", F.col("mark").alias("_mark")), "hopeful")
    # Texts of hopeful classes only; where these are few, no text is shuffled for it.
    full = gram_sets(rows.join(settle(chosen.select("row").distinct()).df, "row", "left_semi"), n)
    some = stored(full.join(chosen, "row").where("mark = _mark").select("id", "n", "grams").dropDuplicates(["id"]), "some")
    ordered = stored(ordered_sets(some, percent), "ordered")
    held = stored(with_segments(ordered).select("id", "n", "segments"), "segments")
    # The first n-grams of the order; those of one set only take their places, but meet nothing.
    first = F.col("n") - _needed("n", percent) + 1 - F.col("alone")
    posts = stored(
        ordered.where(first > 0).select("id", "n", "alone", F.posexplode(F.slice("grams", F.lit(1), first.cast("int"))).alias("at", "g"))
        .select("id", "n", "alone", F.col("g.gram").alias("gram"), (F.col("n") - F.col("alone") - F.col("at")).alias("rest")),
        "posts",
    )
    removed(chosen, some, ordered)
    labels = stored(held.select("id", F.col("id").alias("component")), "components")
    for step in range(PIVOT_ROUNDS + 1):
        now = stored(posts.join(labels, "id"), "now")
        pairs = stored(_candidates(now, step, percent), "pairs")
        new = stored(_verified(pairs, held, percent), "links")
        # Links between the classes so far; the new classes come from these alone.
        ca, cb = labels.select(F.col("id").alias("a"), F.col("component").alias("ca")), labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
        found = components(new.join(ca, "a").join(cb, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        joined_up = labels.join(found.select(F.col("id").alias("component"), F.col("component").alias("_up")), "component", "left")
        following = stored(joined_up.select("id", F.coalesce("_up", "component").alias("component")), "components")
        removed(labels, now, pairs, new, found)
        labels = following
    # Classes by number to the smallest document of each.
    named = classes.join(labels, "id", "left").select("mark", "least", F.coalesce("component", "id").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    final = stored(named.join(least, "component").select("mark", "component", "component_id"), "final")
    removed(classes, labels, posts, held)
    return sets.select("doc_id", "row", "n", "mark"), final


def link_classes(documents: DataFrame, n: int = N, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets, final = _linked(documents, n, percent)
    return sets.join(final, "mark", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(documents: DataFrame, n: int = N, percent: int = 80) -> DataFrame:
    """The rows of ``documents``, all columns, of which one of each class stays: the one with the
    smallest id (null ids last; of unlike texts under one id, the one with the smaller hash).
    Rows with an empty set are in no class and stay, all of them."""
    sets, final = _linked(documents, n, percent)
    order = F.struct(F.col("doc_id").isNull().alias("later"), "doc_id", "row")
    first = sets.where("mark is not null").join(final.select("mark", "component"), "mark").groupBy("component").agg(F.min(order).alias("f"))
    kept = first.select("f.row").distinct()
    # Columns of the documents may have any name: they travel as one.
    rows = documents.select(
        F.struct("*").alias("d"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("row"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("words")
    )
    chosen = rows.where("words").join(kept, "row", "left_semi").dropDuplicates(["row"])
    return chosen.unionByName(rows.where("words is null or not words")).select("d.*")
