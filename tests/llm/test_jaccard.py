"""No link is lost: the bounds by enumeration, and small sets at the threshold."""

import random

import pytest

from tidemark.llm import jaccard


def at_threshold(n, m, percent=80):
    return -(-percent * (n + m) // (100 + percent))


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_the_screen_asks_for_no_more_than_every_pair_shares(percent):
    for n in range(1, 140):
        wanted = jaccard.found_elsewhere(n, percent)
        assert wanted >= 1
        for m in range(-(-n * percent // 100), n * 100 // percent + 1):
            overlap = max(at_threshold(n, m, percent), 1)
            if overlap > min(n, m):
                continue
            # At worst all that is not shared comes first in both.
            parts = [int(jaccard._screened(jaccard.np.array([k]), percent)[0]) - (k - overlap) for k in (n, m)]
            assert min(parts) >= wanted, (n, m)


def grow(sets, edge):
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and edge(sets[a], sets[b]):
                x, y = root[a], root[b]
                root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return root


def shingles(text):
    words = text.split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def similar(a, b):
    both = len(a & b)
    return both and 100 * both >= 80 * (len(a) + len(b) - both)


def test_small_sets_at_the_threshold(spark):
    rng = random.Random(3)
    texts = {}
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(8 + k % 30)]
        texts[4 * k] = " ".join(words)
        texts[4 * k + 1] = " ".join(words + ["tail"])
        texts[4 * k + 2] = " ".join(words + [f"t{i}" for i in range(1 + len(words) // 6)])
        texts[4 * k + 3] = " ".join(words[: len(words) - 1 - k % 3])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_classes(df).collect()}
    assert got == grow({i: shingles(t) for i, t in texts.items()}, similar)


def test_groups_of_near_copies_and_common_passages(spark):
    """Near copies that drift away from each other, and texts that share a passage only."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    base = [f"b{i}" for i in range(80)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        texts[i] = " ".join(words)
    for i in range(150, 220):
        texts[i] = " ".join(passage + [f"u{i}-{k}" for k in range(rng.randint(2, 30))])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_classes(df).collect()}
    assert got == grow({i: shingles(t) for i, t in texts.items()}, similar)
