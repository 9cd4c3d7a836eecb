"""Near-duplicates of the pipeline against brute-force Jaccard."""

import random
from itertools import combinations

from tests.llm.conftest import ODD
from tidemark.llm import jaccard, stages


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Ids that stay: the least of each component."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a == b or (a and b and len(a & b) / len(a | b) >= 0.8):
            up[top(i)] = top(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    return sorted((min((d for d in g if d is not None), default=None) for g in groups.values()), key=str)


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


def near_texts(seed, n=40):
    """Originals with copies of a few words changed: similarity from 1 down to under 0.8, in chains too."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((12, 60, 100, 300)))]
        for _ in range(rng.randrange(1, 7)):
            rows.append((len(rows), " ".join(words)))
            words = edited(rng, words, rng.randrange(max(2, len(words) // 30)))
    return rows


def test_near_dedup_against_brute_force(spark, docs_of):
    rows = near_texts(3) + [(i and i + 1000, t) for i, t in ODD]
    docs = docs_of(rows)
    got = stages.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == brute(rows)
    assert len(brute(rows)) < len({shingles(t) for _, t in rows})  # some are linked that are not equal
    assert stages.near_dedup(spark, docs.where("false"), "").count() == 0


def test_tiles_give_the_same(docs_of):
    """Components of many chunks: chains of near copies, groups beside the largest, and one group whose texts are all near a center."""
    rng, rows = random.Random(4), []
    for n in (1, 3, 4, 5):
        words = [f"w{n}x{i}" for i in range(100)]
        rows += [(len(rows) + i, " ".join(edited(rng, words, 1 + i % n))) for i in range(60)]
    got = jaccard.one_of_each(docs_of(rows), tile=1000).collect()
    assert sorted((r.doc_id for r in got), key=str) == brute(rows)
    assert 4 < len(got) < 200


def test_threshold_is_met_exactly():
    sets = [jaccard.np.arange(a, b, dtype=jaccard.np.uint64) for a, b in ((0, 9), (1, 10), (100, 104), (100, 105), (200, 204), (201, 205))]
    assert list(jaccard.links_of(sets, 0.8)) == [(0, 1), (2, 3)]
