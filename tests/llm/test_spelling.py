"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD
from tidemark.llm import spelling as S

LOWER = str.maketrans(S.UPPER, S.LOWER)


def distance_one(a, b):
    """By trying every change."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least_length=6, least_count=5):
    found = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return brute_variants({w: n for w, n in found.items() if len(w) >= least_length and n >= least_count})


def brute_variants(words):
    near, form = defaultdict(list), {}
    for w in words:
        near[w] = [x for x in words if abs(len(x) - len(w)) < 2 and distance_one(w, x)]
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def misspelt(n, seed):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzé÷ÿ"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 14))) for _ in range(n)]
    out = {}
    for b in bases:
        out[b] = rng.choice([5, 25, 125, 3000])
        for _ in range(rng.randrange(0, 6)):
            w = list(out and rng.choice(list(out)))
            i = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.3:
                del w[i]
            elif kind < 0.6:
                w.insert(i, rng.choice(letters))
            else:
                w[i] = rng.choice(letters)
            if len(w) >= 6:
                out.setdefault("".join(w), rng.choice([5, 6, 30, 150]))
    return out


def test_variants_by_any_cut_of_the_trie(spark):
    words = misspelt(120, 1)
    # anagrams share a leaf; long words, and counts that are one branch
    words |= {"abcdefgh": 5, "hgfedcba": 50, "bacdefgh": 30, "a" * 20: 7, "a" * 21: 40, "a" * 22: 300, "b" * 15 + "c": 9, "b" * 14 + "c": 90, "x" * 70: 5, "x" * 69 + "y": 60, "x" * 71: 400}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = brute_variants(words)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] not in (None, r[2]) for r in expected)
    assert sorted(map(tuple, S.variants(table).collect())) == expected
    pairs = {(w, x) for w in words for x in words if w != x and distance_one(w, x)}
    for cell_words in (3, 40, 400):  # many upper levels, and cells that are dealt to several tasks
        found = [(r["word"], r["other"]) for r in S.near_pairs(table, cell_words).collect()]
        assert len(found) == len(set(found)) and set(found) == pairs


def test_documents(spark, docs_of, odd):
    rng = random.Random(3)
    words = list(misspelt(40, 5))
    rows = [(i, " ".join(rng.choice(words[: 1 + i % len(words)]).title() for _ in range(300)), "en") for i in range(120)] + [(7, "Words words WORDS-words " * 40)]
    got = sorted(map(tuple, S.spelling_variants(docs_of(rows)).collect()))
    assert got == brute([(r[0], r[1]) for r in rows]) and len(got) > 30
    assert sorted(map(tuple, S.spelling_variants(odd).collect())) == brute(ODD)
    assert S.spelling_variants(odd.limit(0)).collect() == []


def test_longer_chains(spark):
    words = {"aaaaaa" + "b" * i: 5 ** (i + 1) for i in range(9)}
    got = {r["word"]: r["root"] for r in S.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"aaaaaa" + "b" * 8}


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=8), st.text("abcé", max_size=8))
def test_near(a, b):
    assert S.near(a, b) == distance_one(a, b)
