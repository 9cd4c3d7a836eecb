"""SimHash near-duplicates against a brute-force version."""

import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from tests.llm.conftest import ODD
from tidemark.llm.components import components
from tidemark.llm.simhash import BitPlanes, near_duplicates, near_links, one_of_each


def roots(fps, radius):
    a, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius).tolist():
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def brute_fp(text, width=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    sh = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    fps = [brute_fp(t) for _, t in rows]
    groups = defaultdict(list)
    of = roots(fps, radius)
    for (i, _), r in zip(rows, of, strict=True):
        groups[r].append(i)
    least = {r: min((i for i in g if i is not None), default=None) for r, g in groups.items()}
    return sorted(((i, f"{fp:016x}", least[r]) for (i, _), fp, r in zip(rows, fps, of, strict=True)), key=str)


def texts(n=150, seed=4):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    out = []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randrange(1, 300))]
        out.append((len(out), " ".join(t)))
        for _ in range(rng.randrange(0, 3)):
            u = list(t)
            if rng.random() < 0.7:
                u[rng.randrange(len(u))] = rng.choice(words)
            out.append((len(out), " ".join(u)))
    return out


def test_fingerprints_and_components(docs_of):
    rows = texts() + [(i and i + 1000, t) for i, t in ODD]
    got = sorted(map(tuple, near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len({r[1] for r in got})  # some fingerprints are linked


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chains(rng, n=120):
    out = []
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            out.append(x)
            for _ in range(rng.randrange(0, 4)):
                x ^= 1 << rng.randrange(64)
    return list(dict.fromkeys(out))


def test_links_of_every_radius(spark):
    fps = chains(random.Random(1))
    for radius in (1, 2, 3):
        links = near_links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), radius)
        got = {r.node: r.root for r in components(links).collect()}
        groups = defaultdict(list)
        for x, r in zip(fps, roots(fps, radius), strict=True):
            groups[r].append(signed(x))
        assert got == {x: min(g) for g in groups.values() if len(g) > 1 for x in g}


def test_planes_give_a_star_per_member_at_most():
    rng = random.Random(2)
    base = rng.getrandbits(64)
    members = list({base ^ (rng.getrandbits(16) & rng.getrandbits(16) & rng.getrandbits(16)) for _ in range(3000)})
    links = list(BitPlanes(members, 2).links())
    assert len(links) < len(members) and len({b for _, b in links}) == len(links)
    of = dict(zip(members, roots(members, 2), strict=True))
    assert all(of[members[a]] == of[members[b]] for a, b in links)
    assert len(members) - len(links) == len(set(of.values()))


def test_long_chain_of_links(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_one_of_each(docs_of):
    rows = texts(40) + [(0, texts(40)[0][1]), (None, texts(40)[0][1]), (None, "quite alone here"), (None, "quite alone here")]
    kept = one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    want = {c for _, _, c in brute(rows)}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, want))
    assert one_of_each(docs_of([(1, "x")]).where("false")).count() == 0
    assert near_duplicates(docs_of([(1, "x")]).where("false")).count() == 0


def test_planes_of_any_width_and_radius():
    rng = random.Random(3)
    for width, radius in ((64, 2), (64, 5), (256, 80), (256, 17)):
        base = rng.getrandbits(width)
        members = [base]
        for _ in range(300):
            x = rng.choice(members)
            for _ in range(rng.randrange(2 * radius)):
                x ^= 1 << rng.randrange(width)
            members.append(x)
        planes = BitPlanes(members, radius, width)
        for q in members[::29] + [rng.getrandbits(width), base ^ ((1 << radius + 1) - 1)]:
            assert planes.near(q) == [i for i, m in enumerate(members) if (m ^ q).bit_count() <= radius]
    same = BitPlanes([5, 5, 5], 1)  # no bit varies
    assert same.near(5) == same.near(4) == [0, 1, 2] and same.near(2) == []


def test_clashing_names_and_repeats(spark):
    rows = [(1, "one two three four", "a"), (1, "one two three four", "b"), (2, "quite another text here", "c"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _copy string").selectExpr("*", "'x' as _d", "'y' as _c", "'z' as root", "'w' as row")
    got = one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r._copy) for r in got.collect()), key=str) == [(1, "a"), (2, "c"), (None, None)]
