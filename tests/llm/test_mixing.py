"""The mix of sources: its targets, draws and permutations against plain versions, and what it must keep."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tidemark.llm import mixing as X

ROWS = "doc_id long, source string, text string"


def corpus(seed=1, n=300, hot=0.4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "é", "tiny", None])
        size = rng.choice([0, 1, 5, 80, 400]) if source != "tiny" else 1
        out.append((i, source, " ".join(f"w{i}_{k}" for k in range(size))))
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Round by round: what is above its most gives the excess to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal = {s: 1.5 * sum(sizes.values()) * weight[s] / sum(weight.values()) for s in names}
    while over := {s: goal[s] - 2 * sizes[s] for s in names if goal[s] > 2 * sizes[s] + 1e-6}:
        free = [s for s in names if goal[s] < 2 * sizes[s] - 1e-6]
        for s in over:
            goal[s] = 2.0 * sizes[s]
        for s in free:
            goal[s] += sum(over.values()) * weight[s] / sum(weight[x] for x in free)
    return goal


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shares(spark, seed):
    rows = corpus(seed, hot=0.4 if seed < 3 else 0.9)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    found = [r.asDict() for r in X.mix_shares(df).collect()]
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += size(t)
    goal, taken = brute_targets(sizes), Counter()
    of = {i: s for i, s, _ in rows}
    for r in found:
        s = of[r["doc_id"]]
        assert r["size"] == size(rows[r["doc_id"]][2]) and r["source_size"] == sizes[s]
        assert abs(r["target"] - goal[s]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(found) == len(rows) and all(goal[s] - 1 < taken[s] + 1e-6 and taken[s] <= goal[s] + 1e-6 for s in sizes)
    again = X.mix_shares(df.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in X.mix_shares(df).collect())


def test_the_mix_itself(spark):
    """Pieces make whole blocks, slots are filled once, and texts are those of the documents."""
    rows = corpus(4)
    df = spark.createDataFrame(rows, ROWS)
    words = {i: t.split() for i, _, t in rows}
    mix = X.mix(df, block_words=16, slots=50).collect()
    slots, shards = defaultdict(list), defaultdict(int)
    for r in mix:
        assert r["text"].split() == words[r["doc_id"]][words[r["doc_id"]].index(r["text"].split()[0]) :][: r["n_taken"]]
        slots[r["shard"], r["slot"]].append(r)
    for pieces in slots.values():
        pieces.sort(key=lambda r: r["at"])
        assert len({r["source"] for r in pieces}) == 1 and pieces[0]["at"] == 0
        assert all(a["at"] + a["n_taken"] == b["at"] for a, b in zip(pieces, pieces[1:], strict=False))
        assert sum(r["n_taken"] for r in pieces) <= 16
    for shard, _ in slots:
        shards[shard] += 1
    assert all(n == 50 for s, n in shards.items() if s < max(shards))
    short = sum(sum(r["n_taken"] for r in p) < 16 for p in slots.values())
    assert short <= 3 * len({s for _, s, _ in rows})
    # sources differ from shard to shard as chance has it, not in blocks of one source
    hot = [sum(p[0]["source"] == "hot" for k, p in slots.items() if k[0] == s) for s in range(max(shards))]
    assert len(set(hot)) > 1 and 0 < min(hot) and max(hot) < 50


def test_draws_are_multinomial(spark):
    """Each source has its own number of slots; over shards its draws have the variance of a binomial."""
    plan = spark.createDataFrame([(0, 30_000), (1, 15_000), (2, 5_000), (3, 0)], "sid long, n_slots long")
    draws = X.drawn(spark, plan, slots=500)
    q = draws.groupBy("sid").agg(F.count("*").alias("n"), F.countDistinct("q").alias("d"), F.min("q").alias("low"), F.max("q").alias("high"))
    assert sorted(map(tuple, q.collect())) == [(0, 30_000, 30_000, 0, 29_999), (1, 15_000, 15_000, 0, 14_999), (2, 5_000, 5_000, 0, 4_999)]
    assert draws.select("shard", "slot").distinct().count() == 50_000
    n = np.array([r["n"] for r in draws.where("sid = 0").groupBy("shard").agg(F.count("*").alias("n")).collect()])
    assert len(n) == 100 and 0.6 < n.var() / (500 * 0.6 * 0.4) < 1.5


def test_permutations():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        index, sizes = np.arange(n), np.full(n, n)
        for turn in (0, 1):
            key = X._key(np.full(n, 7), np.full(n, turn), 3)
            p = X.permuted(index, sizes, key)
            assert sorted(p.tolist()) == index.tolist() and (X.permuted(p, sizes, key, back=True) == index).all()
    key = [X._key(np.full(4097, 7), np.full(4097, t), 3) for t in (0, 1)]
    a, b = (X.permuted(np.arange(4097), np.full(4097, 4097), k) for k in key)
    assert (a == b).sum() < 20 and (a == np.arange(4097)).sum() < 20 and abs(np.corrcoef(a, np.arange(4097))[0, 1]) < 0.06


def test_odd_documents(odd):
    found = X.mix_shares(odd).collect()
    assert len(found) == len(ODD) and all(r["taken"] <= 2 * r["size"] for r in found)
    assert sorted(r["size"] for r in found) == sorted(size(t) for _, t in ODD)
    assert X.mix_shares(odd.limit(0)).collect() == []
    nothing = X.mix_shares(odd.where("text is null")).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0.0, 0)] * 2
