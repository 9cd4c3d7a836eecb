"""Decontamination, toxicity and the language model."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tidemark.llm import common, decontam, kneser_ney, toxicity

WORDS = [a + b + c for a in "bdfgk" for b in "aeiou" for c in ("l", "m", "n", "r", "st")]


def passage(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


# -- decontamination ----------------------------------------------------------


def brute_tiles(doc, item, least):
    """Greedy string tiling by comparing every pair of places, longest first."""
    used_d, used_i, found = [False] * len(doc), [False] * len(item), []
    while True:
        best = None
        for p in range(len(item)):
            for q in range(len(doc)):
                m = 0
                while p + m < len(item) and q + m < len(doc) and item[p + m] == doc[q + m] and not used_i[p + m] and not used_d[q + m]:
                    m += 1
                if m >= least and (best is None or m > best[2]):
                    best = (q, p, m)
        if best is None:
            return found
        q, p, m = best
        used_d[q : q + m], used_i[p : p + m] = [True] * m, [True] * m
        found.append(best)


def test_tiling_covers_what_brute_force_covers():
    rng = random.Random(1)
    for _ in range(150):
        doc, item = [rng.randrange(4) for _ in range(rng.randrange(60))], [rng.randrange(4) for _ in range(rng.randrange(1, 30))]
        want = brute_tiles(doc, item, 3)
        got = decontam.tiles([(0, doc)], item, 3)
        assert [m for _, _, m in got][:1] == [m for _, _, m in want][:1]
        assert sorted(m for _, _, m in got) == sorted(m for _, _, m in want)
        assert all(doc[q : q + m] == item[p : p + m] for q, p, m in got)


def test_leaks(spark, docs_of):
    rng = random.Random(2)
    items = {i: passage(rng, 30) for i in range(20)}
    bench = spark.createDataFrame([(i, " ".join(w).capitalize() + ".", "t") for i, w in items.items()] + [(90, "too short", "t"), (91, None, "t"), (None, "", None)], "item_id long, text string, doc_id string")
    rows, want = [], set()
    for d in range(120):
        text = passage(rng, rng.randrange(0, 400))
        if d % 4 == 0:
            w = items[d % 20]
            parts = {0: w, 1: w[15:] + passage(rng, 3) + w[:15], 2: w[:20]}[d // 4 % 3]
            at = rng.randrange(len(text) + 1)
            text[at:at] = parts
            want.add((d, d % 20))
        elif d % 4 == 1:
            text += items[d % 20][:8]  # a short quotation is no leak
        rows.append((d, ", ".join(text).upper() if d % 8 == 0 else "\n".join(text)))
    rows += [(500 + (i or 0), t) for i, t in ODD] + [(None, rows[0][1]), rows[0]]
    df = docs_of(rows)
    got = decontam.leaks(df, bench)
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert pairs - {(None, 0)} == want and (None, 0) in pairs
    clean = decontam.without_leaks(df, bench)
    assert clean.columns == df.columns and clean.count() == len(rows) - len(want) - 2
    assert decontam.leaks(df.where("false"), bench).count() == decontam.leaks(df, bench.where("false")).count() == 0


def test_leaks_without_the_filter_and_the_broadcast(spark, docs_of, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(passage(rng, 20))) for i in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of([(d, " ".join(passage(rng, 30)) + " " + items[d % 5][1]) for d in range(10)] + [(50, "nothing of it")])
    one = {tuple(r) for r in decontam.leaks(df, bench).collect()}
    monkeypatch.setattr(decontam, "FILTER_SEEDS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    assert {tuple(r) for r in decontam.leaks(df, bench).collect()} == one and len(one) == 10


def test_rare_seeds_meet_every_leak():
    """Whatever seeds a document shares: if they cover the share of the item, one of the rare ones is among them."""
    rng = random.Random(8)
    for _ in range(400):
        k, n = rng.randrange(1, 6), rng.randrange(1, 40)
        seeds = [rng.randrange(30) for _ in range(n)]
        often = {x: rng.randrange(1, 9) for x in set(seeds)}
        share = rng.choice([0.0, 0.2, 0.5, 0.8, 1.0])
        rare = decontam.rare_seeds(seeds, [often[x] for x in seeds], k, share)
        assert set(rare) <= set(seeds)
        for _ in range(20):
            held = {x for x in often if rng.random() < rng.choice([0.2, 0.6, 0.9])}
            tokens = {p + i for p, x in enumerate(seeds) if x in held for i in range(k)}
            assert decontam.covered(np.flatnonzero([x in held for x in seeds]), k) == len(tokens)
            if held & set(seeds) and len(tokens) / (n + k - 1) >= share:
                assert held & set(rare)


def test_a_passage_in_all_items_and_documents_makes_no_pairs(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    common = passage(rng, 20)
    own = {i: passage(rng, 24) for i in range(30)}
    bench = spark.createDataFrame([(i, " ".join(common + w)) for i, w in own.items()], "item_id long, text string")
    rows = [(d, " ".join(passage(rng, 50) + common + (own[d] if d < 10 else []))) for d in range(200)]
    tiled = spark.sparkContext.accumulator(0)
    real = decontam._tiled

    def counted(batches, k, coverage):
        def each():
            for b in batches:
                tiled.add(b.num_rows)
                yield b

        return real(each(), k, coverage)

    monkeypatch.setattr(decontam, "_tiled", counted)
    got = sorted((r.doc_id, r.item_id, r.n_covered) for r in decontam.leaks(docs_of(rows), bench).collect())
    words = {i: common + w for i, w in own.items()}
    texts = {d: t.split() for d, t in rows}
    cover = {(d, i): sum(m for _, _, m in brute_tiles(texts[d], words[i], 5)) for d in range(12) for i in range(12)}
    assert got == [(d, i, n) for (d, i), n in sorted(cover.items()) if n / 44 >= 0.5]
    assert len(got) == 10
    assert tiled.value == 10  # of 6000 pairs that share the passage


# -- toxicity -----------------------------------------------------------------

BAD = ["grumblefoot", "snargwit", "blotterface"]


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        words = passage(rng, rng.randrange(30, 200))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark, docs_of):
    rng = random.Random(4)
    rows, labels = corpus(rng, 900)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    odd = [(5000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "x y z")]
    misspelt = [(9000 + k, " ".join(passage(rng, 30) + [w, w])) for k, w in enumerate(("grumblefood", "snargwitt", "blotterfaces", "grumblfoot"))]
    got = toxicity.toxicity(docs_of(rows + odd + misspelt), lab).collect()
    assert len(got) == len(rows) + len(odd) + len(misspelt)
    by_id = {r.doc_id: r for r in got}
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert sum(by_id[i].predicted for i, _ in misspelt) >= 3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    flat = toxicity.toxicity(docs_of(rows[:5]), lab.where("toxic = 0")).collect()
    assert len({r.score for r in flat}) == 1
    assert toxicity.toxicity(docs_of(rows[:5]).where("false"), lab).count() == 0


def test_block_scores_are_those_of_single_texts():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.standard_normal(1 << toxicity.BITS).astype(np.float32), 0.1)
    texts = [(t or "").encode() for _, t in ODD] + [b"short", b"a", b"ab cd"]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])
    for t in texts:
        buckets, counts = toxicity.bag(t)
        if int(counts.sum()) < 60_000:
            mean = float((model.weights[buckets] * toxicity.shares(counts)).sum()) if len(buckets) else 0.0
            assert np.isclose(model.scores([t])[0], 1 / (1 + math.exp(-(0.1 + toxicity.GAIN * mean))), atol=1e-4)


# -- language model -----------------------------------------------------------


def brute_kn(train, order=3):
    """Interpolated modified Kneser-Ney over words, straight from the definition; returns p((two words before, word))."""
    counts = {order: Counter()}
    for t in train:
        w = ["<s>"] * (order - 1) + t.split() + ["</s>"]
        for i in range(len(w) - order + 1):
            counts[order][tuple(w[i : i + order])] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    loss, total, lost = {}, {}, {}
    for n, cs in counts.items():
        cc = Counter(cs.values())
        y = cc[1] / (cc[1] + 2 * cc[2]) if cc[1] + 2 * cc[2] else None
        d = [0.0]
        for k in (1, 2, 3):
            v = k / 2 if y is None or not cc[k] else k - (k + 1) * y * cc[k + 1] / cc[k]
            d.append(min(k, max(kneser_ney.LEAST_LOSS, v)))
        loss[n], total[n], lost[n] = d, defaultdict(int), defaultdict(float)
        for g, c in cs.items():
            total[n][g[:-1]] += c
            lost[n][g[:-1]] += d[min(c, 3)]

    pairs, firsts = Counter(), Counter()
    for t in train:
        b = "".join(f" {w}" for w in t.split()).encode() + b"  "
        pairs.update(zip(b, b[1:], strict=False))
        firsts.update(b[:-1])

    def spelled(w):
        b = (" " if w == "</s>" else f" {w} ").encode() + (b" " if w == "</s>" else b"")
        return sum(math.log((pairs[x] + 1) / (firsts[x[0]] + 256)) for x in zip(b, b[1:], strict=False))

    def ln_p(g):
        n, h = len(g), g[:-1]
        low = spelled(g[0]) if n == 1 else ln_p(g[1:])
        if not total[n][h]:
            return low
        c = counts[n][g]
        if not c:
            return math.log(lost[n][h] / total[n][h]) + low
        return math.log((c - loss[n][min(c, 3)]) / total[n][h] + lost[n][h] / total[n][h] * math.exp(low))

    ln_p.spelled = spelled
    return ln_p


def test_kneser_ney(spark, docs_of):
    rng = random.Random(6)
    rows = [(i, " ".join(passage(rng, rng.randrange(5, 40))), ("en", "de", "xx")[i % 3]) for i in range(90)]
    rows += [(500 + k, t, None) for k, (_, t) in enumerate(ODD) if t] + [(None, "one two", "en"), (800, "Zzz## zzz##", "en"), (801, "q" * 400, "en")]
    rows += [(810, None, "de"), (811, "", "en"), (812, " \n\t", "xx"), (813, "\x0bone\x0ctwo\rthree ", "en")]
    labels = [(i, i % 5 != 0 and 1 or 0, 0) for i in range(60)] + [(1, 1, 0), (3, None, 0)]
    df, lab = docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = kneser_ney.perplexities(df, lab, strata=("en", "de", "other"), heavy=0.01).collect()
    assert len(got) == len(rows)
    fold = {r.doc_id: r.fold for r in got}
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]+", "\n", t or "").split("\n")
    models = {}
    for s, name in ((1, "en"), (2, "de"), (3, None)):
        models[s] = brute_kn([t for i, t, lang in rows if (lang == name or (s == 3 and lang not in ("en", "de"))) and i is not None and fold[i] > 0])
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        t = texts[r.doc_id]
        w = ["<s>", "<s>", *(w for w in plain(t) if w), "</s>"]
        assert r.n_words == len(w) - 2 and r.n_bytes == len(t.encode())
        want = sum(models[r.stratum](tuple(w[i - 2 : i + 1])) for i in range(2, len(w)))
        assert math.isclose(r.log_p, want, rel_tol=1e-5, abs_tol=1e-3), (r, want)
    en = [t for i, t, lang in rows if lang == "en" and i is not None and fold[i] > 0]
    known = {w for t in en for w in t.split()} | {"</s>"}
    for before in ((), ("<s>", "<s>"), ("<s>", en[0].split()[0])):  # what known words leave is the unknown ones' share
        p, unknown = models[1], math.exp(models[1]((*before, "w?w?")) - models[1].spelled("w?w?"))
        assert math.isclose(sum(math.exp(p((*before, w))) for w in known) + unknown * (1 - sum(math.exp(p.spelled(w)) for w in known)), 1, rel_tol=1e-9)
    key = lambda r: (str(r.doc_id), r.n_bytes, r.log_p)
    for heavy, bits in ((1.0, 1 << 28), (1e-9, 1 << 28), (1.0, 1 << 14), (1.0, 8)):  # nothing and everything broadcast; a filter that lets much through, and none
        other = kneser_ney.perplexities(df, lab, strata=("en", "de", "other"), heavy=heavy, filter_bits=bits).collect()
        for a, b in zip(sorted(got, key=key), sorted(other, key=key), strict=True):
            assert a.doc_id == b.doc_id and a.log_p == b.log_p  # to the last bit


@pytest.mark.parametrize("bits", [1 << 12, 1 << 21])
def test_filter_of_seen_keys(spark, bits):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(1 << 63), 1 << 63, 2000, np.int64))
    table = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(7)
    got = kneser_ney.seen_filter(table, bits)
    want = np.zeros(bits, bool)
    want[keys.view(np.uint64) % np.uint64(bits)] = True
    assert (np.unpackbits(got, bitorder="little").astype(bool) == want).all()
    assert kneser_ney.seen_filter(table, 1 << 11) is None
    assert not kneser_ney.seen_filter(table.where("false"), bits).any()


def test_keys_are_those_of_sql(spark):
    values = np.array([0, 1, -1, 1 << 62, -(1 << 63), 12345], np.int64)
    df = spark.createDataFrame([(int(v), int(w)) for v, w in zip(values, values[::-1], strict=True)], "a long, b long")
    want = [r.k for r in df.selectExpr("xxhash64(a, b) AS k").collect()]
    assert kneser_ney.keys_of(values.view(np.uint64), values[::-1].view(np.uint64)).view(np.int64).tolist() == want


def test_classifier_keeps_clean_and_rejects_junk(spark, docs_of):
    rng = random.Random(7)
    rows = [(i, " ".join(passage(rng, 60)), "en") for i in range(400)]
    junk = [(1000 + i, "".join(chr(rng.randrange(33, 127)) for _ in range(300)), "en") for i in range(20)]
    junk += [(1100 + i, " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(7)) for _ in range(60)), "en") for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.quality_classifier(docs_of(rows + junk + [(2000, "", "en"), (2001, "was ist", "de")]), labels).collect()}
    assert sum(got[i].kept for i in range(400)) >= 398 and not any(got[i].kept for i, _, _ in junk)
    assert got[2000].kept and got[2001].kept and got[2001].threshold is None
    assert kneser_ney.quality_classifier(docs_of([(1, "x")]).where("false"), labels).count() == 0


def test_thresholds_and_verdicts(spark, docs_of):
    """Mean, drawn perplexity, nearest-rank quantile and verdict, by hand from the log-probabilities."""
    rng = random.Random(8)
    rows = [(i, " ".join(passage(rng, rng.randrange(1, 60))), ("en", "de", "zz", None)[i % 4]) for i in range(240)] + [(500, "", "en"), (501, None, "fr"), (502, "q", "fr")]
    df, labels = docs_of(rows), spark.createDataFrame([(i, int(i % 7 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    strata = ("en", "de", "fr", "other")
    each = kneser_ney.perplexities(df, labels, strata).collect()
    for quantile in (0.5, 0.9):
        got = {r.doc_id: r for r in kneser_ney.quality_classifier(df, labels, quantile, strata).collect()}
        rejected = 0
        for s, lang in enumerate(strata, 1):
            mine = [r for r in each if r.stratum == s]
            held = [r for r in mine if r.fold == 0 and r.n_bytes]
            mean = sum(r.log_p for r in held) / sum(r.n_words for r in held) if held else 0.0
            of = {r.doc_id: math.exp(-(r.log_p + kneser_ney.DRAW * mean) / (r.n_words + kneser_ney.DRAW)) for r in mine}
            ranked = sorted(of[r.doc_id] for r in held)
            cut = ranked[math.ceil(quantile * len(ranked)) - 1] if ranked else None
            for i, p in of.items():
                r = got[i]
                assert r.lang == lang and math.isclose(r.perplexity, p, rel_tol=1e-9)
                assert (cut is None) == (r.threshold is None) and (cut is None or math.isclose(r.threshold, cut, rel_tol=1e-9))
                assert r.kept == (r.threshold is None or r.perplexity <= r.threshold)
                rejected += not r.kept
        assert rejected and len(got) == len(rows) and got[502].threshold is None


def test_order_of_words_counts(spark, docs_of):
    rng = random.Random(9)
    follow = {i: [rng.randrange(200) for _ in range(3)] for i in range(200)}

    def prose(n):
        w, out = rng.randrange(200), []
        for _ in range(n):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return out

    rows = [(i, " ".join(prose(80)), "en") for i in range(600)]
    mixed = []
    for i in range(30):
        w = prose(80)
        rng.shuffle(w)
        mixed.append((1000 + i, " ".join(w), "en"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.quality_classifier(docs_of(rows + mixed), labels).collect()}
    assert sum(got[i].kept for i in range(500, 600)) >= 90 and not any(got[i].kept for i, _, _ in mixed)


def test_repeated_ids_give_one_training_row(spark, docs_of, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(passage(rng, 20))) for i in range(30)]
    rows += [(7, " ".join(passage(rng, 20))) for _ in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda bags, y, prior: seen.append((len(bags), int(y.sum()))))
    for given in (rows, rows[::-1], [(i, t) for i, t in dict(rows).items()]):
        toxicity.fit(docs_of(given).select("doc_id", "text"), labels)
    assert len(set(seen)) == 1 and seen[0][0] <= 30


def test_training_against_a_plain_version(monkeypatch):
    """Forward and backward pass and Adam row by row and bucket by bucket."""
    monkeypatch.setattr(toxicity, "BITS", 6)
    monkeypatch.setattr(toxicity, "EPOCHS", 3)
    monkeypatch.setattr(toxicity, "BATCH", 5)
    rng = np.random.default_rng(1)
    bags, labels = [], np.array([i % 3 == 0 for i in range(23)]).astype(np.int64)
    for y in labels:
        b = np.unique(rng.integers(0, 40, 9) + 10 * y)
        bags.append((b.astype(np.int32), toxicity.shares(rng.integers(1, 5, len(b)))))
    bags[4] = (np.zeros(0, np.int32), np.zeros(0, np.float32))
    got = toxicity.train(bags, labels, 0.2, seed=3)

    rng, dim, gain = np.random.default_rng(3), toxicity.DIM, toxicity.GAIN
    emb = np.zeros((64, dim))
    soft, bias = (rng.standard_normal((dim, 2)) * 0.5).astype(np.float32).astype(float), np.zeros(2)
    moments = {}
    share = labels.mean()
    weight = np.array([0.2 / share if y else 0.8 / (1 - share) for y in labels])
    weight /= weight.mean()
    step = 0

    def adam(name, param, grad, rate):
        m, v = moments.get(name, (np.zeros_like(grad), np.zeros_like(grad)))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        moments[name] = (m, v)
        return param - rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * m / (np.sqrt(v) + 1e-8)

    for epoch in range(3):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 5):
            rows, step = order[i : i + 5], step + 1
            d_emb, d_soft, d_bias = {}, np.zeros_like(soft), np.zeros(2)
            for r in rows:
                mean = sum((gain * w * emb[b] for b, w in zip(*bags[r], strict=True)), np.zeros(dim))
                e = np.exp(mean @ soft + bias)
                d = (e / e.sum() - np.eye(2)[labels[r]]) * weight[r] / len(rows)
                d_soft += np.outer(mean, d)
                d_bias += d
                for b, w in zip(*bags[r], strict=True):
                    d_emb[b] = d_emb.get(b, np.zeros(dim)) + gain * w * (soft @ d)
            rate = toxicity.RATE * (1 - epoch / 3)
            for b, g in d_emb.items():
                emb[b] = adam(("emb", b), emb[b], g, rate)
            soft, bias = adam("soft", soft, d_soft, rate), adam("bias", bias, d_bias, rate)
    assert np.allclose(got.weights, emb @ (soft[:, 1] - soft[:, 0]), rtol=1e-3, atol=1e-4) and abs(got.bias - (bias[1] - bias[0])) < 1e-3
    assert np.abs(got.weights).max() > 0.1


def test_trigram_counts(spark, docs_of):
    rng = random.Random(10)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(30)] + ["x y z"]
    rows = spark.createDataFrame([(t, k % 2 + 1) for k, t in enumerate(texts)], "text string, stratum int").repartition(5)
    got = [r.asDict() for r in kneser_ney.trigram_counts(rows).collect()]
    want, after = Counter(), defaultdict(Counter)
    for k, t in enumerate(texts):
        codes = kneser_ney.sequences([t.encode()], np.array([k % 2 + 1]))[0].view(np.int64).tolist()
        want.update(zip(codes, codes[1:], codes[2:], strict=False))
    for (a, b, c), n in want.items():
        after[a, b][c] = n
    assert {(r["a"], r["b"], r["c"]): r["n"] for r in got} == want and len(got) == len(want)
    for r in got:
        ns = list(after[r["a"], r["b"]].values())
        assert (r["total"], r["m1"], r["m2"], r["m3"]) == (sum(ns), ns.count(1), ns.count(2), sum(n > 2 for n in ns))
    assert Counter((r["a"], r["b"]) for r in got if r["first"]) == Counter(after.keys())


def test_classifier_leaves_little_on_disk(spark, docs_of, tmp_path, monkeypatch):
    """The model's tables go as soon as they are used."""
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    rng = random.Random(11)
    rows = [(i, " ".join(passage(rng, 40)), "en") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    assert kneser_ney.quality_classifier(docs_of(rows), labels).count() == 200
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert left == {"good", "languages", "losses", "corrections1", "corrections2", "corrections3", "perplexities"}
