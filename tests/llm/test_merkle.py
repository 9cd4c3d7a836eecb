"""The Merkle manifest against trees built one by one."""

import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, ODD
from tidemark.llm import merkle as M
from tidemark.llm.manifest_sql import MANIFEST
from tidemark.llm.ordering import placed

NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def climb(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def leaf(row, low=False):
    d = dict(zip(NAMES, row, strict=True))
    if low and d["text"] is not None:
        d["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"])
    return digest("".join("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in M.COLUMNS))


def siblings(tree, i):
    for level in tree[:-1]:
        a = i - i % 8
        yield "".join(level[a:i]), "".join(level[i + 1 : a + 8])
        i //= 8


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0), leaf(r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: x[:2])
    trees = {n: climb([x[1] for x in groups[n]]) for n in names}
    crown = climb([trees[n][-1][0] for n in names])
    root, out = crown[-1][0] if names else None, []
    for k, n in enumerate(names):
        for i, (_, lf, r) in enumerate(groups[n]):
            proof = [*siblings(trees[n], i), *siblings(crown, k)]
            h = leaf(r, True) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else lf
            for a, b in proof:
                h = digest(a + h + b)
            out.append((r[0], lf, trees[n][-1][0], root, digest("".join(a + b for a, b in proof)), h, h == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, M.tampering_check(df).collect()), key=str)


def test_large_groups_and_many_groups(spark):
    rng = random.Random(1)
    langs = ["en"] * 4000 + [f"x{i}" for i in range(600)] + [None, "", "é"]
    rows = [(i, f"Text {i}" if i % 7 else None, rng.choice(langs), None if i % 11 == 0 else "s", i) for i in range(6000)]
    found = got(spark.createDataFrame(rows, DOCS.replace("source string, n_chars long", "source string, n_chars long")).repartition(7))
    assert found == brute(rows)
    assert 0 < sum(not r[-1] for r in found) < len(rows) / 2


def test_sizes_at_the_edges_of_blocks(spark):
    for n in (1, 2, 8, 9, 511, 512, 513, 4097):
        rows = [(i, "A", "en", "s", 1) for i in range(n)]
        assert got(spark.createDataFrame(rows, DOCS)) == brute(rows), n


def test_odd_rows(odd):
    rows = [tuple(r) for r in odd.select(*NAMES).collect()]
    assert len(rows) == len(ODD) and got(odd) == brute(rows)
    assert got(odd.limit(0)) == []


def test_sql(spark, tmp_path):
    rows = [(i if i % 50 else None, f"Text {i % 40}", ["en", "de", None][i % 3], "s", 1) for i in range(700)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    result = con.execute(MANIFEST)
    names = [c[0] for c in result.description]
    df = M.tampering_check(spark.read.parquet(str(tmp_path / "d")))
    assert sorted(result.fetchall(), key=str) == sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_any_change_of_a_row_is_seen(spark):
    rows = [(i, "some text", "en", "s", 9) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    leaves = docs.select("doc_id", "lang", M.leaf_digest(*(F.col(c) for c in M.COLUMNS)).alias("leaf"))
    proofs = M.manifest(leaves)
    assert proofs.where(M.fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    changed = docs.withColumn("n_chars", F.col("n_chars") + 1).select("doc_id", M.leaf_digest(*(F.col(c) for c in M.COLUMNS)).alias("now"))
    assert proofs.join(changed, "doc_id").where(M.fold(F.col("now"), F.col("proof")) == F.col("root")).isEmpty()


def test_places(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaab"), rng.randrange(100), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, i long, n long").repartition(9)
    want, sums, seen = {}, {}, {}
    for g, k, i, n in sorted(rows):
        want[i], sums[i] = seen.get(g, (0, 0))
        seen[g] = (want[i] + 1, sums[i] + n)
    assert {r["i"]: r["_at"] for r in placed(df, ["g"], ["k", "i"], "t").collect()} == want
    assert {r["i"]: r["_at"] for r in placed(df, ["g"], ["k", "i"], "t", "n").collect()} == sums
