"""The corpus pipeline against a brute-force version of its stages."""

import hashlib
import random

import corpus_pipeline
from tests.llm.test_bpe import TIKTOKEN
from tests.llm.test_models import passage
from tests.llm.test_rules import base, brute_secrets
from tests.llm.test_simhash import brute
from tidemark.llm.common import materialise


def redacted(text):
    spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in brute_secrets(text)[4].split(",") if s))
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def test_stages(spark, docs_of, tmp_path):
    rng = random.Random(9)
    items = [" ".join(passage(rng, 25)) for _ in range(4)]
    rows = []
    for i in range(90):
        words = passage(rng, rng.choice((20, 70, 120)))
        if i % 9 == 0:
            words[10:10] = items[i % 4].split()
        if i % 10 == 1:
            words[5:5] = ['token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', "end"]
        rows.append((i, " ".join(words)))
    rows += [(100 + i, rows[i * 3][1]) for i in range(20)] + [(200, None), (201, ""), (202, "word " * 300), (10, rows[10][1])]
    df = docs_of(rows, extra=False)
    sf = str(tmp_path)
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    want = [(i, t) for i, t in rows if not base(t)[5]]
    first = {i: c for i, _, c in brute(want)}
    want = list(dict.fromkeys((i, t) for i, t in want if first[i] == i))
    want = [(i, t) for i, t in want if not any(item in t for item in items)]
    want = [(i, redacted(t)) for i, t in want]

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), name)
        assert docs.columns == df.columns, name
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == sorted((i, t, len(t)) for i, t in want)
    assert len({i for i, _ in want}) < len({i for i, t in rows if not base(t)[5]})

    got = {r.doc_id: (r.ids, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    ids = {i: TIKTOKEN.encode_ordinary(t) for i, t in want}
    assert got == {i: (x, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, x in ids.items()}


def test_empty_documents(spark, docs_of, tmp_path):
    sf = str(tmp_path)
    docs_of([(1, "x")], extra=False).where("false").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
