"""Merge replay and token counts against the libraries."""

import base64
import hashlib
import random

import public_tokenizers as P
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from tidemark.llm.bpe import MergeReplay, decode, encode, encode_digests, load
from tidemark.llm.token_counts import token_counts

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
EVERYWHERE = ["".join(chr(c) for c in range(i, i + 251) if not 0xD800 <= c < 0xE000) for i in range(0, 0x20000, 251)]


def test_ids_digests_and_round_trip(docs_of):
    rows = ODD + [(1000 + i, t) for i, t in enumerate(EVERYWHERE)]
    df = docs_of(rows)
    by_id = {i: t or "" for i, t in rows if i is not None}
    ids = {r.doc_id: r.ids for r in encode(df).collect() if r.doc_id is not None}
    assert ids == {i: TIKTOKEN.encode_ordinary(t) for i, t in by_id.items()}
    back = {r.doc_id: bytes(r.bytes) for r in decode(encode(df)).collect() if r.doc_id is not None}
    assert back == {i: t.encode() for i, t in by_id.items()}
    got = encode_digests(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            t = by_id[r.doc_id]
            want = TIKTOKEN.encode_ordinary(t)
            assert r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_replay_takes_the_least_rank_of_overlapping_pairs():
    rng = random.Random(3)
    replay = load(P.path("byte_bpe_50k.tiktoken"))
    words = [bytes(rng.choice(b"aabcdeinst h") for _ in range(rng.randrange(1, 40))) for _ in range(2000)] + [b"a" * n for n in range(1, 60)]
    assert replay.encode(words) == [TIKTOKEN._encode_single_piece(w) for w in words]
    # a token whose merge is only reached by way of a later one
    small = MergeReplay({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"ab": 4})
    assert small.encode([b"abc", b"xab"[1:], b"cab"]) == [[3], [4], [2, 4]]


def counts(df, **kw):
    return {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, **kw).collect() if r.doc_id is not None}


def test_counts_as_the_library_gives_them(docs_of):
    rows = ODD + [(1000 + i, t) for i, t in enumerate(EVERYWHERE)]
    want = {i: len(LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in rows if i is not None}
    got = counts(docs_of(rows))
    assert {i: n for i, (_, n, _) in got.items()} == want
    assert all(got[i] == (len((t or "").encode()), want[i], want[i] > 512) for i, t in rows if i is not None)
    assert token_counts(docs_of(rows)).count() == len(rows)


def test_cache_is_used_and_grows_by_misses_only(spark, docs_of, tmp_path):
    cache = str(tmp_path / "cache")
    first = docs_of([(1, "alpha beta"), (2, "alpha beta"), (3, "gamma")])
    assert counts(first, cache_path=cache)[1] == counts(first, cache_path=cache)[2]
    assert spark.read.parquet(cache).count() == 2
    # a count put into the cache by hand is believed: it is not encoded again
    row = spark.read.parquet(cache).where("n_tokens is not null").limit(1).collect()[0]
    counts(docs_of([(4, "gamma"), (5, "new words here")]), cache_path=cache)
    assert spark.read.parquet(cache).count() == 3 and row.tokenizer
    fake = spark.read.parquet(cache).selectExpr("digest", "tokenizer", "1000L + n_tokens as n_tokens")
    fake.write.parquet(str(tmp_path / "other"))
    assert counts(first, cache_path=str(tmp_path / "other"))[3][1] == 1000 + counts(first)[3][1]
    # of another tokenizer nothing is taken from it
    multi = P.path("byte_bpe_multi_50k.tiktoken")
    assert counts(first, tokenizer=multi, cache_path=cache)[3][1] == counts(first, tokenizer=multi)[3][1]


def test_other_libraries(docs_of):
    texts = ["Hello there", "naïve café", ""]
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    got = counts(docs_of(list(enumerate(texts))), tokenizer=model)
    assert [got[i][1] for i in range(3)] == [len(sp.encode(t)) for t in texts]


def test_a_tokenizer_with_a_normalizer(docs_of):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["Hello   THERE", "naïve café", "", "a<|endoftext|> b", "x-y's"]
    got = counts(docs_of(list(enumerate(texts))), tokenizer=path)
    assert [got[i][1] for i in range(5)] == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_copies_are_encoded_once(spark, docs_of, tmp_path):
    texts = ["one text", "another one", None]
    rows = [(i % 7 if i % 5 else None, texts[i % 3]) for i in range(60)] + [(100 + i, f"alone {i}") for i in range(9)]
    for n, cached in ((12, ()), (60, rows[60:])):  # with few misses they are picked, with many the others left out
        cache = str(tmp_path / f"cache{n}")
        if cached:
            token_counts(docs_of(list(cached)), cache_path=cache).count()
        got = token_counts(docs_of(rows), cache_path=cache)
        assert sorted((r.doc_id, r.n_tokens) for r in got.collect() if r.doc_id is not None) == sorted(
            (i, len(LIBRARY.encode(t or "", add_special_tokens=False))) for i, t in rows if i is not None
        )
        assert got.count() == len(rows)
        assert spark.read.parquet(cache).select("digest").distinct().count() == 12


def test_empty_tables(docs_of):
    none = docs_of([(1, "x")]).where("false")
    assert encode(none).count() == encode_digests(none).count() == token_counts(none).count() == 0
