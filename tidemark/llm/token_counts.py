"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest) to token count.
Documents are reduced to digests; digests that the cache has are only joined.  Of
the others one row stands for all copies, its text is encoded, and the counts are
appended before the final join.

Everything is decided on narrow rows: distinct digests (folded map-side), an anti join
with the cache, and the least doc_id of each digest that is missing.  Those rows, or the
rows that are not to be read where these are fewer, then filter the texts by (doc_id,
digest).  That table is broadcast while it is small; beyond that the join shuffles
texts by a key that copies do not share.  Rows equal in both are encoded once per task.
The last join is on (digest, bytes) rows, where AQE splits a digest with many copies.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import pretokenizer
from tidemark.llm.common import decoded, materialise, pick, read_or_empty, shared_dir, small, spread, text_blocks

BLOCK_BYTES = 1_000_000
CACHE_WORDS = 300_000
CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


class JsonCounter:
    """Counts of a ``tokenizers`` file.

    A byte-level BPE without a normalizer first cuts out its special strings, then
    splits by its pattern, and never merges across a cut.  So the library encodes each
    distinct piece once, and a text's count is the sum over its pieces.  With any other
    tokenizer whole texts are encoded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        step = made.get("pre_tokenizer") or {}
        added = made.get("added_tokens") or []
        self.whole = not (
            made.get("normalizer") is None and (made.get("model") or {}).get("type") == "BPE" and step.get("type") == "ByteLevel"
            and step.get("use_regex", True) and not step.get("add_prefix_space")
            and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
        )
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = sorted(special, key=len, reverse=True)
        self.split = pretokenizer(public_tokenizers.PATTERN).findall
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        for s in self.special:
            if s in text:
                out: list[str] = []
                for i, part in enumerate(text.split(s)):
                    out += [s] * (i > 0)
                    out += self.pieces(part)
                return out
        return self.split(text)

    def block(self, texts: list[str]) -> list[int]:
        if self.whole:
            return [len(self.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
        split = [self.pieces(t) for t in texts]
        words = set().union(*split)
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:  # what this block uses stays
            self.known = {w: self.known[w] for w in words - new}
        new = list(new)
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update(zip(part, map(len, encoded), strict=True))
        known = self.known.__getitem__
        return [sum(map(known, words)) for words in split]


class RanksCounter:
    """Counts of a ``tiktoken`` file of ranks, special strings as ordinary text."""

    def __init__(self, path: str):
        import tiktoken

        from tidemark.llm.bpe import load

        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load(path).ranks, special_tokens={}
        )

    def block(self, texts: list[str]) -> list[int]:
        return [len(self.encoding.encode_ordinary(t)) for t in texts]


class PieceCounter:
    """Counts of a ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def block(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.processor.encode(texts, num_threads=1)]


@functools.lru_cache(maxsize=2)
def counter(path: str):
    """The counter for a tokenizer file, by its ending; once per Python worker."""
    for end, kind in ((".json", JsonCounter), (".tiktoken", RanksCounter), (".model", PieceCounter)):
        if path.endswith(end):
            return kind(path)
    raise ValueError(f"no tokenizer library for {path}")


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and its library's version: a new one opens a new part of the cache."""
    import importlib.metadata as md

    library = {".json": "tokenizers", ".tiktoken": "tiktoken", ".model": "sentencepiece"}[os.path.splitext(path)[1]]
    with open(path, "rb") as f:
        return hashlib.sha256(f"{library} {md.version(library)} ".encode() + f.read()).hexdigest()


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    count, done = counter(path), set()
    for batch in batches:
        # rows that are equal in id and text were all picked: one of them is enough
        digests = batch.column(0).to_pylist()
        new = [i for i, d in enumerate(digests) if d not in done and not done.add(d)]
        batch, n = batch.take(pa.array(new, pa.int64())), []
        for _, _, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            n += count.block(decoded(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    cache_path: str | None = None,
    limit: int = 512,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``cache_path`` is a Parquet folder, read and appended to; without one, a new
    cache is begun in the shared folder.  Null texts count as empty: 0 bytes, 0
    tokens.  Repeated rows give a row each, a null doc_id is carried through, and
    further columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    cache_path = cache_path or f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    version = tokenizer_version(path)

    def cached() -> DataFrame:
        of_version = read_or_empty(spark, cache_path, CACHE_SCHEMA).where(F.col("tokenizer") == version)
        return of_version.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two writers may add one digest

    digested = pick(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = digested.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    keys = materialise(keys, "digests")
    # of each missing digest the least id, a null one last
    rows = keys.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("_d"))).alias("row"))
    rows = rows.join(cached().select("digest"), "digest", "left_anti").select(F.col("digest").alias("_g"), "row._d")
    wanted = materialise(rows, "misses")

    def same(other: DataFrame):
        return (F.col("digest") == other["_g"]) & F.col("doc_id").eqNullSafe(other["_d"])

    others = keys.join(wanted, same(wanted), "left_anti").select(F.col("digest").alias("_g"), F.col("doc_id").alias("_d")).distinct()
    others = materialise(others, "no-misses")
    if wanted.count() <= others.count():
        missing = digested.join(small(wanted), same(wanted), "left_semi")
    else:
        missing = digested.join(small(others), same(others), "left_anti")
    counted = spread(missing.select("digest", "text"), docs).mapInArrow(lambda b: _count(b, path), "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    # as a table of its own it is shuffled anew for the join, and AQE can then split a digest with many copies
    needed = cached().join(keys.select("digest").distinct(), "digest", "left_semi")
    return (
        keys.join(materialise(needed, "counts"), "digest", "left")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
