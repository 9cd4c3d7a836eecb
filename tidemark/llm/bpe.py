"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task gathers the distinct pre-tokens of a block of whole documents, lays them
out as one long row of symbols, and keeps an inverted index from the rank of a
symbol pair to the places where that pair stands.  Ranks are taken in order; each
merge touches only its own places and their two neighbours.  A pre-token is thus
encoded once per block however many documents hold it, and stays in a bounded
cache of the Python worker for later blocks.

Spark partitions the documents; nothing is shuffled, and one row in gives one row
out.  Memory in a worker is bounded by the block size and the cache size, not by
the partition.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import decoded, pick, text_blocks

#: Bytes of text in a block; words kept in a worker's cache.
BLOCK_BYTES = 1_000_000
CACHE_WORDS = 300_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@functools.lru_cache(maxsize=4)
def pretokenizer(pattern: str):
    """Compiled pattern; its white space is Unicode's White_Space, as the encoders have it."""
    return regex.compile(pattern)


class MergeReplay:
    """Merge table of one vocabulary, and the replay over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.wide = max(ranks.values(), default=0) + 1
        self.first = [ranks.get(bytes([b]), -1) for b in range(256)]
        # rank of the token that each pair of tokens makes
        self.merged = {
            ranks[w[:i]] * self.wide + ranks[w[i:]]: r
            for w, r in ranks.items()
            for i in range(1, len(w))
            if w[:i] in ranks and w[i:] in ranks
        }

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        if not words:
            return []
        ranks, first, wide, merged = self.ranks, self.first, self.wide, self.merged.get
        end = -1 - wide * wide  # closes a word: no pair with it is in the table
        sym: list[int] = [end]  # a place merged away holds the same
        starts: list[int] = []
        for w in words:
            starts.append(len(sym))
            if w in ranks:
                sym.append(ranks[w])
            else:
                sym += [first[b] for b in w]
            sym.append(end)
        nxt = list(range(1, len(sym) + 1))
        prv = list(range(-1, len(sym) - 1))
        index: dict[int, list[int]] = {}
        for p, r in enumerate([merged(a * wide + b) for a, b in zip(sym, sym[1:], strict=False)]):
            if r is not None:
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r)
            places.sort()
            for p in places:
                q = nxt[p]
                if merged(sym[p] * wide + sym[q]) != r:  # a neighbour's merge has changed this pair
                    continue
                n = nxt[q]
                sym[p], sym[q] = r, end
                nxt[p], prv[n] = n, p
                left = prv[p]
                m = merged(sym[left] * wide + r)
                if m is not None:
                    if m in index:
                        index[m].append(left)
                    else:
                        index[m] = [left]
                        heapq.heappush(heap, m)
                m = merged(r * wide + sym[n])
                if m is not None:
                    if m in index:
                        index[m].append(p)
                    else:
                        index[m] = [p]
                        heapq.heappush(heap, m)
        ends = [*starts[1:], len(sym)]
        return [[s for s in sym[i : j - 1] if s >= 0] for i, j in zip(starts, ends, strict=True)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> MergeReplay:
    """Merge table of a ``.tiktoken`` file of ranks; once per Python worker."""
    with open(path, "rb") as f:
        return MergeReplay({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Codec:
    """Encodes blocks of texts; holds the worker's bounded cache of words."""

    def __init__(self, vocabulary: str, pattern: str, cache_words: int = CACHE_WORDS):
        self.replay, self.split, self.most = load(vocabulary), pretokenizer(pattern).findall, cache_words
        self.ids: dict[str, bytes] = {}  # each id in decimal, each after a space
        self.back: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.ids)
        if len(self.ids) + len(new) > self.most:  # what this block uses stays
            self.ids = {w: self.ids[w] for w in words - new}
            self.back = {w: self.back[w] for w in words - new}
        new = list(new)
        for w, ids in zip(new, self.replay.encode([w.encode() for w in new]), strict=True):
            self.ids[w] = b"".join([b" %d" % i for i in ids])
            self.back[w] = self.replay.decode(ids)

    def block(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text: its ids in decimal, each after a space, and the decoded bytes."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        ids, back = self.ids.__getitem__, self.back.__getitem__
        for words in split:
            yield b"".join(map(ids, words)), b"".join(map(back, words))


@functools.lru_cache(maxsize=1)
def codec_of(vocabulary: str, pattern: str) -> Codec:
    """The worker's codec, whose cache serves one task after the other."""
    return Codec(vocabulary, pattern)


def _hashed(batches: Iterator[pa.RecordBatch], vocabulary: str, pattern: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    codec = codec_of(vocabulary, pattern)
    sha = hashlib.sha256
    for batch in batches:
        n, a, b, kept = [], [], [], []
        for _, _, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            for ids, back in codec.block(decoded(texts)):
                n.append(ids.count(b" "))
                a.append(sha(ids[1:]).hexdigest())
                b.append(sha(back).hexdigest())
                if keep_ids:
                    kept.append(np.array(ids.split(), np.int32))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        if keep_ids:
            columns.append(pa.array(kept, pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, pattern: str) -> Iterator[pa.RecordBatch]:
    codec = codec_of(vocabulary, pattern)
    for batch in batches:
        for i, j, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            ids = [[int(x) for x in ids.split()] for ids, _ in codec.block(decoded(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    replay = load(vocabulary)
    for batch in batches:
        out = [None if x is None else replay.decode(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return public_tokenizers.path(name)


def encode(
    docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, *, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, in the ids of ``vocabulary``.

    Null and empty texts give an empty array; repeated rows give one row each; a
    null doc_id is carried through.  Further columns of ``docs`` are ignored.
    """
    vocabulary, pattern = vocabulary or vocabulary_path(), pattern or public_tokenizers.PATTERN
    return pick(docs, id_col, text_col).mapInArrow(
        lambda b: _encoded(b, vocabulary, pattern), "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, vocabulary: str | None = None, *, id_col="doc_id", ids_col="ids") -> DataFrame:
    """(doc_id, bytes binary) of every row's ids; null ids stay null.

    Bytes, as ids need not end at a character's end; cast to string for text.
    """
    vocabulary = vocabulary or vocabulary_path()
    return encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids")).mapInArrow(
        lambda b: _decoded(b, vocabulary), "doc_id long, bytes binary"
    )


def encode_digests(
    docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, *, id_col="doc_id", text_col="text", keep_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): an encode and decode round in one pass.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the
    bytes that decoding the ids gives back.  Null and empty texts: no tokens, the
    digests of nothing.  Rows in, rows out, also for repeats and null doc_ids.
    ``keep_ids`` adds the ids themselves (array<int>).
    """
    vocabulary, pattern = vocabulary or vocabulary_path(), pattern or public_tokenizers.PATTERN
    return pick(docs, id_col, text_col).mapInArrow(
        lambda b: _hashed(b, vocabulary, pattern, keep_ids), SCHEMA + ", ids array<int>" * keep_ids
    )
