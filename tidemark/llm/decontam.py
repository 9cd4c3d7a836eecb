"""Benchmark decontamination by greedy string tiling.

1. Seeds.  Every run of ``seed`` tokens of a benchmark item is hashed.  Documents
   are read once; a task hashes tokens and token runs of a block of texts with
   vectorised Karp-Rabin prefix sums and keeps only the stretches that hold a
   benchmark seed.  Where the benchmark's seeds outgrow a bound, this filter is
   left out and all stretches go into the join.
2. Join.  Of each item the seeds that many items have are put aside, as many as
   cannot cover the threshold share of it by themselves.  A leak shares one of the
   rest, so only those meet the stretches' seeds: a phrase that stands in every item
   and document makes no pairs.
3. Tiling.  A pair goes on if all seeds that it shares could cover enough of the item.  Then the longest common stretches of unmarked tokens
   are found with running Karp-Rabin hashes, and marked, again and again, down to
   ``seed`` tokens.  As tiles do not overlap and may stand in any order, a passage
   whose parts were moved about is covered all the same.
4. A pair whose tiles cover the threshold share of the item is a leak.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, pick, small, text_blocks

SEED_TOKENS = 5
COVERAGE = 0.5
#: Most benchmark seeds that are handed to every task as a filter, or broadcast in the join (8 bytes each).
FILTER_SEEDS = 4_000_000
BROADCAST_SEEDS = 1_000_000
BLOCK_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: Byte to token byte: letters and digits in lower case, all of UTF-8's upper half; 0 parts tokens.
_TOKEN_BYTE = np.array([b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 0 for b in range(256)], np.uint8)


class _Powers:
    """Powers of the base and of its inverse, as far as needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up[:n], cls.down[:n]


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every window, from one prefix sum over all."""
    up, down = _Powers.of(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts in order, and the text that each belongs to."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    chars = _TOKEN_BYTE[raw]
    inside = np.empty(len(chars) + 1, np.int8)
    inside[0], inside[1:] = 0, chars != 0
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    hashes = window_hashes(chars.astype(np.uint64), starts, ends)
    offsets = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(offsets, starts, "right")


def seed_starts(owner: np.ndarray, k: int) -> np.ndarray:
    """Places where ``k`` tokens of one text stand in a row."""
    if len(owner) < k:
        return np.zeros(0, np.int64)
    return np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])


class SeedFilter:
    """Membership in a set of hashes: a bit table first, then the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.shift = np.uint64(64 - max(16, min(26, int(len(self.sorted)).bit_length() + 6)))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[self.sorted >> self.shift] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that are in the set."""
        maybe = np.flatnonzero(self.table[hashes >> self.shift])
        if not len(maybe) or not len(self.sorted):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
        return maybe[self.sorted[at] == hashes[maybe]]


_STRETCH = "doc_id long, copy long, start int, tokens array<long>, seeds array<long>"


def _stretches(batches: Iterator[pa.RecordBatch], k: int, wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    keep = None if wanted is None else SeedFilter(wanted)
    for batch in batches:
        ids, copies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        out: list[tuple] = []
        for i, j, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            tokens, owner = token_hashes(texts)
            at = seed_starts(owner, k)
            seeds = window_hashes(tokens, at, at + k)
            if keep is not None:
                hit = keep.holds(seeds)
                at, seeds = at[hit], seeds[hit]
            if not len(at):
                continue
            first = np.searchsorted(owner, np.arange(j - i))  # of each text
            # a stretch ends where the next seed begins beyond this one's tokens, or in another text
            cuts = np.flatnonzero((np.diff(at) > k) | (np.diff(owner[at]) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                a, b, row = int(at[s]), int(at[e - 1]) + k, int(owner[at[s]])
                out.append((ids[i + row], copies[i + row], a - int(first[row]), tokens[a:b].view(np.int64), seeds[s:e].view(np.int64)))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "copy", "start", "tokens", "seeds"]
        )


def _items(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        tokens, owner = token_hashes(texts)
        at = seed_starts(owner, k)
        seeds = window_hashes(tokens, at, at + k)
        n = np.arange(len(texts) + 1)
        t, s = np.searchsorted(owner, n), np.searchsorted(owner[at], n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([tokens[a:b].view(np.int64) for a, b in zip(t, t[1:], strict=False)], pa.list_(pa.int64())),
                pa.array([seeds[a:b].view(np.int64) for a, b in zip(s, s[1:], strict=False)], pa.list_(pa.int64())),
            ],
            ["item_id", "item", "item_seeds"],
        )


def covered(places: np.ndarray, k: int) -> int:
    """Tokens that runs of ``k`` tokens at these places, in order and each given once, cover together."""
    return int(np.minimum(np.diff(places), k).sum()) + k if len(places) else 0


def rare_seeds(seeds: list[int], counts: list[int], k: int, coverage: float) -> list[int]:
    """The seeds of an item of which a document that covers it by ``coverage`` has at least one.

    ``seeds`` stand at places 0, 1, … of the item; ``counts`` say how often the benchmark
    has each.  The most frequent are put aside as long as all that were do not cover the share.
    """
    n = len(seeds) + k - 1
    aside, total = np.zeros(n, bool), 0
    order = sorted(range(len(seeds)), key=lambda p: (-counts[p], p))
    for i, p in enumerate(order):
        total += int((~aside[p : p + k]).sum())
        aside[p : p + k] = True
        if total / n >= coverage:
            return sorted({seeds[q] for q in order[i:]})
    return []


def _rare(batches: Iterator[pa.RecordBatch], k: int, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for places in batch.column(2).to_pylist():
            places.sort(key=lambda x: x["place"])
            kept.append(rare_seeds([x["seed"] for x in places], [x["n"] for x in places], k, coverage))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.int64()))], ["item_id", "item_key", "rare"])


def tiles(stretches: list[tuple[int, list[int]]], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in document, place in item, length), longest first.

    ``stretches``: (start, tokens) of the document, without overlap.  Of equally
    long matches the first in the item, then the first in the document is marked.
    """
    item_tokens = np.array(item, np.int64).view(np.uint64)
    runs = [(start, np.array(tokens, np.int64).view(np.uint64)) for start, tokens in stretches]
    item_free = np.ones(len(item), bool)
    free = [np.ones(len(t), bool) for _, t in runs]
    found: list[tuple[int, int, int]] = []

    def windows(tokens: np.ndarray, open_: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where n unmarked tokens stand in a row, and their Karp-Rabin hashes."""
        if len(tokens) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        marked = np.concatenate([[0], np.cumsum(~open_)])
        at = np.flatnonzero(marked[n:] == marked[:-n])
        return at, window_hashes(tokens, at, at + n)

    def matches(n: int) -> list[tuple[int, int, int, int]]:
        """Maximal matches of at least n unmarked tokens: (-length, item, run, place)."""
        where = defaultdict(list)
        for p, h in zip(*(x.tolist() for x in windows(item_tokens, item_free, n)), strict=True):
            where[h].append(p)
        out = []
        for r, (_, tokens) in enumerate(runs):
            for q, h in zip(*(x.tolist() for x in windows(tokens, free[r], n)), strict=True):
                for p in where.get(h, ()):
                    if p and q and item_free[p - 1] and free[r][q - 1] and item_tokens[p - 1] == tokens[q - 1]:
                        continue  # it is found from further left
                    m = 0
                    while p + m < len(item) and q + m < len(tokens) and item_free[p + m] and free[r][q + m] and item_tokens[p + m] == tokens[q + m]:
                        m += 1
                    if m >= n:
                        out.append((-m, p, r, q))
        return out

    length = max(least, min(len(item), max((len(t) for _, t in runs), default=0)))
    while True:
        heap = matches(length)
        heapq.heapify(heap)
        while heap:
            m, p, r, q = heapq.heappop(heap)
            open_ = item_free[p : p - m] & free[r][q : q - m]
            if open_.all():
                item_free[p : p - m] = free[r][q : q - m] = False
                found.append((runs[r][0] + q, p, -m))
                continue
            # what earlier tiles leave of it goes on as shorter matches
            edges = np.flatnonzero(np.diff(np.concatenate([[0], open_.view(np.int8), [0]])))
            for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if j - i >= length:
                    heapq.heappush(heap, (i - j, p + i, r, q + i))
        if length == least:
            return found
        length = max(least, length // 2)


def _tiled(batches: Iterator[pa.RecordBatch], k: int, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, of = [], []
        for at, row in enumerate(batch.select(["seeds", "stretches", "item", "item_seeds"]).to_pylist()):
            n = len(row["item"])
            # no tiling can cover more than the shared seeds do
            shared = np.flatnonzero(np.isin(np.array(row["item_seeds"], np.int64), np.array(row["seeds"], np.int64)))
            if covered(shared, k) / n < coverage:
                continue
            found = tiles([(s["start"], s["tokens"]) for s in row["stretches"]], row["item"], k)
            of.append(at)
            rows.append((n, sum(m for _, _, m in found), len(found), max((m for _, _, m in found), default=0)))
        counts = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 4)]
        of = pa.array(of, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(of) for c in ("doc_id", "copy", "item_id")), *counts],
            ["doc_id", "copy", "item_id", "n_tokens", "n_covered", "n_tiles", "longest"],
        )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    seed: int = SEED_TOKENS,
    coverage: float = COVERAGE,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, copy, item_id, n_tokens, n_covered, n_tiles, longest, coverage): pairs at or over ``coverage``.

    ``copy`` is a digest of the document's text, which tells rows of one doc_id
    apart; equal rows give one result.  Tokens are letters and digits, A-Z in lower
    case.  Null and empty texts, and items shorter than ``seed`` tokens, are in no
    leak.  A null doc_id or item_id is carried through.  An empty table on either
    side gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    items = materialise(
        pick(benchmark, item_col, item_text_col)
        .withColumnRenamed("doc_id", "item_id")
        .mapInArrow(lambda b: _items(b, seed), "item_id long, item array<long>, item_seeds array<long>")
        .where(F.size("item_seeds") > 0)
        .withColumn("item_key", F.xxhash64("item")),
        "items",
    )
    item_rows = items.dropDuplicates(["item_id", "item_key"])
    benchmark_seeds = item_rows.select("item_id", "item_key", F.posexplode("item_seeds").alias("place", "seed"))
    often = materialise(benchmark_seeds.groupBy("seed").agg(F.count("*").alias("n")), "seeds")
    n_seeds = often.count()
    wanted = None
    if n_seeds <= FILTER_SEEDS:
        wanted = often.select("seed").toArrow().column(0).to_numpy().view(np.uint64)
    rare = (
        benchmark_seeds.join(F.broadcast(often) if n_seeds <= BROADCAST_SEEDS else often, "seed")
        .groupBy("item_id", "item_key")
        .agg(F.collect_list(F.struct("place", "seed", "n")).alias("places"))
        .mapInArrow(lambda b: _rare(b, seed, coverage), "item_id long, item_key long, rare array<long>")
        .select("item_id", "item_key", F.explode("rare").alias("seed"))
    )
    rare = small(materialise(rare, "rare"), BROADCAST_SEEDS)
    source = pick(docs, id_col, text_col).withColumn("copy", F.xxhash64("text"))
    found = source.mapInArrow(lambda b: _stretches(b, seed, wanted), _STRETCH)
    found = materialise(found.dropDuplicates(["doc_id", "copy", "start"]), "stretches")

    pairs = found.select("doc_id", "copy", F.explode("seeds").alias("seed")).join(rare, "seed").select("doc_id", "copy", "item_id", "item_key").distinct()
    item_rows = item_rows.select(F.col("item_id").alias("i"), F.col("item_key").alias("k"), "item", "item_seeds")
    if n_seeds <= BROADCAST_SEEDS and items.agg(F.coalesce(F.sum(F.size("item_seeds")), F.lit(0))).first()[0] <= BROADCAST_SEEDS:
        item_rows = F.broadcast(item_rows)
    grouped = found.groupBy(F.col("doc_id").alias("d"), F.col("copy").alias("c")).agg(
        F.sort_array(F.collect_list(F.struct("start", "tokens"))).alias("stretches"), F.array_distinct(F.flatten(F.collect_list("seeds"))).alias("seeds")
    )
    both = (
        pairs.join(grouped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")))
        .join(item_rows, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("k")))
        .select("doc_id", "copy", "item_id", "seeds", "stretches", "item", "item_seeds")
    )
    tiled = both.mapInArrow(
        lambda b: _tiled(b, seed, coverage),
        "doc_id long, copy long, item_id long, n_tokens long, n_covered long, n_tiles long, longest long",
    )
    return tiled.withColumn("coverage", F.col("n_covered") / F.col("n_tokens")).where(F.col("coverage") >= coverage)


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Of rows with one doc_id only those whose own text holds an item go; null ids and
    texts, repeats and empty tables are as in ``leaks``.
    """
    found = leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    found = small(materialise(found.select(F.col("doc_id").alias("_d"), F.col("copy").alias("_c")).distinct(), "leaks"))
    same = docs[id_col].eqNullSafe(found["_d"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == found["_c"])
    return docs.join(found, same, "left_anti")
