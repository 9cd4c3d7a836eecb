"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: each shingle's XXH64 votes on 64 bits.  Votes are counted eight bits
at a time in the byte lanes of machine words.

Links: equal fingerprints are first folded into one row.  Two fingerprints at most
``radius`` bits apart differ in at most ``radius`` of their eight bytes, so they
agree in one of the choices of the other bytes; for radius 2 that is 28 keys of 48
bits.  Fingerprints that share a key form a bucket, which holds at most 2^16 of
them as only two bytes are free.  Within a bucket the bits are stored as vertical
planes, one big integer per bit with a place for each member.  A fingerprint is
compared with all others of a block at once: each plane is added to carry-save
counters, and a block is left as soon as every place in it is beyond the radius
or already linked.  A bucket gives at most one link per member, never all pairs,
and no link between different texts' components is lost.

Components are found by joins over those links (see ``components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, pick, small, text_blocks
from tidemark.llm.components import components

SEED = 42
BLOCK_BYTES = 1_000_000
#: Members of a bucket that one big integer covers.
PLANE_BITS = 2048
#: Parts that the fingerprints of one component are dealt over.
SALTS = 32
_LANES = np.uint64(0x0101010101010101)


def shingles(text: bytes, width: int) -> list[bytes]:
    """Shingles of the lower-cased text (A-Z only), repeats included; fewer words give one of all."""
    words = text.lower().split()  # of bytes: exactly the ASCII white space
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def votes(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of texts whose shingle hashes stand one after the other.

    A byte lane holds 255 votes, so texts are cut into pieces of that many.
    """
    n_pieces = -(-sizes // 255)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), n_pieces)
    first_piece = np.cumsum(n_pieces) - n_pieces
    at = (ends - sizes)[owner] + 255 * (np.arange(len(owner)) - first_piece[owner])
    counts = np.empty((len(sizes), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, at)
        per_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[:, k::8] = np.add.reduceat(per_byte, first_piece, axis=0)
    bits = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprint_texts(texts: list[bytes], width: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    split = [shingles(t, width) for t in texts]
    full = np.array([i for i, s in enumerate(split) if s], np.int64)
    if len(full):
        sizes = np.array([len(split[i]) for i in full], np.int64)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(s, SEED) for x in split for s in x), np.uint64, int(sizes.sum()))
        out[full] = votes(hashes, sizes)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [fingerprint_texts(texts, width) for _, _, texts in text_blocks(batch.column(1), BLOCK_BYTES)]
        fps = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])


def fingerprints(
    docs: DataFrame, width: int = 3, *, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long"
) -> DataFrame:
    """(doc_id, fp long): the 64 bits as a signed number; a text without words has 0."""
    return pick(docs, id_col, text_col).mapInArrow(lambda b: _fingerprints(b, width), f"doc_id {id_type}, fp long")


class BitPlanes:
    """Vertical bit planes of one bucket's fingerprints, of ``width`` bits each."""

    def __init__(self, members: list[int], radius: int, width: int = 64):
        varying = 0
        for m in members:
            varying |= m ^ members[0]
        self.bits = [j for j in range(width) if varying >> j & 1]
        self.members, self.radius, self.depth = members, radius, radius.bit_length()
        # a block is looked at for places beyond the radius after so many planes
        self.every = 1 if self.depth < 4 else 16
        self.planes, self.open = [], []
        for start in range(0, len(members), PLANE_BITS):
            part = members[start : start + PLANE_BITS]
            self.planes.append([sum((m >> j & 1) << i for i, m in enumerate(part)) for j in self.bits])
            self.open.append((1 << len(part)) - 1)

    def near(self, q: int) -> list[int]:
        """Open places within the radius of fingerprint ``q``."""
        found = []
        fixed = (q ^ self.members[0]) & ~sum(1 << j for j in self.bits)
        spent = fixed.bit_count()  # bits in which all members are alike
        if spent > self.radius:
            return found
        for b, planes in enumerate(self.planes):
            alive = self.open[b]
            if not alive:
                continue
            counters = [-(spent >> k & 1) for k in range(self.depth)]
            for at, (j, plane) in enumerate(zip(self.bits, planes, strict=True), 1):
                carry = (alive & ~plane) if q >> j & 1 else (alive & plane)
                for k in range(self.depth):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                    if not carry:
                        break
                else:
                    alive &= ~carry  # past what the counters hold
                if at % self.every == 0 or at == len(planes):
                    alive &= ~self._beyond(counters)
                if not alive:
                    break
            while alive:
                low = alive & -alive
                found.append(b * PLANE_BITS + low.bit_length() - 1)
                alive ^= low
        return found

    def close(self, place: int) -> None:
        """Leave a place out of what is still compared."""
        b, bit = divmod(place, PLANE_BITS)
        self.open[b] &= ~(1 << bit)

    def is_open(self, place: int) -> bool:
        b, bit = divmod(place, PLANE_BITS)
        return bool(self.open[b] >> bit & 1)

    def _beyond(self, counters: list[int]) -> int:
        """Places whose counter is over the radius."""
        over, same = 0, -1
        for k in reversed(range(self.depth)):
            if self.radius >> k & 1:
                same &= counters[k]
            else:
                over |= same & counters[k]
                same &= ~counters[k]
        return over

    def links(self, alike=None) -> Iterator[tuple[int, int]]:
        """Places (root, other): a star for each group of members that chains of near ones connect.

        ``alike`` (place, place), if given, has the last word on each near pair.
        """
        for root in range(len(self.members)):
            if not self.is_open(root):
                continue
            self.close(root)
            stack = [root]
            while stack:
                q = stack.pop()
                for k in self.near(self.members[q]):
                    if alike is None or alike(q, k):
                        self.close(k)
                        stack.append(k)
                        yield root, k


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = [], []
        for members in batch.column(0).to_pylist():
            for a, b in BitPlanes([m & (1 << 64) - 1 for m in members], radius).links():
                x.append(members[a])
                y.append(members[b])
        columns = [pa.array(c, pa.int64()) for c in (x, y)]
        yield pa.RecordBatch.from_arrays(columns, ["x", "y"])


def near_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (x, y) that connect all of the distinct ``fps`` (fp long) at most ``radius`` bits apart."""
    if not 0 < radius < 4:
        raise ValueError("radius must be 1, 2 or 3: beyond that the keys no longer single out few fingerprints")
    keys = []
    for free in combinations(range(8), radius):
        mask = (1 << 64) - 1
        for byte in free:
            mask &= ~(0xFF << 8 * byte)
        keys.append(F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")))
    buckets = (
        fps.select("fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
        .groupBy("choice", "key")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
    )
    return buckets.select("members").mapInArrow(lambda b: _bucket_links(b, radius), "x long, y long")


def near_duplicates_of(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``marked`` (doc_id, fp); root is the component's least one."""
    folded = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "folded")
    roots = components(near_links(folded.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    rooted = folded.join(roots, "fp").select("fp", "root", "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("least_id"))
    grouped = rooted.join(least, "root").select("fp", "root", "least_id")
    named = folded.join(grouped, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least_id", "first_id").alias("component_id")
    )
    # as a table of its own it is shuffled anew for each join, and AQE can then split a fingerprint with many copies
    return materialise(named, "named")


def near_duplicates(
    docs: DataFrame, width: int = 3, radius: int = 2, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    fingerprint is 16 lowercase hex digits; component_id the smallest doc_id that
    links of at most ``radius`` bits reach, its own included.  A null text counts
    as empty and has fingerprint 0, which links like any other.  Repeated rows give
    a row each; a null doc_id gets the least other doc_id of its component, or
    null.  Further columns are ignored, an empty table gives an empty result.

    Skew: equal fingerprints are folded map-side before anything is shuffled by
    them, and the last join's copies side can be split by AQE.
    """
    marked = materialise(fingerprints(docs, width, id_col=id_col, text_col=text_col), "fingerprints")
    return marked.join(near_duplicates_of(marked, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, width: int = 3, radius: int = 2, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the least doc_id stays.

    All columns stay as they are.  Of a component exactly one row stays: rows of one
    id and text are cut down to one, of several texts under one id the one whose hash
    is least stays, and a row without an id only where no row has one.  Empty tables
    stay empty.
    """
    source = keyed(docs, id_col, text_col)
    marked = materialise(
        fingerprints(source, width, id_col="k", text_col="t", id_type="struct<i:bigint,c:bigint>")
        .select(F.col("doc_id.i").alias("doc_id"), F.col("doc_id.c").alias("copy"), "fp"),
        "fingerprints",
    )
    return first_of_each(docs, marked, near_duplicates_of(marked, radius), id_col=id_col, text_col=text_col)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, t): the id with a hash of the text, which tells rows of one id apart, and the text."""
    copy = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.struct(F.col(id_col).alias("i"), copy.alias("c")).alias("k"), F.col(text_col).alias("t"))


def first_of_each(docs: DataFrame, marked: DataFrame, named: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay; ``marked``: (doc_id, copy, fp) of each, ``named``: (fp, root) of each fp.

    Skew: copies are folded map-side to one row for each fp, and the fps of one root are
    dealt over ``SALTS`` parts for the join with its first row; the join by fp is between
    two tables, so that AQE can split an fp with many copies.
    """
    copy = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    row = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "copy")
    folded = marked.groupBy("fp").agg(F.min(row).alias("own")).join(named.select("fp", "root"), "fp")
    folded = materialise(folded, "firsts")
    shared = folded.groupBy("root").agg(F.min("own").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = materialise(shared.select("root", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")), "shared")
    salted = folded.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    first = salted.join(shared, ["root", "salt"], "left").select("fp", F.coalesce("first", "own").alias("first"))
    rooted = marked.select("doc_id", "copy", "fp").join(materialise(first, "first"), "fp")
    gone = rooted.where(~row.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("_d"), F.col("copy").alias("_c"))
    gone = small(materialise(gone.distinct(), "gone"))

    def same(other: DataFrame):
        return docs[id_col].eqNullSafe(other["_d"]) & (copy == other["_c"])

    kept = docs.join(gone, same(gone), "left_anti")
    # rows that stand there several times still: only these are brought together
    again = marked.groupBy(F.col("doc_id").alias("_d"), F.col("copy").alias("_c")).count().where("count > 1")
    both = again["_d"].eqNullSafe(gone["_d"]) & (again["_c"] == gone["_c"])
    again = materialise(again.join(gone, both, "left_anti").select("_d", "_c"), "again")
    if again.isEmpty():
        return kept
    again = small(again)
    whole = docs.join(again, same(again), "left_semi")
    whole = whole.select(F.struct(whole[id_col].alias("i"), copy.alias("c")).alias("key"), F.struct(*(whole[c] for c in whole.columns)).alias("row"))
    once = whole.groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return kept.join(again, same(again), "left_anti").unionByName(once)
