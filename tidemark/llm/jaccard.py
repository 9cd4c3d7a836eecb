"""Near-duplicates by SimHash bit planes with an exact Jaccard similarity behind them.

Shingles: a text's distinct runs of ``width`` words, as 64-bit hashes.  Texts of equal
sets are folded into one row.

Candidates: at a similarity of 0.8 fingerprints of 256 bits differ by about 39 bits, so
by the pigeonhole principle keys of their own bits would have 4 bits each and single
nothing out.  Candidates share one of ``BANDS`` keys of ``ROWS`` min-hashes instead: a
pair at 0.8 shares none with a chance of (1 - 0.8^4)^24 = 3.2e-6, a more similar one with
less.  Texts that share a key are linked to the least of them, and components of those
links bring all pairs that share one together.

Links: only candidates' sets are shuffled, to tiles in which each text has a SimHash of
256 bits, stored as vertical planes.  A text is compared with a whole block of texts by
carry-save counters, the block is left once all are beyond ``RADIUS``, and only what is
within it is compared exactly.  A text is left out as soon as it is linked, so a tile
gives at most one link per text.

A component of at most ``TILE`` shingles is one tile.  A larger one is cut into chunks,
and each chunk is a tile together with ``CENTERS`` texts of the component.  A group of
near copies is mostly connected by that, in time that grows with its size.  The texts
beside its largest connected part then meet every chunk, in tiles of their own, so that
all pairs of the wanted similarity are connected in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, materialise, pick, small, text_blocks
from tidemark.llm.components import components
from tidemark.llm.decontam import window_hashes
from tidemark.llm.simhash import BLOCK_BYTES, SEED, BitPlanes, first_of_each, keyed, votes

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Bits of a fingerprint, and those in which candidates may differ: 0.8 gives 39 at large sets and 48 at the smallest, at a
#: standard deviation of 6; texts with nothing in common differ by 128.
BITS, RADIUS = 256, 80
#: Shingles of a chunk of a component, about; texts of a larger component that all its chunks are compared with.
TILE, CENTERS = 50_000, 8

_RNG = np.random.default_rng(SEED)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Byte to a number from 1 on, A-Z as a-z; 0 is the ASCII white space that parts words.
_CHAR = np.array([0 if b == 32 or 9 <= b <= 13 else 1 + (b | 32 if 65 <= b <= 90 else b) for b in range(256)], np.uint64)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; none for a text without words, one of all for one of fewer words."""
    chars = _CHAR[np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)]
    steps = np.diff((chars != 0).astype(np.int8))
    starts, ends = np.flatnonzero(steps == 1) + 1, np.flatnonzero(steps == -1) + 1
    words = window_hashes(chars, starts, ends)
    offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, offsets)  # each text's first word, and the end
    n = np.diff(first)
    # places where a shingle begins, and where it ends
    at = np.arange(len(words))
    last = np.repeat(first[1:], n)
    begin = at[(at + width <= last) | (at == np.repeat(first[:-1], n))]
    hashes = window_hashes(words, begin, np.minimum(begin + width, last[begin]))
    cut = np.searchsorted(begin, first)
    return [np.unique(hashes[i:j]) for i, j in zip(cut, cut[1:], strict=False)]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``BANDS`` keys for each of the sets, which have a member at least."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    keys = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = (key ^ np.minimum.reduceat(flat * _TIMES[k] + _PLUS[k], starts)) * _MIX
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys


def wide_fingerprints(sets: list[np.ndarray]) -> list[int]:
    """A SimHash of ``BITS`` bits of each of the sets, none of them empty."""
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    out = [0] * len(sets)
    for k in range(BITS // 64):
        mixed = (flat ^ _PLUS[k]) * _TIMES[k]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
        for i, part in enumerate(votes(mixed ^ (mixed >> np.uint64(29)), sizes).tolist()):
            out[i] |= part << 64 * k
    return out


def _marks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            sets = shingle_sets(texts, width)
            fps = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
            full = [s for s in sets if len(s)]
            keys = band_keys(full) if full else np.zeros((0, BANDS), np.uint64)
            ends = np.cumsum([0, *(BANDS * bool(len(s)) for s in sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(fps.view(np.int64)), lists], ["doc_id", "fp", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            sets = pa.array([s.view(np.int64) for s in shingle_sets(texts, width)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in (0, 2)), sets], ["fp", "part", "members"])


def links_of(sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """A star for each group of the sets (none empty) that chains of similar ones connect."""
    if not sets:
        return

    def alike(i: int, j: int) -> bool:
        a, b = sets[i], sets[j]
        if min(len(a), len(b)) < least * max(len(a), len(b)):
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common >= least * (len(a) + len(b) - common)

    yield from BitPlanes(wide_fingerprints(sets), RADIUS, BITS).links(alike)


def _tile_links(tile: pa.Table, least: float) -> pa.Table:
    fps, members = tile.column("fp").to_numpy(), tile.column("members").combine_chunks()
    if isinstance(members, pa.ChunkedArray):
        members = pa.concat_arrays(members.chunks)
    flat, at = members.values.to_numpy().view(np.uint64), members.offsets.to_numpy()
    fps, places = np.unique(fps, return_index=True)  # rows of one id and text give their set each
    pairs = list(links_of([flat[at[i] : at[i + 1]] for i in places.tolist()], least))
    return pa.table({c: pa.array(fps[[p[k] for p in pairs]] if pairs else [], pa.int64()) for k, c in enumerate("xy")})


_DEALT = ["part", "a", "b", "fp", "members"]


def _tiled(dealt: DataFrame, least: float) -> DataFrame:
    return dealt.select(*_DEALT).groupBy("part", "a", "b").applyInArrow(lambda t: _tile_links(t, least), "x long, y long")


def similar_links(sets: DataFrame, least: float, tile: int = TILE) -> DataFrame:
    """Links (x, y) that connect what pairs of one part at or over ``least`` connect; ``sets``: (fp, part, members), a table."""
    place = F.xxhash64("fp").alias("place")
    parts = sets.groupBy("part").agg(F.ceil(F.sum(F.size("members")) / tile).cast("int").alias("chunks"))
    parts = small(materialise(parts, "parts"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = sets.join(parts, "part").withColumn("a", chunk).withColumn("b", F.lit(-1))
    # of a part in chunks the texts whose hash is least are its centers; a task's own least ones are enough to find them
    ranked = dealt.where("chunks > 1").select("part", "fp", "chunks", place).distinct()
    near = Window.partitionBy("part", F.pmod("place", F.lit(64))).orderBy("place")
    ranked = ranked.withColumn("n", F.row_number().over(near)).where(F.col("n") <= CENTERS)
    ranked = ranked.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("place"))).where(F.col("n") <= CENTERS)
    centers = small(materialise(ranked.select("part", "fp"), "centers"))
    center = dealt.join(centers, ["part", "fp"], "left_semi").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    links = materialise(_tiled(dealt.unionByName(center), least), "links")

    large = dealt.where("chunks > 1").select("part", "fp", "chunks").distinct()
    named = large.join(components(links).select(F.col("node").alias("fp"), "root"), "fp", "left")
    named = materialise(named.select("part", "fp", F.coalesce("root", "fp").alias("root")), "connected")
    most = named.groupBy("part", "root").agg(F.count("*").alias("n")).groupBy("part").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    beside = small(materialise(named.join(F.broadcast(most) if most.count() <= BROADCAST_ROWS else most, "part").where("root <> main").select("part", "fp"), "beside"))
    # what is beside the largest part meets every chunk, itself included
    few = dealt.join(beside, ["part", "fp"], "left_semi")
    sizes = few.groupBy("part").agg(F.ceil(F.sum(F.size("members")) / tile).cast("int").alias("groups"))
    sizes = small(materialise(sizes, "groups"))
    own = few.join(sizes, "part").withColumn("b", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("groups")).cast("int"))
    own = own.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    others = dealt.join(sizes, "part").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    more = _tiled(own.select(*_DEALT).unionByName(others.select(*_DEALT)), least)
    return links.unionByName(materialise(more, "more-links"))


def one_of_each(
    docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY, tile: int = TILE, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the least doc_id stays.

    Two texts are linked where their sets of ``width``-word shingles have a Jaccard
    similarity of ``least`` (0.8 or more) at least; fewer words make one shingle of
    all, and texts without words are alike.  Which row of a component stays is as in
    ``simhash.one_of_each``.
    """
    if not SIMILARITY <= least <= 1:
        raise ValueError("least must be from 0.8 to 1: below that too many pairs share no key")
    source = keyed(docs, id_col, text_col)
    marked = materialise(
        pick(source, "k", "t").mapInArrow(lambda b: _marks(b, width), "doc_id struct<i:bigint,c:bigint>, fp long, keys array<long>")
        .select(F.col("doc_id.i").alias("doc_id"), F.col("doc_id.c").alias("copy"), "fp", "keys"),
        "marks",
    )
    row = F.struct("doc_id", "copy")
    folded = materialise(marked.groupBy("fp").agg(F.min(row).alias("row"), F.first("keys").alias("keys")), "folded")
    keys = folded.select("fp", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("fp").alias("x"), F.max("fp").alias("z")).where("x < z").select("key", "x")
    # a table of its own, so that AQE can split a key that very many sets share
    shared = materialise(shared, "shared-keys")
    parts = components(keys.join(shared, "key").where("fp <> x").select("x", F.col("fp").alias("y")))
    # one text of each set that shares a key
    picked = folded.select("fp", "row").join(parts.select(F.col("node").alias("fp"), F.col("root").alias("part")), "fp")
    picked = small(materialise(picked.select("fp", "part", F.col("row.doc_id").alias("_d"), F.col("row.copy").alias("_c")), "picked"))
    texts = source.join(picked, source["k.i"].eqNullSafe(picked["_d"]) & (source["k.c"] == picked["_c"])).select("fp", "t", "part")
    sets = materialise(texts.mapInArrow(lambda b: _sets(b, width), "fp long, part long, members array<long>"), "sets")
    roots = components(similar_links(sets, least, tile)).select(F.col("node").alias("fp"), "root")
    named = folded.select("fp").join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return first_of_each(docs, marked, materialise(named, "named"), id_col=id_col, text_col=text_col)
