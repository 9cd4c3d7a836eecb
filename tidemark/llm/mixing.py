"""Mixing sources to target weights.

The documents of a source stand one after the other, in order of id, and are packed into
blocks of ``BLOCK_WORDS`` words; a block holds pieces of one or more documents, the last one
of a source may be shorter.  The mix is a table of slots, ``SHARD_SLOTS`` to an output
shard, each filled with a block:

1. ``targets``: how many words each source gives.  Sources share ``SHARE`` times all words by
   weight; none gives more than ``MOST`` times its own, and what is over goes to the others by
   weight, until none is above.  A source's target in words makes a number of slots.
2. ``drawn``: every shard draws how many of its slots each source gets from a multinomial
   distribution with the targets' shares: its slots each draw a source by a number from a
   hash of (seed, shard, slot), and the draws of a shard are counted per source.  Chance gives
   some sources more draws than they have slots, and others fewer; the former keep the same share of
   their draws in each shard, and the i-th draw left over goes to the i-th slot that is missing, so each
   source ends with its own number of slots.
3. A source's slots are numbered over the shards, and slot q takes block p(q) of its round,
   q div the number of blocks.  p is a pseudorandom permutation of the source's blocks, another one each
   round: a Feistel network over the next power of four, walked until it falls inside.  So in a round
   no block is taken twice, no document is taken more than ``MOST`` times over, and nothing is
   shuffled to be put in random order.
4. Slots meet blocks in a join by (source, block).  The last slot of a source takes only as many words
   of its block as its target still lacks: a source gives its target, rounded down to whole words.

Scale: texts are read once to be measured; only where the mix is to hold them are they carried along.
Running sums over a source come from sorted ranges (``ordering.placed``), slots draw their
source from a guide table by an equal key, and slots and blocks are joined by (source,
block), so a source that has a third of everything is spread like the others.  Everything
follows from the rows, the seed and the parameters; a task that is run again draws the same.

Cases: null and empty texts have no words and are in no block; a source without words has a target of
0; a null source comes last and has a weight as others have; repeated rows are documents of their own;
an empty table gives no rows.  Ties of doc_id in a source are ordered by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, materialise, small
from tidemark.llm.ordering import placed

#: Words of a block, slots of an output shard.
BLOCK_WORDS, SHARD_SLOTS = 64, 1024
#: Weights of the sources by their order, again and again; words of the mix, and most words of a source, in halves of the words there are.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED = 20_240_501
#: Cells of the guide table for each source.
CELLS = 8


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def measured(docs: DataFrame, texts: bool = False) -> DataFrame:
    """(row, doc_id, source, size, tie) of every document, and its text if asked for, written once; ``row`` is its own number."""
    text = F.coalesce(F.col("text"), F.lit(""))
    more = [text.alias("text")] if texts else []
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("tie"), *more)
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "mix-measured")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(sid, source, source_size, weight, target) of every source of ``rows`` (source, size); ``sid`` is its place by code point, null last.

    With the sources that would be above their most set to it, the others' targets
    are one level times their weight.  Each round finds the level, then the sources above it;
    the driver sees sums.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = materialise(per.withColumns({"all": F.lit(0), "none": F.col("source").isNull()}), "mix-sources")
    per = placed(per, ["all"], ["none", "source"], "mix-order").withColumnRenamed("_at", "sid")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)).cast("int")).cast("long")
    per = materialise(per.select("sid", "source", "source_size", weight.alias("weight")), "mix-weights")
    cap = F.col("source_size") * most
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share
    level, held = 0.0, -1
    while True:
        # what is above at one level is above at the next ones too, as these are higher
        above = F.col("weight") * F.lit(level) > cap
        n, capped, free = per.agg(F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == held or not free:
            break
        held, level = n, (total - (capped or 0)) / free
    return per.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit words: two multiplications between shifts."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _key(sid: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return _scrambled(_scrambled(sid.astype(np.uint64) + np.uint64(seed)) + turn.astype(np.uint64))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False, rounds: int = 6) -> np.ndarray:
    """For each element, the place of ``index`` in a pseudorandom permutation of 0 … ``size`` - 1 that ``key`` names; or ``back`` from it.

    A Feistel network permutes all numbers of twice ``half`` bits; what falls outside is
    permuted again until it is inside, which makes a permutation of the inside.
    """
    x, size = index.astype(np.uint64), size.astype(np.uint64)
    half = np.ones(len(x), np.uint64)
    while (wide := (np.uint64(1) << (half * np.uint64(2))) < size).any():
        half[wide] += np.uint64(1)
    low = (np.uint64(1) << half) - np.uint64(1)
    steps = [np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (1 << 64) - 1) for r in range(rounds)]
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], low[todo], key[todo]
        a, b = x[todo] >> h, x[todo] & m
        for step in reversed(steps) if back else steps:
            a, b = (b ^ (_scrambled((a ^ k) + step) & m), a) if back else (b, a ^ (_scrambled((b ^ k) + step) & m))
        x[todo] = (a << h) | b
        todo = todo[x[todo] >= size[todo]]
    return x.astype(np.int64)


def planned(per: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """``targets`` with (n_blocks, n_slots, last_words): what a source's last slot takes so that it gives its target in whole words."""

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            size, goal, sid = (df[c].to_numpy(t) for c, t in (("source_size", np.int64), ("target", np.float64), ("sid", np.int64)))
            n, some = -(-size // block_words), np.maximum(size, 1)
            turns, rest = np.floor(goal).astype(np.int64) // some, np.floor(goal).astype(np.int64) % some
            # the last block may be shorter: where in the last round it comes up
            short = n * block_words - size
            place = permuted(np.maximum(n - 1, 0), np.maximum(n, 1), _key(sid, turns, seed), back=True)
            few = -(-rest // block_words)
            late = few > place
            more = np.where(late, -(-(rest + short) // block_words), few)
            before = (more - 1) * block_words - np.where(late & (place < more - 1), short, 0)
            yield df.assign(n_blocks=n, n_slots=turns * n + more, last_words=np.where(rest > 0, rest - before, block_words))

    return per.mapInPandas(plan, f"{', '.join(f'{n} {t}' for n, t in per.dtypes)}, n_blocks long, n_slots long, last_words long")


def drawn(spark: SparkSession, plan: DataFrame, slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, slot, sid, q): each output slot, its source and the number of that source's slot."""
    total, n = plan.agg(F.sum("n_slots"), F.count_if(F.col("n_slots") > 0)).first()
    total = total or 0
    # a source owns as many of the numbers below the total as it has slots; a cell of the guide names those that it touches
    width = max(1, -(-total // (CELLS * max(n, 1))))
    own = placed(plan.where("n_slots > 0").select("sid", "n_slots", F.lit(0).alias("all")), ["all"], ["sid"], "mix-shares", "n_slots")
    ends = own.select("sid", F.col("_at").alias("_low"), (F.col("_at") + F.col("n_slots")).alias("_high"))
    cells = F.sequence(F.floor(F.col("_low") / width), F.floor((F.col("_high") - 1) / width))
    guide = ends.select("sid", "_low", "_high", F.explode(cells).alias("_cell"))
    every = spark.range(total).select(F.floor(F.col("id") / slots).alias("shard"), (F.col("id") % slots).alias("slot"))
    every = every.withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), "shard", "slot"), F.lit(max(total, 1)))).withColumn("_cell", F.floor(F.col("_u") / width))
    draws = every.join(guide, "_cell").where("_u >= _low and _u < _high")
    among = F.row_number().over(Window.partitionBy("shard", "sid").orderBy("slot")) - 1
    draws = materialise(draws.select("shard", "slot", "sid", among.alias("_among")), "mix-draws")
    counts = draws.groupBy("sid", "shard").agg(F.count("*").alias("n"))
    starts = placed(materialise(counts, "mix-counts"), ["sid"], ["shard"], "mix-starts", "n")
    have = small(plan.select("sid", "n_slots").join(starts.groupBy("sid").agg(F.sum("n").alias("_drawn")), "sid", "left").withColumn("_drawn", F.coalesce("_drawn", F.lit(0))))
    # a source with too many draws keeps its share of those of each shard, so no shard is left without it
    kept = lambda c: F.expr(f"if(_drawn > n_slots, cast(cast({c} as decimal(20)) * n_slots div _drawn as long), {c})")
    starts = starts.join(have, "sid").select("sid", "shard", kept("_at").alias("_first"), (kept("(_at + n)") - kept("_at")).alias("_kept"))
    numbered = draws.join(starts, ["sid", "shard"]).select("shard", "slot", "sid", (F.col("_first") + F.col("_among")).alias("q"), (F.col("_among") < F.col("_kept")).alias("own"))
    over = materialise(numbered.where("not own").select("shard", "slot", F.lit(0).alias("all")), "mix-over")
    got = have.where("_drawn < n_slots").withColumnRenamed("_drawn", "n")
    lack = got.select("sid", F.explode(F.sequence(F.col("n"), F.col("n_slots") - 1)).alias("q"))
    lack = materialise(lack.select("sid", "q", F.lit(0).alias("all"), F.xxhash64(F.lit(seed), "sid", "q").alias("_by")), "mix-lacking")
    pairs = placed(over, ["all"], ["shard", "slot"], "mix-over").join(placed(lack, ["all"], ["_by", "sid", "q"], "mix-lacking"), "_at")
    return numbered.where("own").drop("own").unionByName(pairs.select("shard", "slot", "sid", "q"))


def filled(slots: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """``drawn`` with (block, n_take): the block of each slot, and how many of its words are taken."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            q, n, sid = (df[c].to_numpy(np.int64) for c in ("q", "n_blocks", "sid"))
            yield df.assign(block=permuted(q % n, n, _key(sid, q // n, seed)))

    known = slots.join(small(plan.select("sid", "n_blocks", "n_slots", "last_words")), "sid")
    take = F.when(F.col("q") == F.col("n_slots") - 1, F.col("last_words")).otherwise(block_words).alias("n_take")
    return known.select("shard", "slot", "sid", "q", "n_blocks", take).mapInPandas(blocks, "shard long, slot long, sid long, q long, n_blocks long, n_take long, block long").drop("n_blocks")


def packed(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pieces (sid, block, at, row, doc_id, n_words[, text]) of the blocks that documents (row, doc_id, sid, size, tie[, text]) are packed into.

    ``at`` is the piece's place in its block.  A document's words are split off once, whatever the number of its pieces.
    """
    texts = "text" in rows.columns
    lined = placed(rows.where("size > 0"), ["sid"], ["doc_id", "tie", "row"], "mix-packed", "size").withColumn("_end", F.col("_at") + F.col("size"))
    if texts:
        lined = lined.withColumn("_words", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))

    def piece(block: Column) -> Column:
        begin = F.greatest(F.col("_at"), block * block_words)
        n = F.least(F.col("_end"), (block + 1) * block_words) - begin
        own = [F.array_join(F.slice("_words", (begin - F.col("_at") + 1).cast("int"), n.cast("int")), " ").alias("text")] if texts else []
        return F.struct(block.alias("block"), (begin - block * block_words).alias("at"), n.alias("n_words"), *own)

    pieces = F.transform(F.sequence(F.floor(F.col("_at") / block_words), F.floor((F.col("_end") - 1) / block_words)), piece)
    each = lined.select("sid", "row", "doc_id", F.explode(pieces).alias("_p"))
    return each.select("sid", "_p.block", "_p.at", "row", "doc_id", "_p.n_words", *(["_p.text"] if texts else []))


def mixture(rows: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS, slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix, piece by piece: (shard, slot, at, source, row, doc_id, n_taken[, text]); in order of these it reads as the shards do.

    ``rows`` are documents as ``measured`` gives them, with or without texts.  A piece that is cut by the
    end of its source's last slot keeps ``n_taken`` words, of its text too.
    """
    known = small(plan.select("sid", "source"))
    named = rows.alias("r").join(known.alias("s"), F.expr("r.source <=> s.source")).select("r.*", "s.sid")
    pieces = packed(named.drop("source"), block_words)
    chosen = filled(drawn(rows.sparkSession, plan, slots, seed), plan, block_words, seed)
    met = chosen.join(pieces, ["sid", "block"]).withColumn("n_taken", F.least("n_words", F.col("n_take") - F.col("at"))).where("n_taken > 0")
    if "text" in rows.columns:
        cut = F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("n_taken").cast("int")), " ")
        met = met.withColumn("text", F.when(F.col("n_taken") < F.col("n_words"), cut).otherwise(F.col("text")))
    met = met.select("shard", "slot", "at", "sid", "row", "doc_id", "n_taken", *(["text"] if "text" in rows.columns else []))
    return met.join(known, "sid").drop("sid")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, slots: int = SHARD_SLOTS, seed: int = SEED, **share) -> DataFrame:
    """The mix of ``docs`` (doc_id, source, text) with its texts, as ``mixture`` gives it; ``share``: parameters of ``targets``."""
    rows = measured(docs, texts=True)
    plan = materialise(planned(targets(rows, **share), block_words, seed), "mix-plan")
    return mixture(rows, plan, block_words, slots, seed)


def mix_shares(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document: how many of its words the mix takes, and what its source gives."""
    rows = measured(docs)
    plan = materialise(planned(targets(rows)), "mix-plan")
    taken = mixture(rows, plan).groupBy("row").agg(F.sum("n_taken").alias("taken"))
    per = small(plan.select(F.col("source").alias("_s"), "source_size", "target"))
    known = rows.join(per, F.col("source").eqNullSafe(F.col("_s"))).join(taken, "row", "left")
    return known.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
