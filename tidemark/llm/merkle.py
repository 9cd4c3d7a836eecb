"""Merkle manifest of a dataset, with a proof for every row.

Each row is a leaf: the SHA-256 of its columns, each written as ``-`` if null, else as
its number of UTF-8 bytes, ``:`` and its value.  Leaves of a group (a language) stand in
order of id, then of digest; every ``WIDTH`` nodes in a row become their parent, the digest of
their hexadecimal digests one after the other, until one node is left, the group's subroot.
Subroots in order of group, null first, become the root in the same way.

Method: an aligned block of ``WIDTH ** DEPTH`` nodes keeps each of its levels as one
string of hexadecimal digests.  Parents are hashed from fixed-width substrings, and the
siblings of a node are the substrings on its two sides, so a proof is a list of such
pairs from the leaf to the root.  A block becomes one node of a tree above it, which is
blocked in the same way, up to the root; then proofs come down, each block's joined to
what stands in it.

Scale: a leaf is a digest, an id and a group; texts are read once and never shuffled.
Places in a group come from sorted ranges (``ordering.placed``), so a language with most
of the rows is no single task, and no block is larger than its fixed size.  The number of rounds grows with the
logarithm of the rows, to the base of 512.

Cases: nulls in any column are values of their own; null ids come first; repeated rows are
leaves side by side; an empty table gives no rows; a table of one row has its leaf as
subroot and root and a proof without siblings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.ordering import placed

#: Children of a node, and levels that a block keeps.
WIDTH, DEPTH = 8, 3
BLOCK = WIDTH**DEPTH
#: Digits of a digest.
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to by the siblings of a proof."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def _parents(level: Column) -> Column:
    """The level above one that is a string of digests."""
    wide = WIDTH * HEX
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / wide).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * wide + 1, F.lit(wide)), 256)), "")


def _blocks(nodes: DataFrame, more: list[str]) -> DataFrame:
    """Blocks (key, block, members, levels, top, open) of nodes (key, at, digest, …).

    ``levels`` are those whose nodes have parents within the block, ``top`` is the block's
    last node.  A group that is larger than a block is ``open``: each of its
    blocks goes all levels up, and to the tree above; else it ends where one node is left.
    """
    block, place = F.floor(F.col("at") / BLOCK).alias("block"), (F.col("at") % BLOCK).cast("int").alias("place")
    member = F.struct("place", "digest", *more)
    found = nodes.select("key", block, place, "digest", *more).groupBy("key", "block").agg(F.array_sort(F.collect_list(member)).alias("members"))
    open_ = found.where("block > 0").select("key").distinct().withColumn("open", F.lit(True))
    found = found.join(open_, "key", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    level = found.withColumn("_0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    for k in range(DEPTH):
        below = F.col(f"_{k}")
        level = level.withColumn(f"_{k + 1}", F.when(F.col("open") | (F.length(below) > HEX), _parents(below)))
    kept = F.array(*(F.when(F.col(f"_{k + 1}").isNotNull(), F.col(f"_{k}")) for k in range(DEPTH)))
    top = F.coalesce(*(F.col(f"_{k}") for k in range(DEPTH, -1, -1)))
    return level.select("key", "block", "members", F.filter(kept, lambda s: s.isNotNull()).alias("levels"), top.alias("top"), "open")


def _tree(nodes: DataFrame, more: list[str], label: str) -> list[DataFrame]:
    """Tables of blocks from the leaves up, until no group is open."""
    found = [materialise(_blocks(nodes, more), f"merkle-{label}")]
    while not (above := found[-1].where("open")).isEmpty():
        nodes = above.select("key", F.col("block").alias("at"), F.col("top").alias("digest"))
        found.append(materialise(_blocks(nodes, []), f"merkle-{label}"))
    return found


def _flanks(place: Column, levels: Column) -> Column:
    """The siblings on both sides of a block's node, level by level."""

    def at(level: Column, k: Column) -> Column:
        node = F.call_function("shiftright", place, k * (WIDTH.bit_length() - 1))
        first = node - node % WIDTH
        left = F.substring(level, first * HEX + 1, (node - first) * HEX)
        right = F.substring(level, (node + 1) * HEX + 1, (first + WIDTH - 1 - node) * HEX)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(levels, at)


def _members(blocks: DataFrame, above: DataFrame, more: list[str]) -> DataFrame:
    """(key, at, digest, …, proof) of what stands in blocks, given the proofs (key, block, upper, …) of these."""
    cols = [c for c in above.columns if c not in ("key", "block", "upper")]
    joined = blocks.join(above, ["key", "block"])
    rows = F.transform("members", lambda m: F.struct(m.alias("m"), F.concat(_flanks(m["place"], F.col("levels")), F.col("upper")).alias("proof")))
    each = joined.select("key", "block", *cols, F.explode(rows).alias("_r"))
    at = (F.col("block") * BLOCK + F.col("_r.m.place")).alias("at")
    return each.select("key", at, F.col("_r.m.digest").alias("digest"), *cols, *(F.col(f"_r.m.{c}").alias(c) for c in more), F.col("_r.proof").alias("proof"))


def _proofs(tree: list[DataFrame], tops: DataFrame, more: list[str]) -> DataFrame:
    """Members of a tree's lowest blocks with their proofs; ``tops`` (key, upper, …) has what is above each group."""
    cols = [c for c in tops.columns if c not in ("key", "upper")]
    below: DataFrame | None = None
    for k in range(len(tree) - 1, -1, -1):
        above = tree[k].where("not open").select("key", "block").join(tops, "key")
        if below is not None:
            above = above.unionByName(below.select("key", F.col("at").alias("block"), *cols, F.col("proof").alias("upper")))
        below = _members(tree[k], above, more if k == 0 else [])
    return below


def manifest(leaves: DataFrame, more: tuple[str, ...] = (), id_col: str = "doc_id", group: str = "lang", leaf: str = "leaf") -> DataFrame:
    """(id, leaf, subroot, root, proof, …) of every row of ``leaves`` (id, group, leaf, …).

    ``proof`` is an array of (left, right), the siblings from the leaf to the root.
    """
    key = F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit(""))  # sorts as the group does, null first
    narrow = leaves.select(key.alias("key"), F.col(id_col).alias("id"), F.col(leaf).alias("digest"), *more)
    ranked = placed(materialise(narrow, "merkle-leaves"), ["key"], ["id", "digest"], "merkle-ranked").withColumnRenamed("_at", "at")
    tree = _tree(ranked, ["id", *more], "blocks")
    tops = tree[0].where("not open").select("key", "top")
    for blocks in tree[1:]:
        tops = tops.unionByName(blocks.where("not open").select("key", "top"))
    tops = materialise(tops, "merkle-subroots")
    roots = placed(tops.withColumn("all", F.lit(0)), ["all"], ["key"], "merkle-roots")
    crown = _tree(roots.select(F.lit("").alias("key"), F.col("_at").alias("at"), F.col("top").alias("digest"), F.col("key").alias("of")), ["of"], "crown")
    root = crown[-1].where("not open").select("key", F.col("top").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("upper"))
    uppers = _proofs(crown, root, ["of"]).select(F.col("of").alias("key"), F.col("digest").alias("subroot"), "root", F.col("proof").alias("upper"))
    found = _proofs(tree, materialise(uppers, "merkle-uppers"), ["id", *more])
    return found.select(F.col("id").alias(id_col), F.col("digest").alias(leaf), "subroot", "root", "proof", *more)


def tampering_check(docs: DataFrame) -> DataFrame:
    """The manifest of documents, and whether each one's leaf still leads to the root after some texts were lower-cased.

    Of the rows whose decimal doc_id has a CRC-32 that 3 divides, the capitals A to Z
    are lower-cased after the manifest was made.  Columns of ``docs`` other than its five are left behind.
    """
    plain = [F.col(c) for c in COLUMNS]
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in COLUMNS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        F.col("doc_id"), F.col("lang"), leaf_digest(*plain).alias("leaf"), F.when(chosen, leaf_digest(*lowered)).alias("given"),
    )
    proofs = manifest(leaves, more=("given",))
    folded = proofs.withColumn("folded_root", fold(F.coalesce("given", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
