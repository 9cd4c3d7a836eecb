"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is over words, three at a time, one per language, trained on documents
whose labels say that they are good.  Words are runs of anything but ASCII white
space; a document is framed by two signs of its beginning and one of its end.  Below
single words stands their spelling, each byte given the one before it in words of the
language's training texts, so unknown words have a probability too.  Steps:

1. One pass over the training texts counts pairs of bytes (a table of fixed size), another
   spells the words, and one counts trigrams: tasks reduce a block of texts to
   its distinct trigrams, and Spark adds them up, with the counts of their contexts.
   The table grows with the corpus.
2. Probabilities by joins of sharded tables, order by order.  Lower orders count
   distinct left neighbours; the discounts D1, D2, D3+ of each order and language come
   from its counts of counts; each order's discounted share is interpolated with the
   order below.  No table is held in one place; each is deleted once it is used.
3. Interpolation backs off along the words, so a document's log-probability is a sum:
   each trigram, bigram and word that training has seen adds a correction to what is
   below it, and what it has not seen adds nothing.  ``corrections`` is one table of
   (key, value) of all three orders; texts give (row, key, n), and one join and one sum
   by row score them.  Values are whole numbers of 2^-20, so no sum depends on its order.
4. Keys with a large share of the counts of their order, of which there are at most
   ``1 / HEAVY`` an order, are broadcast and added up where the text is read.  So the hot
   words of a language never enter the shuffle; every other key does, at any size.
5. Keys that training has not seen add nothing, and most keys of a text are such.  A
   filter of a fixed number of bits, broadcast, tells them where the text is read: a bit
   for each key's hash, set by all keys of ``corrections``.  What it lets through by
   chance adds nothing in the join.  Beyond half as many keys as bits it is left out, and
   all keys are shuffled.
6. Every tenth training document is held out of the counts.  For each language a
   high quantile of the perplexity of those documents is the threshold; a document
   over it is rejected.  Short documents are drawn towards the language's mean.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, pick, shuffles_cleared, small, text_blocks

STRATA = ("en", "de", "fr", "es", "other")
QUANTILE = 0.995
#: Words at the language's mean that are added to each document.
DRAW = 20
HELD_OUT = 10
#: Share of an order's counts from which a key is broadcast.
HEAVY = 1 / 4_000_000
#: Log-probabilities are whole numbers of one part in this.
UNIT = 1 << 20
BLOCK_BYTES = 1_000_000
#: Most words with what they leave as contexts that are broadcast.
CONTEXT_ROWS = 500_000
#: Bits of the filter of seen keys, a power of two; 32 MB.
FILTER_BITS = 1 << 28
#: Bytes of the filter that are put together in one group, of at most ``FILTER_TASKS`` parts.
FILTER_CHUNK = 1 << 16
FILTER_TASKS = 256
#: No discount is less, so every context leaves something to the order below.
LEAST_LOSS = 0.1

#: Where a word's code holds its language; below it stands a hash.
LANGUAGE_AT = 60
SPACE = 32
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTE_HASH = np.random.default_rng(42).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
# fixed values: primes of XXH64
P1, P2, P3, P4, P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hashed(x: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """XXH64 of whole numbers of eight bytes, as ``xxhash64`` of a long column gives it."""
    h = (seed + P5 + np.uint64(8)) ^ (_turned(x * P2, 31) * P1)
    h = _turned(h, 27) * P1 + P4
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def keys_of(*words: np.ndarray) -> np.ndarray:
    """Keys of grams; the same as ``xxhash64`` of the columns of their words."""
    h = np.uint64(42)
    for w in words:
        h = _hashed(w, h)
    return h


def sequences(texts: list[bytes], strata: np.ndarray, spelling: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(codes of all words and signs, text of each, place of each text's first sign, ln p of each one's spelling).

    ``spelling`` holds ln p in parts of ``UNIT`` by language, byte before and byte, a
    space standing for the ends of a word; the sign of an end is the empty word.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    edge = np.diff(np.concatenate([[True], SPACES[raw], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    after = np.cumsum([len(t) + 1 for t in texts])  # where each text and its separator end
    owner, length = np.searchsorted(after, start, "right"), end - start
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts + 3) - counts - 3
    text_of = np.repeat(np.arange(len(texts)), counts + 3)
    language = strata.astype(np.uint64) << np.uint64(LANGUAGE_AT)
    codes = language[text_of]  # the sign of a beginning is hash 0, that of the end 1
    codes[first + counts + 2] += np.uint64(1)
    spelled = np.zeros(len(codes), np.int64)
    if spelling is not None:
        spelled[first + counts + 2] = spelling[strata, SPACE, SPACE]
    if len(start):
        begin, place = np.cumsum(length) - length, np.arange(len(start)) + 3 * owner + 2
        inside = np.repeat(start - begin, length) + np.arange(int(length.sum()))
        at = inside - np.repeat(start, length)
        power = np.full(int(length.max()), P1)
        power[0] = 1
        power = np.cumprod(power)
        sums = np.add.reduceat(BYTE_HASH[raw[inside]] * power[at], begin)
        codes[place] = (_hashed(sums, np.uint64(42)) & np.uint64((1 << LANGUAGE_AT) - 1)) | language[owner]
        if spelling is not None:
            before = np.where(at > 0, raw[np.maximum(inside - 1, 0)], SPACE)
            spelled[place] = np.add.reduceat(spelling[np.repeat(strata[owner], length), before, raw[inside]], begin)
            spelled[place] += spelling[strata[owner], raw[end - 1], SPACE]
    return codes, text_of, first, spelled


def _byte_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n): language, byte and the byte after it, any white space counting as one space, of a text framed by spaces."""
    for batch in batches:
        strata = batch.column(1).to_numpy()
        for i, j, texts in text_blocks(batch.column(0), BLOCK_BYTES):
            framed = [b" " + b" ".join(t.split()) + b" " if t.split() else b" " for t in texts]
            raw = np.frombuffer(b"".join(x + b" " for x in framed), np.uint8).astype(np.int64)
            ends = np.cumsum([len(x) + 1 for x in framed])
            cells = (np.repeat(strata[i:j].astype(np.int64), [len(x) + 1 for x in framed])[:-1] << 16) | raw[:-1] << 8 | raw[1:]
            cells = np.delete(cells, ends[:-1] - 1)  # from one text to the next
            cell, n = np.unique(cells, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])


def _spelling(training: DataFrame, n_strata: int) -> np.ndarray:
    """ln p of each byte after each byte in parts of ``UNIT``, one added to every count; 65,536 numbers per language."""
    got = training.mapInArrow(_byte_pairs, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.ones((n_strata + 1) << 16)
    counts[got.column("cell").to_numpy()] += got.column("n").to_numpy()
    counts = counts.reshape(n_strata + 1, 256, 256)
    return np.rint(np.log(counts / counts.sum(2, keepdims=True)) * UNIT).astype(np.int64)


def _words(batches: Iterator[pa.RecordBatch], spelling) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        strata = batch.column(1).to_numpy()
        for i, j, texts in text_blocks(batch.column(0), BLOCK_BYTES):
            codes, _, _, spelled = sequences(texts, strata[i:j], spelling.value)
            codes, at = np.unique(codes.view(np.int64), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(spelled[at])], ["c", "spelled"])


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        strata = batch.column(1).to_numpy()
        for i, j, texts in text_blocks(batch.column(0), BLOCK_BYTES):
            codes, _, first, _ = sequences(texts, strata[i:j])
            third = np.ones(len(codes), bool)
            third[first] = third[first + 1] = False
            t = np.flatnonzero(third)
            _, at, n = np.unique(keys_of(codes[t - 2], codes[t - 1], codes[t]), return_index=True, return_counts=True)
            t = t[at]
            yield pa.RecordBatch.from_arrays([*(pa.array(codes[t - k].view(np.int64)) for k in (2, 1, 0)), pa.array(n)], ["a", "b", "c", "n"])


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(byte, bit as a byte) of each key in a filter."""
    at = keys.view(np.uint64) & np.uint64(bits - 1)
    return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)


def _set_bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(chunk, compressed bytes) of a task's own filter, without chunks that are all zero."""
    own = np.zeros(bits // 8, np.uint8)
    for batch in batches:
        byte, bit = _places(batch.column(0).to_numpy(), bits)
        np.bitwise_or.at(own, byte, bit)
    chunks = own.reshape(-1, min(FILTER_CHUNK, len(own)))
    some = np.flatnonzero(chunks.any(1))
    for i in range(0, len(some), 64):
        part = some[i : i + 64]
        packed = [zlib.compress(chunks[c].tobytes(), 1) for c in part]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(packed, pa.binary())], ["chunk", "bits"])


def _united(group: pa.Table) -> pa.Table:
    parts = (np.frombuffer(zlib.decompress(b.as_py()), np.uint8) for b in group.column("bits"))
    whole = functools.reduce(np.bitwise_or, parts)
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})


def seen_filter(values: DataFrame, bits: int = FILTER_BITS) -> np.ndarray | None:
    """``bits`` / 8 bytes in which the bit of every ``key`` is set; None if there are too many keys for it to tell anything."""
    if values.count() > bits // 2:
        return None
    parts = values.select("key").coalesce(FILTER_TASKS).mapInArrow(functools.partial(_set_bits, bits=bits), "chunk int, bits binary")
    got = parts.groupBy("chunk").applyInArrow(_united, "chunk int, bits binary").toArrow()
    out = np.zeros(bits // 8, np.uint8)
    chunks = out.reshape(-1, min(FILTER_CHUNK, len(out)))
    for c, b in zip(got.column("chunk").to_pylist(), got.column("bits"), strict=True):
        chunks[c] = np.frombuffer(b.as_py(), np.uint8)
    return out


def _scored(batches: Iterator[pa.RecordBatch], heavy, spelling) -> Iterator[pa.RecordBatch]:
    """For each text one row about it, under a key of its own, and one for each key that is not heavy and may have been seen."""
    known, value, seen = heavy.value
    for batch in batches:
        strata, rows = batch.column(2).to_numpy(), batch.column(4).to_numpy()
        for i, j, texts in text_blocks(batch.column(1), BLOCK_BYTES):
            codes, owner, first, spelled = sequences(texts, strata[i:j], spelling.value)
            second = np.ones(len(codes), bool)
            second[first] = False
            third = second.copy()
            third[first + 1] = False
            s, t = np.flatnonzero(second), np.flatnonzero(third)
            keys = np.concatenate([keys_of(codes[s]), keys_of(codes[s - 1], codes[s]), keys_of(codes[t - 2], codes[t - 1], codes[t])]).view(np.int64)
            text = np.concatenate([owner[s], owner[s], owner[t]])
            # below 2^53, so exact
            base = np.bincount(owner[t], spelled[t], j - i).astype(np.int64)
            if seen is not None:
                byte, bit = _places(keys, 8 * len(seen))
                kept = (seen[byte] & bit) != 0
                keys, text = keys[kept], text[kept]
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = known[at] == keys
                base += np.bincount(text[found], value[at[found]], j - i).astype(np.int64)
                keys, text = keys[~found], text[~found]
            order = np.lexsort((keys, text))
            keys, text = keys[order], text[order]
            new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])])) if len(keys) else np.zeros(0, int)
            n = np.diff(np.append(new, len(keys)))
            about = pa.StructArray.from_arrays(
                [
                    batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(strata[i:j], pa.int32()), batch.column(3).slice(i, j - i).cast(pa.int32()),
                    pa.array([len(x) for x in texts], pa.int64()), pa.array(np.bincount(owner[t], minlength=j - i)), pa.array(base),
                ],
                ["doc_id", "stratum", "fold", "n_bytes", "n_words", "base"],
            )
            own = rows[i:j]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(keys_of(own.astype(np.uint64)).view(np.int64)), pa.array(np.zeros(j - i, np.int64)), about], ["row", "key", "n", "about"])
            if len(new):
                none = pa.nulls(len(new), about.type)
                yield pa.RecordBatch.from_arrays([pa.array(own[text[new]]), pa.array(keys[new]), pa.array(n), none], ["row", "key", "n", "about"])


def _lang(code: Column) -> Column:
    return F.shiftrightunsigned(code, LANGUAGE_AT)


def losses(seen: DataFrame) -> DataFrame:
    """Of counts (…, c the last word, n > 0) of one order: (lang, d1, d2, d3).

    Discounts by Chen and Goodman: with Y = n1 / (n1 + 2 n2), a count of k loses
    k - (k + 1) Y n(k+1) / n(k); where a count of counts is missing, k / 2.
    """
    cc = seen.groupBy(_lang(F.col("c")).alias("lang")).agg(*(F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    d = [k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    return cc.select("lang", *(F.least(F.lit(float(k)), F.greatest(F.lit(LEAST_LOSS), F.coalesce(x, F.lit(k / 2)))).alias(f"d{k}") for k, x in enumerate(d, 1)))


def _cut(seen: DataFrame, *also: str) -> DataFrame:
    """``seen`` with ``loss``, what its discount takes from each count, and the discounts named; one row per language is broadcast."""
    loss = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    return seen.join(F.broadcast(materialise(losses(seen), "losses")), _lang(F.col("c")) == F.col("lang")).withColumn("loss", loss).drop(*{"d1", "d2", "d3"}.difference(also))


def _contexts(cut: DataFrame, *words: str) -> DataFrame:
    """(words, total, gamma): counts of a context and the share that it leaves to the order below."""
    total = F.sum("n").cast("double")
    return cut.groupBy(*words).agg(total.alias("total"), (F.sum("loss") / total).alias("gamma"))


def trigram_counts(training: DataFrame) -> DataFrame:
    """(a, b, c, n) of the trigrams of (text, stratum) with what their context is: counts in all (total), of one, two and more (m1, m2, m3).

    One shuffle by context, which has a row for each distinct word after it in a task at
    most, does both.  ``first`` marks one row of each context.
    """
    counted = training.mapInArrow(_trigrams, "a long, b long, c long, n long").repartition("a", "b").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))
    of, n = Window.partitionBy("a", "b"), F.col("n")
    counts = [F.count_if(x).over(of).alias(f"m{k}") for k, x in enumerate((n == 1, n == 2, n > 2), 1)]
    return counted.select("a", "b", "c", "n", F.sum("n").over(of).alias("total"), *counts, (F.col("c") == F.min("c").over(of)).alias("first"))


def corrections(trigrams: DataFrame, spellings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((order, key, n, value) of every gram and context of training, (lang, unknown) per language).

    ``trigrams``, a table of ``materialise`` that is gone afterwards, holds ``trigram_counts``.
    ``value`` and ``unknown`` are in parts of ``UNIT``.  With p1, p2, p3 the interpolated
    probabilities and g the share that a context leaves, a word adds ln p1 - ln g - spelling,
    a bigram ln p2 - ln g - ln p1, a trigram ln p3 - ln g - ln p2; words and bigrams also add
    the ln g of what follows them.  ``unknown`` is the ln g below single words.

    Each order is written by itself, so the files of one shuffle are gone before the next.
    """

    def units(value: Column) -> Column:
        return F.round(value * UNIT).cast("long")

    none = F.lit(0.0)
    kept = (F.col("n") - F.col("loss")) / F.col("total")
    given = F.col("total").cast("double")
    gamma = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / given
    cut3 = _cut(trigrams, "d1", "d2", "d3").withColumn("gamma", gamma)
    bigrams = materialise(trigrams.groupBy("b", "c").agg(F.count("*").alias("n")), "bigrams")
    cut2 = _cut(bigrams, "d1")
    cut1 = materialise(_cut(bigrams.groupBy("c").agg(F.count("*").alias("n"))), "words")
    after2 = materialise(_contexts(cut2, "b"), "contexts2")
    all1 = materialise(_contexts(cut1, "lang"), "languages")
    spelled = F.col("spelled") / UNIT
    p1 = cut1.join(F.broadcast(all1), "lang").join(spellings, "c").select(
        "c", "n", ((F.col("n") - F.col("loss")) / F.col("total") + F.col("gamma") * F.exp(spelled)).alias("p1"), (F.ln("gamma") + spelled).alias("low")
    )
    p1 = materialise(p1, "order1")
    # a word that one bigram begins, once, leaves d1 of 1: most words are such and need no row
    several = small(after2.where("total > 1"), CONTEXT_ROWS)
    p2 = cut2.join(several, "b", "left").withColumn("gamma", F.coalesce("gamma", "d1")).withColumn("total", F.coalesce("total", F.lit(1.0)))
    p2 = p2.join(p1.select("c", "p1"), "c").withColumn("p2", kept + F.col("gamma") * F.col("p1"))
    p2 = p2.select(F.xxhash64("b", "c").alias("key"), "n", "p2", units(F.ln("p2") - F.ln("gamma") - F.ln("p1")).alias("value"))
    p2 = materialise(p2, "order2")
    discard(bigrams)

    def entries(order: int, key: Column, value: Column) -> list[Column]:
        return [F.lit(order).alias("order"), key.alias("key"), F.coalesce("n", F.lit(0)).alias("n"), value.alias("value")]

    v1 = p1.join(after2.select(F.col("b").alias("c"), F.col("gamma").alias("g")), "c", "full")
    v1 = v1.select(*entries(1, F.xxhash64("c"), units(F.coalesce(F.ln("p1") - F.col("low"), none) + F.coalesce(F.ln("g"), none))))
    after3 = cut3.where("first").select(F.xxhash64("a", "b").alias("key"), units(F.ln("gamma")).alias("g"))
    v2 = p2.select("key", "n", "value").join(after3, "key", "full")
    v2 = v2.select(*entries(2, F.col("key"), F.coalesce("value", F.lit(0)) + F.coalesce("g", F.lit(0))))
    v3 = cut3.select(F.xxhash64("a", "b", "c").alias("key3"), F.xxhash64("b", "c").alias("key"), "n", kept.alias("kept"), "gamma").join(p2.select("key", "p2"), "key")
    v3 = v3.select(*entries(3, F.col("key3"), units(F.ln(F.col("kept") + F.col("gamma") * F.col("p2")) - F.ln("gamma") - F.ln("p2"))))
    written = [materialise(v, f"corrections{k}") for k, v in enumerate((v1, v2, v3), 1)]
    for used in (trigrams, p2, p1, after2, cut1):
        discard(used)
    return functools.reduce(DataFrame.unionAll, written), all1.select("lang", units(F.ln("gamma")).alias("unknown"))


def perplexities(
    docs: DataFrame,
    labels: DataFrame,
    strata: Sequence[str] = STRATA,
    heavy: float = HEAVY,
    filter_bits: int = FILTER_BITS,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, stratum, fold, n_bytes, n_words, log_p) of every row; fold is 0 for held-out good documents, -1 for unlabelled ones.

    ``n_words`` counts the end as a word.  At most 15 languages; ``heavy`` decides what is
    broadcast (at most 3 / heavy keys), ``filter_bits`` (a power of two, 8 at least) how many keys that training has not
    seen are shuffled; neither changes a result.
    """
    if len(strata) > 15:
        raise ValueError("at most 15 languages")
    sc = docs.sparkSession.sparkContext
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
    good = materialise(good.where("q = 1").select(F.col("doc_id").alias("good_id")), "good")
    lang = F.array_position(F.array(*map(F.lit, strata)), F.coalesce(F.col("lang"), F.lit(""))).cast("int")
    stratum = F.when(lang > 0, lang).otherwise(F.lit(len(strata)))
    source = pick(docs.withColumnRenamed(lang_col, "lang") if lang_col != "lang" else docs, id_col, text_col, "lang")
    source = source.join(small(good), F.col("doc_id") == F.col("good_id"), "left")
    fold = F.when(F.col("good_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)).cast("int"))
    source = source.select("doc_id", "text", stratum.alias("stratum"), fold.alias("fold"))
    training = source.where("fold > 0").select("text", "stratum")
    spelling = sc.broadcast(_spelling(training, len(strata)))
    spellings = training.mapInArrow(functools.partial(_words, spelling=spelling), "c long, spelled long").groupBy("c").agg(F.max("spelled").alias("spelled"))
    values, unknown = corrections(materialise(trigram_counts(training), "trigrams"), spellings)
    # the counts of an order add up to its total, so no more than 1 / heavy keys have such a share
    totals = values.groupBy("order").agg(F.sum("n").alias("all"))
    values = values.join(F.broadcast(totals), "order").select("key", "value", (F.col("n") > F.col("all") * heavy).alias("heavy"))
    top = values.where("heavy").select("key", "value").orderBy("key").toArrow()
    table = sc.broadcast((top.column("key").to_numpy(), top.column("value").to_numpy(), seen_filter(values, filter_bits)))
    rows = source.withColumn("row", F.monotonically_increasing_id())
    about = "doc_id long, stratum int, fold int, n_bytes long, n_words long, base long"
    each = rows.mapInArrow(functools.partial(_scored, heavy=table, spelling=spelling), f"row long, key long, n long, about struct<{about.replace(' ', ':').replace(',:', ',')}>")
    names = [c.split()[0] for c in about.split(", ")]
    each = each.join(values.where("not heavy").select("key", "value"), "key", "left").select("row", (F.col("n") * F.coalesce("value", F.lit(0))).alias("part"), "about.*")
    # one row of a document carries what is known of it
    summed = each.groupBy("row").agg(F.sum("part").alias("part"), *(F.max(c).alias(c) for c in names))
    summed = summed.join(F.broadcast(unknown), summed.stratum == unknown.lang, "left")
    log_p = F.col("part") + F.col("base") + F.col("n_words") * F.coalesce("unknown", F.lit(0))
    return summed.select("doc_id", "stratum", "fold", "n_bytes", "n_words", (log_p / UNIT).alias("log_p"))


def quality_classifier(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, strata: Sequence[str] = STRATA, **options) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, threshold, kept) of every row of ``docs``; the perplexity is one of a word.

    ``lang`` is the language whose model was used; unknown and null ones are
    "other".  Where a language has no held-out good documents there is no threshold
    and its documents are kept.  A text without words is judged by its end alone, drawn
    to the language's mean; null counts as empty.  Repeated rows give a row each; null
    ids are carried, but never labelled; further columns are ignored.
    """
    with shuffles_cleared(docs.sparkSession):
        each = materialise(perplexities(docs, labels, strata, **options), "perplexities")
    held = each.where((F.col("fold") == 0) & (F.col("n_bytes") > 0))
    means = held.groupBy("stratum").agg((F.sum("log_p") / F.sum("n_words")).alias("mean"))
    # one row per language, which are a parameter
    drawn = each.join(F.broadcast(means), "stratum", "left").withColumn(
        "perplexity", F.exp(-F.try_divide(F.col("log_p") + DRAW * F.coalesce("mean", F.lit(0.0)), F.col("n_words") + DRAW))
    )
    cut = drawn.where((F.col("fold") == 0) & (F.col("n_bytes") > 0)).groupBy("stratum")
    cut = cut.agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    return drawn.join(F.broadcast(cut), "stratum", "left").select(
        "doc_id", F.get(F.array(*map(F.lit, strata)), F.col("stratum") - 1).alias("lang"), "n_bytes", "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
    )
