"""Grouping of spelling variants: each word's much more frequent near word, and where that leads.

Words are near if one inserted, deleted or replaced code point makes one of the other.

Method: a trie of frequency vectors.  Letters fall into ``GROUPS`` groups; a word's vector
says how many of its letters each group has, and a level of the trie branches by the count of
one group.  A near word's vector has at most one letter more and one letter less in all, so
the search goes down depth first and spends a surplus of one and a deficit of one; what
arrives at a leaf is verified letter by letter.  A whole set of words goes down together,
each with its own budget, and a branch is left when no word can afford it.

Scale: texts are read once; words are counted where they are read and only distinct ones are
shuffled.  The upper levels of the trie are the shuffle's key: a word is kept in the
cell of its own upper counts and searched in each cell that the budget reaches.  The number of
upper levels grows with the logarithm of the number of words, so a cell holds about
``CELL_WORDS``; a cell that is still larger is dealt to several tasks, each with a share of its
words and all of its searches.  Only words with a much more frequent near word take part in following
forms to the root, and each step multiplies the count by ``RATIO`` at least, so rounds of pointer doubling
are few.

Cases: null and empty texts have no words; a null doc_id is written as nothing; repeated rows count
again; long runs are words like others; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points of a word and its occurrences, at least; how many times as frequent a form is.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One of so many runs of a document loses a code point.
DAMAGED = 199
#: Letter groups: a letter's code point modulo this.  Words of a cell of the trie's upper levels, about.
GROUPS, CELL_WORDS = 16, 20_000
#: Letters that are compared at once; longer words one by one.
WIDE = 32


# -- words --------------------------------------------------------------------


def damaged(doc_id: Column, run: Column) -> Column:
    """``run`` of a document; one of ``DAMAGED``, by CRC-32 of id and run, without one of its code points."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(name.cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % DAMAGED == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all texts of ``docs`` (doc_id, text)."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))
    each = docs.select("doc_id", F.explode(runs).alias("run")).where(F.length("run") >= least_length)
    words = each.select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


# -- the trie -----------------------------------------------------------------


def vectors(words: list[str]) -> np.ndarray:
    """Letters of each group, a row for each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(rows * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS).reshape(len(words), GROUPS).astype(np.int16)


def trie_pairs(have: np.ndarray, ask: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``ask``, rows of ``have``) that meet in a leaf of the trie over the vectors ``have``.

    ``have`` is sorted, so a node of the trie is a range of its rows.
    """

    def down(low: int, high: int, at: int, who: np.ndarray, spare: np.ndarray, lack: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        while at < GROUPS and have[low, at] == have[high - 1, at]:  # one branch only
            d = ask[who, at] - have[low, at]
            spare, lack = spare - np.maximum(d, 0), lack + np.minimum(d, 0)
            fits = (spare >= 0) & (lack >= 0)
            who, spare, lack, at = who[fits], spare[fits], lack[fits], at + 1
        if not len(who):
            return
        if at == GROUPS:
            yield np.repeat(who, high - low), np.tile(np.arange(low, high), len(who))
            return
        column = have[low:high, at]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1, [high - low]))
        for i, j in zip(starts[:-1], starts[1:], strict=True):
            d = ask[who, at] - column[i]
            s, k = spare - np.maximum(d, 0), lack + np.minimum(d, 0)
            fits = (s >= 0) & (k >= 0)
            if fits.any():
                yield from down(low + int(i), low + int(j), at + 1, who[fits], s[fits], k[fits])

    one = np.ones(len(ask), np.int16)
    if len(have) and len(ask):
        yield from down(0, len(have), 0, np.arange(len(ask)), one, one)


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(short, long, strict=False)) if x != y), len(short))
    return short[at + (len(a) == len(b)) :] == long[at + 1 :]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words from the left and from the right, zeros behind them, and the words' lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    left, right = np.zeros((len(words), WIDE), np.uint32), np.zeros((len(words), WIDE), np.uint32)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    back = np.repeat(lengths, lengths) - 1 - place
    left[rows[place < WIDE], place[place < WIDE]] = letters[place < WIDE]
    right[rows[back < WIDE], back[back < WIDE]] = letters[back < WIDE]
    return left, right, lengths


def _verified(a: np.ndarray, b: np.ndarray, asked: tuple, had: tuple, ask_words: list[str], have_words: list[str]) -> np.ndarray:
    """Which pairs (rows a of the asked, rows b of the words had) are near."""

    def common(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        differs = x[a] != y[b]
        return np.minimum(np.where(differs.any(1), differs.argmax(1), WIDE), n)

    la, lb = asked[2][a], had[2][b]
    short, long = np.minimum(la, lb), np.maximum(la, lb)
    same = common(asked[0], had[0], short) + common(asked[1], had[1], short)
    found = np.where(la == lb, (same >= la - 1) & (same < 2 * la), (long - short == 1) & (same >= short))
    for i in np.flatnonzero(long > WIDE):
        found[i] = near(ask_words[a[i]], have_words[b[i]])
    return found


def _search(df: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of one cell: each word that is asked for, with the words there that are near."""
    asked, had = df[df["asks"]], df[~df["asks"]]
    ask_words = asked["word"].tolist()
    order = had.assign(**{f"_{i}": c for i, c in enumerate(vectors(had["word"].tolist()).T)}).sort_values([f"_{i}" for i in range(GROUPS)])
    have_words, have_n = order["word"].tolist(), order["n"].to_numpy()
    ask_n = asked["n"].to_numpy()
    left, right = _letters(ask_words), _letters(have_words)
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def settle(pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        for i in range(0, len(a), 1 << 16):
            x, y = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
            found = _verified(x, y, left, right, ask_words, have_words)
            out.append((x[found], y[found]))

    waiting, n = [], 0
    for pair in trie_pairs(vectors(have_words), vectors(ask_words)):
        waiting.append(pair)
        n += len(pair[0])
        if n > 1 << 16:
            settle(waiting)
            waiting, n = [], 0
    if waiting:
        settle(waiting)
    a, b = (np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else ((), ())))
    return pd.DataFrame({"word": pd.Series([ask_words[i] for i in a], dtype=object), "n": ask_n[a], "other": pd.Series([have_words[i] for i in b], dtype=object), "n_other": have_n[b]})


def _routed(batches: Iterator[pd.DataFrame], levels: int) -> Iterator[pd.DataFrame]:
    """Each word once as kept in the cell of its upper counts, and as asked for in each cell within the budget."""
    steps = np.concatenate([np.zeros((1, levels), np.int64), np.eye(levels, dtype=np.int64), -np.eye(levels, dtype=np.int64)])
    pairs = [np.eye(levels, dtype=np.int64)[i] - np.eye(levels, dtype=np.int64)[j] for i in range(levels) for j in range(levels) if i != j]
    steps = np.concatenate([steps, np.array(pairs, np.int64).reshape(-1, levels)])
    digits = np.left_shift(1, 4 * np.arange(levels), dtype=np.int64)
    for df in batches:
        upper = vectors(df["word"].tolist())[:, :levels].astype(np.int64)
        for i, step in enumerate(steps):
            to = upper + step
            cell = np.minimum(to, 15) @ digits  # counts of 15 and more are one branch
            some = (to >= 0).all(1)
            if i:
                # a branch that stands for several counts is asked once
                some &= ~((step != 0) & (np.minimum(to, 15) == np.minimum(upper, 15))).any(1)
            else:
                yield df.assign(cell=cell, asks=False)
            yield df[some].assign(cell=cell[some], asks=True)


def near_pairs(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, other, n_other) for all near words of ``words`` (word, n; words once each), both ways."""
    size = words.count()
    levels = min(GROUPS - 1, max(1, math.ceil(math.log2(max(size, 1) / cell_words)))) if size > cell_words else 1
    routed = materialise(words.mapInPandas(lambda it: _routed(it, levels), "word string, n long, cell long, asks boolean"), "spelling-routed")
    # a cell that is too large goes to several tasks, and so do all searches in it; cells without a word are not searched
    cells = routed.where("not asks").groupBy("cell").agg(F.ceil(F.count("*") / (2 * cell_words)).cast("int").alias("parts"))
    dealt = routed.join(cells, "cell").withColumn("part", F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))))
    each = dealt.select("word", "n", "asks", "cell", F.explode("part").alias("part"))
    return each.groupBy("cell", "part").applyInPandas(_search, "word string, n long, other string, n_other long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following forms ends.  Each round doubles how far a word sees."""
    now = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        seen = now.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        now = materialise(seen, "spelling-roots")
    return now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n; words once each)."""
    words = materialise(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("n_other")).alias("n"), F.col("other").alias("word"))).alias("best")
    near_of = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near_of, "word", "left")
    is_form = -F.col("best.n") >= ratio * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    known = materialise(known, "spelling-forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among all words of ``docs`` (doc_id, text)."""
    return variants(vocabulary(docs))
