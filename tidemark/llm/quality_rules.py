"""Quality rules whose cutoffs carry a guarantee on false rejection.

Each rule rejects a document when one measure lies over a cutoff.  The cutoffs of a
stratum come from its labelled good documents, distinct texts only (copies are no
independent trials), in two halves by a digest of the text:

1. Aims.  On one half each rule takes the strictest of its candidates that loses no
   more than its part of half the ``risk``.  Nothing is guaranteed by that.
2. Test.  On the other half all rules are tried together, from the most lenient on:
   first every rule so many candidates short of its aim, then one fewer, and so on.
   Each setting must reject the hypothesis "these rules together reject more than
   ``risk`` of the good documents" by the exact binomial tail P(Bin(n, risk) <= k),
   where k of n good documents lie over a cutoff.  Trying stops at the first failure,
   and a fixed sequence needs no correction within itself; across strata the level is
   divided by their number (Bonferroni).

So with probability ``1 - error`` no stratum loses more than ``risk`` of its good
documents to all of its rules taken together.  Where labels are too few to show that
(458 distinct texts in the second half, as the parameters are), no rule applies there.

All of it is DataFrame operations.  A text is read once, in one narrow pass; what
is shuffled are rows of measures (for the join with the labels, and one for each labelled text) and
counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, materialise

#: Fixed bits of a packed (hash, place) number that hold the place.
PLACE_BITS = 30


@dataclass(frozen=True)
class Rule:
    """Rejects where ``measure`` > cutoff; candidate cutoffs from lenient to strict."""

    measure: str
    cutoffs: tuple[float, ...]


def _down(first: float, last: float, n: int) -> tuple[float, ...]:
    return tuple(round(first + (last - first) * i / (n - 1), 6) for i in range(n))


RULES = (
    Rule("symbol_share", _down(0.40, 0.02, 20)),
    Rule("dup_line_share", _down(0.95, 0.35, 13)),
    Rule("repeat_share", _down(0.95, 0.20, 16)),
    Rule("upper_share", _down(0.90, 0.10, 17)),
    Rule("mean_word_chars", _down(16.0, 7.0, 19)),
)
#: Strata by language; any other language, or none, is the stratum "other".
STRATA = ("en", "de", "fr", "es", "other")
RISK = 0.01
ERROR = 0.05


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _after(array: Column, n: int) -> Column:
    return F.slice(array, F.lit(n + 1), F.greatest(F.size(array) - n, F.lit(0)))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts and the measures in a struct column ``_m``.

    Repeated words: 3-word windows are hashed, the hash is packed with the place
    into one number, and the numbers are sorted; only windows whose neighbours share
    the hash are then compared word by word.  That keeps the work per text at
    n log n whatever repeats in it.
    """
    mask = (1 << PLACE_BITS) - 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_words", words_of(text))
    windows = F.greatest(F.size("_words") - 2, F.lit(0))
    df = df.withColumn(
        "_windows",
        F.arrays_zip(*(F.slice("_words", F.lit(i), windows).alias(f"w{i}") for i in (1, 2, 3))),
    )
    df = df.withColumn(
        "_packed",
        F.sort_array(
            F.transform("_windows", lambda w, i: F.xxhash64(w).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
        ),
    )
    # neighbours with one hash: both places are candidates
    pairs = F.filter(
        F.arrays_zip(F.col("_packed").alias("a"), _after(F.col("_packed"), 1).alias("b")),
        lambda p: F.shiftright(p["a"].bitwiseXOR(p["b"]), PLACE_BITS) == 0,
    )
    df = df.withColumn("_pairs", pairs)
    candidates = F.array_distinct(
        F.concat(
            F.transform("_pairs", lambda p: p["a"].bitwiseAND(F.lit(mask))),
            F.transform("_pairs", lambda p: p["b"].bitwiseAND(F.lit(mask))),
        )
    )
    df = df.withColumn("_exact", F.sort_array(F.transform(candidates, lambda i: F.struct(F.get("_windows", i.cast("int")).alias("w"), i.alias("i")))))
    same = F.filter(
        F.arrays_zip(F.col("_exact").alias("a"), _after(F.col("_exact"), 1).alias("b")), lambda p: p["a"]["w"] == p["b"]["w"]
    )
    df = df.withColumn("_same", same)
    places = F.sort_array(
        F.array_distinct(F.concat(F.transform("_same", lambda p: p["a"]["i"]), F.transform("_same", lambda p: p["b"]["i"])))
    )
    df = df.withColumn("_places", places)
    n_repeat = F.aggregate(
        F.arrays_zip(F.col("_places").alias("a"), _after(F.col("_places"), 1).alias("b")),
        F.lit(0).cast("long"),
        lambda n, p: n + F.least(F.lit(3).cast("long"), F.coalesce(p["b"] - p["a"], F.lit(3).cast("long"))),
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    chars = F.char_length(F.array_join("_words", ""))

    def without(pattern: str) -> Column:
        return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))

    df = df.withColumn(
        "_m",
        F.struct(
            F.size("_words").cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            without(r"[A-Z]+").cast("long").alias("n_upper"),
        ),
    )
    return df.select(*(docs[c] for c in docs.columns), "_m")


def _measures(m: Column) -> dict[str, Column]:
    """Each rule's measure; 0 where there is nothing to measure."""

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return {
        "symbol_share": share(m["n_symbols"], m["word_chars"]),
        "dup_line_share": share(m["n_dup_lines"], m["n_lines"]),
        "repeat_share": share(m["n_repeat_words"], m["n_words"]),
        "upper_share": share(m["n_upper"], m["word_chars"]),
        "mean_word_chars": share(m["word_chars"], m["n_words"]),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def stratum(lang: Column, strata: Sequence[str]) -> Column:
    return F.when(lang.isin(*strata[:-1]), lang).otherwise(F.lit(strata[-1]))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms; 1 where k > n * p, which no small level passes."""
    odds = math.log(p) - math.log1p(-p)
    first = n * math.log1p(-p)

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(acc["total"], term)
        return F.struct(
            term.alias("term"), (top + F.log1p(F.exp(F.least(acc["total"], term) - top))).alias("total")
        )

    summed = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("term"), first.alias("total")),
        step,
        lambda acc: F.exp(acc["total"]),
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(summed)


def cutoffs(
    labelled: DataFrame,
    rules: Sequence[Rule] = RULES,
    strata: Sequence[str] = STRATA,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """(stratum, measure, cutoff, n_good, n_over, p_value): the strictest setting that passes.

    ``labelled``: (stratum, aim boolean, one column per measure) of the good documents;
    ``aim`` says in which half a row is.  n_good, n_over and p_value are those of all
    rules together.  Rows are few: at most one per stratum and rule.
    """
    spark = labelled.sparkSession
    # candidates fall, so a document lies over those from this step on
    over = [reduce(add, [(F.col(r.measure) <= c).cast("int") for c in r.cutoffs]) for r in rules]
    rows = labelled.select("stratum", "aim", F.array(*over).alias("steps"))

    halves = rows.where("aim")
    grid = spark.createDataFrame([(i, j) for i, r in enumerate(rules) for j in range(len(r.cutoffs))], "rule int, step int")
    hist = halves.select("stratum", F.posexplode("steps").alias("rule", "step")).groupBy("stratum", "rule", "step").count()
    every = halves.groupBy("stratum").agg(F.count("*").alias("n"))
    lost = F.sum(F.coalesce("count", F.lit(0))).over(Window.partitionBy("stratum", "rule").orderBy("step"))
    # one row for each candidate cutoff of the parameters, and one for each stratum
    tried = F.broadcast(grid).crossJoin(every).join(hist, ["stratum", "rule", "step"], "left").withColumn("lost", lost)
    aims = tried.where(F.col("lost") <= risk / (2 * len(rules)) * F.col("n")).groupBy("stratum", "rule").agg(F.max("step").alias("aim"))
    aims = aims.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "aim"))).alias("m"))
    aims = aims.select("stratum", F.transform(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: F.coalesce(F.get(F.array(F.col("m")), 0)[i], F.lit(-1))).alias("aims"))

    # a document lies over some cutoff while the rules are no further from their aims than this
    nearest = F.array_max(F.zip_with("aims", "steps", lambda a, s: F.when(a >= 0, a - s).otherwise(-1)))
    tested = rows.where("not aim").join(F.broadcast(aims), "stratum").select("stratum", nearest.alias("short"))
    hist = tested.groupBy("stratum", "short").count()
    every = tested.groupBy("stratum").agg(F.count("*").alias("n_good"))
    grid = spark.createDataFrame([(j,) for j in range(max(len(r.cutoffs) for r in rules))], "short int")
    at = Window.partitionBy("stratum").orderBy(F.desc("short"))
    best = (
        F.broadcast(grid)
        .crossJoin(every)
        .join(hist, ["stratum", "short"], "left")
        .withColumn("n_over", F.sum(F.coalesce("count", F.lit(0))).over(at))
        .withColumn("p_value", binomial_tail(F.col("n_over"), F.col("n_good"), risk))
        .withColumn("failed", F.max((F.col("p_value") > error / len(strata)).cast("int")).over(at))
        .where("failed = 0")
        .groupBy("stratum")
        .agg(F.min_by(F.struct("short", "n_good", "n_over", "p_value"), "short").alias("b"))
    )
    names = F.array(*(F.struct(F.lit(r.measure).alias("measure"), F.array(*map(F.lit, r.cutoffs)).alias("cutoffs")) for r in rules))
    step = F.get("aims", F.col("i")) - F.col("b.short")
    return (
        best.join(F.broadcast(aims), "stratum")
        .select("stratum", "aims", "b", F.posexplode(names).alias("i", "rule"))
        .where(step >= 0)
        .select("stratum", "rule.measure", F.get("rule.cutoffs", step).alias("cutoff"), "b.n_good", "b.n_over", "b.p_value")
    )


def judged(
    docs: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    strata: Sequence[str] = STRATA,
    risk: float = RISK,
    error: float = ERROR,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    carry: bool = False,
) -> DataFrame:
    """Measures and verdict of every row: struct columns ``_m`` and ``_doc``, ``base_failed`` and ``kept``.

    ``carry`` keeps the whole row of ``docs`` in ``_doc`` (for a filter); else only
    the id.  A row's own measures decide on it, so repeated ids do no harm.  A
    document counts as good for the calibration if all its labels say 1; it must
    also have passed the base rules, and of equal texts one counts.
    """
    row = F.struct(*(F.col(c) for c in docs.columns)) if carry else F.struct(F.col(id_col))
    narrow = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"), row.alias("_doc")
    )
    key = F.md5(F.coalesce("_text", F.lit(""))).alias("_key")
    seen = measured(narrow, "_text").select("_id", "_doc", "_m", key, stratum(F.col("_lang"), strata).alias("_stratum"))
    seen = materialise(seen, "measures")
    good = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q")).where("q = 1")
    m = _measures(F.col("_m"))
    texts = seen.where(~base_failed(F.col("_m"))).select("_id", "_stratum", "_key", "_m").join(good.select("_id"), "_id", "left_semi")
    texts = texts.groupBy("_stratum", "_key").agg(F.first("_m").alias("_m"))  # equal texts have equal measures
    calibration = texts.select(
        F.col("_stratum").alias("stratum"), (F.col("_key") < "8").alias("aim"), *(m[r.measure].alias(r.measure) for r in rules)
    )
    cut = cutoffs(calibration, rules, strata, risk, error)
    wide = cut.groupBy(F.col("stratum").alias("_stratum")).pivot("measure", [r.measure for r in rules]).agg(F.first("cutoff"))
    # one row per stratum, and the strata are a parameter
    wide = wide.select("_stratum", F.struct(*(F.col(r.measure) for r in rules)).alias("_cut"))
    failed = base_failed(F.col("_m"))
    over = [F.coalesce(m[r.measure] > F.col("_cut")[r.measure], F.lit(False)) for r in rules]
    rejected = failed
    for o in over:
        rejected = rejected | o
    return seen.join(F.broadcast(wide), "_stratum", "left").select(
        "_id", "_doc", "_m", failed.alias("base_failed"), (~rejected).alias("kept"),
        F.concat_ws(",", *(F.when(o, F.lit(r.measure)) for o, r in zip(over, rules, strict=True))).alias("broken"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, broken).

    ``broken`` lists the measures over their cutoffs.  A null text has no words
    (and fails the base); a null or unknown language is judged in the stratum
    "other"; null ids are carried, but never labelled.  Repeated rows give a row
    each; a measure equal to its cutoff is not over it.  Empty ``docs`` give an empty
    result; empty ``labels`` leave the base rules.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs, labels, **options).select(
        F.col("_id").alias("doc_id"), *(F.col("_m")[c].alias(c) for c in base), "base_failed", "kept", "broken"
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; nulls, repeats and empty tables as in ``quality_rules``."""
    return judged(docs, labels, carry=True, **options).where("kept").select("_doc.*")
