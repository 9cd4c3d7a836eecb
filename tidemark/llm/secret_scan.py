"""Secret scans: three fixed patterns, and a battery of randomness tests.

Long runs of letters, digits and ``+ / _ -`` are candidates.  From the characters of
a run its encoding is inferred (digits, letters, hex, base32, base64, letters with digits), and its
symbols are tested against that alphabet: a chi-squared test of uniformity, a runs
test about the alphabet's middle, and lag-1 serial correlation.  Three times the
least p-value says how well the run passes for random.

How often does plain language pass?  Every document gives a decoy for each kind of
alphabet (up to 16 symbols, up to 36, more): what a stretch of its prose holds of that
alphabet, at a place and length that the text's hash picks, and it takes the same tests
over that alphabet.  For each class of alphabet and length, and each bar on the p-value,
the share of decoys over the bar, times the number of candidates, is the expected
number of false findings; the lowest bar at which that is at most ``fdr`` of the
findings is used.  Short runs, on which the tests have little power, so meet a high
bar or are not reported at all.

The work on a text with n findings grows with n^1.5 at most: running sums and maxima
are taken in blocks of about sqrt(n), and nothing compares findings pair by pair.

DataFrame operations only.  Texts are read in one narrow pass; nothing is shuffled
but counts by class and p-value, and the texts of a table of fewer splits than cores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, spread

#: Patterns of the contract, in its order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

#: Runs that are tested.
LEAST = 20
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % LEAST
FDR = 0.05
#: Least numbers of symbols of the classes after the first, and in the first; and the number of bars between p-values 0 and 1.
FEWEST = LEAST // 2
LENGTHS = (LEAST, 24, 28, 32, 36, 40, 48, 64, 96, 160)
BARS = 50

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: encoding, test for it, alphabet; the first that fits is taken.
ENCODINGS = (
    ("base10", r"^[0-9+/_-]+$", DIGITS),
    ("base26", r"^([a-z+/_-]+|[A-Z+/_-]+)$", LOWER),
    ("base52", r"^[A-Za-z+/_-]+$", UPPER + LOWER),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", r"^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", r"^([a-z0-9_-]+|[A-Z0-9_-]+)$", DIGITS + LOWER),
    ("base64", r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^", UPPER + LOWER + DIGITS + "-_"),
)

#: Alphabets of the decoys, what is no symbol of them in lower-cased or whole prose, and prose taken for each symbol.
DECOYS = ((DIGITS + "abcdef", "[^0-9a-f]", True, 8), (LOWER, "[^a-z]", True, 3), (UPPER + LOWER + DIGITS + "+/", "[^A-Za-z0-9+/]", False, 3))

_PLACED = "array<struct<start:int,end:int,decoy:boolean,size:int,places:array<int>>>"
_EMPTY = "array<struct<start:int,end:int,found:string>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, merge, kind: str = "int") -> Column:
    """Of an array x1, x2, ...: x1, merge(x1, x2), ... for an associative ``merge``; in blocks, as appending copies an array."""

    def all_of(xs: Column) -> Column:
        return F.aggregate(
            xs,
            F.array().cast(f"array<{kind}>"),
            lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) > 0, merge(F.try_element_at(acc, F.lit(-1)), x)).otherwise(x))),
        )

    def joined(inner: Column) -> Column:
        ends = all_of(F.transform(inner, lambda xs: F.try_element_at(xs, F.lit(-1))))
        return let(
            ends,
            lambda e: F.flatten(F.transform(inner, lambda xs, j: F.when(j == 0, xs).otherwise(F.transform(xs, lambda x: merge(F.get(e, j - 1), x))))),
        )

    def blocks(xs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int")
        firsts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int"))
        return let(F.transform(firsts, lambda b: all_of(F.slice(xs, b * width + 1, width))), joined)

    return let(values, lambda xs: F.when(F.size(xs) > 0, blocks(xs)).otherwise(xs))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: (start, end, found), in code points.

    The lengths of what stands between the matches, and of the matches, add up to
    their places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))

    def placed(pieces: Column) -> Column:
        ends = running(F.transform(pieces, lambda p: p["gap"] + F.char_length(p["found"])), lambda a, b: a + b)
        return F.transform(
            F.arrays_zip(ends.alias("end"), pieces.alias("p")),
            lambda z: F.struct((z["end"] - F.char_length(z["p"]["found"])).alias("start"), z["end"].alias("end"), z["p"]["found"].alias("found")),
        )

    pieces = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda p: p["found"].isNotNull())
    return F.when(text.rlike(pattern), let(pieces, placed)).otherwise(F.array().cast(_EMPTY))


def normal_tail(z: Column) -> Column:
    """P(N(0, 1) > z), by a logistic curve that is within 0.0002."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(1.5976 * z + 0.07056 * z * z * z))


def encoding(run: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern, _ in reversed(ENCODINGS):
        out = F.when(run.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def alphabet(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, _, letters in ENCODINGS:
        out = F.when(name == key, F.lit(letters)).otherwise(out)
    return out


def randomness(places: Column, size: Column) -> Column:
    """Three times the least p-value of the battery, at most 1, for symbols 0 .. size-1."""
    n = F.size(places).cast("double")
    k = size.cast("double")
    squares = F.aggregate(
        F.transform(F.sequence(F.lit(0), size - 1), lambda s: n - F.size(F.array_remove(places, s))),
        F.lit(0.0),
        lambda a, c: a + c * c,
    )
    df = k - 1
    chi = k / n * squares - n
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal
    uniform = normal_tail((F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    after = F.slice(places, F.lit(2), F.size(places))
    pairs = F.slice(F.arrays_zip(places.alias("a"), after.alias("b")), F.lit(1), F.size(places) - 1)
    high = F.size(F.filter(places, lambda x: 2 * x >= size)).cast("double")
    runs = 1.0 + F.size(F.filter(pairs, lambda p: (2 * p["a"] >= size) != (2 * p["b"] >= size)))
    mean = 2 * high * (n - high) / n + 1
    spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
    of_runs = 2 * normal_tail(F.abs(runs - mean) / spread)
    middle = (k - 1) / 2
    products = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - middle) * (p["b"] - middle))
    total = F.aggregate(places, F.lit(0.0), lambda a, x: a + (x - middle) * (x - middle))
    serial = 2 * normal_tail(F.abs(F.coalesce(F.try_divide(products, total), F.lit(1.0))) * F.sqrt(n))
    return F.least(F.lit(1.0), 3 * F.least(uniform, of_runs, serial))


def _decoys(text: Column) -> Column:
    """Stretches of the text's prose, one for each of ``DECOYS``, in the form of runs to be tested; none in a short text."""
    h = F.xxhash64(text)
    n = F.get(F.array(F.lit(FEWEST), *map(F.lit, LENGTHS)), F.pmod(h, F.lit(len(LENGTHS) + 1)).cast("int"))
    out = []
    for letters, other, lower, times in DECOYS:
        room = F.greatest(F.char_length(text) - times * n, F.lit(1))
        start = F.pmod(F.shiftright(h, 8), room).cast("int")
        stretch = F.substring(text, start + 1, times * n)
        symbols = F.substring(F.regexp_replace(F.lower(stretch) if lower else stretch, other, ""), F.lit(1), n)
        places = F.transform(F.split(symbols, ""), lambda c, letters=letters: F.instr(F.lit(letters), c) - 1)
        one = F.struct(F.lit(0).alias("start"), n.alias("end"), F.lit(True).alias("decoy"), F.lit(len(letters)).alias("size"), places.alias("places"))
        out.append(F.when(F.char_length(symbols) == n, one))
    return F.array_compact(F.array(*out))


def _tested(runs: Column, decoys: Column) -> Column:
    """(start, end, decoy, class, bar) of each run, and of the decoys; a run's class is by its alphabet and the symbols that are tested."""
    named = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["found"].alias("found"), encoding(r["found"]).alias("encoding")))
    lettered = F.filter(
        F.transform(
            named,
            lambda r: F.struct(
                r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
                alphabet(r["encoding"]).alias("alphabet"),
                F.when(r["encoding"].isin("hex"), F.lower(r["found"]))
                .when(r["encoding"] == "base36", F.regexp_replace(F.lower(r["found"]), "[_-]", ""))
                .when(r["encoding"] == "base26", F.regexp_replace(F.lower(r["found"]), "[+/_-]", ""))
                .when(r["encoding"].isin("base10", "base52"), F.regexp_replace(r["found"], "[+/_-]", ""))
                .otherwise(r["found"]).alias("found"),
            ),
        ),
        lambda r: F.char_length(r["found"]) >= FEWEST,
    )
    placed = F.transform(
        lettered,
        lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), F.lit(False).alias("decoy"),
            F.char_length(r["alphabet"]).alias("size"),
            F.transform(F.split(r["found"], ""), lambda c: F.instr(r["alphabet"], c) - 1).alias("places"),
        ),
    )
    return F.transform(
        F.concat(placed, decoys),
        lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["decoy"].alias("decoy"),
            F.aggregate(
                F.array(*map(F.lit, LENGTHS)),
                F.when(r["size"] <= 16, 0).when(r["size"] <= 36, len(LENGTHS) + 1).otherwise(2 * len(LENGTHS) + 2),
                lambda a, least: a + (F.size(r["places"]) >= least).cast("int"),
            ).alias("class"),
            F.floor(randomness(r["places"], r["size"]) * BARS).cast("int").alias("bar"),
        ),
    )


def _bars(scanned: DataFrame, fdr: float) -> dict[int, int]:
    """The lowest bar of each class at which decoys foretell at most ``fdr`` false findings.

    What comes to the driver is one count per class, bar and kind.
    """
    counts = scanned.select(F.inline("_runs")).groupBy("class", "decoy", "bar").count().collect()
    bars = {}
    for c in {r["class"] for r in counts}:
        seen = {kind: {r["bar"]: r["count"] for r in counts if r["class"] == c and r["decoy"] is kind} for kind in (True, False)}
        over = lambda kind, b: sum(n for x, n in seen[kind].items() if x >= b)  # noqa: B023, E731
        for b in range(1, BARS + 1):
            found = over(False, b)
            expected = (over(True, b) + 1) / (over(True, 0) + 1) * over(False, 0)
            if found and expected <= fdr * found:
                bars[c] = b
                break
    return bars


def scanned(docs: DataFrame, fdr: float = FDR, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(_doc, _text, spans): every row with its spans (start, kind as a place in KINDS, end), in order.

    ``carry`` keeps the whole row in ``_doc`` and its text; else only the id.
    """
    row = F.struct(*(F.col(c) for c in docs.columns)) if carry else F.struct(F.col(id_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(row.alias("_doc"), text.alias("_text"))
    df = df if carry else spread(df, docs)
    text = F.col("_text")
    df = df.select("_doc", "_text", matches(text, ASSIGN).alias("_assign"), matches(text, ACCESS).alias("_access"),
                   matches(text, HEX.replace("+", "{24,}")).alias("_hex"), matches(text, RUN).alias("_found"))

    def base(column: str, kind: int, passes) -> Column:
        return F.transform(
            F.filter(column, passes), lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
        )

    df = df.withColumn(
        "_base",
        F.array_sort(
            F.concat(
                base("_assign", 0, lambda s: F.char_length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6),
                base("_access", 1, lambda s: F.char_length(s["found"]) >= 20),
                base("_hex", 2, lambda s: F.char_length(s["found"]) >= 24),
            )
        ),
    )
    df = df.withColumn("_decoys", _decoys(text)).withColumn("_runs", _tested(F.col("_found"), F.col("_decoys")))
    df = materialise(df.select("_doc", *(["_text"] if carry else []), "_base", "_runs"), "scanned")
    bars = _bars(df, fdr)

    def passes(r: Column) -> Column:
        needed = F.lit(BARS + 1)
        for c, b in bars.items():
            needed = F.when(r["class"] == c, F.lit(b)).otherwise(needed)
        return ~r["decoy"] & (r["bar"] >= needed)

    def spans_of(array: Column, kind: int) -> Column:
        return F.transform(array, lambda r: F.struct(r["start"].alias("start"), F.lit(kind).alias("kind"), r["end"].alias("end")))

    def not_within(both: Column) -> Column:
        """Random spans that end beyond all fixed ones which begin no later."""
        reach = running(F.transform(both, lambda s: F.when(s["kind"] == 3, 0).otherwise(s["end"])), F.greatest)
        zipped = F.arrays_zip(both.alias("s"), reach.alias("reach"))
        kept = F.filter(zipped, lambda z: (z["s"]["kind"] == 3) & (z["s"]["end"] > z["reach"]))
        return F.transform(kept, lambda z: z["s"])

    more = let(F.array_sort(F.concat("_base", spans_of(F.filter("_runs", passes), 3))), not_within)
    return df.select("_doc", *(["_text"] if carry else []), "_base", F.array_sort(F.concat("_base", more)).alias("spans"))


def _written(spans: Column | str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, fdr: float = FDR, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then
    kind.  A random run that lies within a span of the fixed patterns is not reported
    again; one that only overlaps it is.  A null or empty text has no spans.  Repeated rows give a row each; null
    ids are carried; further columns are ignored.
    """
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return scanned(docs, fdr, id_col=id_col, text_col=text_col).select(
        F.col("_doc")[id_col].alias("doc_id"),
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written("_base"), 256).alias("base_sha256"), _written("spans").alias("spans"),
    )


def redacted(
    docs: DataFrame, mark: str = "[secret]", fdr: float = FDR, *, id_col="doc_id", text_col="text", length_col: str | None = None
) -> DataFrame:
    """``docs`` with every span of the scan replaced by ``mark``; spans that overlap are replaced as one.

    ``length_col`` names a column that holds the text's length, which is set anew
    where the text changes.  All rows stay, null texts stay null.
    """
    seen = scanned(docs, fdr, id_col=id_col, text_col=text_col, carry=True)
    text = F.col("_text")

    def gaps(reach: Column) -> Column:
        """What stands between the spans, also before the first and after the last: (from, to)."""
        before = F.concat(F.array(F.lit(0)), F.slice(reach, F.lit(1), F.size(reach) - 1))
        zipped = F.arrays_zip(before.alias("from"), F.transform("spans", lambda s: s["start"]).alias("to"))
        last = F.struct(F.try_element_at(reach, F.lit(-1)).alias("from"), F.char_length(text).alias("to"))
        return F.concat(F.filter(zipped, lambda g: g["from"] <= g["to"]), F.array(last))

    def cut(pieces: Column) -> Column:
        """The pieces' text, cut from stretches of about sqrt(n) pieces, as finding a place in a text takes as long as what stands before."""
        width = F.ceil(F.sqrt(F.size(pieces).cast("double"))).cast("int")
        firsts = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / width).cast("int"))

        def of_block(block: Column) -> Column:
            low, high = F.get(block, 0)["from"], F.try_element_at(block, F.lit(-1))["to"]
            inner = lambda part: F.transform(block, lambda p: F.substring(part, p["from"] - low + 1, p["to"] - p["from"]))
            return let(F.substring(text, low + 1, high - low), inner)

        return F.array_join(F.flatten(F.transform(firsts, lambda b: let(F.slice(pieces, b * width + 1, width), of_block))), mark)

    reach = running(F.transform("spans", lambda s: s["end"]), F.greatest)
    clean = let(reach, lambda r: let(gaps(r), cut))
    seen = seen.withColumn("_clean", F.when(F.size("spans") > 0, clean))
    return seen.select(
        *(
            F.coalesce("_clean", F.col("_doc")[c]).alias(c) if c == text_col
            else F.when(F.col("_clean").isNotNull(), F.char_length("_clean").cast(docs.schema[c].dataType)).otherwise(F.col("_doc")[c]).alias(c) if c == length_col
            else F.col("_doc")[c].alias(c)
            for c in docs.columns
        )
    )
