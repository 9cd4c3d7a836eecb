import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with columns whose names clash with the operators' own."""

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            names = ("fp", "digest", "score", "spans", "kept", "copy", "_m", "_doc", "fingerprint", "label")
            for n in names:
                df = df.selectExpr("*", f"'x' as {n}")
        return df

    return make


#: Nulls, empty and odd texts, repeats and ties.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One TWO three"), (6, "One TWO three"), (None, "one two three four"),
    (None, None), (7, "é\u0085 ö\u2003x \x1c y"), (8, "a b c " * 3000), (9, "word " * 20000), (10, "<|endoftext|> a<|endoftext|>b"),
    (11, "x\n\nx\n x\nx\n"), (12, "\U0001f600 emoji \U0001f600" * 50),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)
