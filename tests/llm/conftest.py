import pytest

#: Columns whose names the operators use themselves.
CLASH = "score double, fp long, component_id long, words int, row long, token string, n_words int, kept boolean, ids string, spans string, slice int, h long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null text, empty text, white space, null id, repeated rows, a very long text, ties; and columns with clashing names."""
    prose = " ".join(f"word{i % 97} of the text{i % 89}" for i in range(300))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "a text without an id and some more words"), (4, prose), (4, prose), (5, prose), (6, prose + " end"),
        (7, "x" * 60_000), (8, "idiot " * 40_000), (9, "Éa ñ 日本 \u2581 \u00a0 b\x0bc"), (10, "a"), (11, "\n".join(["same line"] * 30)),
    ]
    data = [(i, t, "en", "s", len(t or ""), *[None] * 12) for i, t in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
