import pytest

CLASHING = ["_id", "_h", "_t", "row", "kept", "n_words", "matches", "lines", "cuts", "node", "bucket", "spans", "held_out", "score",
            "label", "n_chars"]


@pytest.fixture
def table_of(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash with those of the operators."""
    def make(rows, lang="en"):
        data = [(i, t, lang, "s", *[7] * len(CLASHING)) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` long" for c in CLASHING)
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture
def odd(table_of):
    """Nulls, empty and blank texts, ties, repeated rows, one very long text."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    prose = " ".join(f"word{i}" for i in range(300))
    return table_of([(1, None), (2, ""), (3, " \n\t\n"), (4, prose), (4, prose), (5, prose), (None, "a null id has a text"), (None, None),
                     (6, long), (7, "é" * 500), (8, "x"), (9, "x"), (10, "\0 \x1c odd bytes ퟿")])
