import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row_id string, kind int, _found string, _language string, _node string"


@pytest.fixture
def docs_of(spark):
    """A documents table of texts, or of (doc_id, text) pairs, with columns whose names operators
    use themselves; several partitions."""

    def make(rows, langs=None):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        langs = langs or [None] * len(rows)
        full = [(i, t, g, "s", len(t or ""), "x", "y", 1, "f", "l", "n") for (i, t), g in zip(rows, langs)]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        return stored(spark, df)

    return make


def stored(spark, df):
    from skyloom.sources.lake import staged

    return staged(df, "fixture")


LONG = " ".join(f"w{i % 977}" for i in range(60_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "one two three four"), (5, "a b c d e f g"),
    (6, "a b c d e f g"), (7, LONG), (8, "ÀB c\x1cd \x00 🙂"), (9, "same same same " * 20), (None, None),
]
