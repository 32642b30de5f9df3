import pytest

NAMES = "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, rank string, pos int, label int, word string, part int"


@pytest.fixture(scope="session")
def make(spark):
    """Rows of (doc_id, text[, lang]) as documents with columns whose names operators use inside."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else None, 7, 7, "x", 7, 7, "w", 7) for r in rows]
        return spark.createDataFrame(full, NAMES)

    return build


@pytest.fixture(scope="session")
def tiny(make):
    """Nulls, blanks, copies, a repeated row, odd characters, one very long text."""
    long_text = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000))
    return make(
        (1, "alpha beta gamma delta"), (2, None), (3, ""), (4, " \t\n "), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta"), (6, "é½ 日本語 \x1c😀 ok"), (7, long_text), (8, long_text), (None, "alpha beta"), (9, "<|endoftext|> a<|endoftext|>"),
        (10, "one"), (11, None, None),
    )
