import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, shard string, kept string, posterior int, n int, label string, window string"
LONG = " ".join(f"word{i % 997} of{i}" for i in range(30_000))


@pytest.fixture
def docs(spark):
    """Rows of documents: nulls, empty and long texts, ties, repeats, columns with clashing names."""
    texts = [
        (0, "The first text is here, and it says little. It ends soon.", "en", "a"), (1, "", "en", "a"), (2, None, "de", None),
        (3, LONG, "en", "b"), (4, "The first text is here, and it says little. It ends soon.", "en", "b"),
        (4, "The first text is here, and it says little. It ends soon.", "en", "b"),
        (None, "No number stands here; still it is a text of ten words or more.", None, "a"), (7, "### *** $$$ | | | ###", "en", None),
        (8, "mail a.b@c.example.org or +1 (415) 555-0134, host 10.0.0.256 and 10.0.0.1, card 4111 1111 1111 1111.", "en", "é"),
        (9, "\t\n  \x0b", "en", "a"), (10, "Übergänge größer 日本 😀 naïve\ncafé\ncafé\n", "de", "b"),
    ]
    rows = [(i, t, lang, s, len(t or ""), "x", "y", "z", 1, 2, "l", "w") for i, t, lang, s in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
