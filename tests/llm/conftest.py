import datetime

import pytest

LONG = " ".join(f"word{k % 977}x" for k in range(40_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    five = "one two three four five six seven eight nine ten"
    passage = "\n".join(f"the shared line number {k} stands in many documents" for k in range(6))
    rows = [
        (1, five, "en", "a"),
        (2, five, "en", "a"),
        (2, five, "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \t\n ", "en", "b"),
        (6, LONG, "de", "a"),
        (7, LONG + " end", "de", "a"),
        (None, "a document without an id but with words in it", "en", None),
        (8, f"{passage}\nown ending of eight", "en", "c"),
        (9, f"own start of nine\n{passage}", "en", "c"),
        (10, "tie", None, "c"),
        (11, "tie", "fr", None),
        (12, "Ünï cödé ☃ 日本語 \U0001f600 token = 'abcdef123'", "en", "\U0001f600"),
        (-5, "negative ids are ids as well and this is a longer text for them", "en", "a"),
    ]
    extra = (7, 1.5, "x", datetime.date(2020, 1, 1))
    names = "doc_id long, text string, lang string, source string, n_chars long"
    clashes = (
        "size long, row double, key string, kept date, n_words long, shard double, label string, _id date, "
        "first long, served double, class string, place date, blob long, counts double, _row string, found date"
    )
    return spark.createDataFrame([(*r, len(r[1] or ""), *extra * 4) for r in rows], f"{names}, {clashes}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
