import pytest


@pytest.fixture
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns that clash with inner names."""
    import public_tokenizers  # noqa: F401
    long = " ".join(f"word{i % 997} the of and" for i in range(6000))
    clean = "the quick brown fox and the lazy dog of this house sleep in the shade " * 6
    rows = [(1, clean, "en"), (2, clean, "en"), (2, clean, "en"), (3, None, "en"), (4, "", None), (5, long, "en"),
            (None, "orphan text of the night", "en"), (7, "Licensed under the Apache License, Version 2.0.", "en"),
            (8, "12 34 ?? \x00\x1c", "de"), (9, "der hund und die katze " * 20, "de"), (10, "漢字 и кириллица 🙂 é", None)]
    return spark.createDataFrame([(*r, i, "x", "k") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, fp long, key string, row_key string")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
