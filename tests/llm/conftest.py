import os

import pytest


@pytest.fixture(scope="session")
def vocab():
    return __import__("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing names."""
    long_text = "one two three four five six seven eight nine ten\n" * 3000
    same = "Exactly the same words stand in this text, which is longer than a hundred bytes so that it can be found again."
    rows = [
        (1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, None, None, None), (4, "", "en", None, 0), (5, " \n\t ", "de", "b", 4),
        (6, long_text, "en", "b", len(long_text)), (None, same, "en", "c", 1), (None, None, None, "c", 1), (7, "Été <|endoftext|> naïve Σας 日本語 $$$ x's", "fr", "a", 5), (9, "word", "en", "a", 4), (8, "a" * 500, "en", "a", 500),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'x' as fingerprint", "1 as score", "2 as kept_", "'y' as h", "0 as k")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else pytest.skip("no test data")
