import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, columns with the names of results."""
    text = "The quick brown fox jumps over the lazy dog near the old river bank today.\n"
    rows = [
        (1, text * 3, "en", "a", 5), (1, text * 3, "en", "a", 5), (2, None, "en", None, None), (3, "", None, "a", 0),
        (None, text, None, None, 1), (None, text, None, None, 1), (4, " \n\t\n", "fr", "b", 3), (5, "x", "fr", "b", 1),
        (6, "".join(f"word{i} and{i % 7} so{i % 11}\n" for i in range(20000)), "en", "a", 7), (7, "été\u2028çà 漢字 \u00a0x", "fr", "b", 2),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["n_words", "fingerprint", "kept", "items", "spans", "rate", "lang_pred", "n_lines", "kinds", "n_tokens", "name", "pos", "a", "k1"]
    return frame.select("*", *[F.lit("own").alias(c) for c in clash])


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
