import pytest

from tests.conftest import SF_SMALL

# Rows every operator has to take: null and empty texts, white space only, repeated rows, one id with two
# texts, a null id, a very long text, odd characters; and extra columns named like the operators' own.
LONG = " ".join(f"word{i % 977} item{i % 31}, again" for i in range(20_000))
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "a b c"), (5, "d e f g h"), (None, "a null id has words"),
       (6, LONG), (7, "x" * 50_000), (8, "é́日本  \x0b\x1f ￿ 😀 <s> <|endoftext|> ▁▁ it's"), (9, "same line\nsame line\n\nsame line "),
       (10, "a b c"), (11, "A B\tC")]
CLASHES = ["n_words", "ids", "__whole", "found", "__quality", "text_hash", "bytes", "__hash", "__id", "__spans", "__verdict", "__kid", "__khash"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    from pyspark.sql import functions as F
    return rows.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
