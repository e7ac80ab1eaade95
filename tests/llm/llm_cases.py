import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string"

WORDS = "the of and to in is ble tion ing er re ent ly ou th es an on he at".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


# Nulls in every column, blank and very long texts, equal texts, a repeated row.
EDGE = [
    (1, prose(60, 1), "en", "a"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (4, " \t\n\x0b\x0c\r ", "de", "a"),
    (5, prose(30_000, 2), "de", "c"),
    (6, prose(60, 1).replace(" ", "\n\t"), "en", None),
    (6, prose(60, 1).replace(" ", "\n\t"), "en", None),
    (7, "12 ## 34", None, "a"),
    (None, prose(40, 3), "fr", "b"),
    (8, "é" * 50_000, "fr", "b"),
    (9, "<|endoftext|> \x1c  ​漢字🙂", "en", "a"),
]

CLASHING = ["kept", "size", "rule", "node", "repeats", "n_words", "draw", "of", "h", "rows", "counts"]


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(EDGE, DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(4)
