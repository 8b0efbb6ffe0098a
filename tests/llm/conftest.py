"""Awkward documents, and the driver's smallest tables, for every training-data operator."""

import random

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

WORDS = "the of and stone river light house dark green walks under over seven paper night glass winter road".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


#: (doc_id, text): nulls, empty and blank texts, repeated rows, one id on two texts, no id, odd characters, a long text.
EDGE = [
    (1, prose(1, 300)), (2, None), (3, ""), (4, " \t\n \x0b"), (5, prose(5, 120)), (5, prose(5, 120)), (6, prose(5, 120)),
    (7, prose(7, 80)), (7, prose(70, 80)), (None, prose(5, 120)), (None, None), (8, "Ünïcode ΣΑΣ İ 漢字 😀 it's 12.5%, <|endoftext|> x"),
    (9, "one two"), (10, prose(10, 9000)), (11, "x" * 70_000), (12, prose(1, 300) + " tail"), (13, "a\n\n\na b c\na b c\r\na b c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The awkward documents with extra columns that clash with the operators' own names."""
    rows = spark.createDataFrame(EDGE, "doc_id bigint, text string").repartition(3)
    clashing = ("segment", "term", "n_words", "spans", "part", "digest", "score", "n_tokens", "_row", "cls", "kept")
    return rows.select("*", *[F.lit(-7).alias(c) for c in clashing])


@pytest.fixture(scope="session")
def small(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def sort_key(row):
    return [(v is not None, v) for v in row]


def same(got, want):
    """Rows in any order."""
    assert sorted(map(tuple, got), key=lambda r: repr(r)) == sorted(map(tuple, want), key=lambda r: repr(r))
