"""Fixtures of the operators' tests: documents with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import pytest

#: Names that the operators use for columns of their own.
CLASHES = ["row", "size", "rank", "place", "node", "component", "score", "tokens", "good", "of", "copies", "target", "spans", "new", "gone", "held_out"]

LONG = " ".join(f"w{i % 977}" if i % 11 else f"w{i % 977}." for i in range(30_000))
BASE = " ".join(f"term{i}" for i in range(60))

#: doc_id, text, lang, source: nulls, empty and very long texts, ties, repeated rows, copies.
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "b"),
    (3, BASE + " tail", "en", None),
    (4, None, None, None),
    (5, "", "en", "a"),
    (6, " \t\n ", "en", "a"),
    (7, "One two", "en", "é"),
    (8, "one\x0btwo ", "en", ""),
    (9, LONG, "en", "a"),
    (10, LONG + " more", "en", "a"),
    (11, "lone", None, "b"),
    (12, "lone", "en", "b"),
    (12, "lone", "en", "b"),
    (None, "lone", "en", "b"),
    (13, "É é ß 漢字 \U0001f600 x", "de", "b"),
    (14, "mail a.b@c.example.com and 10.0.0.1, 256.1.1.1; 4012 8888 8888 1881 +1 (555) 010-9999", "en", "a"),
    (15, "You idiot! " + BASE, "en", "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for c in CLASHES:
        df = df.withColumn(c, F.lit(None).cast("string") if len(c) % 2 else F.lit("x"))
    return df


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, (i % 3 > 0) * 1, (i % 4 == 0) * 1) for i in range(1, 16)] + [(None, 1, 1), (1, None, None), (77, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.where("false")
