"""Awkward texts and tables for the tests of the operators."""

import pytest
from pyspark.sql import types as T

#: Columns of documents, and some whose names the operators use inside.
DOCUMENTS = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("text", T.StringType())
    .add("lang", T.StringType())
    .add("source", T.StringType())
    .add("n_chars", T.LongType())
)
CLASHING = (
    "_text", "held", "bits", "key", "n_words", "component", "_row", "line", "chunk",
    "_doc", "_spans", "_gone", "_every", "row", "doc", "gone", "every", "version",
)

LINE = "the quick brown foxes jumped gladly over seven lazy sleeping hounds"
LONG = " ".join(f"word{i % 5003}x{i % 7}" for i in range(60_000))

TEXTS = [
    None,
    "",
    " \t\n ",
    "!!! ???",
    LINE,
    LINE,
    LINE.upper() + "!",
    f"{LINE}\nsome other words stand here today\n{LINE}",
    "Élan vital çà et là, ñandú über Straße",
    "short one",
    LONG,
    LONG + " tail",
    "a b c a b c a b c a b c " * 10,
    "| # $ % & < > *",
    "zero\x00byte and ﻿mark and  separator 漢字 текст",
    "<|endoftext|> inside <|startoftext|> a text",
]


def rows(texts, first=0):
    langs, sources = ["en", "fr", None], ["a", None]
    return [
        (first + i, t, langs[i % 3], sources[i % 2], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]


def documents(spark, data):
    df = spark.createDataFrame(data, DOCUMENTS)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def others_kept(df):
    """Whether the clashing columns still hold what they held."""
    return all(r[name] == "x" for r in df.collect() for name in CLASHING)


@pytest.fixture(scope="session")
def messy(spark):
    """Awkward texts; two rows occur twice, one id has two texts, one id is NULL."""
    data = rows(TEXTS)
    data += [data[4], data[10], (4, "another text under an id that is taken", "en", "a", 38)]
    data += [(None, LINE + " of nobody", None, None, None), (None, None, None, None, None)]
    return documents(spark, data)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
