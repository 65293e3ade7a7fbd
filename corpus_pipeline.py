"""From raw documents to token ids, in five stages.

Every stage reads all that the one before it kept, from Parquet in the shared folder, and
returns the columns of ``documents``; the last returns the ids.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import signalguard
from signalguard.llm import bpe, decontam, fuzzy_lines, langid, simhash
from signalguard.llm.base import fold, stored, table

# Python workers get the package's functions by value, so they need no installed copy.
cloudpickle.register_pickle_by_value(signalguard)

#: A language is accepted if its posterior is at least this.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is determined."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    model = langid.learn(docs.where(fold("doc_id", 4) != 2), vocabulary)
    marked = langid.identify(
        docs, model, vocabulary, keep=docs.columns, language="_language", score="_certainty"
    )
    sure = (F.col("_language") != langid.UNDETERMINED) & (F.col("_certainty") >= LEAST_SCORE)
    return marked.where(sure).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that an earlier document, or an earlier line, has in about the same words."""
    cut = fuzzy_lines.remove_lines(docs, fuzzy_lines.line_groups(docs, least_letters=1))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group."""
    return simhash.one_per_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by the benchmark."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digest of what they decode to."""
    done = bpe.encode_and_decode(
        docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id", "lang", "source"]
    )
    return done.select(
        "doc_id",
        "lang",
        "source",
        F.expr("length(ids) DIV 4").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("encode", encode),
]

#: SQL can express neither the language model nor the encoding; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
