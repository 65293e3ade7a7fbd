"""Exact duplicates of lines or paragraphs across a corpus, and passages that documents share.

Units (lines, paragraphs, or sentences inside lines) are hashed and their digests grouped.
Every repeat of a unit can be removed.  A passage is more than that: neighbouring sentences
that all stand in other documents too, and are long enough together, so a short line that
thousands of documents have by chance makes none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import as_row, from_row, pieces, stored, utf8

_BREAKS = {
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*"),
    "sentence": re.compile(r"\n|(?<=[.!?…])[^\S\n]+|(?<=[。！？])"),
}
_UNITS = pa.schema(
    [
        ("unit", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("digest", pa.binary()),
        ("words", pa.int32()),
        ("letters", pa.int32()),
    ]
)
_UNIT_TYPES = "unit int, start int, end int, digest binary, words int, letters int"


def units_of(text: str, unit: str = "line", least_letters: int = 1):
    """(number, start, end, digest) of each unit with enough characters.

    Blanks are not counted, and a unit of nothing else is never one.

    Offsets count code points of the text.  The digest is of the lower-cased words joined
    by single spaces.
    """
    for number, start, end, digest, _, _ in _measured(text, unit, least_letters):
        yield number, start, end, digest


def _measured(text: str, unit: str, least_letters: int):
    """``units_of`` with each unit's number of words and of characters that are not blank."""
    start = 0
    breaks = [(m.start(), m.end()) for m in _BREAKS[unit].finditer(text)]
    for number, (end, after) in enumerate([*breaks, (len(text), len(text))]):
        words = text[start:end].lower().split()
        letters = sum(map(len, words))
        if letters >= max(1, least_letters):
            digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
            yield number, start, end, digest, len(words), letters
        start = after


def _split(unit: str, least_letters: int, in_a_row: bool = False):
    """Texts to units; numbered in a row, blank ones left out, or by their place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in pieces(batch, "_text"):
                rows, places = [], []
                for i, text in enumerate(texts, first):
                    found = list(_measured(text.decode("utf-8", "replace"), unit, least_letters))
                    if in_a_row:
                        found = [(k, *unit_row[1:]) for k, unit_row in enumerate(found)]
                    rows += found
                    places += [i] * len(found)
                at = pa.array(places, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(at) for c in ("doc_id", "version")),
                        *(
                            pa.array([r[k] for r in rows], field.type)
                            for k, field in enumerate(_UNITS)
                        ),
                    ],
                    names=["doc_id", "version", *_UNITS.names],
                )

    return run


def repeated_units(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    unit: str = "line",
    least_letters: int = 1,
) -> DataFrame:
    """Every unit that repeats an earlier one: doc_id, version, unit, start, end, keep_*.

    Units are ranked by document id, then text, then place; the first of equal units is
    kept, and ``keep_doc_id``, ``keep_start``, ``keep_end`` say where.  ``version`` is the
    hash of the text, so rows of one id and different texts are told apart; equal rows are
    one.  NULL ids rank first.  NULL texts and units of under ``least_letters``
    characters without blanks are never repeats.  Digests are grouped with sums made in each
    task first; a digest that a third of all units share is one row of the group table, and
    Spark splits the join.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), utf8(text).alias("_text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _split(unit, least_letters), f"doc_id {kind}, version bigint, {_UNIT_TYPES}"
    ).drop("words", "letters")
    found = stored(found.distinct(), "units")
    place = F.struct("doc_id", "version", "unit", "start", "end")
    firsts = found.groupBy("digest").agg(F.min(place).alias("keep"), F.count(F.lit(1)).alias("n"))
    again = found.join(firsts.where("n > 1"), "digest").where(place != F.col("keep"))
    return again.select(
        "doc_id",
        "version",
        "unit",
        "start",
        "end",
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.start").alias("keep_start"),
        F.col("keep.end").alias("keep_end"),
    )


def shared_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = 30,
    least_letters: int = 300,
) -> DataFrame:
    """Passages that other documents share: doc_id, version, start, end, n_words, keep_doc_id.

    A passage is a longest row of neighbouring sentences each of which also stands in another
    document, in the same lower-cased words.  It has at least ``least_words`` words, or, for
    scripts without blanks, ``least_letters`` characters that are not blank.  Sentences end at
    line breaks and after full stops, question and exclamation marks.  ``start`` and ``end``
    are code points of the text.  ``keep_doc_id`` is the first document that has the passage's
    first sentence; where it is the row's own, the passage is the one to be kept.

    Documents are told apart by id and text: equal rows are one document and share nothing
    with each other.  NULL ids rank first.  NULL, empty and blank texts have no passages, nor
    has an empty table; a text may be of any length.  A sentence that a third of all documents
    have is one row of the digest table, summed up in each task first.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), utf8(text).alias("_text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _split("sentence", 1, in_a_row=True), f"doc_id {kind}, version bigint, {_UNIT_TYPES}"
    )
    found = stored(found, "sentences")
    doc = F.struct("doc_id", "version")
    shared = (
        found.groupBy("digest")
        .agg(F.min(doc).alias("first"), F.max(doc).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("digest", F.col("first.doc_id").alias("keep_doc_id"))
    )
    # One shuffle by document serves the repeated rows, the window and the sums.
    again = found.join(shared, "digest").drop("digest").repartition("doc_id", "version")
    again = again.dropDuplicates(["doc_id", "version", "unit"])
    place = F.row_number().over(Window.partitionBy("doc_id", "version").orderBy("unit"))
    again = again.withColumn("row", F.col("unit") - place)
    long_enough = (F.col("n_words") >= least_words) | (F.col("n_letters") >= least_letters)
    return (
        again.groupBy("doc_id", "version", "row")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("words").alias("n_words"),
            F.sum("letters").alias("n_letters"),
            F.min_by("keep_doc_id", "unit").alias("keep_doc_id"),
        )
        .where(long_enough)
        .select("doc_id", "version", "start", "end", "n_words", "keep_doc_id")
    )


def _spans(repeats: DataFrame) -> DataFrame:
    span = F.struct("start", "end", "keep_doc_id", "keep_start", "keep_end")
    return repeats.groupBy(F.struct("doc_id", "version").alias("_doc")).agg(
        F.array_sort(F.collect_list(span)).alias("_spans")
    )


def _passages(passages: DataFrame) -> DataFrame:
    span = F.struct("start", "end", "n_words", "keep_doc_id")
    return passages.groupBy(F.struct("doc_id", "version").alias("_doc")).agg(
        F.array_sort(F.collect_list(span)).alias("passages")
    )


def removed_spans(
    docs: DataFrame,
    repeats: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    passages: DataFrame | None = None,
):
    """Per document: doc_id, n_chars_left, and the removed spans with their offsets in the text.

    One row out per row in; a document without repeats has no spans.  With ``passages`` (of
    ``shared_passages``) also n_passages and passages, which may overlap the removed spans.
    """
    rows = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version")).alias("_doc"),
        F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("_chars"),
    )
    gone = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]).cast("bigint")
    )
    kept = rows.join(_spans(repeats), "_doc", "left")
    more = []
    if passages is not None:
        kept = kept.join(_passages(passages), "_doc", "left")
        listed = F.coalesce("passages", F.array())
        more = [F.size(listed).cast("bigint").alias("n_passages"), listed.alias("passages")]
    kept = kept.select(
        F.col("_doc.doc_id").alias(doc_id),
        "_chars",
        F.coalesce("_spans", F.array()).alias("spans"),
        *more,
    )
    return kept.select(
        doc_id,
        *(["n_passages"] if more else []),
        F.size("spans").cast("bigint").alias("n_removed"),
        (F.col("_chars") - gone).alias("n_chars_left"),
        "spans",
        *(["passages"] if more else []),
    )


def remove_repeats(docs: DataFrame, repeats: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """The documents, all columns, with repeated units cut out of ``text``; breaks stay."""
    key = F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"))
    rows = docs.select(key.alias("_doc"), as_row(docs).alias("row"))
    joined = rows.join(_spans(repeats), "_doc", "left")
    whole = F.col("row").getField(text)
    starts = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: s["end"]))
    ends = F.concat(F.transform("_spans", lambda s: s["start"]), F.array(F.length(whole)))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda s: F.substring(whole, s["a"] + 1, s["b"] - s["a"]),
    )
    cleaned = F.when(F.col("_spans").isNull(), whole).otherwise(F.concat_ws("", parts))
    return joined.select(*from_row(docs.columns, **{text: cleaned}))
