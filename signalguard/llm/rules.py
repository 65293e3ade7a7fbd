"""Quality rules with adaptive thresholds, in DataFrame functions only.

Fixed measures of each text, then cutoffs that follow the data: for every language and
source a mergeable quantile sketch of each measure, and fences some interquartile ranges
beyond the quartiles.  The sketch is a log-linear histogram of whole numbers: a value
keeps its leading bits, so a bin is at most 1/32 of its value wide, and two sketches merge
by adding their counts.  Small groups use the merged sketch of their language, and small
languages that of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import stored

_SPACE = "[\\x20\\x09-\\x0D]+"
_SYMBOLS = "#*$%&|<>"  # fixed values


@dataclass(frozen=True)
class Measure:
    """A whole-number measure; ``slack`` is the least distance of a fence from its quartile."""

    name: str
    value: str
    slack: int
    low: bool = False
    high: bool = True


MEASURES = (
    Measure("word_length", "word_chars * 100 DIV n_words", slack=150, low=True),
    Measure("symbols", "n_symbols * 1000 DIV word_chars", slack=100),
    Measure("dup_lines", "n_dup_lines * 1000 DIV greatest(n_lines, 1)", slack=300),
    Measure("repeats", "n_repeat_words * 1000 DIV n_words", slack=200),
)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are sorted by hash, so equal ones are neighbours; the places of the repeated
    ones, sorted again, cover at most three new words each.
    """

    def count(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
            ),
        )
        return _bound(
            F.array_sort(windows),
            lambda s: _bound(
                F.array_sort(
                    F.transform(
                        F.filter(
                            s,
                            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
                        ),
                        lambda x: x["i"],
                    )
                ),
                lambda places: F.aggregate(
                    F.transform(
                        places,
                        lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))),
                    ),
                    F.lit(0).cast("bigint"),
                    lambda total, n: total + n,
                ),
            ),
        )

    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(_bound(words, count))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the base measures of every text; NULL texts have no words.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_lines (with a word).
    """
    held = {f"_k{i}": F.col(c) for i, c in enumerate(keep)}
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*[c.alias(n) for n, c in held.items()], t.alias("_text"))
    words = F.filter(F.split("_text", _SPACE), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.regexp_replace(x, _SPACE, "") != "")
    split = rows.select(
        *held,
        words.alias("_words"),
        F.struct(
            F.size(lines).cast("bigint").alias("n"),
            F.size(F.array_distinct(lines)).cast("bigint").alias("d"),
        ).alias("_lines"),
        (F.length("_text") - F.length(F.translate("_text", _SYMBOLS, ""))).alias("_symbols"),
    )
    chars = F.aggregate("_words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w))
    return split.select(
        *[F.col(n).alias(c) for n, c in zip(held, keep, strict=True)],
        F.size("_words").cast("bigint").alias("n_words"),
        chars.alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        (F.col("_lines.n") - F.col("_lines.d")).alias("n_dup_lines"),
        _repeated(F.col("_words")).alias("n_repeat_words"),
        F.col("_lines.n").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bin_of(value: Column, bits: int = 6) -> Column:
    """The value with all but its leading bits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, groups: tuple[str, str]) -> DataFrame:
    """Sketches per group and measure: ``lang, source, measure, bin, n``.

    Documents that fail the base rules, or have no words, shape no threshold.  Counts are
    summed in each task before they are shuffled, so a hot group sends bins, not rows.
    """
    values = F.array(
        *[
            F.struct(
                F.lit(m.name).alias("measure"), bin_of(F.expr(f"({m.value})")).alias("bin")
            )
            for m in MEASURES
        ]
    )
    rows = measured.where(~base_failed() & (F.col("word_chars") > 0))
    rows = rows.select(*groups, F.inline(values))
    return rows.groupBy(*groups, "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def _merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def _fences(sketch: DataFrame, keys: list[str], reach: int, least: int) -> DataFrame:
    """One row per group with enough rows: a struct (low, high) per measure."""
    group = Window.partitionBy(*keys, "measure")
    ranked = sketch.select(
        *keys,
        "measure",
        "bin",
        F.sum("n").over(group.orderBy("bin")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    ).where(F.col("total") >= least)
    quartiles = ranked.groupBy(*keys, "measure").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"),
    )
    gap = reach * (F.col("q3") - F.col("q1"))
    columns = []
    for m in MEASURES:
        mine = F.col("measure") == m.name
        room = F.greatest(gap, F.lit(m.slack))
        low = (F.col("q1") - room) if m.low else F.lit(None).cast("bigint")
        high = (F.col("q3") + room) if m.high else F.lit(None).cast("bigint")
        columns.append(
            F.max(F.when(mine, F.struct(low.alias("low"), high.alias("high")))).alias(m.name)
        )
    return quartiles.groupBy(*keys).agg(*columns)


def judge(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    groups: tuple[str, str] = ("lang", "source"),
    reach: int = 3,
    least: int = 200,
) -> DataFrame:
    """Per row: the base measures, ``base_failed`` and ``kept``.

    ``kept``: the base rules hold and each measure lies within the fences of the row's
    language and source.  A fence is ``reach`` interquartile ranges, and at least the
    measure's slack, beyond a quartile.  Groups of fewer than ``least`` rows take the fences
    of their language, then those of all rows; with none, only the base rules count.  NULL
    languages and sources are groups of their own.  One row out per row in.
    """
    lang, source = groups
    measured = stored(measure(docs, text, (doc_id, lang, source)), "measures")
    # An outer join with the fences on equal values; NULL is made a value of its own.
    tagged = measured.select(
        F.col(doc_id).alias("_id"),
        F.struct(F.col(lang)).alias("_lang"),
        F.struct(F.col(source)).alias("_source"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
    )
    own = stored(sketches(tagged, ("_lang", "_source")), "sketches")
    by_lang = _merge(own, ["_lang"])
    everything = _merge(own.withColumn("_all", F.lit(1)), ["_all"])
    names = [m.name for m in MEASURES]
    tiers = [
        (_fences(own, ["_lang", "_source"], reach, least), ["_lang", "_source"]),
        (_fences(by_lang, ["_lang"], reach, least), ["_lang"]),
        (_fences(everything, ["_all"], reach, 1), ["_all"]),
    ]
    joined = tagged.withColumn("_all", F.lit(1))
    for number, (fences, keys) in enumerate(tiers):
        named = fences.select(*keys, F.struct(*names).alias(f"_fence{number}"))
        joined = joined.join(named, keys, "left")
    fence = F.coalesce("_fence0", "_fence1", "_fence2")
    inside = F.lit(True)
    for m in MEASURES:
        value, limits = F.expr(f"({m.value})"), fence[m.name]
        inside = inside & F.coalesce(value >= limits["low"], F.lit(True))
        inside = inside & F.coalesce(value <= limits["high"], F.lit(True))
    failed = base_failed()
    return joined.select(
        F.col("_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed | (F.col("word_chars") == 0), F.lit(False)).otherwise(inside).alias("kept"),
    )
