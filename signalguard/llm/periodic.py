"""Periodic runs of words: stretches that say the same few words over and over.

Per text an enhanced suffix array (suffix array, its inverse, longest common prefixes) stands
in for the suffix tree.  An LCP interval of depth ``d`` holds the suffixes that share their
first ``d`` words.  A square of period ``d`` that its right neighbour ends is a pair of
suffixes ``d`` apart in different children of such an interval, so it suffices to ask for
every suffix ``i`` outside the largest child whether the suffixes ``i + d`` and ``i - d`` lie
in the interval too: O(n log n) questions.  Rotating a square to the left while it stays one
gives the start of its run, and equal stretches merge into the run of the smallest period.

Many texts are worked on at once as NumPy arrays; words are told apart by text, so that no
suffix of one text shares a word with another's.  A task holds some 250,000 words, or one
text; a text with repeats of up to ``m`` words costs about ``4 log2 m`` bytes a word more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalguard.llm.base import utf8

#: Words of one round of array work; a longer text is a round of its own.
ROUND_WORDS = 250_000
#: Suffixes of small children that are looked at together.
ROUND_SUFFIXES = 2_000_000

RUN = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add(
    "period", T.LongType()
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, inverse, and for each k the ranks of the suffixes' first 2^k keys.

    Prefix doubling: a round sorts only the suffixes that still share a rank.  Two suffixes
    have the same rank of level k just where their first 2^k keys agree.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    places = np.arange(n)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # past the end
    rank[order] = _group_starts(keys[order], places)
    levels: list[np.ndarray] = []
    step = 1
    open_places = _shared(rank[order], places)
    while len(open_places):
        levels.append(rank[:n].astype(np.int32))
        suffixes = order[open_places]
        pairs = rank[suffixes] * (n + 1) + rank[np.minimum(suffixes + step, n)] + 1
        by_pair = np.argsort(pairs, kind="stable")
        suffixes, pairs = suffixes[by_pair], pairs[by_pair]
        order[open_places] = suffixes
        starts = _group_starts(pairs, open_places)
        rank[suffixes] = starts
        open_places = _shared(starts, open_places)
        step *= 2
    return order, rank[:n], levels


def _group_starts(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For sorted values: the place of the first of each group of equal ones."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return np.repeat(places[first], np.diff(np.append(np.flatnonzero(first), len(values))))


def _shared(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places whose rank another place has too; equal ranks are neighbours."""
    same = np.zeros(len(ranks) + 1, bool)
    same[1:-1] = ranks[1:] == ranks[:-1]
    return places[same[1:] | same[:-1]]


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of each suffix and the one before it in the order; 0 at both ends."""
    lcp = np.zeros(len(order) + 1, np.int64)
    if not levels:
        return lcp
    first = levels[0][order]
    places = np.flatnonzero(first[1:] == first[:-1]) + 1
    a, b = order[places - 1], order[places]
    length = np.zeros(len(places), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + length] == levels[k][b + length]
        length[same] += 1 << k
    lcp[places] = length
    return lcp


def _next(values: np.ndarray, places: np.ndarray, strictly: bool) -> np.ndarray:
    """For each place the next one with a smaller (or, not strictly, no larger) value.

    The last value must be 0 and those asked for larger.  A place whose next one is no answer
    takes that one's next, so the distances about double with every round.
    """
    following = np.arange(1, len(values) + 1)
    asked = places
    while len(asked):
        target = following[asked]
        own, there = values[asked], values[target]
        missed = there >= own if strictly else there > own
        asked = asked[missed]
        following[asked] = following[target[missed]]
    return following[places]


def squares(
    keys: np.ndarray, order: np.ndarray, rank: np.ndarray, lcp: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square whose next word breaks the period."""
    places = np.flatnonzero(lcp)
    if not len(places):
        return places, places
    depth = lcp[places]
    end = _next(lcp, places, strictly=True)
    child_end = _next(lcp, places, strictly=False)
    n = len(lcp) - 1
    start = n - _next(lcp[::-1], n - places[::-1], strictly=True)[::-1]
    # An interval is known by where it starts and its depth; its first border comes first.
    _, first, interval = np.unique(
        start * (depth.max() + 1) + depth, return_index=True, return_inverse=True
    )
    low = np.concatenate([places, start[first]])
    high = np.concatenate([child_end, places[first]])
    of = np.concatenate([interval, np.arange(len(first))])
    by_size = np.lexsort((high - low, of))
    small = by_size[:-1][of[by_size[1:]] == of[by_size[:-1]]]  # all but each interval's largest
    low, size, of = low[small], (high - low)[small], of[small]
    depth, start, end = depth[first], start[first], end[first]
    starts, periods = [], []
    until = np.cumsum(size)
    at = 0
    while at < len(size):
        done = until[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(until, done + ROUND_SUFFIXES, "right")))
        count = size[at:upto]
        offset = np.arange(count.sum()) - np.repeat(until[at:upto] - count - done, count)
        suffix = order[np.repeat(low[at:upto], count) + offset]
        group = np.repeat(of[at:upto], count)
        d, lowest, highest = depth[group], start[group], end[group]
        for left in (suffix, suffix - d):
            right = left + d
            other = right if left is suffix else left
            known = (other >= 0) & (other < n)
            other_rank = rank[np.where(known, other, 0)]
            inside = known & (other_rank >= lowest) & (other_rank < highest)
            left_in, d_in = left[inside], d[inside]
            breaks = keys[left_in + d_in] != keys[left_in + 2 * d_in]
            starts.append(left_in[breaks])
            periods.append(d_in[breaks])
        at = upto
    pairs = np.unique(np.concatenate(starts) * (n + 1) + np.concatenate(periods))
    return pairs // (n + 1), pairs % (n + 1)


def runs_of(
    keys: np.ndarray, least_length: int, least_repeats: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and then period.

    ``keys`` tell words apart; every text ends with a key that occurs nowhere else.
    """
    order, rank, levels = suffix_order(keys)
    start, period = squares(keys, order, rank, common_prefixes(order, levels))
    end = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        before = start - (1 << k)
        turned = before >= 0
        at = before[turned]
        turned[turned] = levels[k][at] == levels[k][at + period[turned]]
        start = np.where(turned, before, start)
    length = end - start
    long = length >= np.maximum(least_length, least_repeats * period)
    start, end, period = start[long], end[long], period[long]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _round(texts: list[list[bytes]], least_length: int, least_repeats: int):
    """(runs, collapsed text) of each list of words."""
    sizes = np.array([len(words) for words in texts])
    ends = np.cumsum(sizes + 1)  # a text's words and its end
    firsts = ends - sizes - 1
    codes, known = pd.factorize(
        np.fromiter((w for words in texts for w in (*words, b"")), object, ends[-1])
    )
    width = len(known)
    keys = codes + np.repeat(np.arange(len(texts)) * width, sizes + 1)
    start, end, period = runs_of(keys, least_length, least_repeats)
    owner = np.searchsorted(ends, start, "right")
    change = np.zeros(len(keys) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change)[:-1] == 0
    cut = {}
    for text, s, e, p in zip(
        owner.tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True
    ):
        first = int(firsts[text])
        cut.setdefault(text, []).append({"start": s - first, "length": e - s, "period": p})
    for i, words in enumerate(texts):
        if i in cut:
            first = firsts[i]
            words = [w for w, k in zip(words, kept[first : first + sizes[i]], strict=True) if k]
        yield cut.get(i, []), b" ".join(words)


def find_runs(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    least_length: int = 6,
    least_repeats: int = 4,
    runs: str = "runs",
    collapsed: str = "collapsed",
) -> DataFrame:
    """All periodic runs of each text, and the text without the repeats.

    A word is a stretch without ASCII white space; words are numbered from 0.  A run is a
    longest stretch in which words ``period`` apart are equal, ``period`` being its smallest,
    of at least ``least_length`` words and ``least_repeats`` periods (two at least).
    ``runs`` has them as (start, length, period) by start and then period; ``collapsed`` joins
    the words by one space, without those that a run holds after its first period.

    One row out per row in, nothing is shuffled, and rows do not see each other: ids may
    repeat or be NULL.  A NULL, empty or blank text has no runs and collapses to an empty
    text; an empty table gives an empty one.  Long texts are worked on whole.  ``keep`` are
    the columns to carry, which may have any names but those of the two results; others
    are not read, whatever their names.
    """
    if least_repeats < 2:
        raise ValueError("a run has two periods at least")
    clash = {runs, collapsed} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results; name them differently")
    # The carried columns travel as one struct, so that no name can clash on the way.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("row"),
        utf8(text).alias("data"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, first = batch.column("data"), 0
            texts: list[list[bytes]] = []
            held = 0
            for i in range(len(data)):
                texts.append(data[i].as_py().split())
                held += len(texts[-1])
                if held >= ROUND_WORDS or i + 1 == len(data):
                    found, short = zip(*_round(texts, least_length, least_repeats), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row").slice(first, len(texts)),
                            pa.array(found, pa.list_(_RUN)),
                            pa.array(short, pa.binary()),
                        ],
                        names=["row", "runs", "collapsed"],
                    )
                    first, texts, held = i + 1, [], 0

    schema = (
        T.StructType()
        .add("row", rows.schema["row"].dataType)
        .add("runs", T.ArrayType(RUN))
        .add("collapsed", T.BinaryType())
    )
    found = rows.mapInArrow(work, schema)
    return found.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)],
        F.col("runs").alias(runs),
        F.col("collapsed").cast("string").alias(collapsed),
    )


def with_planted_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with a tail of every tenth text made periodic, as a test of the search.

    Let ``h`` be the CRC-32 of the key as text and ``g = h // 10``.  Where 10 divides ``h``
    and there are ``n > 0`` words, word ``i >= a`` becomes word ``a + (i - a) % p`` with
    ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``.  Other rows stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def turned(words):
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        chosen = F.transform(
            words,
            lambda w, i: F.when(i < a, w).otherwise(
                F.element_at(words, (a + (i - a) % p + 1).cast("int"))
            ),
        )
        return F.when(n > 0, F.array_join(chosen, " ")).otherwise(F.lit(""))

    # A one-element array binds the words to a name, so that they are split once.
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    planted = F.element_at(F.transform(F.array(words), turned), 1)
    return df.withColumn(text, F.when(h % 10 == 0, planted).otherwise(F.col(text)))
