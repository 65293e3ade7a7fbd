"""Benchmark decontamination by a generalised suffix automaton of the items' words.

The automaton holds every run of words of every item.  A document's words are streamed
through it; after each word it knows the longest run of words ending there that some item
has.  Where that run is at least a window long, the last window of it is an occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import Shared, pieces, utf8

# Word bytes are digits, a-z and everything beyond ASCII; A-Z fold to a-z, the rest splits.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

_OUT = (
    "_item_ids array<string>, _n_words bigint, _n_hit bigint, "
    "_spans array<struct<start:int,end:int>>"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over words; states are numbered, 0 is the empty run."""

    def __init__(self, items: Iterable[tuple[str, Sequence[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set[str]] = [set()]
        self.short: dict[int, list[tuple[int, str]]] = {}
        ends: list[tuple[int, str, int]] = []
        for name, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word, owners)
                ends.append((last, name, len(words)))
            if words and len(words) < window:
                self.short.setdefault(last, []).append((len(words), name))
        for state, name, _ in ends:
            # A run belongs to the item as do all shorter runs that end where it ends.
            while state > 0 and self.length[state] >= window and name not in owners[state]:
                owners[state].add(name)
                state = self.link[state]
        # Items of the window that a run of at least its length ends with.
        self.items: list[frozenset | None] = [None] * len(self.link)
        self.shorts: list[tuple] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            own = tuple(self.short.get(state, ()))
            self.shorts[state] = own + self.shorts[up]
            if self.length[state] >= window:
                if self.length[up] < window:
                    self.items[state] = frozenset(owners[state])
                else:
                    self.items[state] = self.items[up]

    def _extend(self, last: int, word: bytes, owners: list[set[str]]) -> int:
        nexts, link, length = self.next, self.link, self.length
        there = nexts[last].get(word)
        if there is not None:
            if length[there] == length[last] + 1:
                return there
            return self._clone(last, word, there, owners)
        new = self._state(length[last] + 1, {}, owners)
        state = last
        while state != -1 and word not in nexts[state]:
            nexts[state][word] = new
            state = link[state]
        if state == -1:
            link[new] = 0
        elif length[nexts[state][word]] == length[state] + 1:
            link[new] = nexts[state][word]
        else:
            link[new] = self._clone(state, word, nexts[state][word], owners)
        return new

    def _state(self, length: int, nexts: dict, owners: list[set[str]]) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(0)
        owners.append(set())
        return len(self.link) - 1

    def _clone(self, state: int, word: bytes, there: int, owners: list[set[str]]) -> int:
        copy = self._state(self.length[state] + 1, dict(self.next[there]), owners)
        self.link[copy] = self.link[there]
        self.link[there] = copy
        while state != -1 and self.next[state].get(word) == there:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def find(self, words: Sequence[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items with an occurring window, and the covered word ranges ``[start, end)``."""
        nexts, link, length = self.next, self.link, self.length
        items, shorts, window, root = self.items, self.shorts, self.window, self.next[0]
        names: set[str] = set()
        spans: list[list[int]] = []
        state, run = 0, 0
        for at, word in enumerate(words):
            there = nexts[state].get(word)
            if there is None:
                if word not in root:
                    state = run = 0
                    continue
                while there is None:
                    state = link[state]
                    there = nexts[state].get(word)
                run = length[state]
            state, run = there, run + 1
            if run >= window:
                names |= items[state]
                reach = window
            elif shorts[state]:
                reach = 0
            else:
                continue
            for size, name in shorts[state]:
                if size <= run:
                    names.add(name)
                    reach = max(reach, size)
            if reach:
                start = at + 1 - reach
                while spans and start <= spans[-1][0]:
                    spans.pop()
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = at + 1
                else:
                    spans.append([start, at + 1])
        return names, [(a, b) for a, b in spans]


def _stream(shared: Shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = shared.load()
        for batch in batches:
            ids, counts, hits, spans = [], [], [], []
            for _, texts in pieces(batch, "_text"):
                for text in texts:
                    words = words_of(text)
                    names, found = automaton.find(words)
                    ids.append(sorted(names))
                    counts.append(len(words))
                    hits.append(sum(b - a for a, b in found))
                    spans.append([{"start": a, "end": b} for a, b in found])
            rest = [c for c in batch.schema.names if c != "_text"]
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in rest),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array(spans, span),
                ],
                names=[*rest, "_item_ids", "_n_words", "_n_hit", "_spans"],
            )

    return run


def _blocks(items: DataFrame, most_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of at most so many words (an item alone may be longer)."""
    block, size = [], 0
    for row in items.toLocalIterator():
        words = words_of(bytes(row[1]))
        if block and size + len(words) > most_words:
            yield block
            block, size = [], 0
        if words:
            block.append((str(row[0]), words))
            size += len(words)
    yield block


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: tuple[int, int] = (1, 20),
    keep: Sequence[str] = (),
    block_words: int = 200_000,
) -> DataFrame:
    """Per document: what it shares with the items.

    Columns: ``doc_id``, ``keep``, n_words, n_hit (words inside an occurrence of a window),
    item_ids (items with an occurring window, as text, sorted), spans (covered word ranges),
    contaminated (n_hit at least the ``share`` of n_words, and not 0).

    One row out per row in, repeated rows included; NULL and empty texts have no words.
    Items are a stated query set: an automaton holds at most ``block_words`` of their words
    (about half a kilobyte each), and more items mean more passes over the documents, whose
    results are merged by position.  Items of equal id count once; NULL ids read ``None``.
    """
    names = [doc_id, *keep]
    done = _found(docs, items, names, text, item_id, item_text, window, block_words)
    return done.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)],
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.col("_item_ids").alias("item_ids"),
        F.col("_spans").alias("spans"),
        _contaminated(share).alias("contaminated"),
    )


def _contaminated(share: tuple[int, int]) -> Column:
    part, whole = share
    n_words, n_hit = F.col("_n_words"), F.col("_n_hit")
    return (n_hit > 0) & (n_hit * whole >= n_words * part)


def _found(
    docs: DataFrame,
    items: DataFrame,
    names: Sequence[str],
    text: str,
    item_id: str,
    item_text: str,
    window: int,
    block_words: int,
) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], utf8(text).alias("_text")
    )
    kinds = ", ".join(f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    wanted = items.select(F.col(item_id).cast("string"), utf8(item_text))
    blocks = [
        Shared(spark, Automaton(block, window)) for block in _blocks(wanted, block_words)
    ]
    if len(blocks) == 1:
        return rows.mapInArrow(_stream(blocks[0]), f"{kinds}, {_OUT}")
    rows = rows.withColumn("_digest", F.sha2("_text", 256))
    schema = f"{kinds}, _digest string, {_OUT}"
    return _merged([rows.mapInArrow(_stream(b), schema) for b in blocks], list(names))


def _merged(passes: list[DataFrame], names: list[str]) -> DataFrame:
    """One row per document from one row per document and block of items.

    The text's digest is among the keys, so rows that meet have equal results; equal rows
    are numbered within a block and come back as often as they occur.
    """
    keys = [f"_k{i}" for i in range(len(names))] + ["_digest"]
    every = passes[0].withColumn("_block", F.lit(0))
    for number, found in enumerate(passes[1:], 1):
        every = every.unionByName(found.withColumn("_block", F.lit(number)))
    place = Window.partitionBy(*keys, "_block").orderBy(F.lit(0))
    every = every.withColumn("_nth", F.row_number().over(place))
    merged = every.groupBy(*keys, "_nth").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_item_ids")))).alias("_item_ids"),
        F.max("_n_words").alias("_n_words"),
        F.array_sort(F.flatten(F.collect_list("_spans"))).alias("_all"),
    )
    joined = F.aggregate(
        "_all",
        F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda found, s: F.when(
            (F.size(found) > 0) & (s["start"] <= F.element_at(found, -1)["end"]),
            F.concat(
                F.slice(found, 1, F.size(found) - 1),
                F.array(
                    F.struct(
                        F.element_at(found, -1)["start"].alias("start"),
                        F.greatest(F.element_at(found, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(found, F.array(s))),
    )
    merged = merged.withColumn("_spans", joined)
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return merged.withColumn("_n_hit", hit)


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: tuple[int, int] = (1, 20),
    block_words: int = 200_000,
) -> DataFrame:
    """The documents, all columns, that are not contaminated; rows are judged one by one."""
    names = docs.columns
    found = _found(docs, items, names, text, item_id, item_text, window, block_words)
    return found.where(~_contaminated(share)).select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)]
    )


def remove_spans(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: tuple[int, int] = (1, 20),
    block_words: int = 200_000,
) -> DataFrame:
    """All documents, all columns, with the covered words cut out of contaminated texts.

    A cut reaches from a span's first word to the next word after it.
    """
    names = docs.columns
    found = _found(docs, items, names, text, item_id, item_text, window, block_words)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if t is None else without(t, [(s["start"], s["end"]) for s in spans])
                for t, spans in zip(
                    batch.column("_cut").to_pylist(), batch.column("_spans").to_pylist(), strict=True
                )
            ]
            rest = [c for c in batch.schema.names if c not in ("_cut", "_spans")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(texts, pa.string())],
                names=[*rest, "_cut"],
            )

    at = names.index(text)
    held = [f"_k{i}" for i in range(len(names)) if i != at]
    rows = found.select(
        *held,
        F.col(f"_k{at}").cast("string").alias("_cut"),
        F.when(_contaminated(share), F.col("_spans")).otherwise(F.array()).alias("_spans"),
    )
    kinds = "".join(f"{h} {rows.schema[h].dataType.simpleString()}, " for h in held)
    done = rows.mapInArrow(cut, f"{kinds}_cut string")
    return done.select(
        *[
            F.col("_cut" if i == at else f"_k{i}").alias(c)
            for i, c in enumerate(names)
        ]
    )


def without(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without the words of the ranges ``[start, end)``."""
    if not spans:
        return text
    folded = text.encode("utf-8").translate(_FOLD)
    raw = text.encode("utf-8")
    starts = [m.start() for m in re.finditer(rb"[^ ]+", folded)] + [len(raw)]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : starts[a]])
        done = starts[b]
    return b"".join([*out, raw[done:]]).decode("utf-8")
