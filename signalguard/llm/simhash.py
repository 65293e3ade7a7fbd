"""Near-duplicate documents by SimHash, found through pivot distance tables.

Fingerprints link where at most three of 64 bits differ.  Five blocks of bits hold three
differences in at most three of them, so linked fingerprints agree in two blocks: each pair
of blocks is a key, and candidates share a key.  Among them the pivot table decides first:
the distances of every fingerprint to many reference fingerprints are computed once, and a
pair whose distances to any one of them differ by more than three cannot be linked (triangle
inequality).  Survivors are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import LOWER, as_row, from_row, pieces, stored, utf8
from signalguard.llm.components import components

BLOCKS = (13, 13, 13, 13, 12)  # bits
PIVOTS = 24
_CELL = 4096  # fingerprints of one key that are compared in one place


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half the hashes of the word shingles."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:count].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for b in range(0, count, 65536):
        part = hashes[b : b + 65536]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                fingerprint(t, shingle) for _, texts in pieces(batch, "_text") for t in texts
            ]
            bits = pa.array(np.array(found, dtype="<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), bits],
                names=["doc_id", "version", "bits"],
            )

    return run


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of their numbers."""
    return np.array(
        [xxhash.xxh64_intdigest(str(i).encode(), 1) for i in range(count)], dtype=np.uint64
    )


def pivot_table(bits: np.ndarray, references: np.ndarray) -> np.ndarray:
    """A row of distances per reference fingerprint."""
    return np.stack([np.bitwise_count(bits ^ r) for r in references]).astype(np.int8)


def linked(
    table: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) at most ``most`` bits apart: by the table first, then by the bits."""
    for row in table:
        near = np.abs(row[i] - row[j]) <= most
        i, j = i[near], j[near]
        if not len(i):
            return i, j
    near = np.bitwise_count(bits[i] ^ bits[j]) <= most
    return i[near], j[near]


class _Forest:
    """Union-find over the rows of a batch; keeps the links that joined two trees."""

    def __init__(self, size: int):
        self.up = np.arange(size)
        self.used: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if (higher == self.up).all():
                return self.up
            self.up = higher

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        up = self.up
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = a, b
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)
                self.used.append((a, b))


def _spanning_links(cell: np.ndarray, bits: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected within each run of equal ``cell``.

    Rows are compared with those one, two, ... places on, all runs at once; pairs that
    already hang together are left out.  A run of n rows gives at most n - 1 links.
    """
    table = pivot_table(bits, pivots())
    forest = _Forest(len(bits))
    ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell))
    left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(cell)) - 1
    step = 1
    at = np.flatnonzero(left >= step)
    while len(at):
        roots = forest.roots()
        apart = at[roots[at] != roots[at + step]]
        i, j = linked(table, bits, apart, apart + step, most)
        forest.add(i, j)
        step += 1
        at = at[left[at] >= step]
    return iter(forest.used)


def _link_cells(most: int):
    """Links within cells; a cell's rows are neighbours, possibly over several batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 3), dtype=np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy() for c in ("key", "pair", "bits")])
            rows = np.concatenate([rest, rows])
            if not len(rows):
                continue
            other = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield _links_of(rows[:cut], most)
            rest = rows[cut:]
        if len(rest):
            yield _links_of(rest, most)

    return run


def _links_of(rows: np.ndarray, most: int) -> pa.RecordBatch:
    cells = np.cumsum(np.append(0, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
    bits = rows[:, 2].view(np.uint64)
    found = np.array(list(_spanning_links(cells, bits, most)), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[found[:, 0], 2]), pa.array(rows[found[:, 1], 2])], names=["a", "b"]
    )


def keys_of(
    bits: str = "bits", blocks: tuple[int, ...] = BLOCKS, agree: int = 2
) -> list[Column]:
    """One key per choice of ``agree`` blocks: the choice's number and the blocks' bits."""
    c, starts = F.col(bits), [sum(blocks[:i]) for i in range(len(blocks))]
    block = [
        F.call_function("shiftrightunsigned", c, F.lit(s)).bitwiseAND(F.lit((1 << w) - 1))
        for s, w in zip(starts, blocks, strict=True)
    ]
    keys = []
    for number, chosen in enumerate(combinations(range(len(blocks)), agree)):
        key = F.lit(number).cast("bigint")
        for i in chosen:
            key = F.call_function("shiftleft", key, F.lit(blocks[i])) + block[i]
        keys.append(key)
    return keys


def find_links(distinct: DataFrame, most: int = 3, cell: int = _CELL) -> DataFrame:
    """Links (a, b) that connect fingerprints ``bits`` exactly as all links would.

    A key of more than ``cell`` fingerprints is dealt out: its fingerprints are hashed into
    groups, and each pair of groups is a cell of its own, so a task compares a bounded
    number whatever the size of the key.
    """
    if most > len(BLOCKS) - 2:
        raise ValueError(f"{len(BLOCKS)} blocks find at most {len(BLOCKS) - 2} differences")
    keyed = distinct.select("bits", F.explode(F.array(*keys_of())).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = keyed.join(sizes, "key")
    groups = F.ceil(F.col("n") / cell).cast("int")
    group = F.pmod(F.xxhash64("bits"), groups).cast("int")
    low, high = F.least(F.col("mine"), F.col("other")), F.greatest(F.col("mine"), F.col("other"))
    dealt = sized.select(
        "key",
        "bits",
        group.alias("mine"),
        F.explode(F.sequence(F.lit(0), groups - 1)).alias("other"),
    ).select(
        "key",
        (F.call_function("shiftleft", low.cast("bigint"), F.lit(32)) + high).alias("pair"),
        "bits",
    )
    return (
        dealt.repartition("key", "pair")
        .sortWithinPartitions("key", "pair", "bits")
        .mapInArrow(_link_cells(most), "a bigint, b bigint")
    )


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, most: int) -> DataFrame:
    """doc_id, version (hash of the text), bits and component (a fingerprint) of every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), utf8(text).alias("_text")
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    marked = stored(
        rows.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, version bigint, bits bigint"),
        "fingerprints",
    )
    distinct = stored(marked.select("bits").distinct(), "distinct_fingerprints")
    found = components(find_links(distinct, most))
    named = distinct.join(found, distinct["bits"] == found["node"], "left").select(
        "bits", F.coalesce("component", "bits").alias("component")
    )
    return marked.join(named, "bits")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    most: int = 3,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least id of its group).

    One row out per row in.  NULL texts and texts without words have fingerprint zero and
    are linked like any other.  A row of NULL id belongs to a group but never names it; a
    group of such rows alone has a NULL component.  Equal fingerprints are compared once,
    however many documents have them.
    """
    grouped = stored(_grouped(docs, doc_id, text, shingle, most), "document_groups")
    names = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(names, "component").select(
        F.col("doc_id").alias(doc_id),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    most: int = 3,
) -> DataFrame:
    """One document of each group, with all columns: the one of least id, NULL ids last.

    Of rows with the same id in a group the one of least text hash stays, once.
    """
    grouped = _grouped(docs, doc_id, text, shingle, most)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version")
    first = grouped.groupBy("component").agg(F.min(rank).alias("_first"))
    winners = first.select(
        F.struct("_first.last", "_first.doc_id", "_first.version").alias("key")
    ).distinct()
    key = F.struct(
        F.col(doc_id).isNull().alias("last"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("version"),
    )
    rows = docs.select(key.alias("key"), as_row(docs).alias("row"))
    kept = rows.join(winners, "key", "left_semi").dropDuplicates(["key"])
    return kept.select(*from_row(docs.columns))
