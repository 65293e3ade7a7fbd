"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed byte trigrams, of pairs of neighbouring word shapes, and
of repetition.  Counts are damped, weighted by rarity, and projected on the leading
singular vectors of a bounded sample of labelled texts.  The sample's projected vectors are
broadcast; each document is compared with all of them, block by block, and its nearest
neighbours vote with their cosine as weight.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import Shared, pieces, stored, utf8

GRAMS = 2048  # hashed byte trigrams
SHAPES = 24  # kinds of words
LEVELS = 21  # of repetition
WIDTH = GRAMS + SHAPES * SHAPES + 2 * LEVELS
_BLOCKS = ((0, GRAMS, 1.0), (GRAMS, GRAMS + SHAPES * SHAPES, 1.0), (WIDTH - 2 * LEVELS, WIDTH, 0.7))
_UPPER = frozenset(range(65, 91))
_LOWER = frozenset(range(97, 123))
_DIGIT = frozenset(range(48, 58))


def shape(word: bytes) -> int:
    """Case and make-up of a word (6 kinds) and its last byte (4 kinds)."""
    letters = [c for c in word if c in _UPPER or c in _LOWER or c >= 128]
    upper = sum(c in _UPPER for c in word)
    if not letters:
        kind = 5 if any(c in _DIGIT for c in word) else 4
    elif upper > 1 and upper * 2 > len(letters):
        kind = 3
    elif upper:
        kind = 1 if word[0] in _UPPER else 2
    else:
        kind = 0
    last = word[-1]
    if last >= 128 or last in _LOWER or last in _UPPER or last in _DIGIT:
        return kind * 4
    return kind * 4 + (1 if last in b".?" else 2 if last in b",;:" else 3)


def _level(part: int, whole: int) -> int:
    return part * (LEVELS - 1) // whole if whole else 0


class Counter:
    """Feature counts of texts; remembers the shapes of words up to a bound."""

    def __init__(self, most: int = 300_000):
        self.shapes: dict[bytes, int] = {}
        self.most = most

    def counts(self, text: bytes) -> np.ndarray:
        row = np.zeros(WIDTH, dtype=np.float32)
        data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
        if len(data) > 2:
            code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
            row[:GRAMS] = np.bincount(code >> 21, minlength=GRAMS)
        words = text.split()
        if not words:
            return row
        known = self.shapes
        if len(known) > self.most:
            known.clear()
        kinds = np.zeros(len(words), dtype=np.int64)
        for i, w in enumerate(words):
            kind = known.get(w)
            if kind is None:
                kind = known[w] = shape(w)
            kinds[i] = kind
        pairs = np.append(kinds[:-1] * SHAPES + kinds[1:], kinds[-1] * (SHAPES + 1))
        row[GRAMS : GRAMS + SHAPES * SHAPES] = np.bincount(pairs, minlength=SHAPES * SHAPES)
        again = len(words) - len(set(words))
        same = sum(map(bytes.__eq__, words, words[1:]))
        row[WIDTH - 2 * LEVELS + _level(again, len(words))] = 1
        row[WIDTH - LEVELS + _level(same, len(words))] = 1
        return row


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts times rarity; each block of features has its own unit length."""
    x = np.log1p(counts) * rarity
    for start, end, weight in _BLOCKS:
        norm = np.sqrt(np.einsum("ij,ij->i", x[:, start:end], x[:, start:end]))[:, None]
        x[:, start:end] *= weight / np.maximum(norm, 1e-9)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Neighbours:
    """The fitted space and the labelled vectors; its size is set by the sample's bound."""

    rarity: np.ndarray
    centre: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    nearest: int
    sharpness: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        return _unit((_weighted(counts, self.rarity) - self.centre) @ self.axes)

    def scores(self, counts: np.ndarray, block: int = 256) -> np.ndarray:
        """Votes of the nearest labelled vectors, by exact cosine products in blocks."""
        if not len(self.labels):
            return np.zeros(len(counts))
        out = np.empty(len(counts))
        k = min(self.nearest, len(self.labels))
        for b in range(0, len(counts), block):
            cosine = self.place(counts[b : b + block]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6) ** self.sharpness
            out[b : b + block] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        empty = ~counts[:, WIDTH - LEVELS :].any(axis=1)
        return np.where(empty, 0.0, np.clip(out, 0.0, 1.0))


def _count_sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in batches:
        label = batch.column("_label")
        for first, texts in pieces(batch, "_text", 1 << 20):
            rows = [counter.counts(t).astype(np.uint32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    label.slice(first, len(texts)),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                names=["_label", "_counts"],
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_labelled: int = 4096,
    dimensions: int = 64,
    nearest: int = 15,
    sharpness: float = 4.0,
) -> Neighbours:
    """Fit on at most ``most_labelled`` labelled documents, those of least id hash.

    Several labels of an id are averaged; NULL labels and ids are left out.  The sample's
    counts come to the driver (10 kB each), nothing else does.  Without labelled rows the
    model scores every text 0.
    """
    marks = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_label"))
    marks = marks.where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
    marks = marks.groupBy("_id").agg(F.avg("_label").alias("_label"))
    # Ids are chosen without their texts; only those of the sample are fetched.
    there = docs.select(F.col(doc_id).alias("_id"))
    chosen = (
        marks.join(there, "_id", "left_semi")
        .withColumn("_hash", F.xxhash64("_id"))
        .orderBy("_hash", "_label")
        .limit(most_labelled)
    )
    chosen = stored(chosen, "quality-sample")
    rows = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_text"))
    sample = (
        rows.join(chosen, "_id")
        .select("_label", "_text", "_hash")
        .orderBy("_hash", "_label", F.length("_text"))
        .limit(most_labelled)
    )
    got = sample.drop("_hash").mapInArrow(_count_sample, "_label double, _counts binary")
    table = got.toArrow()
    y = np.array(table["_label"].to_pylist(), dtype=np.float32)
    if not len(y):
        none = np.zeros((0, WIDTH), dtype=np.float32)
        return Neighbours(none, none, none, none, y, nearest, sharpness)
    counts = np.stack(
        [np.frombuffer(c, dtype=np.uint32) for c in table["_counts"].to_pylist()]
    ).astype(np.float32)
    rarity = (np.log((1 + len(y)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _weighted(counts, rarity)
    centre = x.mean(axis=0)
    axes = _leading_axes(x - centre, dimensions)
    return Neighbours(rarity, centre, axes, _unit((x - centre) @ axes), y, nearest, sharpness)


def _leading_axes(x: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration."""
    count = min(count, *x.shape)
    start = np.random.default_rng(seed).standard_normal((x.shape[1], count + 8))
    q = np.linalg.qr(x.T @ (x @ start.astype(np.float32)))[0]
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ turn.T)[:, :count].astype(np.float32)


def _vote(shared: Shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Neighbours = shared.load()
        counter = Counter()
        for batch in batches:
            scores: list[np.ndarray] = []
            for _, texts in pieces(batch, "_text"):
                for b in range(0, len(texts), 1024):
                    counts = np.stack([counter.counts(t) for t in texts[b : b + 1024]])
                    scores.append(model.scores(counts))
            found = np.concatenate(scores) if scores else np.zeros(0)
            rest = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(found.astype(float))],
                names=[*rest, "_score"],
            )

    return run


def score_quality(
    docs: DataFrame, model: Neighbours, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` and ``score``: 0 to 1, higher where label 1 is likelier.

    One row out per row in, repeated rows included.  NULL texts and texts without a word
    score 0.  Equal texts score equally.
    """
    shared = Shared(docs.sparkSession, model)
    rows = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], utf8(text).alias("_text")
    )
    kinds = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    done = rows.mapInArrow(_vote(shared), f"{kinds}_score double")
    return done.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias("score")
    )
