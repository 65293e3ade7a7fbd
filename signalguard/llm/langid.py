"""Language identification by segmentation-marginalised unigrams.

A language gives each piece of a fixed public vocabulary a probability.  The probability of
a word is the sum, over all ways to cut it into pieces, of the product of the pieces'
probabilities; the forward algorithm adds them up without listing them.  A text is the
product of its words.  Words are maximal runs of letters, lower-cased, with the
vocabulary's mark of a word's start in front.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import pieces, stored, utf8

START = "▁"  # the vocabulary's mark of a word's start
UNDETERMINED = "und"
_LETTERS = regex.compile(r"\p{L}+")
_WIDE = 48  # longer words take the path that rescales at every step
_FLUSH = 400_000  # distinct words a task holds before it hands them on


def words_of(text: bytes) -> list[str]:
    return _LETTERS.findall(text.decode("utf-8", "replace").lower())


class Lattice:
    """All pieces of the vocabulary inside a word, found through one sorted trie."""

    def __init__(self, vocabulary: Sequence[str]):
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, int] = {}
        self.size = len(vocabulary)
        for number, piece in enumerate(vocabulary):
            node = 0
            for letter in piece:
                node = nodes.setdefault((node, letter), len(nodes) + 1)
            ends[node] = number
        self.longest = max(map(len, vocabulary), default=1)
        keys = np.array([n << 21 | ord(c) for n, c in nodes], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.child = np.append(np.fromiter(nodes.values(), np.int64, len(nodes))[order], 0)
        self.piece = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())

    def edges(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of words of one length, by rising start.

        ``letters`` has a row per word.  A letter outside the vocabulary is the piece
        ``size``, the unknown.
        """
        count, length = letters.shape
        for start in range(length):
            rows, node = np.arange(count), np.zeros(count, dtype=np.int64)
            lone = np.ones(count, dtype=bool)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                key = node << 21 | letters[rows, end - 1]
                at = np.searchsorted(self.keys, key)
                going = self.keys[at] == key
                rows, node = rows[going], self.child[at[going]]
                piece = self.piece[node]
                whole = piece >= 0
                if whole.any():
                    if end == start + 1:
                        lone[rows[whole]] = False
                    yield start, end, rows[whole], piece[whole]
                if not len(rows):
                    break
            if lone.any():
                found = np.flatnonzero(lone)
                yield start, start + 1, found, np.full(len(found), self.size)


def lattice(model_file: str) -> Lattice:
    return Lattice(vocabulary(model_file))


def vocabulary(model_file: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model, with no part of the space of a gap."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    names = [
        model.id_to_piece(i)
        for i in range(model.vocab_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    return [n for n in names if regex.fullmatch(f"{START}?\\p{{L}}+|{START}", n)]


def by_length(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, letters) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        text = "".join(START + words[i] for i in at)
        letters = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        yield at, letters.reshape(len(at), length)


def forward(found: Lattice, letters: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Log-probability of each word (of one length) under each language.

    ``chances``: a row per piece and one for the unknown, a column per language.  Each row
    of sums is rescaled before it is used, so words of any length keep their precision.
    """
    count, length = letters.shape
    alpha = np.zeros((length + 1, count, chances.shape[1]))
    alpha[0] = 1.0
    scale = np.zeros((count, chances.shape[1]))
    last = -1
    for start, end, rows, piece in found.edges(letters):
        if start != last and start and (length > _WIDE or start % 16 == 0):
            ahead = slice(start, min(length, start + found.longest) + 1)
            top = alpha[ahead].max(axis=0)
            top[top == 0] = 1.0
            alpha[ahead] /= top
            scale += np.log(top)
        last = start
        alpha[end][rows] += alpha[start][rows] * chances[piece]
    return np.log(np.maximum(alpha[length], 1e-300)) + scale


def expected_pieces(
    found: Lattice, words: Sequence[str], counts: np.ndarray, chances: np.ndarray
) -> np.ndarray:
    """Expected uses of each piece in the words, over all segmentations (one language)."""
    total = np.zeros(found.size + 1)
    for at, letters in by_length(words):
        length = letters.shape[1]
        weight = counts[at].astype(float)
        edges = list(found.edges(letters))
        alpha = np.zeros((length + 1, len(at)))
        alpha[0] = 1.0
        gain = np.ones((length + 1, len(at)))  # what each position was divided by
        reached = 0
        for start, end, rows, piece in edges:
            if start != reached:
                reached = start
                gain[start] = np.where(alpha[start] > 0, alpha[start], 1.0)
                ahead = slice(start, min(length, start + found.longest) + 1)
                alpha[ahead] /= gain[start]
            alpha[end][rows] += alpha[start][rows] * chances[piece]
        # The backward sums use the same divisors, so their products stay in range.
        beta = np.zeros((length + 1, len(at)))
        whole = np.where(alpha[length] > 0, alpha[length], 1.0)
        beta[length] = 1.0
        by_start: dict[int, list] = {}
        for edge in edges:
            by_start.setdefault(edge[0], []).append(edge)
        for start in range(length - 1, -1, -1):
            for _, end, rows, piece in by_start.get(start, ()):
                # Sums at ``end`` were divided by all gains from start + 1 to end.
                span = np.prod(gain[start + 1 : end + 1], axis=0)[rows] if end > start else 1.0
                beta[start][rows] += chances[piece] * beta[end][rows] / span
        for start, end, rows, piece in edges:
            span = np.prod(gain[start + 1 : end + 1], axis=0)[rows]
            share = alpha[start][rows] * chances[piece] * beta[end][rows] / span / whole[rows]
            np.add.at(total, piece, share * weight[rows])
    return total


def _count_words(model_rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush():
        keys = list(counts)
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in keys], pa.string()),
                "word": pa.array([k[1] for k in keys], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    for batch in model_rows:
        langs = batch.column("lang").to_pylist()
        for first, texts in pieces(batch, "text"):
            for i, text in enumerate(texts, first):
                lang = langs[i]
                counts.update((lang, w) for w in words_of(text))
            if len(counts) >= _FLUSH:
                yield flush()
                counts.clear()
    if counts:
        yield flush()


def _pieces_of_words(model_file: str, chances: np.ndarray, langs: Sequence[str]):
    """Expected pieces of counted words, summed per batch of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lattice(model_file)
        column = {lang: i for i, lang in enumerate(langs)}
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            of_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                of_lang.setdefault(lang, []).append(i)
            words = batch.column("word").to_pylist()
            counts = batch.column("n").to_numpy(zero_copy_only=False)
            for lang, at in of_lang.items():
                p = chances[:, column[lang]] if chances.ndim == 2 else chances
                got = expected_pieces(found, [words[i] for i in at], counts[at], p)
                totals[lang] = totals.get(lang, 0.0) + got
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(used), pa.string()),
                    "piece": pa.array(used, pa.int64()),
                    "n": pa.array(total[used], pa.float64()),
                }
            )

    return run


def learn(
    docs: DataFrame,
    model_file: str,
    text: str = "text",
    lang: str = "lang",
    rounds: int = 2,
    smoothing: float = 0.1,
    most_languages: int = 1000,
) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities) from all labelled texts.

    Words are counted per language in Spark; then each round of expectation-maximisation
    spreads them over their pieces.  What reaches the driver is one number per language and
    piece, bounded by the vocabulary and ``most_languages``.  Rows without a language or
    text teach nothing.  No rows at all give no languages.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), utf8(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counted = (
        rows.mapInArrow(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    counted = stored(counted, "language_words")
    langs = [
        r[0] for r in counted.select("lang").distinct().limit(most_languages + 1).collect()
    ]
    if len(langs) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages")
    langs.sort()
    size = lattice(model_file).size + 1
    if not langs:
        return [], np.zeros((size, 0))
    chances = np.full(size, 1.0)
    for _ in range(rounds):
        step = counted.mapInArrow(
            _pieces_of_words(model_file, chances, langs), "lang string, piece bigint, n double"
        )
        sums = step.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((size, len(langs)), smoothing)
        place = {name: i for i, name in enumerate(langs)}
        table[sums["piece"].to_numpy(), sums["lang"].map(place).to_numpy()] += sums["n"]
        chances = table / table.sum(axis=0)
    return langs, chances


class WordScores:
    """Log-probabilities of words under each language, remembered up to a bound."""

    def __init__(self, model_file: str, chances: np.ndarray, most: int = 300_000):
        self.found, self.chances, self.most = lattice(model_file), chances, most
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, chances.shape[1]))

    def of(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.place]
        if not fresh:
            return
        if len(self.place) + len(fresh) > self.most:
            self.place, self.rows = {}, self.rows[:0]
            fresh = list(words)
        scores = np.zeros((len(fresh), self.chances.shape[1]))
        for at, letters in by_length(fresh):
            # A block's sums take letters * words * languages numbers.
            block = max(1, 4_000_000 // (letters.shape[1] * self.chances.shape[1]))
            for b in range(0, len(at), block):
                part = slice(b, b + block)
                scores[at[part]] = forward(self.found, letters[part], self.chances)
        base = len(self.rows)
        self.place.update((w, base + i) for i, w in enumerate(fresh))
        self.rows = np.vstack([self.rows, scores])


def _score(model_file: str, langs: Sequence[str], chances: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model_file, chances)
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for _, texts in pieces(batch, "_text"):
                split = [words_of(t) for t in texts]
                if langs:
                    known.of(set().union(*split))
                for words in split:
                    if not words or not langs:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    at = np.fromiter(map(known.place.__getitem__, words), np.int64, len(words))
                    total = known.rows[at].sum(axis=0)
                    best = int(total.argmax())
                    names.append(langs[best])
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            rest = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(names), pa.array(scores)],
                names=[*rest, "_lang", "_score"],
            )

    return run


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    model_file: str,
    text: str = "text",
    keep: Sequence[str] = (),
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """The columns ``keep`` with the likeliest language of each text and its posterior.

    One row out per row in, repeated rows included.  Every language is equally likely
    beforehand; a tie goes to the first by name.  A NULL or empty text, or one without a
    letter, is ``und`` with score 0.
    """
    langs, chances = model
    held = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*held, utf8(text).alias("_text"))
    kinds = ", ".join(f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema = f"{kinds}{', ' * bool(keep)}_lang string, _score double"
    done = rows.mapInArrow(_score(model_file, langs, chances), schema)
    return done.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_lang").alias(language),
        F.col("_score").alias(score),
    )
