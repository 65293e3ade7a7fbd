"""BPE by a table of distinct words.

Texts are split into words where the tokenizer would split them.  A stretch of documents
(a chunk) keeps its texts as numbers of its own word list; the word lists of all chunks meet
per word, each distinct word is encoded once, its ids meet their pieces in a join, and both
return to the chunk, where they take the places of the numbers.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterable, Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import Shared, pieces, utf8
from signalguard.session import shared_dir

# Fixed value: where the byte-level tokenizer splits.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CHUNK_BYTES = 32 << 20
_CHUNK_WORDS = 600_000
#: Encoded words that a task packs together for the chunks that list them.
_HELD_WORDS = 300_000


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _newcomers() -> frozenset[str]:
    """Letters and digits of the pattern library that an older Unicode does not know yet."""
    known = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000)]))
    found = regex.findall(r"[\p{L}\p{N}]", known)
    return frozenset(c for c in found if unicodedata.category(c) == "Cn")


def splitter(special: Sequence[str], own=None):
    """A function from text to words; special strings are words of their own.

    Texts with characters that only a newer Unicode has are split by the tokenizer's ``own``
    splitting, if given.
    """
    plain = regex.compile(SPLIT).findall
    newcomers = _newcomers() if own else frozenset()

    def words(text: str) -> list[str]:
        if text.isascii() or newcomers.isdisjoint(text):
            return plain(text)
        return [text[a:b] for _, (a, b) in own.pre_tokenize_str(text)]

    if not special:
        return words
    apart = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")

    def run(text: str) -> list[str]:
        parts = apart.split(text)
        if len(parts) == 1:
            return words(text)
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else words(p))]

    return run


def piece_table(path: str) -> list[bytes]:
    """The bytes each id stands for; printable stand-ins are undone, special strings stay."""
    found = tokenizer(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        back[chr(256 + n)] = b
    special = {a.content for a in found.get_added_tokens_decoder().values()}
    vocabulary = found.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = piece.encode() if piece in special else bytes(back[c] for c in piece)
    return pieces


def _pack_codes(codes: np.ndarray) -> bytes:
    """Numbers by planes of bytes: the upper planes are nearly all zero."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack_codes(packed: bytes) -> list[int]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().tolist()


def _pack_words(words: Sequence[bytes], codes: np.ndarray) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    head = np.array([len(words)], dtype="<u4").tobytes()
    plain = head + lengths.tobytes() + codes.astype("<u4").tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=3).compress(plain)


def _unpack_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for chunk, packed in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words")), strict=True):
            plain = unpack(packed)
            count = int(np.frombuffer(plain, "<u4", 1)[0])
            ends = np.cumsum(np.frombuffer(plain, "<u4", count, 4), dtype=np.int64)
            data = pa.py_buffer(plain[4 + 8 * count :])
            offsets = pa.py_buffer(np.concatenate([[0], ends]).astype("<i4").tobytes())
            codes = np.frombuffer(plain, "<u4", count, 4 + 4 * count).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.StringArray.from_buffers(count, offsets, data),
                    pa.array([chunk] * count, pa.int64()),
                    pa.array(codes),
                ],
                names=["word", "chunk", "code"],
            )


class _Chunk:
    """A stretch of documents: their texts as numbers of words, and the words."""

    def __init__(self, name: int):
        self.name, self.size = name, 0
        self.number: dict[str, int] = {}
        self.texts: list[np.ndarray] = []
        self.held: list[pa.Array] = []

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Frequent words get small numbers; words are listed in order, which packs well."""
        every = np.concatenate([np.zeros(0, np.uint32), *self.texts])
        uses = np.bincount(every, minlength=len(self.number))
        rank = np.empty(len(uses), dtype=np.uint32)
        rank[np.argsort(-uses, kind="stable")] = np.arange(len(uses), dtype=np.uint32)
        done = 0
        for held in self.held:
            part = self.texts[done : done + len(held)]
            done += len(held)
            yield self._batch(held, None, [_pack_codes(rank[t]) for t in part])
        kind = self.held[0].type
        words = sorted((w.encode(), c) for w, c in self.number.items())
        for b in range(0, len(words), 50_000):
            part = words[b : b + 50_000]
            codes = rank[[c for _, c in part]]
            packed = _pack_words([w for w, _ in part], codes)
            yield self._batch(pa.nulls(1, kind), [packed], None)

    def _batch(self, held, words, codes) -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.name] * n, pa.int64()),
                pa.array(words or [None] * n, pa.binary()),
                pa.array(codes or [None] * n, pa.binary()),
                held,
            ],
            names=["chunk", "words", "codes", "held"],
        )


def _chunks(path: str):
    """The numbered texts and the word list of each chunk of a task's documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tokenizer(path)
        special = [a.content for a in found.get_added_tokens_decoder().values()]
        split = splitter(special, found.pre_tokenizer)
        chunk = _Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            held = batch.column("held")
            for first, texts in pieces(batch, "_text"):
                number = chunk.number
                for text in texts:
                    chunk.size += len(text)
                    words = split(text.decode("utf-8", "replace"))
                    codes = [number.setdefault(w, len(number)) for w in words]
                    chunk.texts.append(np.array(codes, dtype=np.uint32))
                chunk.held.append(held.slice(first, len(texts)))
                if chunk.size >= _CHUNK_BYTES or len(number) >= _CHUNK_WORDS:
                    yield from chunk.rows()
                    chunk = _Chunk(chunk.name + 1)
        if chunk.texts:
            yield from chunk.rows()

    return run


def _pack_ids(codes: np.ndarray, ids: Sequence[bytes]) -> bytes:
    lengths = np.fromiter(map(len, ids), "<u4", len(ids))
    head = np.array([len(ids)], dtype="<u4").tobytes()
    numbers = np.frombuffer(b"".join(ids), np.uint8).reshape(-1, 4).T  # by planes of bytes
    plain = head + lengths.tobytes() + codes.astype("<u4").tobytes() + numbers.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(plain)


def _unpack_ids(packed: bytes) -> Iterator[tuple[int, bytes]]:
    plain = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(plain, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(plain, "<u4", count, 4), dtype=np.int64).tolist()
    codes = np.frombuffer(plain, "<u4", count, 4 + 4 * count).tolist()
    planes = np.frombuffer(plain, np.uint8, offset=4 + 8 * count).reshape(4, -1)
    data = np.ascontiguousarray(planes.T).tobytes()
    start = 0
    for code, end in zip(codes, ends, strict=True):
        yield code, data[start:end]
        start = end


def _encode(path: str):
    """Ids of sorted words, each distinct one encoded once, packed for the chunks that list it."""

    def packed(chunks: list[int], codes: list[int], ids: list[bytes]) -> pa.RecordBatch:
        chunk, code = np.array(chunks, np.int64), np.array(codes, np.uint32)
        order = np.argsort(chunk, kind="stable")
        names, first = np.unique(chunk[order], return_index=True)
        parts = [
            _pack_ids(code[part], [ids[i] for i in part.tolist()])
            for part in np.split(order, first[1:])
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(parts, pa.binary())], names=["chunk", "ids"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tokenizer(path)
        last: tuple[str, bytes] | None = None
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            words = batch.column("word").to_pylist()
            fresh = [
                w for i, w in enumerate(words) if w != (words[i - 1] if i else last and last[0])
            ]
            done = iter(found.encode_batch_fast(fresh, add_special_tokens=False))
            held[0].extend(batch.column("chunk").to_pylist())
            held[1].extend(batch.column("code").to_pylist())
            for word in words:
                if last is None or word != last[0]:
                    last = (word, array("I", next(done).ids).tobytes())
                held[2].append(last[1])
            if len(held[0]) >= _HELD_WORDS:
                yield packed(*held)
                held = ([], [], [])
        if held[0]:
            yield packed(*held)

    return run


def _assemble(shared: Shared):
    """Put the ids of a chunk's words, and their pieces, in the places of their numbers."""

    def run(words: pa.Table, texts: pa.Table) -> pa.Table:
        table = shared.load()
        found = dict(pair for part in words["ids"].to_pylist() for pair in _unpack_ids(part))
        ids_of = [found[code] for code in range(len(found))]
        # Each id meets its piece once per distinct word of the chunk.
        bytes_of = [b"".join(map(table.__getitem__, array("I", ids))) for ids in ids_of]
        ids, decoded = [], []
        for packed in texts["codes"].to_pylist():
            row = _unpack_codes(packed)
            ids.append(b"".join(map(ids_of.__getitem__, row)))
            plain = b"".join(map(bytes_of.__getitem__, row))
            decoded.append(plain.decode("utf-8", "replace"))
        return pa.table(
            {
                "held": texts["held"],
                "ids": pa.array(ids, pa.binary()),
                "decoded": pa.array(decoded, pa.string()),
            }
        )

    return run


def encode_and_decode(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``ids`` (little-endian unsigned 32-bit ids of the text) and ``decoded``.

    One row out per row in, repeated rows included; NULL and empty texts have no ids and
    decode to an empty text.  Equal to the tokenizer's own encoding without added special
    tokens; a special string inside a text is that token.

    A chunk holds some megabytes of text and a bounded word list, so what meets in one task
    is bounded too; a frequent word is one row per chunk.  Ids meet their pieces in a map-side
    join: its broadcast side has one entry per piece of the vocabulary, which bounds it.
    """
    spark = docs.sparkSession
    held = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]).alias("held")
    rows = docs.select(held, utf8(text).alias("_text"))
    kind = rows.schema["held"].dataType.simpleString()
    listed = rows.mapInArrow(
        _chunks(path), f"chunk bigint, words binary, codes binary, held {kind}"
    )
    # Bucketed by chunk, so the numbered texts are not shuffled to meet their words.
    name = f"bpe_chunks_{uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = listed.write.bucketBy(buckets, "chunk").option("path", shared_dir(spark, name))
    writer.saveAsTable(name)
    stored = spark.table(name)
    words = stored.where(F.col("words").isNotNull()).select("chunk", "words")
    encoded = (
        words.mapInArrow(_unpack_words, "word string, chunk bigint, code int")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode(path), "chunk bigint, ids binary")
    )
    pieces_by_id = Shared(spark, piece_table(path))
    texts = stored.where(F.col("codes").isNotNull()).select("chunk", "codes", "held")
    done = (
        encoded.groupBy("chunk")
        .cogroup(texts.groupBy("chunk"))
        .applyInArrow(_assemble(pieces_by_id), f"held {kind}, ids binary, decoded string")
    )
    return done.select(
        *[F.col(f"held.k{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded"
    )

