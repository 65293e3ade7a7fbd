"""Token ids in seekable compressed files.

A file is a row of independent zstandard frames, one per document in ascending id order,
then one frame with the ids of the documents, and a seek table in a skippable frame at the
end: the packed and plain size of every frame and the low half of its XXH64.  A reader
takes the table and the id frame and then unpacks only the frames asked for.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import pieces, stored, utf8
from signalguard.session import shared_dir

# Fixed values of the seekable format.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_CHECKSUMS = 0x80

_NO_ID = -(2**63)  # stands for NULL in the id frame; sorts first
_FILE_BYTES = 256 << 20  # plain bytes after which a task starts a new file


#: ASCII punctuation, but for what special tokens start with.
_TAIL = b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
#: The same without the apostrophe, which a letter after it may turn into a contraction.
_HEAD = _TAIL.replace(b"'", b"")


def _parts(run: bytes) -> tuple[bytes, bytes, bytes]:
    """A run as punctuation, a word, and punctuation, which the tokenizer encodes apart.

    Only where that is certain: an ASCII letter or digit stands at either end of the word.
    An ASCII word is lower-cased, as the tokenizer does.
    """
    if run.isalnum():
        return b"", run.lower(), b""
    if b"<" in run:
        return b"", run, b""
    core = run.rstrip(_TAIL)
    if not core[-1:].isalnum():
        return b"", run, b""
    tail, bare = run[len(core) :], core.lstrip(_HEAD)
    if not bare[:1].isalnum():
        bare = core
    return core[: len(core) - len(bare)], bare.lower() if bare.isascii() else bare, tail


#: Texts on which a tokenizer shows whether blanks, case and punctuation can be cut apart.
_PROBES = (
    b"Hello World, again.",
    b"Ab  cd\n\tEF!? x.y: 'tis (so) 123,456; THE end...",
    "Naïve ÉTÉ, über Straße: 漢字 текст".encode(),
    b" a <b> c<|d|> ",
    b"(Word) 'tis dogs', !'s **Bold**%%% it's; x-y_z [9]. 'LL we'll -- ~a~ ''b'' c\x01 d",
    "ÜBER Straße ñandú, ÇA Øre þ ÿ æ ×x÷y µm ªº".encode(),
    "(été) «été» eté, façade... e\u0301t, a\u0301.".encode(),
)

#: Letters that no normal form changes and whose small forms are one letter each.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

#: Stands between blanks for the end of a run, where many are encoded as one text.
_MARK = b"\x01"


@contextmanager
def _uncollected():
    """Without looking for cycles of objects: many are made here, and none of them is in one."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class ChunkEncoder:
    """Ids of texts; each distinct run between ASCII blanks is encoded once while remembered.

    That is right for tokenizers that lower-case, and drop white space before anything else
    looks across it.  Probes tell; texts of other tokenizers are encoded whole.
    """

    def __init__(self, tokenizer_file: str, most: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.most = most
        # Two generations: of what was remembered only what is met again stays for longer.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        mark = self._whole([b" " + _MARK + b" "])[0]
        self.mark = int.from_bytes(mark, "little") if len(mark) == 4 else None
        self.letters = self._letters()
        self.raw = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.by_runs = self._by_runs(_PROBES) == self._whole(_PROBES)

    def _letters(self) -> dict[int, str] | None:
        """What the tokenizer's model reads for each small Latin letter."""
        split = self.tokenizer.pre_tokenizer
        small = [chr(c) for c in range(0x100) if _LATIN.fullmatch(chr(c)) and chr(c).islower()]
        if split is None:
            return None
        found = {ord(c): split.pre_tokenize_str(c) for c in small}
        if any(len(pieces) != 1 for pieces in found.values()):
            return None
        return {c: pieces[0][0] for c, pieces in found.items()}

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_runs:
            return self._whole(texts)
        with _uncollected():
            return self._by_runs(texts)

    def _whole(self, texts: Sequence[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(
            [t.decode("utf-8", "replace") for t in texts], add_special_tokens=False
        )
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _by_runs(self, texts: Sequence[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        self._learn(set().union(*split))
        # Two empty runs more: a getter of one or no key would not return a tuple.
        known = self.known
        known[b""] = b""
        return [b"".join(itemgetter(b"", b"", *runs)(known)) for runs in split]

    def _learn(self, runs: set[bytes]) -> None:
        """See that all these runs are known."""
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        # Each step below goes over the runs, few of all that is remembered.
        runs = {r for r in runs if r not in known}
        again = [r for r in runs if r in older]
        known.update((r, older[r]) for r in again)
        runs.difference_update(again)
        # Of a small ASCII word nothing is cut off: it is wanted as it stands.
        small = {r for r in runs if r.islower() and r.isalnum()}
        runs -= small
        parts = [_parts(r) for r in runs]
        wanted = {w for w in small.union(*parts) if w not in known}
        again = [w for w in wanted if w in older]
        known.update((w, older[w]) for w in again)
        wanted.difference_update(again)
        known.update(self._encode_runs(list(wanted)))
        known.update(
            (r, known[head] + known[core] + known[tail])
            for r, (head, core, tail) in zip(runs, parts, strict=True)
        )

    def _encode_runs(self, runs: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """A word of Latin letters goes straight to the tokenizer's model, which need not split it.

        Other runs are encoded many at a time, with a control character between blanks after
        each.  Only that character, alone, has its id, so the id ends a run; runs that contain
        the character, or may contain a special token, are encoded alone.
        """
        if self.letters is not None:
            model, raw, letters, others = self.tokenizer.model.tokenize, self.raw, self.letters, []
            for run in runs:
                word = run.decode("utf-8", "replace")
                if run.isalpha():
                    yield run, b"".join([raw[t.id] for t in model(word)])
                elif _LATIN.fullmatch(word):
                    word = word.lower().translate(letters)
                    yield run, b"".join([raw[t.id] for t in model(word)])
                else:
                    others.append(run)
            runs = others
        marked: list[bytes] = []
        alone = runs
        if self.mark is not None:
            alone = [r for r in runs if _MARK in r or b"<" in r]
            marked = [r for r in runs if _MARK not in r and b"<" not in r]
        between = b" " + _MARK + b" "
        for b in range(0, len(marked), 2000):
            part = marked[b : b + 2000]
            joined = (between.join(part) + between).decode("utf-8", "replace")
            found = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            data, start = ids.tobytes(), 0
            for run, end in zip(part, np.flatnonzero(ids == self.mark).tolist(), strict=True):
                yield run, data[4 * start : 4 * end]
                start = end + 1
        texts = [r.decode("utf-8", "replace") for r in alone]
        for run, e in zip(
            alone, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True
        ):
            yield run, np.array(e.ids, dtype="<u4").tobytes()


class SeekableWriter:
    """Writes frames, then the id frame and the seek table."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.sizes, self.ids = stream, [], []
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.plain = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._frame(ids)
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.plain += len(ids)
        self.tokens += len(ids) // 4

    def _frame(self, plain: bytes) -> None:
        packed = self.pack(plain)
        self.stream.write(packed)
        self.sizes.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        self._frame(np.array(self.ids, dtype="<i8").tobytes())
        table = b"".join(struct.pack("<III", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), _CHECKSUMS, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.stream.close()


class SeekableReader:
    """Random access to a file's documents; every frame read is checked."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.seek(0, 2)
        count, flags, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != _SEEKABLE or not flags & _CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        raw = self._read(end - 9 - 12 * count, 12 * count)
        self.table = np.frombuffer(raw, dtype="<u4").reshape(count, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.ids = np.frombuffer(self._unpack(count - 1), dtype="<i8")

    def _read(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def _unpack(self, frame: int) -> bytes:
        packed, plain, check = self.table[frame].tolist()
        raw = self._read(int(self.starts[frame]), packed)
        data = zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(plain, 1))
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {frame} is damaged")
        return data

    @property
    def tokens(self) -> np.ndarray:
        """Number of ids of each document, from the table alone."""
        return self.table[:-1, 1] // 4

    def documents(self, places: Iterable[int]) -> Iterator[tuple[int | None, int, bytes]]:
        """(id, place, ids) of the documents at these places."""
        for i in places:
            doc_id = int(self.ids[i])
            yield None if doc_id == _NO_ID else doc_id, i, self._unpack(i)


@dataclass(frozen=True)
class TokenFiles:
    """Files of one corpus: the folder and the table of the files that count."""

    folder: str
    manifest: DataFrame


def _writer(folder: str, tokenizer_file: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_file)
        end = struct.pack("<I", end_id)
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get().partitionId()
        done: list[dict] = []
        out: SeekableWriter | None = None

        def finish():
            if out is not None:
                out.close()
                done[-1] |= {"docs": len(out.ids), "tokens": out.tokens}

        for batch in batches:
            ids = batch.column("_id").to_pylist()
            for first, texts in pieces(batch, "_text"):
                for i, data in enumerate(encoder.encode(texts), first):
                    if out is None or out.plain > _FILE_BYTES:
                        finish()
                        # A repeated attempt writes other names; only files of the attempt
                        # whose rows are committed are in the manifest.
                        name = f"part-{task:06d}-{len(done):06d}-{uuid.uuid4().hex}.zst"
                        out = SeekableWriter(files.open_output_stream(f"{root}/{name}", compression=None))
                        done.append({"part": task, "number": len(done), "file": name})
                    out.add(ids[i], data + end)
        finish()
        yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST)

    return run


_MANIFEST = pa.schema(
    [
        ("part", pa.int64()),
        ("number", pa.int64()),
        ("file", pa.string()),
        ("docs", pa.int64()),
        ("tokens", pa.int64()),
    ]
)


def write_token_files(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    task_bytes: int = 32 << 20,
) -> TokenFiles:
    """Encode every text, with ``end_id`` after it, in ascending id order.

    NULL and empty texts are just the end.  Ids are whole numbers; NULL ids come first and
    equal ids stand together, in the order of their texts' hashes.  Ranges of ids, of about
    ``task_bytes`` of text each, go to tasks, each of which writes its own files into the
    shared folder; a task encodes what it meets again only once, so small ranges cost more.
    """
    folder = folder or shared_dir(docs.sparkSession, "token_files")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("_id"), utf8(text).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    tasks = size // task_bytes + 1
    ordered = rows.repartitionByRange(tasks, "_id", "_tie").sortWithinPartitions("_id", "_tie")
    wrote = ordered.select("_id", "_text").mapInArrow(
        _writer(folder, tokenizer_file, end_id),
        "part bigint, number bigint, file string, docs bigint, tokens bigint",
    )
    manifest = stored(wrote, "token_files_manifest")
    # One row per file, so the running total is over few rows.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return TokenFiles(
        folder,
        manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))),
    )


def read_token_files(
    written: TokenFiles,
    wanted: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """doc_id, start (ids before the document in the corpus), n_tokens, ids (bytes).

    ``wanted`` maps the ids of a file's documents to a mask; other frames stay packed.
    """
    folder = written.folder

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                reader = SeekableReader(files.open_input_file(f"{root}/{row['file']}"))
                starts = row["start"] + np.cumsum(reader.tokens) - reader.tokens
                mask = np.ones(len(starts), bool) if wanted is None else wanted(reader.ids)
                places = np.flatnonzero(mask).tolist()
                for b in range(0, len(places), 1000):
                    found = list(reader.documents(places[b : b + 1000]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f[0] for f in found], pa.int64()),
                            pa.array([int(starts[f[1]]) for f in found], pa.int64()),
                            pa.array([len(f[2]) // 4 for f in found], pa.int64()),
                            pa.array([f[2] for f in found], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    count = written.manifest.count()
    rows = written.manifest.repartition(max(1, min(count, 10_000)))
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def checksums(read: DataFrame) -> DataFrame:
    """``read_token_files`` with the ids replaced by their crc32."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
