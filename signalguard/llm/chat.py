"""Conversations as training text, with the generated parts marked, and back.

Turns are numbered over the whole table and grouped into segments of at most 64 turns, so a
conversation of any length is rendered by many tasks; the compiled template
(``chat_template.py``) prints what surrounds the turns only in the first and last segment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalguard.llm.base import stored, utf8
from signalguard.llm.chat_template import Escape, Template
from signalguard.llm.ordering import numbered

SEGMENT_TURNS = 64

START, END, OPENER = "<|im_start|>", "<|im_end|>", "<|"
#: Turns between marks, the role on a line of its own; the assistant's texts are generated.
TURNS = (
    "{% for message in messages %}"
    "{{ start ~ (message.role | escape_line) ~ '\\n' }}"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ end ~ '\\n' }}"
    "{% endfor %}"
)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)

SEGMENT = (
    T.StructType()
    .add("formatted", T.BinaryType())
    .add(
        "spans",
        T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType())),
    )
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def turns_template() -> Template:
    """The default template: marked turns whose texts hold no control string."""
    return Template(TURNS, OPENER, {"start": START, "end": END})


def _decode(data: bytes | None) -> str:
    """Bytes that are no UTF-8 survive the way there and back."""
    return (data or b"").decode("utf-8", "surrogateescape")


def _encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def format_conversations(
    df: DataFrame,
    template: Template | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    fields: Sequence[str] = ("role", "text"),
) -> DataFrame:
    """Each conversation's text in segments: conversation, segment, segments, formatted, spans.

    Turns ascend by ``turn`` (NULL first, equal ones by their fields, so that repeated rows
    stay as repeated turns); a message has the ``fields`` as texts, NULL as empty.  NULL is
    a conversation of its own.  ``spans`` are the generated parts in code points of the
    segment's ``formatted``.  The segments in order, put together, are the conversation;
    those of up to 64 turns have one.  Other columns are not read, whatever their names; an
    empty table gives no row.  A task holds one segment, so the longest 64 turns must fit.
    The result is a stored table.
    """
    template = template or turns_template()
    names = list(fields)
    turns = df.select(
        F.struct(F.col(f"`{conversation}`").alias("id")).alias("tree"),
        F.col(f"`{turn}`").alias("rank"),
        *[utf8(f"`{name}`").alias(f"f{i}") for i, name in enumerate(names)],
    )
    # Ties are told apart by digests: range boundaries are sampled to the driver.
    tied = turns.withColumn("tie", F.xxhash64(*[f"f{i}" for i in range(len(names))]))
    placed = numbered(tied, "tree", ["rank", "tie"], "chat-turns")
    message = F.struct("pos", *[f"f{i}" for i in range(len(names))])
    segments = placed.groupBy(
        "tree", F.expr(f"pos DIV {SEGMENT_TURNS}").alias("segment")
    ).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(message)).alias("messages"))
    head = segments.select(
        F.struct(
            "tree", "segment", F.ceil(F.col("n") / SEGMENT_TURNS).alias("segments")
        ).alias("head"),
        "n",
        "messages",
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, lists = batch.column("n"), batch.column("messages")
            for i in range(len(batch)):
                rows = lists[i].as_py()
                told = [
                    {name: _decode(row[f"f{j}"]) for j, name in enumerate(names)} for row in rows
                ]
                text, spans = template.render(told, rows[0]["pos"], totals[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("head").slice(i, 1),
                        pa.array([_encode(text)], pa.binary()),
                        pa.array([[{"start": a, "end": b} for a, b in spans]], _SPANS),
                    ],
                    names=["head", "formatted", "spans"],
                )

    schema = T.StructType([T.StructField("head", head.schema["head"].dataType), *SEGMENT.fields])
    done = head.mapInArrow(render, schema)
    return stored(
        done.select(
            F.col("head.tree.id").alias(conversation),
            F.col("head.segment").alias("segment"),
            F.col("head.segments").alias("segments"),
            F.col("formatted").cast("string").alias("formatted"),
            "spans",
        ),
        "chat-formatted",
    )


class _Reader:
    """Digests of one conversation, segment after segment."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, spans: list[dict], escape: Escape) -> None:
        self.chars += len(formatted)
        at = 0
        while at < len(formatted):
            found = _TURN.match(formatted, at)
            if not found:
                raise ValueError(f"no turn starts at character {at}")
            role, text = escape.show_line(found[1]), escape.show(found[2])
            self.all.update(_encode(f"{role}\n{text}\n"))
            self.turns += 1
            at = found.end()
        for span in spans:
            text = escape.show(formatted[span["start"] : span["end"]])
            self.loss.update(_encode(text))
            self.loss_chars += len(text)

    def row(self) -> dict:
        return {
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


FACTS = (
    T.StructType()
    .add("n_turns", T.LongType())
    .add("turns_sha256", T.StringType())
    .add("loss_chars", T.LongType())
    .add("loss_sha256", T.StringType())
    .add("formatted_chars", T.LongType())
)


def read_back(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, from texts of the default template: its turns and generated text.

    ``n_turns``; ``turns_sha256`` of role, newline, text, newline per turn; ``loss_chars``
    and ``loss_sha256`` of the text under the spans, unescaped; ``formatted_chars``.

    A conversation of one segment is read where it lies.  The segments of a longer one
    meet in one task, since a digest is taken in order, but pass through it one at a time.
    """
    rows = formatted.select(
        F.struct(F.col(f"`{conversation}`").alias("id")).alias("tree"),
        "segment",
        "segments",
        F.col("formatted").cast("binary").alias("formatted"),
        "spans",
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = Escape(OPENER)
        reader = _Reader()
        for batch in batches:
            ends, facts = [], []
            last = batch.column("segments")
            for i in range(len(batch)):
                text = _decode(batch.column("formatted")[i].as_py())
                reader.read(text, batch.column("spans")[i].as_py(), escape)
                if batch.column("segment")[i].as_py() + 1 == last[i].as_py():
                    ends.append(i)
                    facts.append(reader.row())
                    reader = _Reader()
            if ends:
                told = pa.Table.from_pylist(facts).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("tree").take(pa.array(ends)), *told.columns],
                    names=["tree", *told.schema.names],
                )

    short = rows.where("segments = 1")
    long = rows.where("segments > 1").repartition("tree").sortWithinPartitions("tree", "segment")
    schema = T.StructType([rows.schema["tree"], *FACTS.fields])
    found = short.mapInArrow(read, schema).unionAll(long.mapInArrow(read, schema))
    return found.select(F.col("tree.id").alias(conversation), *FACTS.fieldNames())
