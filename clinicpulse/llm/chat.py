"""Chat formatting: conversations rendered by a compiled template, with the spans a model is to learn marked.

Rows are sorted by conversation and turn over all tasks, and each task renders its range as a stream: a conversation is
never held whole and a long one is rendered by many tasks, in parts that end with a turn. Control strings inside texts
and roles are escaped reversibly, so the formatted text can be read back turn by turn, every part by itself. Only the
digests of a conversation need its parts in order; one task hashes what was read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.llm.template import compiled, walks_turn_by_turn

_PART = 1 << 20
START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + (message.role | escape_role) + '\\n' }}"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
)


def escape(text: str) -> str:
    """One more backslash between every ``<`` and ``|`` that only backslashes part."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """A role ends at its line's end, so line breaks in it are written out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


FILTERS = {"escape": escape, "escape_role": escape_role}


def read_back(parts: Iterable[tuple[str, list[tuple[int, int]]]]) -> Iterator[tuple[str, str, str]]:
    """(role, text, learnt text) of each turn of one conversation's formatted parts; all unescaped."""
    held, marks = "", []
    for formatted, learnt in parts:
        marks += [(a + len(held), b + len(held)) for a, b in learnt]
        held += formatted
        at = nearest = 0
        while True:
            line = held.find("\n", at)
            end = held.find(END, line) if line >= 0 else -1
            if end < 0 or end + len(END) >= len(held):
                break
            if not held.startswith(START, at):
                raise ValueError("a turn does not begin where the last one ends")
            while nearest < len(marks) and marks[nearest][1] <= line + 1:
                nearest += 1
            inside, k = [], nearest
            while k < len(marks) and marks[k][0] < end:
                inside.append(held[max(marks[k][0], line + 1) : min(marks[k][1], end)])
                k += 1
            yield unescape_role(held[at + len(START) : line]), unescape(held[line + 1 : end]), unescape("".join(inside))
            at = end + len(END) + 1
        marks = [(a - at, b - at) for a, b in marks[nearest:] if b > at]
        held = held[at:]
    if held:
        raise ValueError("the last turn does not end")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows, cut by their text so that long ones do not pile up."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 1000 or size >= 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def rendered(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: str = TEMPLATE
) -> DataFrame:
    """(conv_id, part, whole, formatted, learnt): each conversation's formatted text in parts of about a million signs,
    in the order of ``part``, with the (start, end) code points of a part that a model is to learn.

    Null roles and texts count as empty. Null turns come first; equal turns go by role, then text, and repeated rows
    all stay. Rows with a null conversation are one conversation. Other columns are not read. A template may walk
    over ``messages`` once. One that does nothing else is rendered turn by turn, on as many tasks as there are
    shuffle partitions, and its parts are ``whole``: they begin and end with a turn. For any other a conversation is one
    task's.
    """
    spark = conversations.sparkSession
    bounded_batches(spark)
    rows = conversations.select(
        quoted(conv_id).alias("conv_id"),
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    by_turn = walks_turn_by_turn(template, FILTERS)
    if by_turn:
        # Ranges are cut by short keys in the same order; those of equal keys share a task.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        short = F.when(F.length("role") < 64, F.substring("text", 1, 64))
        dealt = rows.repartitionByRange(parts, "conv_id", "turn", F.substring("role", 1, 64), short)
    else:
        dealt = rows.repartition("conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    fields = "part bigint, whole boolean, formatted string, learnt array<struct<start:bigint,end:bigint>>"
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, first = compiled(template, FILTERS), TaskContext.get().partitionId() << 32

        def written(messages: Iterator[dict]) -> Iterator[tuple[str, bool, bool]]:
            """Pieces, and whether a part may end after them."""
            if not by_turn:
                for piece, learnt in write({"messages": messages}):
                    yield piece, learnt, True
                return
            for message in messages:
                for piece, learnt in write({"messages": (message,)}):
                    yield piece, learnt, False
                yield "", False, True

        def parts() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                messages = ({"role": r, "text": t} for _, _, r, t in group)
                pieces, spans, at, part = [], [], 0, first
                for piece, learnt, ends in written(messages):
                    if learnt and piece:
                        spans.append({"start": at, "end": at + len(piece)})
                    pieces.append(piece)
                    at += len(piece)
                    if ends and at >= _PART:
                        yield conv, part, by_turn, "".join(pieces), spans
                        pieces, spans, at, part = [], [], 0, part + 1
                if at or part == first:
                    yield conv, part, by_turn, "".join(pieces), spans

        yield from _batched(parts(), arrow)

    return dealt.mapInArrow(render, schema)


def _turns(parts: DataFrame) -> DataFrame:
    """(conv_id, part, n, turns, loss, chars): what was read back of each part, its learnt text apart.

    Whole parts are read where they lie; others are read in order, by conversation, as a turn may go on in the next.
    """
    fields = "part bigint, n bigint, turns string, loss string, chars bigint"
    schema = T.StructType([parts.schema["conv_id"], *T.StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)
    parts = parts.select("conv_id", "part", "formatted", "learnt", "whole")

    def row(conv, part: int, read: list[tuple[str, str, str]], chars: int) -> tuple:
        turns = "".join(f"{role}\n{text}\n" for role, text, _ in read)
        return conv, part, len(read), turns, "".join(learnt for _, _, learnt in read), chars

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _streamed(batches)
        yield from _batched(
            (row(c, part, list(read_back([(f, _marks(learnt))])), len(f)) for c, part, f, learnt, _ in rows), arrow
        )

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                chars = n = held = 0
                read = []

                def counted() -> Iterator[tuple]:
                    nonlocal chars
                    for _, _, formatted, learnt, _ in group:
                        chars += len(formatted)
                        yield formatted, _marks(learnt)

                for turn in read_back(counted()):
                    read.append(turn)
                    held += len(turn[1])
                    if held >= _PART:
                        yield row(conv, n, read, 0)
                        read, held, n = [], 0, n + 1
                yield row(conv, n, read, chars)

        yield from _batched(conversations(), arrow)

    others = parts.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.filter("whole").mapInArrow(each, schema).unionByName(others.mapInArrow(in_order, schema))


def _marks(learnt: list[dict]) -> list[tuple[int, int]]:
    return [(s["start"], s["end"]) for s in learnt]


def summaries(parts: DataFrame) -> DataFrame:
    """Each conversation's digests, read back from the parts that ``rendered`` made.

    ``turns_sha256`` covers role, line break, text, line break per turn; ``loss_sha256`` the learnt text alone, both
    unescaped; ``formatted_chars`` counts the formatted text. The digests of a conversation are one task's work, as
    they need its turns in order; what they cover is streamed through it, so its size does not matter.
    """
    bounded_batches(parts.sparkSession)
    dealt = _turns(parts).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    digests = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    schema = T.StructType([parts.schema["conv_id"], *T.StructType.fromDDL(digests).fields])
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                total = loss_chars = formatted_chars = 0
                for _, _, n, text, learnt, chars in group:
                    turns.update(text.encode())
                    loss.update(learnt.encode())
                    total, loss_chars, formatted_chars = total + n, loss_chars + len(learnt), formatted_chars + chars
                yield conv, total, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars

        yield from _batched(conversations(), arrow)

    return dealt.mapInArrow(digest, schema)
