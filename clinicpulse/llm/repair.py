"""Conversation structure repair by weighted CYK parsing of spans.

A conversation is to read as ``(s?(ua)+)?`` in the initials of its roles. A nonterminal (p, q) of the repair grammar
stands for rows that, once edited, take the automaton of that language from state p to state q. In Chomsky normal form
the rules are (p, q) -> (p, r) (r, q) and (p, q) -> an edited row, closed under insertions on both sides. A cell of the
chart holds the least (cost, audit) of each nonterminal over a span.

Every derivation is in some state at every boundary of rows, so the rule holds at every split of a span and all splits
give the same cell: one split per span is enough, and spans are combined from length one upwards by doubling. A span of
a hot conversation can thus be parsed in blocks on many tasks, whose cells are combined afterwards.

Least audits may be joined to least audits: two audits of one span have the same number of letters other than I, so if
one opened the other, the longer would have insertions more and cost more. Equal costs therefore differ at some letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.operators.staging import stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
WHITE = " \t\n\x0b\x0c\r"

# The automaton: nothing yet, after s, after u, after a.
_STATES = range(4)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPTING = (0, 3)
_WRITTEN = {"u": "user", "a": "assistant"}

Entry = tuple[float, str]
Cell = tuple[tuple[Entry, ...], ...]
_NOTHING: Entry = (float("inf"), "")
# Kinds of rows: the initial of the role, a capital if the text is cut off; gone if the row must be deleted.
OTHER, GONE = "o", "x"
_KNOWN_SPAN = 32


def _cell(entries: Iterable[tuple[int, int, Entry]]) -> Cell:
    """The least entry for each pair of states."""
    least = [[_NOTHING] * len(_STATES) for _ in _STATES]
    for p, q, entry in entries:
        least[p][q] = min(least[p][q], entry)
    return tuple(map(tuple, least))


def combined(left: Cell, right: Cell) -> Cell:
    """(p, q) -> (p, r) (r, q): the cell of two spans side by side."""

    def least(p: int, q: int) -> Entry:
        costs = [left[p][r][0] + right[r][q][0] for r in _STATES]
        cost = min(costs)
        if cost == _NOTHING[0]:
            return _NOTHING
        return cost, min(left[p][r][1] + right[r][q][1] for r in _STATES if costs[r] == cost)

    return tuple(tuple(least(p, q) for q in _STATES) for p in _STATES)


def _insertions() -> Cell:
    """The cell of no rows: closed, so combining it with itself changes nothing."""
    steps = [(p, q, (COST[INSERT], INSERT)) for (p, role), q in _NEXT.items() if role in _WRITTEN]
    cell = _cell([*((p, p, (0, "")) for p in _STATES), *steps])
    while (more := combined(cell, cell)) != cell:
        cell = more
    return cell


NO_ROWS = _insertions()


@lru_cache(maxsize=None)
def row_cell(kind: str) -> Cell:
    """The cell of one row of a kind."""
    edits = [(p, p, (COST[DELETE], DELETE)) for p in _STATES]
    if kind != GONE:
        more = TRUNCATED_COST if kind.isupper() else 0
        for (p, role), q in _NEXT.items():
            if role == kind.lower():
                edits.append((p, q, (COST[KEEP] + more, KEEP)))
            if role in _WRITTEN:
                edits.append((p, q, (COST[REROLE] + more, REROLE)))
    return combined(combined(NO_ROWS, _cell(edits)), NO_ROWS)


def combine_all(cells: list[Cell]) -> Cell:
    """Neighbouring spans, two by two, until one is left."""
    while len(cells) > 1:
        pairs = [combined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0] if cells else NO_ROWS


@lru_cache(maxsize=1 << 15)
def _short_span(kinds: str) -> Cell:
    return combine_all([row_cell(k) for k in kinds])


def span_cell(kinds: str) -> Cell:
    """The cell of a run of rows, given as their kinds; short spans are remembered."""
    return combine_all([_short_span(kinds[i : i + _KNOWN_SPAN]) for i in range(0, len(kinds), _KNOWN_SPAN)])


def cheapest(cell: Cell) -> Entry:
    return min(cell[0][q] for q in _ACCEPTING)


def edited(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows; rows are read one at a time."""
    state, rest = 0, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rest)
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = next(_WRITTEN[r] for r in _WRITTEN if (state, r) in _NEXT)
        state = _NEXT[state, role[0]]
        yield role, text


_ORDER = ["conv_id", "turn", "role", "lead", "digest"]


def _rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns under fixed names, with what orders rows of one turn."""
    text_column = F.coalesce(quoted(text), F.lit(" "))
    return conversations.select(
        quoted(conv_id).alias("conv_id"),
        quoted(turn).cast("bigint").alias("turn"),
        F.coalesce(quoted(role), F.lit(" ")).alias("role"),
        text_column.alias("text"),
        F.substring(text_column, 1, 64).alias("lead"),
        F.sha2(text_column, 256).alias("digest"),
    )


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _faults(rows: DataFrame) -> DataFrame:
    """One line per conversation, turn, role and text, with its faults and number of copies; without the text.

    Copies fold into a number before they are shuffled, and repeats in other turns are looked up by key, so neither a
    hot conversation nor a hot text meets in one task.
    """
    body = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    described = rows.select(
        *_ORDER,
        F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER).alias("initial"),
        (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    folded = stage(described.groupBy(*described.columns).agg(F.count(F.lit(1)).alias("copies")), "turns")
    key = ["conv_id", "role", "digest"]
    repeated = folded.filter(~F.col("blank")).groupBy(*key).agg(
        F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("first_is_null"), F.count(F.lit(1)).alias("places")
    )
    repeated = stage(repeated.filter("places > 1").select(*[F.col(k).alias(f"_{k}") for k in key], "first_turn", "first_is_null"), "repeats")
    on = same("conv_id", "_conv_id") & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    later = F.when(F.col("first_is_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    found = folded.join(repeated, on, "left").select(
        *folded.columns, (~F.col("blank") & F.coalesce(later, F.lit(False))).alias("repeats")
    )
    return stage(found, "faults")


def _counted(faults: DataFrame) -> DataFrame:
    """Fault counts and gaps in the turns of each conversation."""
    whole, none = F.col("copies"), F.lit(0).cast("bigint")
    duplicates = F.when(F.col("blank"), none).when(F.col("repeats"), whole).otherwise(whole - 1)
    cut_off = (F.col("cut") & ~F.col("blank") & ~F.col("repeats")).cast("bigint")
    return faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), none).alias("gaps"),
        F.sum(F.when(F.col("blank"), whole).otherwise(none)).alias("blank"),
        F.sum(duplicates).alias("duplicate"),
        F.sum(cut_off).alias("truncated"),
    )


_CELL = "array<struct<p:int,q:int,cost:bigint,audit:string>>"


def _listed(cell: Cell, starts: Iterable[int]) -> list[dict]:
    return [
        {"p": p, "q": q, "cost": int(cell[p][q][0]), "audit": cell[p][q][1]}
        for p in starts for q in _STATES if cell[p][q] != _NOTHING
    ]


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _flushed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 5000 or size >= 1 << 22:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _cells(faults: DataFrame) -> DataFrame:
    """One cell per conversation and block; a block is a range of rows in order, on one task."""
    parts = int(faults.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    capital = F.when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    kind = F.when(F.col("blank") | F.col("repeats"), GONE).otherwise(capital)
    dealt = faults.select(*_ORDER, kind.alias("kind"), "initial", "copies").repartitionByRange(parts, *_ORDER)
    ordered = dealt.sortWithinPartitions(*_ORDER).select("conv_id", "kind", "initial", "copies")
    fields = T.StructType.fromDDL(f"block int, first string, last string, illegal bigint, cell {_CELL}").fields
    schema = T.StructType([ordered.schema["conv_id"], *fields])
    arrow = to_arrow_schema(schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()

        def runs() -> Iterator[tuple]:
            # Only the first and the last conversation of a block may go on in another one, where any state may meet.
            opening, waiting = True, None
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                if waiting:
                    yield finished(*waiting, whole=not opening)
                    opening = False
                waiting = (conv, *taken(group))
            if waiting:
                yield finished(*waiting, whole=False)

        def taken(group: Iterator[tuple]) -> tuple:
            kinds, first, last, illegal = [], "", "", 0
            for _, kind, initial, copies in group:
                kinds.append(kind + GONE * (copies - 1))
                illegal += bool(last) and not _legal(last, initial)
                illegal += (copies - 1) * (not _legal(initial, initial))
                first, last = first or initial, initial
            return "".join(kinds), first, last, illegal

        def finished(conv, kinds: str, first: str, last: str, illegal: int, whole: bool) -> tuple:
            cell = span_cell(kinds)
            return conv, block, first, last, illegal, _listed(cell, [0] if whole else _STATES)

        yield from _flushed(runs(), arrow)

    return ordered.mapInArrow(parse, schema)


def _parsed(cells: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation, from the cells of its blocks in order."""
    dealt = cells.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    schema = T.StructType([cells.schema["conv_id"], *T.StructType.fromDDL("illegal bigint, cost bigint, audit string").fields])
    arrow = to_arrow_schema(schema)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                found, before, illegal = [], "", 0
                for _, _, first, last, inside, entries in group:
                    illegal += inside + (bool(before) and not _legal(before, first))
                    before = last
                    found.append(_cell((e["p"], e["q"], (e["cost"], e["audit"])) for e in entries))
                cost, audit = cheapest(combine_all(found))
                yield conv, illegal, int(cost), audit

        yield from _flushed(conversations(), arrow)

    return dealt.mapInArrow(settle, schema)


def repairs(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation.

    Null roles and texts count as one space; null turns come first. Rows of one turn go by role, the first 64 signs of
    the text and its digest; repeated rows all stay, and all but the first are duplicates. A role other than one that
    begins with s, u or a cannot be kept. Rows with a null conversation are one conversation; one without rows is in
    no result. Other columns are not read. Runs jobs and stages what they find.

    What must fit one worker is a conversation's audit, one letter per row, as it is one value of the result.
    """
    bounded_batches(conversations.sparkSession)
    faults = _faults(_rows(conversations, conv_id, turn, role, text))
    return met(_counted(faults), _parsed(_cells(faults)))


def met(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the other columns of ``right``, by conversation; a null one meets the null one."""
    other = right.withColumnRenamed("conv_id", "_conv_id")
    return left.join(other, same("conv_id", "_conv_id"), "left").drop("_conv_id")


def repaired_turns(
    conversations: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, role, text): the rows of the repaired conversations, numbered from 0, by what ``repairs``
    found. Conversations lie in order within the partitions, their rows too. Texts are streamed, never held together.
    """
    bounded_batches(conversations.sparkSession)
    rows = _rows(conversations, conv_id, turn, role, text)
    audits = found.select("conv_id", F.col("audit").alias("text"), F.lit(0).alias("kind"))
    both = rows.withColumn("kind", F.lit(1)).unionByName(audits, allowMissingColumns=True)
    # The audit comes before its conversation's rows.
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER[1:])
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL("place bigint, role string, text string").fields])
    arrow = to_arrow_schema(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                audit = next(group)[2]
                for place, (said_by, said) in enumerate(edited(audit, ((r[1], r[2]) for r in group))):
                    yield conv, place, said_by, said

        yield from _flushed(turns(), arrow)

    return dealt.select("conv_id", "role", "text").mapInArrow(write, schema)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the digest of ``role:text`` of the rows ``repaired_turns`` gave, joined by line
    breaks. The digest needs the rows in order, so one task walks over a conversation, holding a row at a time."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                whole = hashlib.sha256()
                for _, place, said_by, said in group:
                    whole.update(f"{chr(10) if place else ''}{said_by}:{said}".encode())
                yield conv, whole.hexdigest()

        yield from _flushed(conversations(), arrow)

    return turns.mapInArrow(digest, schema)
