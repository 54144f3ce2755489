"""Packing of documents into sequences of fixed length, by bounded-space online best-fit.

Texts become token ids and are cut into pieces. Pieces are dealt over tasks by hash, in windows that are sorted from
long to short, and arrive one by one at a packer with a fixed number of open bins. The bins are keyed by their free
space in a bitset: the lowest set bit at or above a piece's length is the bin it fits best. When none fits and all bins
are in use, the fullest closes and a new one opens. A task holds the bins' figures, never the pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinicpulse.llm.frames import bounded_batches, quoted

# The pattern that cuts texts before the merges of a byte-level vocabulary, white space, and the
# printable signs that stand for bytes in such a file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_WHITE = "\t-\r \x85\xa0  -     　"
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# No pre-token spans a change from other signs to white space, so long texts are encoded in slices that end at one.
_SLICE = 1 << 20
_SLICE_END = re.compile(f"[^{_WHITE}](?=[{_WHITE}])")
_BATCH_BYTES = 1 << 22
_SEQUENCES_PER_PART = 1 << 33
_encoders: dict[str, tiktoken.Encoding] = {}


@dataclass(frozen=True)
class Settings:
    """``limit``: tokens of a sequence; ``end``: the id that closes a document; ``open_bins``: sequences a task keeps
    open; ``window``: documents whose pieces arrive from long to short; ``windows``: such windows per task."""

    limit: int = 1024
    end: int = 2
    open_bins: int = 4096
    window: int = 8192
    windows: int = 2


class Packer:
    """Online best-fit into bins of ``limit``, at most ``open_bins`` of them open."""

    def __init__(self, limit: int, open_bins: int) -> None:
        self.limit, self.open_bins = limit, open_bins
        # Bit f is set if an open bin has f tokens free; those bins are in held[f].
        self.free, self.held = 0, [[] for _ in range(limit + 1)]
        self.opened = self.n = 0

    def _take(self, space: int) -> int:
        bins = self.held[space]
        number = bins.pop()
        if not bins:
            self.free &= ~(1 << space)
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin a piece goes to and its offset there."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.opened == self.open_bins:
                # The lowest bit is the fullest bin.
                self._take((self.free & -self.free).bit_length() - 1)
                self.opened -= 1
            space, number = self.limit, self.n
            self.n += 1
            self.opened += 1
        left = space - length
        if left:
            self.held[left].append(number)
            self.free |= 1 << left
        else:
            self.opened -= 1
        return number, self.limit - space


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids by byte string, and special tokens, of a byte-level vocabulary file whose ids are in the order of merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model["type"] != "BPE" or spec["normalizer"] or any(before.get(k) != v for k, v in plain.items()):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].split() != [t["content"]] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take in their surroundings")
    others = iter(range(0x100, 0x200))
    byte_of = {chr(b) if b in _PRINTED else chr(next(others)): b for b in range(256)}
    ids = {bytes(map(byte_of.__getitem__, word)): i for word, i in model["vocab"].items() if word not in specials}
    merged = [model["vocab"][m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(ids) != len(merged) + 256:
        raise ValueError(f"{path} does not number its symbols in the order of its merges")
    return ids, specials


class Encoder:
    """Token ids of whole texts; the vocabulary is broadcast and built once per worker."""

    def __init__(self, spark, path: str) -> None:
        ids, specials = vocabulary(path)
        self.key = hashlib.sha256(repr((sorted(ids.items()), sorted(specials.items()))).encode()).hexdigest()
        self.held = spark.sparkContext.broadcast((ids, specials))

    def encode(self, text: str) -> np.ndarray:
        if self.key not in _encoders:
            ids, specials = self.held.value
            _encoders[self.key] = tiktoken.Encoding(self.key, pat_str=PATTERN, mergeable_ranks=ids, special_tokens=specials)
        of = _encoders[self.key].encode_to_numpy
        if len(text) <= _SLICE:
            return of(text, allowed_special="all")
        parts, at = [], 0
        while at < len(text):
            cut = _SLICE_END.search(text, at + _SLICE)
            end = cut.end() if cut else len(text)
            parts.append(of(text[at:end], allowed_special="all"))
            at = end
        return np.concatenate(parts)


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row: its token ids, little-endian in 32 bits, in pieces.

    A null text counts as empty, which is the closing id alone. Only documents above the limit are cut; all pieces but
    the first then have ``limit`` tokens. Texts of any length are encoded whole; what a worker holds of one is its ids.
    Other columns are not read; repeated rows each give their pieces.
    """
    spark, limit, end = docs.sparkSession, settings.limit, settings.end
    bounded_batches(spark)
    encoder = Encoder(spark, path)
    rows = docs.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("piece int, start bigint, length bigint, ids binary").fields])
    arrow = to_arrow_schema(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at, value in enumerate(batch.column(1)):
                ids = np.append(encoder.encode(value.as_py()), end).astype("<u4")
                cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)] if len(ids) > limit else [0, len(ids)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    held.append((batch.column(0)[at].as_py(), piece, start, stop - start, ids[start:stop].tobytes()))
                    size += 4 * (stop - start)
                    if size >= _BATCH_BYTES or len(held) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return rows.mapInArrow(encode, schema)


def packed(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``pieces`` with the sequence each goes to and its offset there; a sequence's pieces leave no gap.

    Counts the rows at once. A document has at most one piece below the limit, so rows tell how many windows are
    needed. Which pieces meet depends on hashes of ids alone, so a task that is run again places them alike; equal
    pieces of equal ids may change places. No rows give no sequences.
    """
    windows = max(1, -(-docs.count() // settings.window))
    tasks = -(-windows // settings.windows)
    found = pieces(docs, path, doc_id, text, settings)
    window = F.pmod(F.xxhash64("doc_id", "piece", "length", F.crc32("ids")), F.lit(windows))
    dealt = (
        found.withColumn("window", window)
        .withColumn("part", F.pmod("window", F.lit(tasks)))
        .repartitionById(tasks, F.col("part").cast("int"))
        .sortWithinPartitions("part", "window", F.desc("length"), "doc_id", "piece", "ids")
    )
    schema = T.StructType([*found.schema.fields, *T.StructType.fromDDL("sequence_id bigint, offset bigint").fields])
    arrow, limit, open_bins = to_arrow_schema(schema), settings.limit, settings.open_bins
    names = found.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part_now, first = None, None, 0
        for batch in batches:
            sequence, offset = [], []
            for part, length in zip(batch.column("part").to_pylist(), batch.column("length").to_pylist()):
                if part != part_now:
                    packer, part_now, first = Packer(limit, open_bins), part, part * _SEQUENCES_PER_PART
                number, place = packer.place(length)
                sequence.append(first + number)
                offset.append(place)
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], schema=arrow)

    return dealt.mapInArrow(pack, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): each sequence's token ids in order, and where its pieces start.

    A group holds at most ``limit`` tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.col("parts.offset").alias("starts"))
