"""Benchmark decontamination by greedy string tiling.

Seeds are the runs of ``width`` words of the benchmark items. One pass over the documents looks every run of words up
in a bitmap of the seeds, whose size is bounded; the runs that hit, few unless a document holds benchmark text, are
joined with the seeds themselves, so the bitmap costs precision but never results. A document and an item that share
enough seeds to reach the threshold are tiled: the longest common runs are found with running Karp-Rabin hashes and
marked, longest first and never overlapping, until none of ``width`` words is left. The words under tiles are the
covered part of the item, in whatever order the document has them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.llm.hashing import shingles, word_hashes
from clinicpulse.operators.staging import stage

_BASE = 0x2545F4914F6CDD1D | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
# 64 MB at most, whatever the benchmark's size. Up to that a run of words hits by chance once in 65,000 times.
_MAX_BITS = 1 << 29
_BITS_PER_SEED = 64
_PLACES = 4
# Matches are found in portions of about this many, and laid in blocks.
_PORTION, _BLOCK = 1 << 20, 4096


@dataclass(frozen=True)
class Settings:
    """Tiles have ``width`` words at least; a document is contaminated if ``percent`` of an item's words are tiled."""

    width: int = 5
    percent: int = 80


class _Running:
    """Karp-Rabin hashes of every run of a word sequence, for any length, from one running sum."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, dtype=np.uint64)], dtype=np.uint64)
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE, dtype=np.uint64)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(words * up[:n], dtype=np.uint64)]
        self.words, self.free = words, np.ones(n, dtype=bool)

    def hashes(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.down[starts]

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the unmarked runs of ``length``, and their hashes."""
        marked = np.r_[0, np.cumsum(~self.free)]
        starts = np.flatnonzero(marked[length:] == marked[:-length])
        return starts, self.hashes(starts, length)

    def room(self) -> np.ndarray:
        """How many unmarked words follow from each place on."""
        n = len(self.free)
        stops = np.where(self.free, n, np.arange(n))
        return np.minimum.accumulate(stops[::-1])[::-1] - np.arange(n)


def _starts(a: _Running, b: _Running, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where common unmarked runs of ``length`` begin that cannot be extended to the left, in bounded portions.

    Runs with equal hashes and equal unmarked words before them only continue an earlier one. They are left out by
    their place in the sorted order, without ever being paired: n and m equal words begin n + m common runs, not n * m.
    """
    at_a, hash_a = a.runs(length)
    at_b, hash_b = b.runs(length)
    if not len(at_a):
        return
    known = np.unique(hash_a)
    place = np.minimum(np.searchsorted(known, hash_b), len(known) - 1)
    shared = known[place] == hash_b
    at_b, place_b = at_b[shared], place[shared]
    before = np.unique(a.words)

    def kind(side: _Running, at: np.ndarray, none: int) -> np.ndarray:
        """The word before each run as a number; ``none`` where it is marked, missing, or not in the item."""
        word = side.words[at - 1]
        number = np.minimum(np.searchsorted(before, word), len(before) - 1)
        return np.where((at > 0) & side.free[at - 1] & (before[number] == word), number, none)

    kinds = len(before) + 2
    key = np.searchsorted(known, hash_a) * kinds + kind(a, at_a, kinds - 2)
    order = np.argsort(key, kind="stable")
    at_a, key = at_a[order], key[order]
    low, high = np.searchsorted(key, place_b * kinds), np.searchsorted(key, (place_b + 1) * kinds)
    same = place_b * kinds + kind(b, at_b, kinds - 1)
    left, right = np.searchsorted(key, same, "left"), np.searchsorted(key, same, "right")
    first, second = left - low, high - right
    total = np.cumsum(first + second)
    begin = 0
    while begin < len(at_b):
        done = total[begin - 1] if begin else 0
        end = max(int(np.searchsorted(total, done + _PORTION, "right")), begin + 1)
        n, m = first[begin:end], second[begin:end]
        count = n + m
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        skip = np.where(nth < np.repeat(n, count), np.repeat(low[begin:end], count), np.repeat(right[begin:end] - n, count))
        yield at_a[skip + nth], np.repeat(at_b[begin:end], count)
        begin = end


def _matches(a: _Running, b: _Running, length: int) -> tuple[np.ndarray, bool]:
    """Maximal unmarked common runs of at least ``length`` words, longest first: rows of (size, start in a, start in b).

    At most ``2 * _PORTION`` are held. If there are more, these are the first ones in order and the second value says
    that others wait.
    """
    room_a, room_b = a.room(), b.room()
    held, waiting = np.zeros((0, 3), dtype=np.int64), False
    for i, j in _starts(a, b, length):
        # The longest size whose hashes agree, by halving.
        low, high = np.full(len(i), length), np.minimum(room_a[i], room_b[j])
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = a.hashes(i, middle) == b.hashes(j, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        held = np.r_[held, np.stack([low, i, j], axis=1)]
        if len(held) > 2 * _PORTION:
            held, waiting = _ordered(held)[:_PORTION], True
    return _ordered(held), waiting


def _ordered(matches: np.ndarray) -> np.ndarray:
    return matches[np.lexsort((matches[:, 2], matches[:, 1], -matches[:, 0]))]


def tiles(item: np.ndarray, document: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word-hash sequences: (size, start in item, start in document).

    The search length starts long and is halved; ties go to the earlier start in the item, then in the document.
    """
    if min(len(item), len(document)) < width:
        return []
    a, b = _Running(item), _Running(document)
    laid: list[tuple[int, int, int]] = []
    length = max(width, min(len(item), len(document)))
    while True:
        matches, again = _matches(a, b, length)
        for at in range(0, len(matches), _BLOCK):
            size, i, j = matches[at : at + _BLOCK].T
            # Tiles laid before are as long at least, so one that overlaps a match covers an end of it.
            open_ = a.free[i] & a.free[i + size - 1] & b.free[j] & b.free[j + size - 1]
            # What is left of a match after longer tiles is searched anew, at this length or a smaller one.
            again |= not open_.all()
            for s, x, y in matches[at : at + _BLOCK][open_].tolist():
                if a.free[x] and a.free[x + s - 1] and b.free[y] and b.free[y + s - 1]:
                    a.free[x : x + s] = b.free[y : y + s] = False
                    laid.append((s, x, y))
                else:
                    again = True
        if again:
            continue
        if length == width:
            return laid
        length = max(width, length // 2)


def _positions(hashes: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The ``i``-th place of each seed in the bitmap; ``_bitmap`` reckons the same ones."""
    start, stride = hashes >> np.uint64(8), (hashes >> np.uint64(34)) | np.uint64(1)
    return (start + np.uint64(i) * stride) & np.uint64(bits - 1)


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of all seeds, built in chunks on the cluster; its size is ``bits``, not that of the seeds."""
    start, stride = F.shiftrightunsigned("seed", 8), F.shiftrightunsigned("seed", 34).bitwiseOR(F.lit(1))
    places = F.array(*[(start + F.lit(i) * stride).bitwiseAND(F.lit(bits - 1)) for i in range(_PLACES)])
    chunks = (
        seeds.select(F.explode(places).alias("place")).distinct()
        .select(F.shiftright("place", 15).alias("chunk"), F.bitmap_bit_position(F.col("place") + 1).alias("bit"))
        .groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    whole = np.zeros((max(bits >> 15, 1), 4096), dtype=np.uint8)
    for row in chunks.toLocalIterator():
        whole[row["chunk"]] = np.frombuffer(bytes(row["bitmap"]), dtype=np.uint8)
    return whole.reshape(-1)


def coverage(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """(row_a, row_b, items, item_id, covered, contaminated) of the documents that share seeds with an item.

    ``row_a`` and ``row_b`` are ``row_key(id, text)``, the hashes rows are joined back on. ``covered`` is the largest share of an item's
    words under tiles, ``item_id`` that item (the smaller id if equal), ``items`` the number of items at or over the
    threshold. Null, empty and blank texts share nothing, nor do items under ``width`` words; repeated documents or
    items each count with the same result. Without documents or items the table is empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    width, percent = settings.width, settings.percent

    @F.arrow_udf("struct<words:int,seeds:array<struct<seed:bigint,places:int>>>")
    def seeded(texts: pa.Array) -> pa.Array:
        words = [word_hashes(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        seeds = [np.unique(shingles(w, width), return_counts=True) if len(w) >= width else (w[:0], []) for w in words]
        ends = np.cumsum([0, *(len(x) for x, _ in seeds)])
        flat = np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in seeds)]).astype(np.int64)
        places = np.concatenate([np.zeros(0, np.int64), *(n for _, n in seeds)]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(flat), pa.array(places)], ["seed", "places"])
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        return pa.StructArray.from_arrays([pa.array([len(w) for w in words], pa.int32()), listed], ["words", "seeds"])

    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text")).distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "item_text"))
    items = stage(items.select("*", seeded("item_text").alias("s")).select("item", "item_id", "item_text", "s.*"), "items")
    seeds = items.select("item", "words", F.inline("seeds"))
    count = seeds.count()
    bits = min(max(1 << math.ceil(math.log2(_BITS_PER_SEED * count + 1)), 1 << 16), _MAX_BITS)
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds, bits))

    @F.arrow_udf("array<bigint>")
    def hits(texts: pa.Array) -> pa.Array:
        found, table = [], bitmap.value
        for t in texts.cast(pa.binary()).to_pylist():
            words = word_hashes(t or b"")
            if len(words) < width:
                found.append(None)
                continue
            seeds = shingles(words, width)
            for i in range(_PLACES):
                # Few seeds outlast the first place.
                at = _positions(seeds, i, bits)
                seeds = seeds[((table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]
            some = np.unique(seeds)
            found.append(some.astype(np.int64) if len(some) else None)
        return pa.array(found, pa.list_(pa.int64()))

    source = docs.select(*row_key(id_column, text), quoted(text).alias("text"))
    near = stage(source.withColumn("hits", hits("text")).filter("hits IS NOT NULL"), "hits")
    rows = ["row_a", "row_b"]
    # Tiles of ``width`` words hold a seed's place each, longer ones more, and no two the same place: seeds with fewer
    # places in the item cannot cover enough. A seed that the item repeats counts with all its places.
    least = F.ceil(F.col("words") * percent / (100.0 * width) - F.lit(1e-9))
    pairs = (
        near.select(*rows, F.explode("hits").alias("seed"))
        .distinct()
        .join(seeds, "seed")
        .groupBy(*rows, "item")
        .agg(F.sum("places").alias("common"), F.first("words").alias("words"))
        .filter(F.col("common") >= least)
        .select(*rows, "item")
    )

    @F.arrow_udf("double")
    def covered(item_texts: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(item_texts.cast(pa.binary()).to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
            item = word_hashes(a)
            out.append(sum(size for size, _, _ in tiles(item, word_hashes(b), width)) / len(item))
        return pa.array(out, pa.float64())

    texts = near.select(*rows, "text").dropDuplicates(rows)
    tiled = (
        pairs.join(items.select("item", "item_id", "item_text"), "item")
        .join(texts, rows)
        .select(*rows, "item_id", covered("item_text", "text").alias("covered"))
    )
    over = F.col("covered") * 100 >= F.lit(float(percent)) - 1e-9
    best = F.min(F.struct((-F.col("covered")).alias("least"), "item_id"))
    return stage(
        tiled.groupBy(*rows)
        .agg(F.count_if(over).alias("items"), best.alias("best"))
        .select(*rows, "items", F.col("best.item_id").alias("item_id"), (-F.col("best.least")).alias("covered")),
        "covered",
    ).withColumn("contaminated", F.col("items") > 0)


def row_key(id_column: str, text: str) -> tuple:
    """Two hashes of a row's id and text; rows that agree on both have the same text, so they may share results."""
    return (
        F.xxhash64(quoted(id_column), quoted(text)).alias("row_a"),
        F.xxhash64(F.lit(2), quoted(id_column), quoted(text)).alias("row_b"),
    )
