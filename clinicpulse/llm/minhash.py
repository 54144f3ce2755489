"""Near-duplicate documents by one-permutation MinHash with optimal densification, banded buckets and stars.

One pass hashes a document's distinct word shingles once each, keeps the smallest hash of each bin, and lets an empty
bin borrow from the bins a fixed random sequence names until one is full. Runs of bins form bands; documents that
agree on a band share a bucket. A bucket adds one edge per member, to its smallest document, so edges grow with the
rows and not with their squares. Every edge is confirmed on the full shingle sets, and confirmed links are folded into
components.

A star can miss a link between two documents neither of which is like the centre. So buckets that still hold
several components are settled afterwards: their members outside the largest component meet the others in blocks of
bounded size, a sketch names the pairs that may reach the threshold, and these are confirmed on full sets too; first
the most similar few, then all that are left. Exact copies are one document throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.llm.components import components
from clinicpulse.llm.frames import bounded_batches
from clinicpulse.llm.hashing import mix, shingle_set
from clinicpulse.operators.staging import stage

_BORROWS = 1024
_SKETCH_BINS = 512
_BLOCK = 512
_FEW = 4


@dataclass(frozen=True)
class Settings:
    """Words per shingle; a link needs ``100 * intersection >= percent * union``; ``bands`` of ``rows`` bins each.

    At the threshold of 0.8 a pair misses every band with a chance of 3 in a million.
    """

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def _borrowing(bins: int) -> np.ndarray:
    """For each bin, the bins it borrows from, in order, if it is empty."""
    return np.random.Generator(np.random.PCG64(31)).integers(0, bins, (_BORROWS, bins))


def _bin_minima(hashes: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The filled bins of a sorted set, and the smallest hash of each."""
    of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.r_[True, of[1:] != of[:-1]]
    return of[first], hashes[first]


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One hash per bin of a sorted, non-empty shingle set; empty bins borrow."""
    of, least = _bin_minima(hashes, bins)
    values, filled = np.zeros(bins, dtype=np.uint64), np.zeros(bins, dtype=bool)
    values[of], filled[of] = least, True
    empty = np.flatnonzero(~filled)
    for upto in (16, _BORROWS):
        if not len(empty):
            return values
        turns = _borrowing(bins)[:upto, empty]
        full = filled[turns]
        found = full.any(axis=0)
        values[empty[found]] = values[turns[full.argmax(axis=0), np.arange(len(empty))][found]]
        empty = empty[~found]
    # Past the fixed sequence: the next full bin, wrapping round.
    values[empty] = values[of[np.searchsorted(of, empty) % len(of)]]
    return values


def band_keys(values: np.ndarray, settings: Settings) -> np.ndarray:
    """A bucket key for each band; different bands never share one but by chance."""
    steps = np.arange(1, settings.rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    rows = mix(values.reshape(settings.bands, settings.rows) ^ steps)
    weights = np.uint64(2) * np.arange(1, settings.rows + 1, dtype=np.uint64) + np.uint64(1)
    return mix((rows * weights).sum(axis=1, dtype=np.uint64) + np.arange(settings.bands, dtype=np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each sketch bin cut to 16 bits; 0 marks an empty bin."""
    values = np.zeros(_SKETCH_BINS, dtype=np.uint16)
    if len(hashes):
        of, least = _bin_minima(hashes, _SKETCH_BINS)
        values[of] = (mix(least) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
    return values


def may_link(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> tuple:
    """Which pairs of sketch rows may reach the threshold, and how similar they look.

    A pair is ruled out by its sizes, by a union that is too large already, or by five standard errors of the sketch;
    the error shrinks with the part of the union that lies beyond the sketch.
    """
    some = (left != 0) | (right != 0)
    full = some.sum(axis=1)
    share = ((left == right) & some).sum(axis=1) / np.maximum(full, 1)
    level, both = percent / 100, n_left + n_right
    # A pair at the threshold has a union of this size, one above it a smaller one.
    union = both / (1 + level)
    unseen = np.maximum(0.02, 1 - full / np.maximum(union, 1))
    error = np.sqrt(level * (1 - level) / np.maximum(full, 1) * unseen)
    sizes = 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    return sizes & (full <= union + 1e-9) & (share >= level - 5 * error), share


def _signed(text: Column, settings: Settings) -> Column:
    @F.arrow_udf("struct<n:bigint,d0:bigint,d1:bigint,bands:array<bigint>>")
    def signed(texts: pa.Array) -> pa.Array:
        n, d0, d1, bands = [], [], [], []
        for raw in texts.cast(pa.binary()).to_pylist():
            found = shingle_set(raw, settings.width)
            n.append(len(found))
            if not len(found):
                d0.append(None), d1.append(None), bands.append(None)
                continue
            # Two independent sums identify the set.
            d0.append(int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
            d1.append(int(mix(found + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).astype(np.int64)))
            bands.append(band_keys(signature(found, settings.bins), settings).astype(np.int64))
        arrays = [pa.array(n, pa.int64()), pa.array(d0, pa.int64()), pa.array(d1, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, ["n", "d0", "d1", "bands"])

    return signed(text)


def _confirmed(edges: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The edges (a, b) whose full shingle sets are similar enough."""
    width, percent = settings.width, settings.percent

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        sets = lru_cache(maxsize=16)(lambda raw: shingle_set(raw, width))
        found = []
        for a, b in zip(left.cast(pa.binary()).to_pylist(), right.cast(pa.binary()).to_pylist(), strict=True):
            x, y = sets(a), sets(b)
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(found, pa.bool_())

    first = edges.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.filter(linked("text_a", "text_b")).select("a", "b").distinct()


def _blocks(members: DataFrame) -> DataFrame:
    """Cut the open buckets (key, node, component) into blocks of about ``_BLOCK`` on either side.

    A member is repeated for the blocks it meets, so its sketch is joined later.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    per_key = sizes.groupBy("key").agg(
        F.sum("size").alias("total"), F.max(F.struct("size", "component")).alias("most")
    )
    per_key = per_key.select(
        "key",
        F.col("most.component").alias("main"),
        F.ceil(F.col("total") / _BLOCK).alias("blocks"),
        F.ceil((F.col("total") - F.col("most.size")) / _BLOCK).alias("chunks"),
    )
    known = members.join(per_key, "key").withColumn("spread", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["node", "component", (F.col("component") == F.col("main")).alias("inside")]
    # A target meets every chunk of askers, an asker every block of targets.
    targets = known.select(
        "key", F.pmod("spread", "blocks").alias("block"), every("chunks").alias("chunk"), F.lit(False).alias("asks"), *columns
    )
    askers = known.filter("component <> main").select(
        "key", every("blocks").alias("block"), F.pmod("spread", "chunks").alias("chunk"), F.lit(True).alias("asks"), *columns
    )
    return targets.unionByName(askers)


def _likely_pairs(blocks: DataFrame, percent: int, most: int | None) -> DataFrame:
    """For each asker of a block, the targets of other components it may be linked to; ``most`` of them if given.

    Two documents meet in every bucket they share, but make a pair in the first of them only.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last = None

        def settle() -> Iterator[pa.RecordBatch]:
            ask, meet = [r for r in held if r["asks"]], [r for r in held if not r["asks"]]
            if not ask or not meet:
                return
            numbers = lambda rows, name: np.array([r[name] for r in rows], dtype=np.int64)
            sketches = lambda rows: np.stack([np.frombuffer(r["sketch"], dtype=np.uint16) for r in rows])
            a, b = numbers(ask, "node"), numbers(meet, "node")
            fit = numbers(ask, "component")[:, None] != numbers(meet, "component")[None, :]
            # Where either asks the other, one direction is enough.
            fit &= (a[:, None] < b[None, :]) | np.array([r["inside"] for r in meet])[None, :]
            bands = numbers(ask, "bands")
            first = (bands[:, None, :] == numbers(meet, "bands")[None, :, :]).argmax(axis=2)
            fit &= first == (bands == last[0]).argmax(axis=1)[:, None]
            x, y = np.nonzero(fit)
            left, right, n_left, n_right = sketches(ask), sketches(meet), numbers(ask, "n"), numbers(meet, "n")
            shares = np.full(fit.shape, -1.0)
            for at in range(0, len(x), 4096):
                i, j = x[at : at + 4096], y[at : at + 4096]
                ok, share = may_link(left[i], right[j], n_left[i], n_right[j], percent)
                shares[i[ok], j[ok]] = share[ok]
            fit = shares >= 0
            if most is not None and fit.shape[1] > most:
                fit &= np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1) < most
            x, y = np.nonzero(fit)
            if len(x):
                a, b = a[x], b[y]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                at = (row["key"], row["block"], row["chunk"])
                if at != last:
                    yield from settle()
                    held, last = [], at
                held.append(row)
        yield from settle()

    order = ["key", "block", "chunk"]
    dealt = blocks.repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(pairs, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    The component is the smallest id reachable over links; ``kept`` marks the document that has it. Texts that are
    null, empty or blank have no shingles and link with nothing. Rows that repeat an id are one document that has
    the links of each of its texts. A null id links with nothing, has a null component and is kept. Other columns
    of ``docs`` are not read. Ids are bigint.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_column).cast("bigint").alias("node"), F.col(text).alias("text"))
    signed = stage(source.select("node", _signed(F.col("text"), settings).alias("s")).select("node", "s.*"), "signatures")

    full = signed.filter("n > 0 AND node IS NOT NULL")
    classes = stage(
        full.groupBy("d0", "d1").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("rows")), "classes"
    )
    name = ["node", "d0", "d1"]
    # Repeated rows are one member of their buckets.
    heads = full.join(classes.select(*name), name, "left_semi").dropDuplicates(name)
    keys = heads.select("node", F.explode(F.array_distinct("bands")).alias("key"))
    shared = stage(
        keys.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last"),
        "buckets",
    )
    met = stage(keys.join(shared.select("key", "centre"), "key"), "members")
    texts = stage(source.join(met.select("node").distinct(), "node", "left_semi"), "texts")

    # Texts that share an id are one document.
    one = full.groupBy("node").agg(F.min("d0").alias("d0"), F.max("d0").alias("d1")).filter("d0 <> d1").select("node")
    of_class = full.select("node", "d0", "d1").join(
        classes.select("d0", "d1", F.col("node").alias("class")), ["d0", "d1"]
    ).select("node", "class")
    tied = of_class.join(one, "node", "left_semi").select(F.col("node").alias("a"), F.col("class").alias("b"))

    tried = stage(met.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "tried")
    links = stage(_confirmed(tried, texts, settings).unionByName(tied), "links")
    groups = stage(components(links), "groups")

    @F.arrow_udf("struct<n:bigint,sketch:binary,bands:array<bigint>>")
    def sketched(raw: pa.Array) -> pa.Array:
        sets = [shingle_set(t, settings.width) for t in raw.cast(pa.binary()).to_pylist()]
        bands = [band_keys(signature(s, settings.bins), settings).astype(np.int64) if len(s) else [] for s in sets]
        return pa.StructArray.from_arrays(
            [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["n", "sketch", "bands"],
        )

    marks = None
    for most in (_FEW, None):
        placed = met.select("key", "node").join(groups, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        )
        several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_ = stage(placed.join(several.filter("low < high").select("key"), "key", "left_semi"), "open")
        if open_.isEmpty():
            break
        if marks is None:
            # Buckets only ever close, so these serve the later round too.
            marks = texts.join(open_.select("node").distinct(), "node", "left_semi")
            marks = marks.select("node", sketched("text").alias("s")).select("node", "s.n", "s.sketch", "s.bands")
            marks = stage(marks.filter("n > 0"), "sketches")
        pairs = _likely_pairs(_blocks(open_).join(marks, "node"), settings.percent, most)
        new = stage(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = stage(_confirmed(new, texts, settings), "links")
        tried = tried.unionByName(new)
        if not more.isEmpty():
            known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = stage(components(known.unionByName(more)), "groups")

    whole = stage(
        of_class.distinct().join(groups.withColumnRenamed("node", "class"), "class", "left")
        .groupBy("node").agg(F.min(F.coalesce("component", "class")).alias("component")),
        "components",
    )
    found = signed.select("node", "n").join(whole, "node", "left")
    component = F.coalesce("component", "node")
    return found.select(
        F.col("node").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("node") == component, F.lit(True)).alias("kept"),
    )
