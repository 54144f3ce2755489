"""Near-duplicate embeddings by an inverted multi-index.

Two codebooks, learnt apart on the halves of a bounded sample of unit vectors, span a grid of cells. A vector lies in
the cell of its nearest pair of codewords, and visits cells in the order of its distance to them (the multi-sequence
order) until the target recall: the reach of a visit is set on the farthest of the true links that a hashed set of
vectors has with all rows, and on partners planted at the threshold itself; if that set has too few links, also on
partners displaced along the differences of vectors. A pair is looked for once, from the cell that comes first. Vectors meet in blocks of bounded size and every
link is verified in double precision. A block returns each vector's number of links and the smallest vector it hangs
together with, so results grow with the vectors and not with the pairs. Exact copies are one vector with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.llm.components import components
from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.operators.staging import stage

_BLOCK = 512


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the numbers the codebooks are fitted on (rows times length), ``pairs`` the vectors of it whose
    links with all rows are looked at; ``per_cell`` sets the grid's size: about that many vectors to a cell, with at most
    ``codewords`` per half."""

    threshold: float = 0.93
    recall: float = 0.999
    sample: int = 2_000_000
    pairs: int = 4_000
    per_cell: int = 512
    codewords: int = 256
    rounds: int = 10
    seed: int = 7


@dataclass(frozen=True)
class Grid:
    """The codebooks of the two halves, and how far beyond its own cell a vector visits."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    def _distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]

        def squared(half: np.ndarray, words: np.ndarray) -> np.ndarray:
            return np.maximum((half**2).sum(1)[:, None] - 2 * half @ words.T + (words**2).sum(1), 0)

        return squared(vectors[:, :cut], self.first), squared(vectors[:, cut:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self._distances(vectors)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def excess(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How much farther each vector is from a given cell than from its own."""
        a, b = self._distances(vectors)
        row, column = np.divmod(cells, len(self.second))
        at = np.arange(len(vectors))
        return a[at, row] + b[at, column] - a.min(1) - b.min(1)

    def visits(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The cells each vector visits, nearest first, its own cell leading.

        Both halves are walked in order of distance; in each row of the grid the walk stops at the reach, and so
        does the walk over rows.
        """
        a, b = self._distances(vectors)
        order_a, order_b = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        out = []
        for x, y, i, j in zip(a, b, order_a, order_b, strict=True):
            x, y = x[i], y[j]
            left = x[0] + y[0] + self.reach - x
            widths = np.searchsorted(y, left[left >= y[0]], "right")
            rows = np.repeat(np.arange(len(widths)), widths)
            columns = np.arange(len(rows)) - np.repeat(np.cumsum(widths) - widths, widths)
            nearest = np.argsort(x[rows] + y[columns], kind="stable")
            out.append(i[rows[nearest]] * len(self.second) + j[columns[nearest]])
        return out


def _codewords(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    words = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = ((words**2).sum(1) - 2 * points @ words.T).argmin(1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=k)
        words[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return words


def learn(sample: np.ndarray, rows: int, settings: Settings) -> Grid:
    """Fit the codebooks on a sample of unit vectors of a table with ``rows`` rows, and the reach on planted partners."""
    rng = np.random.default_rng(settings.seed)
    distinct = np.unique(sample, axis=0)
    k = int(np.clip(round((rows / settings.per_cell) ** 0.5), 1, min(settings.codewords, len(distinct))))
    cut = (sample.shape[1] + 1) // 2
    halves = [_codewords(half, k, settings.rounds, rng) for half in (distinct[:, :cut], distinct[:, cut:])]
    grid = Grid(halves[0], halves[1], 0.0)
    return replace(grid, reach=_planted(grid, sample, rng.normal(size=sample.shape), settings))


def _planted(grid: Grid, sample: np.ndarray, aside: np.ndarray, settings: Settings) -> float:
    """The reach that meets partners planted at the threshold, each vector's displaced towards its row of ``aside``."""
    aside = aside - (aside * sample).sum(1)[:, None] * sample
    aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
    partners = settings.threshold * sample + (1 - settings.threshold**2) ** 0.5 * aside
    return float(np.quantile(grid.excess(sample, grid.cells(partners)), settings.recall))


def _farthest_links(chosen: DataFrame, grid: Grid, asking: pa.Table, settings: Settings) -> tuple[int, float]:
    """How many of the asking vectors have links among all rows of their label, and the farthest excess of one.

    A pair is looked for from the lower cell, so its excess is taken from there. A task sends a row for each asking
    vector with links.
    """
    units, nodes = _matrix(asking["vector"].combine_chunks()), asking["node"].to_numpy()
    labels = np.array(asking["label"].to_pylist(), dtype=object)
    by_label = {label: np.flatnonzero(labels == label) for label in set(labels)}
    held = chosen.sparkSession.sparkContext.broadcast((grid, units, nodes, by_label))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, units, nodes, by_label = held.value
        far = np.full(len(units), -1.0)
        cells, (a, b) = grid.cells(units), grid._distances(units)
        own, (row, column) = a.min(1) + b.min(1), np.divmod(cells, len(grid.second))
        for batch in batches:
            of = np.array(batch.column(1).to_pylist(), dtype=object)
            for label in set(of) & by_label.keys():
                q = by_label[label]
                at = np.flatnonzero(of == label)
                for start in range(0, len(at), 256):
                    some = pa.array(at[start : start + 256])
                    x, names = _matrix(batch.column(2).take(some)), batch.column(0).take(some).to_numpy()
                    i, j = np.nonzero((x @ units[q].T >= settings.threshold) & (names[:, None] != nodes[q][None, :]))
                    j, (c, d), its = q[j], grid._distances(x), grid.cells(x)
                    up, over = np.divmod(its, len(grid.second))
                    forth = c[i, row[j]] + d[i, column[j]] - (c.min(1) + d.min(1))[i]
                    back = a[j, up[i]] + b[j, over[i]] - own[j]
                    np.maximum.at(far, j, np.maximum(np.where(its[i] <= cells[j], forth, back), 0.0))
        hit = np.flatnonzero(far >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(far[hit])], ["asking", "far"])

    found = chosen.select("node", "label", "vector").mapInArrow(measure, "asking int, far double")
    row = found.groupBy("asking").agg(F.max("far").alias("far")).agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).first()
    held.unpersist()
    return row["n"], row["far"] or 0.0


def _reaching(chosen: DataFrame, grid: Grid, sample: pa.Table, settings: Settings) -> Grid:
    """The grid with its reach set on true links too: all those of a hashed set of vectors.

    The share of links missed can be told from these only if ``1 / (1 - recall)`` of the set have some. With fewer,
    partners displaced towards other vectors count as well: they leave their cells straight for the next ones.
    """
    asking, far = _farthest_links(chosen, grid, sample.slice(0, settings.pairs), settings)
    reach = max(grid.reach, far)
    if asking * (1 - settings.recall) < 1 - 1e-9:
        units = _matrix(sample["vector"].combine_chunks())
        towards = units[np.random.default_rng(settings.seed).permutation(len(units))] - units
        reach = max(reach, _planted(grid, units, towards, settings))
    return replace(grid, reach=reach)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows or vanishes."""
    rows = np.array(vectors.to_pylist(), dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _met(blocks: DataFrame, threshold: float) -> DataFrame:
    """(node, links, low) for every vector with links inside a block of askers and targets."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last = None

        def settle() -> Iterator[pa.RecordBatch]:
            ask, meet = [r for r in held if r["asks"]], [r for r in held if not r["asks"]]
            if not ask or not meet:
                return
            unpack = lambda rows: np.stack([np.frombuffer(r["unit"], dtype=np.float64) for r in rows])
            column = lambda rows, name: np.array([r[name] for r in rows], dtype=np.int64)
            x, y = column(ask, "node"), column(meet, "node")
            linked = unpack(ask) @ unpack(meet).T >= threshold
            # Inside a cell both ask; a pair counts once.
            linked &= (column(ask, "own")[:, None] != column(meet, "own")[None, :]) | (x[:, None] < y[None, :])
            some_x, some_y = linked.any(1), linked.any(0)
            if not some_x.any():
                return
            # In a cell's own block a node may stand on both sides.
            names, place = np.unique(np.r_[x, y], return_inverse=True)
            at_x, at_y = place[: len(x)], place[len(x) :]
            low = names.copy()
            while True:
                new = low.copy()
                np.minimum.at(new, at_x, np.where(linked, low[at_y][None, :], low[at_x][:, None]).min(1))
                np.minimum.at(new, at_y, np.where(linked, new[at_x][:, None], new[at_y][None, :]).min(0))
                if (new == low).all():
                    break
                low = new
            links = np.zeros(len(names), dtype=np.int64)
            np.add.at(links, at_x, linked @ column(meet, "weight"))
            np.add.at(links, at_y, column(ask, "weight") @ linked)
            hit = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[hit]), pa.array(links[hit]), pa.array(low[hit])], ["node", "links", "low"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                at = (row["label"], row["cell"], row["block"], row["chunk"])
                if at != last:
                    yield from settle()
                    held, last = [], at
                held.append(row)
        yield from settle()

    order = ["label", "cell", "block", "chunk"]
    dealt = blocks.repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(meet, "node bigint, links bigint, low bigint")


def _usable(vector: Column, id_: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = id_.isNotNull() & label.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    return F.coalesce(usable, F.lit(False))


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``table``: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label and one length link if their cosine reaches the threshold; ``n_links`` counts the other rows
    linked directly, copies too, and the component is the smallest id reachable. A row links with nothing if its id or
    label is null, or its vector is null, empty, zero or holds a null or non-finite number. Other columns are not
    read. Ids are bigint; rows that repeat an id are one node, with the links of all its vectors.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    rows = table.select(
        quoted(id_column).cast("bigint").alias("id"),
        quoted(vector).cast("array<double>").alias("vector"),
        quoted(label).cast("string").alias("label"),
    )
    sound = _usable(F.col("vector"), F.col("id"), F.col("label"))
    # Two hashes name a vector; 0.0 and -0.0 hash alike.
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select(
        "id",
        F.concat_ws(":", F.size("vector").cast("string"), "label").alias("label"),
        sound.alias("sound"),
        F.xxhash64(plain).alias("d0"),
        F.xxhash64(F.lit(3), plain).alias("d1"),
        F.when(sound, F.col("vector")).alias("vector"),
    )
    key = ["label", "d0", "d1"]
    classes = rows.filter("sound").groupBy(*key).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))
    classes = stage(classes, "classes")
    chosen = rows.filter("sound").join(classes.withColumnRenamed("node", "id"), [*key, "id"]).dropDuplicates([*key])
    chosen = stage(chosen.select(F.col("id").alias("node"), "label", "weight", "vector"), "vectors")

    linked = spark.createDataFrame([], "node bigint, links bigint, low bigint")
    for alike, length, count in _by_length(chosen):
        most = max(settings.sample // length, 1)
        hashed = alike.orderBy(F.xxhash64("node", "label"), "node", "label").limit(most)
        sample = hashed.select("node", "label", "vector").toArrow()
        grid = learn(_matrix(sample["vector"].combine_chunks()), count, settings)
        grid = spark.sparkContext.broadcast(_reaching(alike, grid, sample, settings))
        linked = linked.unionByName(stage(_linked(alike, grid, settings), "met"))
    groups = stage(components(linked.select(F.col("node").alias("a"), F.col("low").alias("b"))), "groups")

    per_class = classes.join(linked.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    per_class = per_class.join(groups, "node", "left").select(
        *key,
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "node").alias("component"),
    )
    found = rows.drop("vector").join(per_class.withColumn("sound", F.lit(True)), [*key, "sound"], "left")
    component = F.coalesce("component", "id")
    return found.select(
        F.col("id").alias(id_column),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _by_length(chosen: DataFrame) -> Iterator[tuple[DataFrame, int, int]]:
    """Vectors that can share a grid, with their length and number: those between two powers of two.

    Zeros fill up the shorter ones, which changes no cosine and at most doubles them; there are as many grids as powers.
    """
    size = F.size("vector")
    power = F.ceil(F.log2(size)).cast("int")
    found = chosen.groupBy(power.alias("power")).agg(F.max(size).alias("length"), F.count(F.lit(1)).alias("n"))
    for power_, length, n in sorted(tuple(r) for r in found.collect()):
        zeros = F.array_repeat(F.lit(0.0), F.lit(length) - size)
        yield chosen.filter(power == power_).withColumn("vector", F.concat("vector", zeros)), length, n


def _linked(chosen: DataFrame, grid, settings: Settings) -> DataFrame:
    @F.arrow_udf("struct<unit:binary,own:bigint,visits:array<bigint>>")
    def placed(vectors: pa.Array) -> pa.Array:
        units, index = _matrix(vectors), grid.value
        own = index.cells(units)
        # A pair of cells is met from the one with the lower number.
        visits = [v[v >= o] for v, o in zip(index.visits(units), own, strict=True)]
        return pa.StructArray.from_arrays(
            [
                pa.array([u.tobytes() for u in units], pa.binary()),
                pa.array(own, pa.int64()),
                pa.array(visits, pa.list_(pa.int64())),
            ],
            ["unit", "own", "visits"],
        )

    placed_rows = stage(chosen.select("node", "label", "weight", placed("vector").alias("p")).select("node", "label", "weight", "p.*"), "placed")
    own = placed_rows.select("node", "label", "weight", "unit", "own")
    held = own.groupBy("label", F.col("own").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    asks = placed_rows.select("node", "label", "own", F.explode("visits").alias("cell"))
    sizes = stage(
        asks.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("chunks")).join(held, ["label", "cell"]),
        "cells",
    )
    spread = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["label", "cell", "block", "chunk", "asks", "node", "weight", "own", "unit"]
    targets = own.withColumn("cell", F.col("own")).join(sizes, ["label", "cell"])
    targets = targets.withColumn("block", F.pmod(spread, "blocks")).withColumn("chunk", every("chunks"))
    askers = placed_rows.select("node", "label", "weight", "unit", "own", F.explode("visits").alias("cell"))
    askers = askers.join(sizes, ["label", "cell"])
    askers = askers.withColumn("chunk", F.pmod(spread, "chunks")).withColumn("block", every("blocks"))
    blocks = targets.withColumn("asks", F.lit(False)).select(*columns).unionByName(
        askers.withColumn("asks", F.lit(True)).select(*columns)
    )
    return _met(blocks, settings.threshold)
