"""Line dedup with levelled sorted runs of line hashes; DataFrame operations only.

A run is a table of (hash, documents), bucketed and sorted by hash. A level holds a few of them; then they are merged into
one run of the next level, bucket by bucket and without a shuffle. Each batch of documents is counted per hash, merge-
anti-joined with the keys that the runs count often enough, and what remains is added as a run of its own: a key that is
settled is not counted again. A key's documents may lie in any batch, so the lines of an input meet the settled keys in
a second look, once all its batches are in. Runs may be kept for later inputs, which are then cleaned against them.

Only hashes and positions are shuffled to find the lines; texts move once, to meet their own positions. Keys so hot
that a few thousand of them at most can exist in a batch are broadcast, so that no task gets one line's rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinicpulse.llm.frames import fresh, quoted
from clinicpulse.operators.staging import new_folder, stage

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A key in more than 1 / _HOT of all line rows is hot, so there are fewer than _HOT such keys.
_HOT = 4096


def line_hashes(text: Column, min_chars: int) -> Column:
    """The hash of each line's key, null for keys under ``min_chars``.

    The key is the line without white space at its ends, A-Z in lower case. Hashes have 64 bits: with 10**9 frequent
    keys a line is taken for one of them with a chance of 5 in 10**11.
    """
    ascii_only = F.length(text) == F.octet_length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    keys = F.transform(F.split(folded, "\n", -1), lambda line: F.btrim(line, F.lit(_SPACE)))
    return F.transform(keys, lambda key: F.when(F.length(key) >= min_chars, F.xxhash64(key)))


class LineRuns:
    """Levels of sorted runs: a level holds fewer than ``fanout`` runs, the next level's run merges that many."""

    def __init__(self, spark: SparkSession, fanout: int = 2) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "hash").sortBy("hash").option(
            "path", new_folder(self.spark, "run")
        ).saveAsTable(name)
        return name

    def add(self, hashes: DataFrame, settled_at: int | None = None) -> DataFrame:
        """Count a batch's hashes, one row per document and key, and keep them as a new run.

        Keys that the runs count ``settled_at`` times already are left out; None counts on. Returns the batch's hot keys,
        fewer than ``_HOT``.
        """
        counted = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("documents"))
        batch = self._write(counted.repartition(self.buckets, "hash"))
        rows = self.spark.table(batch)
        size = rows.agg(F.sum("documents")).first()[0] or 0
        hot = stage(rows.filter(F.col("documents") > size / _HOT).select("hash"), "hot")
        if settled_at is not None and self.levels:
            rows = self.unsettled(batch, settled_at)
            own = self._write(rows)
            self.spark.sql(f"DROP TABLE {batch}")
            batch = own
        self._put(batch, 0)
        return hot

    def unsettled(self, batch: str, settled_at: int) -> DataFrame:
        """A batch's rows without the keys that the runs settle, by merge joins with each run.

        The batch's buckets line up with those of every run and stay so from join to join: nothing is shuffled.
        """
        rows, known = self.spark.table(batch), F.lit(0)
        for at, name in enumerate(self.names()):
            run = self.spark.table(name).withColumnRenamed("documents", f"known_{at}")
            rows = rows.join(run.hint("merge"), "hash", "left")
            known = known + F.coalesce(f"known_{at}", F.lit(0))
        return rows.filter(known < settled_at).select("hash", "documents")

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _put(self, run: str, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merge(self.levels[level]))
            for name in self.levels[level]:
                self.spark.sql(f"DROP TABLE {name}")
            self.levels[level] = []
            self._put(merged, level + 1)

    def _merge(self, runs: list[str]) -> DataFrame:
        """Merge-join bucketed runs; the buckets of two line up, so nothing is shuffled. A third one would shuffle."""

        def both(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.withColumnRenamed("documents", "more")
            total = F.coalesce("documents", F.lit(0)) + F.coalesce("more", F.lit(0))
            return left.join(right, "hash", "full").select("hash", total.alias("documents"))

        return reduce(both, [self.spark.table(name) for name in runs])

    def totals(self) -> DataFrame | None:
        """Each hash once, with the documents that hold it; None before the first batch."""
        runs = self.names()
        return self._merge(runs) if runs else None

    def drop(self) -> None:
        """Take the runs out of the catalog; their files go with the shared folder."""
        for name in self.names():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def without_frequent_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_documents: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    runs: LineRuns | None = None,
) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three columns added: the text without frequent lines, its lines before, and the lines dropped.

    Returns the frame and the three names, which avoid those of ``docs``. A line goes, in every document, if its key
    is in at least ``min_documents`` rows. A null or empty text is one empty line, which stays; each row is a document
    of its own, also if rows repeat. Without rows nothing is frequent.

    With ``runs`` the documents of earlier inputs count as well, and this input's runs are added for later ones: a
    later input is cleaned against all before it. Lines of an earlier input that only a later one makes frequent are
    found by a second look, ``without_settled_lines``.
    """
    held = LineRuns(docs.sparkSession) if runs is None else runs
    hashed = _hashed(docs, id_column, text, min_chars)
    hot = []
    for batch in range(batches):
        rows = hashed.filter(F.pmod("row_a", F.lit(batches)) == batch)
        once = rows.select(F.explode(F.array_distinct("hashes")).alias("hash")).filter("hash IS NOT NULL")
        hot.append(held.add(once, min_documents))
    frequent = stage(held.totals().filter(F.col("documents") >= min_documents).select("hash"), "frequent")
    if runs is None:
        held.drop()
    # A key hot in the whole input is hot in a batch.
    return _dropped(docs, hashed, frequent, reduce(DataFrame.unionAll, hot).distinct(), id_column, text)


def without_settled_lines(
    docs: DataFrame,
    runs: LineRuns,
    id_column: str = "doc_id",
    text: str = "text",
    min_documents: int = 10,
    min_chars: int = 1,
) -> tuple[DataFrame, str, str, str]:
    """The same for documents that the runs have counted already: their lines meet the runs, which stay as they are."""
    hashed = _hashed(docs, id_column, text, min_chars)
    lines = hashed.select(F.explode(F.array_distinct("hashes")).alias("hash")).filter("hash IS NOT NULL")
    counted = stage(lines.groupBy("hash").agg(F.count(F.lit(1)).alias("documents")), "counted")
    size = counted.agg(F.sum("documents")).first()[0] or 0
    known = runs.totals()
    if known is None:
        known = counted.limit(0)
    frequent = stage(known.filter(F.col("documents") >= min_documents).select("hash"), "frequent")
    return _dropped(docs, hashed, frequent, counted.filter(F.col("documents") > size / _HOT).select("hash"), id_column, text)


def _row_key(id_column: str, text: str) -> tuple[Column, Column]:
    """Rows with one id and text have the same lines, so they may share these."""
    whole = F.coalesce(quoted(text), F.lit(""))
    return F.xxhash64(quoted(id_column), whole), F.xxhash64(F.lit(1), quoted(id_column), whole)


def _hashed(docs: DataFrame, id_column: str, text: str, min_chars: int) -> DataFrame:
    row_a, row_b = _row_key(id_column, text)
    hashes = line_hashes(F.coalesce(quoted(text), F.lit("")), min_chars)
    return stage(docs.select(row_a.alias("row_a"), row_b.alias("row_b"), hashes.alias("hashes")), "line-hashes")


def _dropped(
    docs: DataFrame, hashed: DataFrame, frequent: DataFrame, hot: DataFrame, id_column: str, text: str
) -> tuple[DataFrame, str, str, str]:
    """``docs`` without their frequent lines. ``hot`` has fewer than ``_HOT`` keys per batch, whatever the input."""
    kept, total, dropped = fresh(docs, "kept_text"), fresh(docs, "lines_before"), fresh(docs, "lines_dropped")
    row_a, row_b, gone = fresh(docs, "_row_a"), fresh(docs, "_row_b"), fresh(docs, "_gone")
    whole = F.coalesce(quoted(text), F.lit(""))
    warm = F.broadcast(stage(frequent.join(F.broadcast(hot), "hash", "left_semi"), "warm"))
    cold = frequent.join(warm, "hash", "left_anti")
    lines = hashed.select("row_a", "row_b", F.posexplode("hashes").alias("position", "hash")).filter("hash IS NOT NULL")
    found = lines.join(warm, "hash", "left_semi").unionByName(
        lines.join(warm, "hash", "left_anti").join(cold, "hash", "left_semi")
    )
    places = stage(found.groupBy("row_a", "row_b").agg(F.collect_set("position").alias("places")), "places")

    at_a, at_b = _row_key(id_column, text)
    marked = docs.withColumn(row_a, at_a).withColumn(row_b, at_b)
    near = places.select(
        F.col("row_a").alias(row_a), F.col("row_b").alias(row_b), F.col("places").alias(gone)
    )
    met = marked.join(near, [row_a, row_b], "left")
    parts = F.split(whole, "\n", -1)
    # A set difference of positions: its cost follows the lines, not lines times dropped lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.coalesce(quoted(gone), F.array().cast("array<int>")))
    cleaned = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    out = met.select(
        *[quoted(c) for c in docs.columns],
        F.when(quoted(gone).isNull(), whole).otherwise(cleaned).alias(kept),
        F.size(parts).cast("bigint").alias(total),
        F.coalesce(F.size(quoted(gone)), F.lit(0)).cast("bigint").alias(dropped),
    )
    return out, kept, total, dropped
