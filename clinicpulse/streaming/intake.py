"""Loading export files as they land.

Identity and presence are merges by key of minima and maxima, so they can follow the files: every batch is
typed, its new rows are appended, and the days it touches are merged again. Late rows are simply a batch that
touches older days.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clinicpulse.operators import staging
from clinicpulse.plans import daily
from clinicpulse.plans.identity import USER_ID_PATH
from clinicpulse.sources import landing
from clinicpulse.sources.specs import SPARK_TYPES, ExportSpec

Update = Callable[[date, date], None]


def touched_days(raw: DataFrame, spec: ExportSpec) -> list[date]:
    """The distinct event days of a raw batch, in order; rows without a readable time touch none."""
    source = spec.prefix + spec.field(spec.time).sources[0]
    day = F.to_date(F.col(f"`{source}`").try_cast(SPARK_TYPES[spec.field(spec.time).type]))
    found = raw.select(day.alias("day")).filter("day IS NOT NULL").distinct().orderBy("day")
    return [r["day"] for r in found.collect()]


def stretches(days: list[date]) -> list[tuple[date, date]]:
    """Runs of days without a gap, so that one stray date renews only itself."""
    runs: list[tuple[date, date]] = []
    for day in days:
        if runs and day - runs[-1][1] == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def follow(
    spark: SparkSession,
    w: daily.Warehouse,
    spec: ExportSpec,
    landed: str,
    checkpoint: str,
    update: Update,
    files_per_batch: int = 1000,
    path: str = USER_ID_PATH,
) -> StreamingQuery:
    """Process all files not seen yet, in batches, then stop. ``checkpoint`` must be a shared folder.

    The stream is one of file names, of which a batch has at most ``files_per_batch``; their contents are read as the
    daily loads read them, large files by many tasks. ``update`` is called for each run of event days the batch
    touches. A batch may be run again after a failure, or cut differently: row ids depend on the landed file alone, so
    nothing is appended twice, and the merges give the same result. ``path`` is where params hold the user id.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landed)
        .select("path", "length")
    )

    def load(batch: DataFrame, _: int) -> None:
        with staging.scope(spark):
            raw = staging.stage(landing.read_named(spark, landed, spec, batch.collect()), f"batch-{spec.name}")
            daily.append_export(w, spec, raw, path)
            for stretch in stretches(touched_days(raw, spec)):
                update(*stretch)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
