"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME = {
    # Days and months are cut in UTC, whatever the cluster's own zone is.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where the next aggregate then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet columns unpack to several times their size on disk; a side is broadcast on the larger figure.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # A filtered side of some million keys cuts a large scan by a Bloom filter of at most 8 MB before rows are shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the jobs need on a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "clinicpulse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
