"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinicpulse.llm import lines, minhash, mixing, quality, tiling
from clinicpulse.llm.frames import by_id, quoted, table
from clinicpulse.operators.staging import stage

MIN_SCORE = 0.3
# Wanted share of the tokens by language, the domain the labelled documents are marked with.
TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject; the labels train it and are no input of a score."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", quality.Settings())
    return docs.filter(quality.score(model, F.col("text")) >= MIN_SCORE)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents share; every document stays, ``n_chars`` follows."""
    cleaned, kept, _, _ = lines.without_frequent_lines(docs)
    changed = {"text": quoted(kept), "n_chars": F.length(quoted(kept)).cast("bigint")}
    return cleaned.select(*[changed.get(c, quoted(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows without an id stay."""
    found = minhash.near_duplicates(docs)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return by_id(docs, gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item."""
    gone = tiling.coverage(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select("row_a", "row_b")
    keys = tiling.row_key("doc_id", "text")
    return by_id(docs.select("*", *keys), gone, ["row_a", "row_b"], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens, its posterior over the target domains and the rate that meets ``TARGETS``."""
    marked = table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = by_id(docs.select("doc_id", "text", "lang"), marked, "doc_id", "left_semi")
    labelled = labelled.select("text", F.col("lang").alias("domain"))
    mixed, tokens, posterior, rate = mixing.mix(docs, labelled, TARGETS)
    return mixed.select(
        "doc_id", "lang", "source", F.col(tokens).alias("tokens"), F.col(posterior).alias("posterior"), F.col(rate).alias("rate")
    )


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("mix", mix_sources),
]

# The classifier, the near duplicates and the fitted rates are beyond SQL; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
