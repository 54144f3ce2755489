"""A quality classifier: hashed word and character n-gram vectors, averaged per document, then softmax.

Every word (lower-cased), every word that repeats the one before it, and every run of 3 to 5 characters within a word
and its bounds has a learned vector in a hashed table; a document is the mean of its vectors. Training is stochastic
gradient descent in numpy over a bounded sample of labelled rows. Scoring folds the output layer into the table, so that a document costs one look-up per
feature; it covers the whole text and runs as an Arrow UDF beside the scan, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.llm.hashing import mix, word_hashes
from clinicpulse.operators.staging import stage

_SLOTS = np.random.Generator(np.random.PCG64(21)).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Settings:
    """``rows`` and ``slots`` bound the labelled rows that are learnt from: their number, and the distinct features of all
    of them together (8 bytes each), which the driver holds. A row is learnt from whole or not at all.

    ``steps`` counts single documents: few labelled rows are gone over again until it is reached.
    """

    bits: int = 17
    dim: int = 8
    rows: int = 4000
    slots: int = 40_000_000
    steps: int = 12_000
    rate: float = 1.0
    seed: int = 5


def feature_ids(text: bytes | None, bits: int) -> np.ndarray:
    """The hashed features of a whole UTF-8 text, repeats included; none for a null or blank text."""
    if not text:
        return np.empty(0, dtype=np.int32)
    shift = np.uint64(64 - bits)
    words = word_hashes(text)
    # A word that repeats the one before it also gives the shared feature of slot 0.
    echoes = np.zeros(np.count_nonzero(words[1:] == words[:-1]), dtype=np.int32)
    found = [(mix(words + np.uint64(1)) >> shift).astype(np.int32), echoes]
    codes = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    if codes.max() > 127:
        codes = np.frombuffer(codes.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes = np.where(blank, 32, codes).astype(np.uint64)
    before = np.r_[0, np.cumsum(blank, dtype=np.int64)]
    total = codes[:-1] * _SLOTS[0] + codes[1:] * _SLOTS[1]
    for n in (3, 4, 5):
        count = len(codes) - n + 1
        if count < 1:
            break
        total = total[:count] + codes[n - 1 :] * _SLOTS[n - 1]
        # Blanks may stand at the ends of a run only.
        whole = before[n - 1 : n - 1 + count] == before[1 : 1 + count]
        found.append(((total[whole] * _SLOTS[7]) >> shift).astype(np.int32))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """``weights`` holds the difference of the two outputs for each slot of the table."""

    bits: int
    weights: np.ndarray
    bias: float

    def score(self, text: bytes | None) -> float:
        ids = feature_ids(text, self.bits)
        z = self.bias + (float(self.weights[ids].mean()) if len(ids) else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50.0, 50.0))))


def descend(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Stochastic gradient descent over (slots, counts, label) rows, in a new but repeatable order each time round."""
    share = np.mean([y for _, _, y in rows]) if rows else 0.5
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    prior = np.array([np.log(1 - share), np.log(share)])
    if len({y for _, _, y in rows}) < 2:
        return Model(settings.bits, np.zeros(1 << settings.bits, dtype=np.float32), float(prior[1] - prior[0]))
    rng = np.random.default_rng(settings.seed)
    table = rng.uniform(-1, 1, (1 << settings.bits, settings.dim)) / settings.dim
    out = np.zeros((settings.dim, 2))
    bias = prior.copy()
    done = 0
    while done < settings.steps:
        for at in rng.permutation(len(rows))[: settings.steps - done]:
            slots, counts, label = rows[at]
            rate = settings.rate * (1 - done / settings.steps)
            done += 1
            if not len(slots):
                continue
            part = counts / counts.sum()
            mean = part @ table[slots]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.01 * rate * p
            # A slot's share is small in a long text; the root keeps frequent slots from drowning the rest.
            table[slots] -= rate * np.outer(part / np.sqrt((part**2).sum()), back)
    return Model(settings.bits, (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, settings: Settings) -> Model:
    """Learn ``label`` (0 or 1) from the texts of the labelled ``docs``.

    Learnt from are the labelled rows whose ids hash lowest, at most ``settings.rows`` of them and no more than have
    ``settings.slots`` distinct features together, each with its whole text; null ids and labels teach nothing,
    repeated rows once. With no labelled row every score is 0.5, with one label only it is near that label.
    """
    bounded_batches(docs.sparkSession)
    bits = settings.bits

    @F.arrow_udf("struct<slots:binary,counts:binary>")
    def packed(texts: pa.Array) -> pa.Array:
        slots, counts = [], []
        for raw in texts.cast(pa.binary()).to_pylist():
            ids, n = np.unique(feature_ids(raw, bits), return_counts=True)
            slots.append(ids.astype(np.int32).tobytes())
            counts.append(n.astype(np.int32).tobytes())
        return pa.StructArray.from_arrays([pa.array(slots, pa.binary()), pa.array(counts, pa.binary())], ["slots", "counts"])

    known = labels.select(quoted(id_column).alias("_id"), quoted(label).cast("int").alias("_y"))
    known = known.filter("_id IS NOT NULL AND _y IN (0, 1)")
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(settings.rows)
    texts = docs.select(quoted(id_column).alias("_id"), quoted(text).alias("_text"))
    # The sample's size is bounded by the setting, whatever the tables hold.
    found = texts.join(F.broadcast(sample), "_id").select("_id", "_y", packed("_text").alias("f"))
    found = found.select("_y", "f.slots", "f.counts", F.xxhash64("_id", "_y", "f.slots").alias("_place"))
    found = stage(found.withColumn("_n", F.octet_length("slots") / 4).dropDuplicates(["_place"]), "features")
    # A pair of numbers per row tells up to which place the rows fit.
    fitting = found.select("_place", "_n").orderBy("_place").limit(settings.rows).collect()
    ends = np.cumsum([r["_n"] for r in fitting])
    kept = [r["_place"] for r, end in zip(fitting, ends) if end <= settings.slots]
    chosen = found.filter(F.col("_place") <= (kept[-1] if kept else -(2**63)))
    read = lambda raw: np.frombuffer(raw, dtype=np.int32)
    # A part at a time, so that the driver holds the rows once.
    rows = [(r["_place"], read(r["slots"]), read(r["counts"]), r["_y"]) for r in chosen.toLocalIterator()]
    rows.sort(key=lambda r: r[0])
    return descend([r[1:] for r in rows], settings)


def score(model: Model, text: Column) -> Column:
    """The probability of label 1 for a text; a null or empty text gets the model's bias alone."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(raw) for raw in texts.cast(pa.binary()).to_pylist()], pa.float64())

    return scored(text)
