"""Mixing documents to target domain weights by soft membership.

A naive Bayes classifier, counted over all rows of a labelled table, gives each document a posterior over the domains.
How much a text's words count, and how that grows with their number, is fitted to the log loss of held-out rows.
Non-negative rates are then fitted by least squares so that the expected tokens of each domain meet their targets: a
projected gradient whose step sums a few numbers over all documents and sends a few back. A rate depends on the
document's posterior and the steps so far, so it is recomputed where it is needed and no state is kept between steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clinicpulse.llm.frames import bounded_batches, fresh, quoted
from clinicpulse.llm.hashing import word_hashes
from clinicpulse.operators.staging import stage


@dataclass(frozen=True)
class Settings:
    """``evidence``: a text's words count like this many independent ones at most; fitted on held-out rows if None.

    ``total`` is the wanted number of tokens as a share of what is there. Steps end once the largest difference from
    a target is under ``close`` of the total, or after ``steps`` of them.
    """

    slots: int = 1 << 14
    evidence: float | None = None
    total: float = 1.0
    close: float = 1e-5
    steps: int = 60


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    prior: np.ndarray
    log_odds: np.ndarray
    evidence: float
    growth: float = 0.0

    def posterior(self, words: np.ndarray) -> np.ndarray:
        """The prior for a text without words; n words count like ``evidence * n**growth`` independent ones, or n."""
        logits = self.prior
        if len(words):
            seen = self.log_odds[:, words % np.uint64(self.log_odds.shape[1])]
            logits = logits + min(len(words), self.evidence * len(words) ** self.growth) * seen.mean(axis=1)
        p = np.exp(logits - logits.max())
        return p / p.sum()


# What is tried for ``evidence`` and ``growth``; the first is taken if no rows are held out.
_SOFTNESS = [(2.0, 0.0)] + [(2.0**e, g / 4) for g in range(5) for e in range(-4, 7) if (e, g) != (1, 0)]
# A text in so many is held out, copies with it.
_ASIDE = 5


def train(labelled: DataFrame, text: str, domain: str, domains: tuple[str, ...], settings: Settings) -> Classifier:
    """Count words by domain over every labelled row; rows of other or null domains teach nothing.

    Words are hashed into ``slots``, so what reaches the driver is twice slots times domains. The softness is fitted on
    the rows held out, by a model of the others. Without rows the posterior is even.
    """
    bounded_batches(labelled.sparkSession)
    slots, known = settings.slots, list(domains)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, len(known), slots + 1), dtype=np.int64)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for name, raw, aside in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True):
                k = known.index(name)
                seen[int(aside), k, slots] += 1
                words = word_hashes(raw or b"") % np.uint64(slots)
                seen[int(aside), k, :slots] += np.bincount(words.astype(np.int64), minlength=slots)
        aside, k, slot = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int32()) for x in (aside, k, slot)), pa.array(seen[aside, k, slot])], ["aside", "k", "slot", "n"]
        )

    rows = labelled.filter(quoted(domain).isin(known)).select(
        quoted(domain).alias("d"), quoted(text).alias("t"), (F.pmod(F.xxhash64(quoted(text)), F.lit(_ASIDE)) == 0).alias("aside")
    )
    counts = np.zeros((2, len(known), slots + 1))
    for row in rows.mapInArrow(count, "aside int, k int, slot int, n bigint").groupBy("aside", "k", "slot").agg(F.sum("n").alias("n")).collect():
        counts[row["aside"], row["k"], row["slot"]] = row["n"]

    def counted(n: np.ndarray, evidence: float, growth: float = 0.0) -> Classifier:
        prior = np.log((n[:, slots] + 1) / (n[:, slots].sum() + len(known)))
        smooth = n[:, :slots] + 0.1
        likely = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        return Classifier(domains, prior, (likely - likely.mean(axis=0)).astype(np.float64), evidence, growth)

    if settings.evidence is not None:
        return counted(counts.sum(axis=0), settings.evidence)
    softness = _softness(rows.filter("aside").select("d", "t"), counted(counts[0], 1.0), known)
    return counted(counts.sum(axis=0), *softness)


def _softness(aside: DataFrame, model: Classifier, known: list[str]) -> tuple[float, float]:
    """The evidence and growth with the least log loss over the held-out rows; a task sends one row for each choice."""

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = np.zeros(len(_SOFTNESS))
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = word_hashes(raw or b"")
                if not len(words):
                    continue
                seen = model.log_odds[:, words % np.uint64(model.log_odds.shape[1])].mean(axis=1)
                much = np.array([min(len(words), e * len(words) ** g) for e, g in _SOFTNESS])
                logits = model.prior + much[:, None] * seen
                logits -= logits.max(axis=1, keepdims=True)
                loss += np.log(np.exp(logits).sum(axis=1)) - logits[:, known.index(name)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(loss)), pa.int32()), pa.array(loss)], ["choice", "loss"])

    total = np.zeros(len(_SOFTNESS))
    for row in aside.mapInArrow(lose, "choice int, loss double").groupBy("choice").agg(F.sum("loss").alias("loss")).collect():
        total[row["choice"]] = row["loss"]
    return _SOFTNESS[int(total.argmin())]


@dataclass(frozen=True)
class Step:
    """A step of the projected gradient: how far to lean on the last change first, then what to take off by domain."""

    lean: float
    off: np.ndarray


def rates(posteriors: np.ndarray, steps: list[Step], lean: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """The rates of documents after these steps, from 1 on and never negative; and the point the next step leaves from
    if it leans by ``lean``."""
    rate = before = np.ones(len(posteriors))
    for step in steps:
        leaving = rate + step.lean * (rate - before)
        before, rate = rate, np.maximum(0.0, leaving - posteriors @ step.off)
    return rate, rate + lean * (rate - before)


def _sums(members: DataFrame, steps: list[Step], lean: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected tokens by domain at the rates and where the next step leaves from; the domains' cross products; all
    tokens."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, leaving, cross, total = np.zeros(k), np.zeros(k), np.zeros((k, k)), 0.0
        for batch in batches:
            n = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            weighted = p * n[:, None]
            at, ahead = rates(p, steps, lean)
            sums += weighted.T @ at
            leaving += weighted.T @ ahead
            cross += p.T @ weighted
            total += n.sum()
        values = np.r_[sums, leaving, cross.ravel(), total]
        place = np.arange(len(values))
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(values)], ["place", "value"])

    added = members.select("tokens", "posterior").mapInArrow(part, "place int, value double")
    found = np.zeros(k * k + 2 * k + 1)
    for row in added.groupBy("place").agg(F.sum("value").alias("value")).collect():
        found[row["place"]] = row["value"]
    return found[:k], found[k : 2 * k], found[2 * k : -1].reshape(k, k), found[-1]


def fit(members: DataFrame, weights: np.ndarray, settings: Settings) -> list[Step]:
    """Steps of an accelerated projected gradient on (tokens, posterior) rows towards ``weights`` of the wanted tokens.

    The gradient is taken in the metric of the documents' tokens and the domains' cross products, in which its
    steepness is 1: a step of that size neither stalls on a rare domain nor overshoots. Momentum starts anew whenever
    the squares grow.
    """
    k, steps = len(weights), []
    momentum, lean, last = 1.0, 0.0, np.inf
    while True:
        sums, leaving, cross, total = _sums(members, steps, lean, k)
        wanted = weights * settings.total * total
        missing = sums - wanted
        if total == 0 or np.abs(missing).max() <= settings.close * total or len(steps) >= settings.steps:
            return steps
        metric = cross + 1e-9 * total * np.eye(k)
        squares = float(missing @ np.linalg.solve(metric, missing))
        if squares > last:
            momentum, lean, leaving = 1.0, 0.0, sums
        last = squares
        steps.append(Step(lean, np.linalg.solve(metric, leaving - wanted)))
        grown = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        momentum, lean = grown, (momentum - 1) / grown


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    text: str = "text",
    domain: str = "domain",
    settings: Settings = Settings(),
) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three columns added: tokens, posterior (in the sorted order of ``targets``), and rate.

    Returns the frame and the three names, which avoid those of ``docs``. ``labelled`` has a text and a domain;
    target weights are scaled to sum to 1. The rate is the expected number of times a document is used. Null, empty
    and blank texts have no tokens, the prior as posterior, and a rate like any document's. Every row stays. If no
    documents can meet a target the rates come as close as the steps allow.
    """
    domains = tuple(sorted(targets))
    weights = np.array([float(targets[d]) for d in domains])
    weights = weights / weights.sum()
    model = train(labelled, text, domain, domains, settings)
    tokens, posterior, rate = fresh(docs, "tokens"), fresh(docs, "posterior"), fresh(docs, "rate")

    @F.arrow_udf("struct<tokens:bigint,posterior:array<double>>")
    def member(texts: pa.Array) -> pa.Array:
        words = [word_hashes(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([model.posterior(w) for w in words], pa.list_(pa.float64())),
            ],
            ["tokens", "posterior"],
        )

    whole = fresh(docs, "_member")
    kept = [quoted(c) for c in docs.columns if c != text]
    found = docs.withColumn(whole, member(quoted(text)))
    # The text is not needed any more; it would be written for nothing.
    found = stage(
        found.select(*kept, quoted(whole)["tokens"].alias(tokens), quoted(whole)["posterior"].alias(posterior)),
        "members",
    )
    steps = fit(found.select(quoted(tokens).alias("tokens"), quoted(posterior).alias("posterior")), weights, settings)

    @F.arrow_udf("double")
    def rated(p: pa.Array) -> pa.Array:
        return pa.array(rates(p.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(domains)), steps)[0])

    return found.withColumn(rate, rated(quoted(posterior))), tokens, posterior, rate
