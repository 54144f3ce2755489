import random

import numpy as np
import pytest

from clinicpulse.llm import mixing
from clinicpulse.llm.hashing import word_hashes

WORDS = {"a": ["alpha", "arch", "atom", "axis"], "b": ["bell", "boat", "bark", "birch"], "c": ["coal", "crow", "calm", "cliff"]}


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    docs, labelled = [], []
    for i in range(n):
        main = rng.choices("abc", weights=[7, 2, 1])[0]
        pool = WORDS[main] * 4 + WORDS[rng.choice("abc")]
        docs.append((i, " ".join(rng.choices(pool, k=rng.randint(1, 60))), "x", 5))
        if i % 3 == 0:
            labelled.append((docs[-1][1], main))
    return docs, labelled


SCHEMA = "doc_id bigint, text string, rate string, Tokens int"


def mixed(spark, docs, labelled, targets, **settings):
    df, tokens, posterior, rate = mixing.mix(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labelled, "text string, domain string"), targets,
        settings=mixing.Settings(**settings),
    )
    assert {"doc_id", "rate", "Tokens"} <= set(df.columns) and tokens == "tokens_" and rate == "rate_"
    return sorted([(r["doc_id"], r[tokens], tuple(r[posterior]), r[rate]) for r in df.collect()], key=str)


def totals(rows):
    n, p, r = (np.array([x[i] for x in rows], dtype=float) for i in (1, 2, 3))
    return (n * r) @ p, n.sum()


def test_expected_tokens_meet_the_targets(spark):
    docs, labelled = corpus()
    for targets, total in (({"a": 1, "b": 1, "c": 1}, 1.0), ({"a": 0.1, "b": 0.6, "c": 0.3}, 0.5), ({"a": 5, "b": 3, "c": 2}, 2.0)):
        rows = mixed(spark, docs, labelled, targets, total=total, evidence=50.0)
        got, tokens = totals(rows)
        weights = np.array([targets[d] for d in sorted(targets)], dtype=float)
        assert got / (tokens * total) == pytest.approx(weights / weights.sum(), abs=1e-4)
        assert min(r[3] for r in rows) >= 0 and len(rows) == len(docs)


def test_production_settings_meet_the_targets(spark):
    """Long texts of one domain with words all domains share; short ones stay soft."""
    rng = random.Random(7)
    shared, docs, labelled = [f"s{i}" for i in range(40)], [], []
    for i in range(300):
        main = rng.choices("abc", weights=[7, 2, 1])[0]
        docs.append((i, " ".join(rng.choices(shared * 2 + WORDS[main] * 5, k=rng.choice([3, 40, 2000]))), "x", 5))
        labelled.append((docs[-1][1], main))
    targets = {"a": 0.2, "b": 0.2, "c": 0.6}
    rows = mixed(spark, docs, labelled, targets)
    got, tokens = totals(rows)
    assert got / tokens == pytest.approx([0.2, 0.2, 0.6], abs=1e-4)
    own = {i: "abc".index(label) for i, (_, label) in enumerate(labelled)}
    assert min(r[2][own[r[0]]] for r in rows if r[1] == 2000) > 0.95
    assert any(max(r[2]) < 0.95 for r in rows if r[1] == 3)


def test_agrees_with_a_plain_projected_gradient(spark):
    """The same least squares, by many plain steps over all documents at once; here no rates meet the targets."""
    docs, labelled = corpus(2)
    rows = mixed(spark, docs, labelled, {"a": 0.001, "b": 0.001, "c": 0.998}, steps=100)
    n, p, got = (np.array([x[i] for x in rows], dtype=float) for i in (1, 2, 3))
    wanted = np.array([0.001, 0.001, 0.998]) * n.sum()
    inverse = np.linalg.inv((p * n[:, None]).T @ p)
    rate = np.ones(len(n))
    for _ in range(20_000):
        rate = np.maximum(0, rate - p @ inverse @ (p.T @ (n * rate) - wanted))
    left = lambda r: (p.T @ (n * r) - wanted) @ inverse @ (p.T @ (n * r) - wanted)
    assert left(got) <= left(rate) + 1e-3 * left(np.ones(len(n)))


def test_posteriors_are_soft_and_right():
    text = " ".join(WORDS["a"])
    counts = np.full((2, 64), 0.1)
    counts[0, (word_hashes(text.encode()) % np.uint64(64)).astype(int)] += 5
    likely = np.log(counts / counts.sum(1, keepdims=True))
    model = mixing.Classifier(("a", "b"), np.log([0.5, 0.5]), likely - likely.mean(0), 2.0)
    p = model.posterior(word_hashes(text.encode()))
    assert p.sum() == pytest.approx(1) and 0.5 < p[0] < 1
    assert model.posterior(word_hashes(b"")) == pytest.approx([0.5, 0.5])


def test_nulls_empty_and_long_texts_and_unknown_domains(spark):
    docs, labelled = corpus(3, 60)
    docs += [(None, None, None, None), (900, "", "", 1), (900, "", "", 1), (901, "alpha " * 300_000, "", 1)]
    labelled += [(None, "a"), ("alpha", None), ("odd", "zz"), ("", "b")]
    rows = mixed(spark, docs, labelled, {"a": 0.5, "b": 0.25, "c": 0.25})
    by = {r[0]: r for r in rows}
    assert len(rows) == 64 and by[None][1] == by[900][1] == 0 and by[901][1] == 300_000
    assert all(r[3] >= 0 and abs(sum(r[2]) - 1) < 1e-9 for r in rows)


def test_empty_tables_and_an_unreachable_target(spark):
    docs, labelled = corpus(4, 30)
    assert mixed(spark, [], labelled, {"a": 1, "b": 1}) == []
    even = mixed(spark, docs, [], {"a": 1, "b": 1})
    assert {r[2] for r in even} == {(0.5, 0.5)}
    rows = mixed(spark, docs, [r for r in labelled if r[1] == "a"], {"a": 1, "zz": 1}, steps=5)
    assert all(np.isfinite(r[3]) and r[3] >= 0 for r in rows)
