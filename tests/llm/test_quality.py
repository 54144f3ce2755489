import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinicpulse.llm import quality
from clinicpulse.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


def test_held_out_accuracy(spark):
    rows = QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality IS NOT NULL")
    got = rows.join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert len(got) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.97
    good = [r["predicted"] for r in got if r["quality"] == 1]
    assert np.mean(good) > 0.99


def test_held_out_rows_are_those_of_the_contract(spark):
    rows = QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert len(rows) == docs
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def trained(spark, docs, labels, **settings):
    return quality.train(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, doc_text string"), "doc_id", "text",
        "quality", quality.Settings(**settings),
    )


def small(n=120):
    rng = random.Random(1)
    good, bad = ["river", "stone", "meadow", "cloud"], ["BUY!!", "$$$", "click", "WIN!!"]
    docs = [(i, " ".join(rng.choices(bad if i % 3 == 0 else good, k=rng.randint(1, 30)))) for i in range(n)]
    return docs, [(i, int(i % 3 != 0), "x") for i in range(n)]


def test_nulls_empty_texts_repeats_and_unlabelled(spark):
    docs, labels = small()
    model = trained(spark, [*docs, (None, "a"), docs[0]], [*labels, (None, 1, ""), (3, None, ""), (10**6, 1, ""), labels[0]])
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "stone cloud river"), (5, "BUY!! $$$ click"), (5, "BUY!! $$$ click"), (6, "x " * 400_000)], SCHEMA)
    scores = [r[0] for r in df.select(quality.score(model, F.col("text"))).collect()]
    prior = 1 / (1 + np.exp(-model.bias))
    assert scores[0] == scores[1] == scores[2] == pytest.approx(prior)
    assert scores[3] > 0.7 and scores[4] < 0.3 and scores[4] == scores[5] and 0 <= scores[6] <= 1


def test_no_labels_and_one_label(spark):
    docs, labels = small(12)
    assert trained(spark, docs, []).score(b"stone") == pytest.approx(0.5)
    assert trained(spark, [], labels).score(b"stone") == pytest.approx(0.5)
    assert trained(spark, docs, [(i, 1, "") for i in range(12)]).score(b"stone") > 0.9


def test_bounds_hold_and_training_repeats(spark):
    docs, labels = small()
    a, b = (trained(spark, docs, labels, rows=60, slots=200, steps=180) for _ in range(2))
    assert (a.weights == b.weights).all() and a.bias == b.bias
    assert a.score(b"stone cloud") > a.score(b"BUY!! $$$")


def test_scoring_is_the_softmax_of_the_mean_vector():
    """The folded table gives what embedding, mean, output layer and softmax give."""
    rng = np.random.default_rng(0)
    table, out, bias = rng.normal(size=(1 << 12, 6)), rng.normal(size=(6, 2)), rng.normal(size=2)
    ids = quality.feature_ids("Some wörds, some words".encode(), 12)
    logits = table[ids].mean(0) @ out + bias
    p = np.exp(logits) / np.exp(logits).sum()
    model = quality.Model(12, (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))
    assert model.score("Some wörds, some words".encode()) == pytest.approx(p[1], abs=1e-5)


def test_features_stay_within_words():
    ids = lambda t: sorted(quality.feature_ids(t.encode(), 20).tolist())
    assert ids("ab cd") == sorted(ids("ab") + ids("cd")) == ids("  cd\n ab ")
    assert len(ids("ab")) == 1 + 2 + 1
    assert ids("é€🙂") != ids("é€") and len(ids("")) == 0
    assert ids("go go").count(0) == ids("go").count(0) * 2 + 1


def test_descent_agrees_with_a_plain_one():
    """Fifty rows, one number at a time: same table, same order, same steps."""
    docs, labels = small(50)
    settings = quality.Settings(bits=6, dim=3, steps=150)
    rows = [(*np.unique(quality.feature_ids(t.encode(), 6), return_counts=True), y) for (_, t), (_, y, _) in zip(docs, labels)]
    model = quality.descend(rows, settings)
    rng = np.random.default_rng(settings.seed)
    table = [[float(v) for v in row] for row in rng.uniform(-1, 1, (64, 3)) / 3]
    share = sum(y for _, _, y in rows) / 50
    out, bias, done = [[0.0, 0.0] for _ in range(3)], [np.log(1 - share), np.log(share)], 0
    while done < 150:
        for at in rng.permutation(50)[: 150 - done]:
            slots, counts, label = rows[at]
            rate = 1 - done / 150
            done += 1
            total = sum(counts)
            part = [c / total for c in counts]
            mean = [sum(p * table[s][k] for p, s in zip(part, slots)) for k in range(3)]
            z = [sum(mean[k] * out[k][j] for k in range(3)) + bias[j] for j in (0, 1)]
            top = [np.exp(v - max(z)) for v in z]
            wrong = [v / sum(top) - (j == label) for j, v in enumerate(top)]
            back = [sum(out[k][j] * wrong[j] for j in (0, 1)) for k in range(3)]
            norm = np.sqrt(sum(p * p for p in part))
            for k in range(3):
                for j in (0, 1):
                    out[k][j] -= rate * mean[k] * wrong[j]
                for p, s in zip(part, slots):
                    table[s][k] -= rate * p / norm * back[k]
            bias = [b - 0.01 * rate * w for b, w in zip(bias, wrong)]
    weights = [sum(row[k] * (out[k][1] - out[k][0]) for k in range(3)) for row in table]
    assert np.allclose(model.weights, weights, atol=1e-5) and model.bias == pytest.approx(bias[1] - bias[0])


def test_rows_are_learnt_whole_within_the_bounds(spark, monkeypatch):
    docs, labels = small()
    docs.append((500, " ".join(f"word{i}" for i in range(20_000))))
    labels.append((500, 1, ""))
    seen = []
    plain = quality.descend
    monkeypatch.setattr(quality, "descend", lambda rows, settings: seen.append(rows) or plain(rows, settings))
    trained(spark, docs, labels, bits=16)
    trained(spark, docs, labels, bits=16, slots=1500)
    trained(spark, docs, labels, bits=16, rows=20)
    trained(spark, docs, labels, bits=16, slots=0)
    sizes = [sorted(len(slots) for slots, _, _ in rows) for rows in seen]
    assert len(sizes[0]) == 121 and sizes[0][-1] == len(np.unique(quality.feature_ids(docs[-1][1].encode(), 16))) > 20_000
    assert 0 < sum(sizes[1]) <= 1500 and len(sizes[2]) == 20 and sizes[3] == []
    # A column name may hold a dot.
    frame = spark.createDataFrame(docs, "`d.id` bigint, `the.text` string"), spark.createDataFrame(labels, "`d.id` bigint, `q.q` int, x string")
    assert quality.train(*frame, "d.id", "the.text", "q.q", quality.Settings(bits=16)).score(b"stone river") > 0.7
