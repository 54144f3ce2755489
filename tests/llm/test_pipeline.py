import corpus_pipeline
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from clinicpulse.llm import lines, tiling

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        step(spark, out[-1], DATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "mix"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_rejects_and_keeps(spark, stages):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = stages[1].select("doc_id").withColumn("in", F.lit(1))
    share = labels.join(kept, "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("in", F.lit(0))).alias("kept")).collect()
    by = {r["quality"]: r["kept"] for r in share}
    assert by[1] > 0.98 and by[0] < 0.2


def test_lines_are_those_of_a_plain_count(stages):
    before = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    after = {r["doc_id"]: r for r in stages[2].collect()}
    held = {}
    fold = lambda x: x.strip(lines._SPACE).translate(str.maketrans(lines._UPPER, lines._LOWER))
    for i, text in before.items():
        for line in text.split("\n"):
            held.setdefault(fold(line), set()).add(i)
    for i, text in before.items():
        kept = "\n".join(x for x in text.split("\n") if not fold(x) or len(held[fold(x)]) < 10)
        assert after[i]["text"] == kept and after[i]["n_chars"] == len(kept)


def test_one_document_of_each_group_stays(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    sizes, components = plain.near_duplicates(texts, 5)
    assert ids(stages[3]) == {i for i in texts if components[i] == i}


def test_benchmark_passages_go(spark, stages):
    items = [plain.words(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    seeds = {tuple(w[i : i + 5]) for w in items for i in range(len(w) - 4)}
    gone = ids(stages[3]) - ids(stages[4])
    hold = set()
    for r in stages[3].collect():
        found = plain.words(r["text"])
        if seeds & {tuple(found[i : i + 5]) for i in range(len(found) - 4)}:
            a = tiling.word_hashes(r["text"].encode())
            if any(sum(s for s, _, _ in tiling.tiles(tiling.word_hashes(b" ".join(w)), a, 5)) >= 0.8 * len(w) for w in items):
                hold.add(r["doc_id"])
    assert gone == hold and hold


def test_rates_meet_the_targets(stages):
    rows = stages[5].collect()
    assert ids(stages[5]) == ids(stages[4])
    n, p, r = (np.array([x[c] for x in rows], dtype=float) for c in ("tokens", "posterior", "rate"))
    wanted = [corpus_pipeline.TARGETS[d] for d in sorted(corpus_pipeline.TARGETS)]
    assert ((n * r) @ p) / n.sum() == pytest.approx(wanted, abs=1e-4)


def test_run_applies_the_stages(spark, stages):
    assert ids(corpus_pipeline.run(spark, DATA)) == ids(stages[5])


def test_odd_rows_and_an_empty_table(spark, stages):
    schema = stages[0].schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 50_000, None, "s", 5)]
    for rows_ in (rows, []):
        df = spark.createDataFrame(rows_, schema)
        for _, step in corpus_pipeline.STAGES:
            df = step(spark, df, DATA)
            assert df.count() <= len(rows_)
