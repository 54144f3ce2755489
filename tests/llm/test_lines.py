import hashlib
import random

from clinicpulse.llm import lines
from clinicpulse.llm.lines import LineRuns

WHITE = " \t\n\x0b\x0c\r"


def folded(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(rows, least):
    held = {}
    for at, row in enumerate(rows):
        for line in (row[1] or "").split("\n"):
            held.setdefault(folded(line), set()).add(at)
    gone = {k for k, docs in held.items() if k and len(docs) >= least}
    out = []
    for row in rows:
        all_lines = (row[1] or "").split("\n")
        kept = [x for x in all_lines if folded(x) not in gone]
        out.append((row[0], len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(spark, rows, least, schema="doc_id bigint, text string", **more):
    df, kept, total, dropped = lines.without_frequent_lines(spark.createDataFrame(rows, schema), min_documents=least, **more)
    return sorted([(r["doc_id"], r[total], r[dropped], r[kept]) for r in df.collect()], key=str)


def test_agrees_with_a_plain_count(spark):
    rng = random.Random(2)
    pool = [f"Line {i} É" for i in range(40)] + ["  LINE 3 é", "line 3 É\r", "\tLine 5 É ", "", " ", "Ünï", "ünï"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 8)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, "Line 1 É"), (None, "Line 1 É\nalone"), (7, "Line 1 É"), (7, "Line 1 É")]
    for least in (2, 10, 25):
        assert found(spark, rows, least) == expected(rows, least)


def test_clashing_columns_stay_and_empty_table(spark):
    schema = "doc_id bigint, text string, Kept_Text string, lines_before int, lines_dropped int, _gone int"
    assert found(spark, [], 10, schema) == []
    rows = [(i, "same\nown " + str(i), "keep", 1, 2, 3) for i in range(3)]
    df, kept, _, _ = lines.without_frequent_lines(spark.createDataFrame(rows, schema), min_documents=3)
    assert {(r["doc_id"], r["Kept_Text"], r["_gone"], r[kept]) for r in df.collect()} == {(i, "keep", 3, f"own {i}") for i in range(3)}


def test_batches_and_levels_do_not_change_the_result(spark):
    rows = [(i, f"a\nb{i % 3}\nc{i}") for i in range(40)]
    assert found(spark, rows, 13, batches=1) == found(spark, rows, 13, batches=7) == expected(rows, 13)


def test_runs_merge_by_levels(spark):
    runs = LineRuns(spark, fanout=2)
    for batch in range(5):
        runs.add(spark.createDataFrame([(h,) for h in [1, 1, 2, 10 + batch]], "hash bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["hash"]: r["documents"] for r in runs.totals().collect()} == {1: 10, 2: 5, **{10 + b: 1 for b in range(5)}}
    plan = runs.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan


def test_batches_leave_out_what_the_runs_settle(spark):
    runs = LineRuns(spark)
    for batch in range(5):
        runs.add(spark.createDataFrame([(h,) for h in [1, 1, 2, 10 + batch]], "hash bigint"), 4)
    # Key 1 is settled after two batches; key 2 after four, so the fifth adds neither.
    assert {r["hash"]: r["documents"] for r in runs.totals().collect()} == {1: 4, 2: 4, **{10 + b: 1 for b in range(5)}}
    more = LineRuns(spark, fanout=9)
    for _ in range(4):
        more.add(spark.createDataFrame([(1,), (2,)], "hash bigint"))
    plan = more.unsettled(more.names()[0], 3)
    assert plan.collect() == [] and len(more.unsettled(more.names()[0], 5).collect()) == 2
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("SortMergeJoin") >= 4


def test_later_inputs_are_cleaned_against_earlier_runs(spark):
    runs, schema = LineRuns(spark), "doc_id bigint, text string"
    inputs = [[(10 * n + i, f"shared\nown {n} {i}\nin {'two' if n < 2 else 'last'}") for i in range(4)] for n in range(3)]
    seen = []
    for n, rows in enumerate(inputs):
        df, kept, _, dropped = lines.without_frequent_lines(spark.createDataFrame(rows, schema), min_documents=5, batches=2, runs=runs)
        out = {r["doc_id"]: r[kept] for r in df.collect()}
        seen += rows
        all_before = {r[0]: r[3] for r in expected(seen, 5)}
        assert out == {r[0]: all_before[r[0]] for r in rows}
        # A second look gives earlier inputs what they would have come to with all of them.
        df, kept, _, _ = lines.without_settled_lines(spark.createDataFrame(seen, schema), runs, min_documents=5)
        assert {r["doc_id"]: r[kept] for r in df.collect()} == all_before
    df, _, _, dropped = lines.without_settled_lines(spark.createDataFrame(seen, schema), LineRuns(spark), min_documents=5)
    assert {r[dropped] for r in df.collect()} == {0}
    runs.drop()


def test_very_long_text(spark):
    rows = [(1, "\n".join(["same", *[f"line {i}" for i in range(50_000)]])), (2, "same")]
    out = found(spark, rows, 2)
    assert [(r[0], r[1], r[2]) for r in out] == [(1, 50_001, 1), (2, 1, 1)]
    assert hashlib.sha256(out[0][3].encode()).hexdigest() == hashlib.sha256(rows[0][1][5:].encode()).hexdigest()
