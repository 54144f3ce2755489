"""Fill-in-middle: against a plain version, round trips, and hostile rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clinicpulse.llm import infill

UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def plainly(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", " ", "\n\t ", "one", "  one", "one  ", "a b c d e f g", "x<P>y z", "<S>", "ends <M>", "<P <S M>", "> <", "<",
    "tab\tand\x0bfeed\x0cand\rreturn", "\xa0hard\xa0space  em", "😀 😁 é 𝔘nicode 漢 字", "$1 \\1 ${x} \\E\\Q", "\x00 zero \x1c sep",
    "word " * 30_000, "l" * 200_000, " " * 50_000 + "end", "a\n\n\n b" * 5_000,
]


def shown(spark, rows, settings=infill.Settings(), schema="doc_id bigint, text string"):
    df, names = infill.transformed(spark.createDataFrame(rows, schema), settings=settings)
    back = infill.restored(F.col(names["output"]), F.col(names["form"]), settings)
    wanted = [names[k] for k in ("n", "form", "prefix_chars", "middle_chars", "output")]
    return sorted(map(tuple, df.select("doc_id", *wanted, back, "text").collect()), key=str)


def test_agrees_with_the_plain_version_and_reads_back(spark):
    rows = [(i * 31 + k, t) for i, t in enumerate(TEXTS) for k in range(6)] + [(None, "no id at all"), (-7, "below zero"), (1, "a b"), (1, "a b")]
    found = shown(spark, rows)
    assert [r[:6] for r in found] == [p[:6] for p in sorted([(*plainly(*r), r[1] or "", r[1]) for r in rows], key=str)]
    assert all(r[6] == (r[7] or "") for r in found)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_marks_that_only_seem_to_arise_are_not_read_as_marks(spark):
    rows = [(i, t) for i, t in enumerate(["a <P b< P> <", "< <S <M", ">P< S>M", "<P <P <P", "< < < <"] * 40)]
    settings = infill.Settings(rate=100)
    assert all(r[6] == r[7] and r[2] != "plain" for r in shown(spark, rows, settings))


def test_other_marks_seeds_and_shares(spark):
    settings = infill.Settings(seed=7, rate=100, spm=0, prefix="[pre]", suffix="[suf]", middle="[mid]")
    rows = [(i, f"w{i} x y z") for i in range(50)]
    found = shown(spark, rows, settings)
    assert {r[2] for r in found} == {"psm"}
    for doc_id, _, _, _, _, output, back, text in found:
        _, _, _, _, _, plain = plainly(doc_id, text, 7, 100, 0)
        assert output == plain.replace("<P>", "[pre]").replace("<S>", "[suf]").replace("<M>", "[mid]") and back == text


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("x$", "<S>", "<M>"), ("ab", "bc", "<M>"), ("<M", "<S>", "<M>")])
def test_marks_that_could_be_misread_are_refused(marks):
    with pytest.raises(ValueError):
        infill.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_clashing_names_and_no_rows(spark):
    schema = "doc_id bigint, text string, N int, form string, output string, whole string, `a.b` int"
    df, names = infill.transformed(spark.createDataFrame([(1, "a b c", 5, "f", "o", "w", 2)], schema))
    assert set(names.values()) == {"n_", "form_", "output_", "prefix_chars", "middle_chars"}
    row = df.first()
    assert (row["N"], row["form"], row["output"], row["whole"], row["n_"]) == (5, "f", "o", "w", 3)
    assert shown(spark, []) == []


def test_the_plan_has_no_shuffle_and_no_python(spark):
    df, _ = infill.transformed(spark.createDataFrame([], "doc_id bigint, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
