"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix, and written in another order.

A text is a run of units: white space with the word after it, or white space alone. Two of its unit boundaries are
drawn from a hash of its id. One match of a pattern made for the row, with a counted possessive group for the units of
the prefix and one for those of the middle, captures the three parts. Counted possessive groups are matched in a loop
and never given back, so neither the stack nor the time grows beyond the text. Everything stays in JVM expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.llm.frames import fresh, quoted

UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Settings:
    """``seed`` opens the hashed key of a row; ``rate`` is the share of texts rearranged and ``spm`` that of those with
    the suffix first, both in percent; the marks stand before prefix, suffix and middle."""

    seed: int = 42
    rate: int = 50
    spm: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        ends = any(a[-i:] == b[:i] for a in marks for b in marks for i in range(1, min(len(a), len(b))))
        within = any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j)
        # Without overlaps a mark cannot arise where a part and a mark meet, so outputs read back in one way only.
        if not all(marks) or ends or within or any("\\" in m or "$" in m for m in marks):
            raise ValueError(f"marks must be set, share no ends and hold no backslash or dollar: {marks}")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(doc_id: Column, settings: Settings) -> list[Column]:
    """Four numbers below 2**32 from the row's id; a null id is written as nothing."""
    key = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def units(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UNIT)).cast("bigint")


def parts_pattern(before: Column, within: Column) -> Column:
    """A pattern that captures the first ``before`` units, the next ``within`` and the rest in one match."""
    counted = [F.concat(F.lit(f"({UNIT}{{"), n.cast("string"), F.lit("}+)")) for n in (before, within)]
    return F.concat(F.lit(r"(?s)\A"), *counted, F.lit(r"(.*+)\z"))


def transformed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the transformed text and how it came about; also the names of the added columns, as given in
    the keys ``n`` (units), ``form`` (plain, psm or spm), ``output``, ``prefix_chars`` and ``middle_chars``.

    A null text counts as empty. Texts that are empty, hold a mark or are not drawn stay plain: their output is the
    text and their part lengths are null. Parts may be empty. Rows are treated one by one, so repeated rows get equal
    results, and rows with equal ids equal draws. Names that ``docs`` already has are given an underscore.
    """
    names: dict[str, str] = {}

    def add(df: DataFrame, key: str, column: Column) -> DataFrame:
        names[key] = fresh(df, key)
        return df.withColumn(names[key], column)

    def of(key: str) -> Column:
        return quoted(names[key])

    rows = add(docs, "whole", F.coalesce(quoted(text), F.lit("")))
    rows = add(rows, "n", units(of("whole")))
    h1, h2, h3, h4 = draws(quoted(doc_id), settings)
    first, second = h1 % (of("n") + 1), h2 % (of("n") + 1)
    marked = F.lit(False)
    for mark in settings.marks:
        marked = marked | F.contains(of("whole"), F.lit(mark))
    stays = (of("whole") == "") | marked | (h3 % 100 >= settings.rate)
    rows = add(rows, "form", F.when(stays, PLAIN).when(h4 % 100 < settings.spm, SPM).otherwise(PSM))
    before = F.least(first, second)
    pattern = parts_pattern(before, F.greatest(first, second) - before)
    p, s, m = settings.marks
    order = F.when(of("form") == SPM, f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    rows = add(rows, "output", F.when(of("form") == PLAIN, of("whole")).otherwise(F.regexp_replace(of("whole"), pattern, order)))
    cut = F.when(of("form") != PLAIN, _parts(of("output"), of("form"), settings))
    rows = add(rows, "prefix_chars", F.length(cut[0]).cast("bigint"))
    rows = add(rows, "middle_chars", F.length(cut[1]).cast("bigint"))
    return rows.drop(names.pop("whole")), names


def _parts(output: Column, form: Column, settings: Settings) -> Column:
    """Prefix, middle and suffix of a rearranged text."""
    pieces = F.split(output, "|".join(f"\\Q{m}\\E" for m in settings.marks), -1)
    psm = F.array(pieces[1], pieces[3], pieces[2])
    return F.when(form == SPM, F.array(pieces[2], pieces[3], pieces[1])).otherwise(psm)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text a transformed one was made of."""
    return F.when(form == PLAIN, output).otherwise(F.array_join(_parts(output, form, settings), ""))
