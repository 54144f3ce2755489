"""Column expressions used by more than one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_DAY_MICROS = 86_400_000_000


def none_if(column: Column, sentinels: Sequence[str]) -> Column:
    """NULL for values that only stand for "not there"; exact match."""
    return F.when(~column.isin(list(sentinels)), column) if sentinels else column


def user_id_from_json(document: Column, path: str) -> Column:
    """Whole number at ``path``; NULL if absent, not a number, or the document is malformed."""
    return F.get_json_object(document, path).try_cast("bigint")


def lead_days(later: Column, earlier: Column) -> Column:
    """Days between two times, rounded half up to two digits, as exact decimals."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later).cast("decimal(20,0)")
    return F.round(micros / F.lit(_DAY_MICROS).cast("decimal(11,0)"), 2).cast("decimal(12,2)")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Decimal division by a count, to 17 digits, so that rounding the result to a few is exact."""
    return numerator.cast("decimal(24,4)") / denominator.cast("decimal(12,0)")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` rounded to two digits, 0 when there is no whole."""
    ratio = F.when(whole > 0, quotient(part, whole)).otherwise(F.lit(0))
    return F.round(ratio, 2).cast("decimal(12,2)")


def decimal_comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


def split_list(text: Column) -> Column:
    """Comma list to array, blanks removed; an empty text gives an empty array."""
    return F.filter(F.split(F.replace(text, F.lit(" "), F.lit("")), ","), lambda item: item != "")


def csv_has(text: Column, item: Column) -> Column:
    """Whether ``item`` is an element of a comma list; elements are compared as written, not trimmed."""
    return (text != "") & F.array_contains(F.split(text, ","), item)


def padded(key: Column, width: int = 36) -> Column:
    """Blank-padded form, under which a fixed-width key equals its unpadded writing."""
    return F.rpad(key, width, " ")


def contains_if(flag: bool | None, text: Column, word: str) -> Column | None:
    """Three-way text filter: has the word, lacks it, or (unset) no condition at all."""
    if flag is None:
        return None
    return text.contains(word) if flag else ~text.contains(word)
