"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score.

DataFrame operations only, beside the scan and without a shuffle. Spark gives the matches of a pattern and the pieces
between them; the running sum of their lengths gives each match's place in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# The kinds, in the order that settles equal starts.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "private_key", "access_key", "secret")
BASE_KINDS = KINDS[:4]

_CONTEXT = 40
_BOOST = 0.35
ACCEPT = 0.5


# The length of an account number by its country code.
_IBAN_CODES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Account numbers in one piece or in groups of four, as long as their country has them, so that no word after one
    is taken in. Codes of no such country take as many groups as there are, up to where a number of known length begins.
    """
    end = "(?![A-Za-z0-9])"

    def long(length: int) -> str:
        groups, rest = divmod(length - 4, 4)
        last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        return rf"[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{last}{end}"

    known = "|".join(f"(?:{codes.replace(' ', '|')}){long(length)}" for length, codes in _IBAN_CODES.items())
    codes = "|".join(_IBAN_CODES.values()).replace(" ", "|")
    apart = rf"(?!\x20(?:{known}))\x20?[A-Z0-9]"
    other = rf"(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?:{apart}{{4}}){{2,7}}(?:{apart}{{1,3}})?{end}"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets(value: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(value, "[.]"), small)


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _mod97(value: Column) -> Column:
    """The check of account numbers: first four signs moved to the end, letters as 10 to 35, remainder 1."""
    bare = F.replace(value, F.lit(" "))
    moved = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.length(bare).between(15, 34) & (F.aggregate(F.split(moved, ""), F.lit(0), step) == 1)


_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_of_token(value: Column) -> Column:
    """The check of tokens that end in the CRC-32 of their thirty random signs, in six digits of base 62."""
    body, end = F.substring(value, 5, 30), F.substring(value, 35, 6)
    place = lambda sign: F.instr(F.lit(_BASE62), sign).cast("bigint") - 1
    given = F.aggregate(F.split(end, ""), F.lit(0).cast("bigint"), lambda rest, sign: rest * 62 + place(sign))
    return ~F.startswith(value, F.lit("gh")) | (given == F.crc32(body.cast("binary")))


def _random(value: Column) -> Column:
    """Letters and digits mixed, with three bits or more to a sign: no word, number or rule made of one sign."""
    signs = F.split(value, "")

    def bits(sum_: Column, sign: Column) -> Column:
        share = F.size(F.filter(signs, lambda s: s == sign)) / F.size(signs)
        return sum_ - share * F.log2(share)

    mixed = F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    return mixed & (F.aggregate(F.array_distinct(signs), F.lit(0.0), bits) >= 3.0)


@dataclass(frozen=True)
class Detector:
    """``gate`` is a cheap test that a text may hold the kind at all; ``score`` what a confirmed span has by itself.

    Patterns begin only where a run of their first signs begins or the last match ended, and repeat possessively:
    the same matches as the plain pattern's, in time that follows the text.
    """

    kind: str
    gate: Callable[[Column], Column]
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    words: str


def _has_digit(text: Column) -> Column:
    return F.rlike(text, F.lit("[0-9]"))


DETECTORS = (
    Detector(
        "email",
        lambda text: F.contains(text, F.lit("@")),
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda value: F.lit(True),
        0.9,
        "e-?mail|contact|write",
    ),
    Detector(
        "ip",
        _has_digit,
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _octets,
        0.6,
        "ip|host|server|address",
    ),
    Detector("card", _has_digit, r"[0-9](?:[\x20-]?[0-9])++", _luhn, 0.8, "card|visa|credit|payment"),
    Detector(
        "phone",
        lambda text: F.contains(text, F.lit("+")),
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda value: F.length(_digits(value)).between(10, 15),
        0.6,
        "phone|tel|call|fax|mobile",
    ),
    Detector(
        "iban",
        _has_digit,
        _iban_pattern(),
        _mod97,
        0.9,
        "iban|account|bank",
    ),
    # No checksum: only a word nearby lifts it over the bar.
    Detector(
        "ssn",
        _has_digit,
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda value: ~F.rlike(value, F.lit("^(000|666|9)|-00-|-0000$")),
        0.3,
        "ssn|social security",
    ),
    Detector(
        "private_key",
        lambda text: F.contains(text, F.lit("PRIVATE KEY-----")),
        r"-----BEGIN\x20((?:[A-Z0-9]{1,20}\x20){0,3})PRIVATE\x20KEY-----[^-]*+(?:-(?!----)[^-]*+){0,64}+-----END\x20\1PRIVATE\x20KEY-----",
        lambda value: F.lit(True),
        0.9,
        "key",
    ),
    Detector(
        "access_key",
        lambda text: F.rlike(text, F.lit("A[KS]IA|gh[pousr]_")),
        r"(?<![A-Za-z0-9_])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9_])",
        _crc_of_token,
        0.9,
        "key|token",
    ),
    # No checksum either: signs without an order, and a word nearby that says what they are.
    Detector(
        "secret",
        _has_digit,
        r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,200}+(?![A-Za-z0-9_+/-])={0,2}",
        _random,
        0.3,
        r"(?:[a-z]+[_-])?(?:token|secret|password|passwd|credential|bearer|api[ _-]?key)s?",
    ),
)

_SPAN = "array<struct<kind:string,rank:int,start:int,end:int,score:double,value:string>>"


def _found(text: Column, d: Detector) -> Column:
    """Confirmed spans of one kind, scored; leftmost and non-overlapping, failing ones dropped."""
    pattern = F.lit(d.pattern)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("value"), F.split(text, pattern, -1).alias("before")
    )
    empty = F.array().cast("array<struct<start:int,value:string>>")

    def step(at: Column, pair: Column) -> Column:
        start = at["place"] + F.length(pair["before"])
        length = F.coalesce(F.length(pair["value"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), pair["value"].alias("value")))
        return F.struct((start + length).alias("place"), F.concat(at["spans"], span).alias("spans"))

    begin = F.struct(F.lit(0).alias("place"), empty.alias("spans"))
    matches = F.aggregate(pairs, begin, step, lambda at: at["spans"])
    # The last piece has no match after it.
    confirmed = F.filter(matches, lambda m: m["value"].isNotNull() & d.confirm(m["value"]))

    def scored(m: Column) -> Column:
        first = F.greatest(m["start"] - _CONTEXT, F.lit(0))
        nearby = F.lower(F.substr(text, first + 1, m["start"] - first))
        boost = F.when(F.rlike(nearby, F.lit(rf"\b(?:{d.words})\b")), F.lit(_BOOST)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(d.kind).alias("kind"),
            F.lit(KINDS.index(d.kind)).alias("rank"),
            m["start"].alias("start"),
            (m["start"] + F.length(m["value"])).alias("end"),
            F.least(F.lit(d.score) + boost, F.lit(1.0)).alias("score"),
            m["value"].alias("value"),
        )

    return F.when(d.gate(text), F.transform(confirmed, scored)).otherwise(F.array().cast(_SPAN))


def spans(text: Column) -> Column:
    """All accepted spans of a text: array of (kind, rank, start, end, score, value), by start, then by kind.

    Places are code points, ends exclusive. Spans of ``BASE_KINDS`` always stay; a span of another kind needs a score
    of ``ACCEPT`` and must not overlap one of them, a ``secret`` no span at all. A null or empty text has none.
    """
    text = F.coalesce(text, F.lit(""))

    def of(kinds: tuple[str, ...]) -> Column:
        return F.concat(*[_found(text, d) for d in DETECTORS if d.kind in kinds])

    def apart(spans: Column, others: Column) -> Column:
        free = lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        return F.filter(spans, lambda s: (s["score"] >= ACCEPT) & free(s))

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        """``value`` computed once, however often ``use`` names it."""
        return F.transform(F.array(value), use)[0]

    def settled(parts: Column) -> Column:
        known = F.concat(parts["base"], apart(parts["more"], parts["base"]))
        return bound(known, lambda spans: F.concat(spans, apart(parts["secret"], spans)))

    more = tuple(k for k in KINDS if k not in BASE_KINDS and k != "secret")
    parts = F.struct(of(BASE_KINDS).alias("base"), of(more).alias("more"), of(("secret",)).alias("secret"))
    kept = bound(parts, settled)
    order = F.transform(kept, lambda s: F.struct(s["start"].alias("start_"), s["rank"].alias("rank_"), s.alias("span")))
    return F.transform(F.array_sort(order), lambda s: s["span"])


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def listed(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    some = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
