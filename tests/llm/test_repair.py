"""Structure repair: against a search over all edits, textbook parsing over all splits, and hostile rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from clinicpulse.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
WANTED = re.compile(r"(s?(ua)+)?")


def described(rows):
    """Kinds and counts of rows in order, by the definitions."""
    seen, kinds, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        body = text.strip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kinds.append((role, fault))
    return kinds, counts


def search(kinds, limit=100_000):
    """The least (cost, audit) by a best-first search over partial edits; knows nothing of spans or cells."""
    queue = [(0, "", 0, "")]
    while queue:
        cost, audit, at, initials = heapq.heappop(queue)
        if at == len(kinds) and WANTED.fullmatch(initials):
            return cost, audit
        if not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        steps = [(2, "I", at, "u"), (2, "I", at, "a")]
        if at < len(kinds):
            role, fault = kinds[at]
            steps.append((3, "D", at + 1, ""))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                steps += [(more, "K", at + 1, role[:1] or "?"), (2 + more, "R", at + 1, "u"), (2 + more, "R", at + 1, "a")]
        for price, edit, then, initial in steps:
            heapq.heappush(queue, (cost + price, audit + edit, then, initials + initial))
    raise AssertionError


def textbook(kinds):
    """Cells over all spans and all splits."""
    n, cells = len(kinds), {}
    for i in range(n):
        cells[i, i + 1] = repair.row_cell(kinds[i])
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            options = [repair.combined(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
            assert all(o == options[0] for o in options)
            cells[i, i + size] = options[0]
    return cells[0, n]


def plainly(conversations):
    """Expected rows of the operator and the digest, for {conv: [(turn, role, text)]}; texts of a turn differ early."""
    out = []
    for conv, rows in conversations.items():
        rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        kinds, counts = described([(r, x) for _, r, x in rows])
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = search(kinds)
        text = "\n".join(f"{r}:{x}" for r, x in repair.edited(audit, [(r, x) for _, r, x in rows]))
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, conversations, partitions=None):
    df = spark.createDataFrame([(c, *r) for c, rows in conversations.items() for r in rows], SCHEMA)
    fixes = repair.repairs(df)
    written = repair.digests(repair.repaired_turns(df, fixes))
    empty = hashlib.sha256(b"").hexdigest()
    rows = repair.met(fixes, written).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ).collect()
    return sorted([(*tuple(r)[:-1], r[-1] or empty) for r in rows], key=str)


def some_rows(rng, n, texts=("Yes.", "No!", "What", "", " \t", "Yes.", "So it is?")):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uhm", "User"]
    return [(rng.choice([i, i, i + 3, None]), rng.choice(roles), rng.choice([*texts, None])) for i in range(n)]


def test_one_split_is_enough():
    rng = random.Random(1)
    for _ in range(150):
        kinds = "".join(rng.choices("suaoSUAOx", k=rng.randint(1, 9)))
        assert textbook(kinds) == repair.span_cell(kinds)


def test_cells_are_the_cheapest_edits():
    rng = random.Random(2)
    for _ in range(400):
        kinds = "".join(rng.choices("suaoSUAOxua", k=rng.randint(0, 6)))
        plain = [(k.lower(), "blank" if k == "x" else "truncated" if k.isupper() else None) for k in kinds]
        assert repair.cheapest(repair.span_cell(kinds)) == search(plain)


def test_agrees_with_the_search(spark):
    rng = random.Random(3)
    conversations = {i: some_rows(rng, rng.randint(1, 6)) for i in range(120)}
    conversations[None] = some_rows(rng, 5)
    conversations[1000] = [(None, "user", "Hi."), (None, "assistant", "Ho."), (None, "user", "Hi.")]
    conversations[1001] = [(0, None, None)]
    conversations[1002] = [(4, "user", "Same."), (4, "user", "Same."), (4, "user", "Same."), (9, "user", "Same.")]
    assert found(spark, conversations) == plainly(conversations)


def straight(rows):
    """Least (cost, audit) row by row with four states: another way to the same figures for long conversations."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    def closed(best):
        for _ in range(3):
            for (p, role), q in step.items():
                if role != "s" and p in best:
                    best[q] = min(best.get(q, (9e9, "")), (best[p][0] + 2, best[p][1] + "I"))
        return best
    best = closed({0: (0, "")})
    for role, fault in rows:
        new = {}
        def offer(q, cost, audit):
            new[q] = min(new.get(q, (9e9, "")), (cost, audit))
        for p, (cost, audit) in best.items():
            offer(p, cost + 3, audit + "D")
            if fault not in ("blank", "duplicate"):
                for role_to, edit, price in ((role[:1], "K", 0), ("u", "R", 2), ("a", "R", 2)):
                    if (p, role_to) in step:
                        offer(step[p, role_to], cost + price + (fault == "truncated"), audit + edit)
        best = closed(new)
    return min(best[q] for q in (0, 3) if q in best)


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_a_conversation_over_many_blocks(spark, partitions):
    rng = random.Random(4)
    texts = [f"line {i}{rng.choice(['.', '!', '', '?'])}" for i in range(900)]
    hot = [(i // 2 if i % 5 else i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(texts)) for i in range(1500)]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = found(spark, {1: hot, 2: [(0, "user", "a.")], 0: [(0, "user", "a."), (1, "assistant", "b.")]})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    ordered = sorted(hot)
    kinds, counts = described([(r, x) for _, r, x in ordered])
    cost, audit = straight(kinds)
    text = "\n".join(f"{r}:{x}" for r, x in repair.edited(audit, [(r, x) for _, r, x in ordered]))
    wanted = next(r for r in rows if r[0] == 1)
    assert wanted[2:5] == tuple(counts.values()) and wanted[6:8] == (cost, audit)
    assert wanted[8] == hashlib.sha256(text.encode()).hexdigest()
    assert len(rows) == 3 and [r[6] for r in rows if r[0] in (0, 2)] == [0, 2]


def test_many_copies_of_one_row(spark):
    rows = found(spark, {5: [(1, "user", "Again.")] * 30_000 + [(2, "assistant", "Yes.")]})
    assert rows[0][2:8] == (0, 29_999, 0, 29_999, 3 * 29_999, "K" + "D" * 29_999 + "K")


def test_repaired_rows_and_clashing_columns(spark):
    schema = "`conv.id` string, n int, kind string, said string, role int, text int, digest string, audit string, block int"
    df = spark.createDataFrame([("c", 1, "assistant", "b.", 1, 2, "d", "a", 3), ("c", 0, "tool", "a", 1, 2, "d", "a", 3)], schema)
    names = ("conv.id", "n", "kind", "said")
    fixes = repair.repairs(df, *names)
    assert [tuple(r) for r in repair.repaired_turns(df, fixes, *names).orderBy("place").collect()] == [("c", 0, "user", "a"), ("c", 1, "assistant", "b.")]
    assert fixes.first()["audit"] == "RK" and fixes.first()["cost"] == 3


def test_no_rows(spark):
    assert found(spark, {}) == []


def damaged_plainly(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_on_the_conversations(spark, sf):
    sf = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    conversations = damaged_plainly(rows)
    wanted = plainly({c: r for c, r in conversations.items() if r})
    wanted += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, r in conversations.items() if not r]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, queries.QUERIES["op11_structure_repair"](spark, sf).select(*names).collect()), key=str) == sorted(wanted, key=str)
