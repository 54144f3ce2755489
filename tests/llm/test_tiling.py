import random

import plain

from clinicpulse.llm import tiling
from clinicpulse.llm.hashing import word_hashes


def greedy(item, doc, width):
    """Greedy string tiling as it is defined: the longest free common run is marked again and again."""
    free_a, free_b, laid = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < width:
            return laid
        for x in range(k):
            free_a[i + x] = free_b[j + x] = False
        laid += k


def words(rng, n):
    return [rng.choice("abcdefgh") for _ in range(n)]


def test_tiles_cover_what_the_definition_covers():
    rng = random.Random(3)
    for _ in range(300):
        item, doc = words(rng, rng.randint(0, 30)), words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            if item and len(doc) > 12:
                a, b = sorted(rng.sample(range(len(item) + 1), 2))
                at = rng.randrange(len(doc))
                doc[at:at] = item[a:b]
        laid = tiling.tiles(word_hashes(" ".join(item).encode()), word_hashes(" ".join(doc).encode()), 4)
        covered_a = [i + k for size, i, _ in laid for k in range(size)]
        covered_b = [j + k for size, _, j in laid for k in range(size)]
        assert len(set(covered_a)) == len(covered_a) and len(set(covered_b)) == len(covered_b)
        assert all(item[i : i + s] == doc[j : j + s] and s >= 4 for s, i, j in laid)
        wanted = greedy(item, doc, 4)
        # Ties between equally long runs may be laid either way.
        assert abs(sum(s for s, _, _ in laid) - wanted) <= 4 or sum(s for s, _, _ in laid) >= wanted


def test_distinct_words_leave_no_ties():
    rng = random.Random(9)
    for _ in range(100):
        item = [f"w{i}" for i in range(40)]
        cuts = sorted(rng.sample(range(1, 40), rng.randint(0, 6)))
        pieces = [item[a:b] for a, b in zip([0, *cuts], [*cuts, 40], strict=True)]
        rng.shuffle(pieces)
        doc = [w for p in pieces for w in [*p, "other"]]
        laid = tiling.tiles(word_hashes(" ".join(item).encode()), word_hashes(" ".join(doc).encode()), 5)
        assert sum(s for s, _, _ in laid) == greedy(item, doc, 5)


def test_equal_words_are_not_paired():
    item, doc = word_hashes(b"x " * 1000 + b"y"), word_hashes(b"x " * 300_000)
    assert tiling.tiles(item, doc, 5) == [(1000, 0, 0)]
    started = sum(len(i) for i, _ in tiling._starts(tiling._Running(item), tiling._Running(doc), 500))
    assert started <= len(item) + len(doc)


def test_portions_do_not_change_the_tiles(monkeypatch):
    rng = random.Random(8)
    pairs = [([rng.choice("ab") for _ in range(50)], [rng.choice("abc") for _ in range(400)]) for _ in range(30)]
    hashed = [[word_hashes(" ".join(x).encode()) for x in pair] for pair in pairs]
    whole = [sum(s for s, _, _ in tiling.tiles(a, b, 4)) for a, b in hashed]
    monkeypatch.setattr(tiling, "_PORTION", 20)
    monkeypatch.setattr(tiling, "_BLOCK", 7)
    for (item, doc), (a, b), covered in zip(pairs, hashed, whole, strict=True):
        laid = tiling.tiles(a, b, 4)
        assert len({i + k for s, i, _ in laid for k in range(s)}) == len({j + k for s, _, j in laid for k in range(s)})
        assert all(item[i : i + s] == doc[j : j + s] and s >= 4 for s, i, j in laid)
        assert abs(sum(s for s, _, _ in laid) - covered) <= 4


def found(spark, docs, items, **more):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string, covered int, words int")
    out = tiling.coverage(df, spark.createDataFrame(items, "item_id bigint, text string, item int"), **more)
    joined = df.select("doc_id", *tiling.row_key("doc_id", "text")).join(out, ["row_a", "row_b"], "left")
    return sorted([(r["doc_id"], r["items"] or 0, r["item_id"], r["covered"], bool(r["contaminated"])) for r in joined.collect()], key=str)


def wide(rows):
    return [(*r, "x", 1, 2) for r in rows]


def test_whole_reordered_and_partial_passages(spark):
    rng = random.Random(5)
    item = plain.prose(rng, 40, 10**6)
    text = lambda *parts: " ".join(w for p in parts for w in p)
    noise = lambda n: plain.prose(rng, n, 10**6)
    docs = [
        (1, text(noise(50), item, noise(30))),
        (2, text(item[20:], noise(9), item[:20])),
        (3, text(noise(5), item[:31], noise(5))),
        (4, text(noise(5), item[:33], noise(5))),
        (5, text(noise(300))),
        (6, " ".join(item).upper().replace(" ", "\n\t")),
        (7, text(*[item[i : i + 4] + noise(1) for i in range(0, 40, 4)])),
    ]
    out = {r[0]: r for r in found(spark, wide(docs), [(9, " ".join(item), 0), (8, "too short", 0)])}
    assert [out[i][4] for i in range(1, 8)] == [True, True, False, True, False, True, False]
    assert out[1][3] == 1.0 and out[2][3] == 1.0 and out[4][3] == 33 / 40 and out[6][2] == 9


def test_items_that_repeat_themselves(spark):
    item = " ".join(["the cat sat on the mat"] * 10)
    docs = [(1, f"before {item} after"), (2, "the cat sat on the mat the cat sat"), (3, "the cat sat on a mat"), (1, f"before {item} after")]
    out = found(spark, wide(docs), [(4, item, 0), (5, "7 " * 50, 0)])
    assert [(r[0], r[2], r[4]) for r in out] == [(1, 4, True), (1, 4, True), (2, 4, False), (3, None, False)]
    assert [r[3] for r in out[:3]] == [1.0, 1.0, 9 / 60]


def test_nulls_ties_repeats_and_empty_tables(spark):
    passage = "one two three four five six seven"
    docs = [(None, passage), (1, passage), (1, passage), (2, None), (3, ""), (4, "  "), (5, "one two three four")]
    items = [(7, passage, 0), (3, passage, 1), (3, passage, 2), (None, None, 0), (5, "", 0), (6, "one two three four", 0)]
    hit, miss = (2, 3, 1.0, True), (0, None, None, False)
    assert found(spark, wide(docs), items) == sorted(
        [(None, *hit), (1, *hit), (1, *hit), (2, *miss), (3, *miss), (4, *miss), (5, *miss)], key=str
    )
    assert found(spark, [], items) == []
    assert found(spark, wide(docs[:1]), []) == [(None, *miss)]


def test_a_passage_that_most_documents_hold_and_a_long_text(spark):
    rng = random.Random(6)
    item = " ".join(plain.prose(rng, 30, 10**6))
    docs = [(i, f"{' '.join(plain.prose(rng, 5))} {item if i % 3 else ''}") for i in range(600)]
    docs.append((9999, f"{' '.join(plain.prose(rng, 300_000, 50))} {item}"))
    out = found(spark, wide(docs), [(i, item if i == 0 else " ".join(plain.prose(rng, 30, 10**6)), 0) for i in range(20)])
    assert {r[0] for r in out if r[4]} == {i for i in range(600) if i % 3} | {9999}


def test_a_crowded_bitmap_only_costs_precision(spark, monkeypatch):
    monkeypatch.setattr(tiling, "_MAX_BITS", 1 << 16)
    rng = random.Random(7)
    items = [(i, " ".join(plain.prose(rng, 60, 10**6)), 0) for i in range(1500)]
    docs = [(i, items[i * 7][1]) for i in range(50)] + [(100 + i, " ".join(plain.prose(rng, 200, 10**6))) for i in range(50)]
    out = found(spark, wide(docs), items)
    assert {r[0]: r[2] for r in out if r[4]} == {i: i * 7 for i in range(50)}
