import random

import numpy as np
import plain
import pytest

from clinicpulse.llm import minhash
from clinicpulse.llm.hashing import shingle_set


def found(spark, rows, schema="doc_id bigint, text string", **settings):
    df = minhash.near_duplicates(spark.createDataFrame(rows, schema), settings=minhash.Settings(**settings))
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("width", [4, 5])
def test_agrees_with_all_pairs(spark, width):
    texts = plain.corpus(seed=width)
    texts |= {1000: None, 1001: "", 1002: " \t\n", 1003: "one two", 1004: "ONE  two", 1005: "one two three"}
    sizes, components = plain.near_duplicates(texts, width)
    rows = found(spark, list(texts.items()), width=width)
    assert {r[0]: r[1:] for r in rows} == {i: (sizes[i], components[i], components[i] == i) for i in texts}


def test_one_large_group_whose_members_differ(spark):
    """Copies with so many changes that a star finds few of the links; blocks must find the rest."""
    rng = random.Random(4)
    base = plain.prose(rng, 120, 10**6)
    texts = {i: " ".join(plain.edited(rng, base, rng.randint(0, 7))) for i in range(400)}
    sizes, components = plain.near_duplicates(texts, 4)
    rows = found(spark, list(texts.items()), width=4)
    assert {r[0]: r[2] for r in rows} == components


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, "a b c d e f", 1, "x"), (3, "a b c d e f", 2, None), (3, "a b c d e f", 3, "y"),
        (2, "A B C D E F", 4, None), (5, "other words that stand alone here", 5, ""), (5, "a b c d e f", 6, ""),
        (6, "other words that stand alone here", 7, "z"), (7, None, None, None),
    ]
    out = found(spark, rows, "doc_id bigint, text string, component_id bigint, kept string", width=4)
    assert sorted(out, key=str) == sorted(
        [(None, 3, None, True), (3, 3, 2, False), (3, 3, 2, False), (2, 3, 2, True), (5, 3, 2, False), (5, 3, 2, False),
         (6, 3, 2, False), (7, 0, 7, True)],
        key=str,
    )


def test_empty_table_and_very_long_text(spark):
    assert found(spark, []) == []
    long = " ".join(plain.prose(random.Random(1), 200_000, 10**5))
    out = found(spark, [(1, long), (2, long + " more"), (3, "x" * 1_000_000)])
    assert [(r[0], r[2]) for r in sorted(out)] == [(1, 1), (2, 1), (3, 3)]


def test_signatures_do_not_depend_on_order_and_fill_every_bin():
    text = "a b c d e f g h i j"
    sets = [shingle_set(t.encode(), 1) for t in (text, " ".join(reversed(text.split())))]
    first, second = (minhash.signature(s, 160) for s in sets)
    assert (first == second).all() and set(first) <= set(sets[0])
    one = minhash.signature(shingle_set(b"a", 1), 160)
    assert len(np.unique(one)) == 1 and len(one) == 160


def test_agreement_of_bins_estimates_similarity():
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    same = []
    for _ in range(60):
        common, a, b = draw(800), draw(100), draw(100)
        x, y = (minhash.signature(np.unique(np.r_[common, s]), 160) for s in (a, b))
        same.append((x == y).mean())
    assert abs(np.mean(same) - 0.8) < 0.02


def test_members_are_dealt_to_blocks_without_their_sketches(spark):
    """A bucket of n members with m outside the largest component makes about n + m rows for each 512 of the others."""
    members = spark.range(2000).selectExpr("1L AS key", "id AS node", "IF(id < 1400, 0L, id) AS component")
    blocks = minhash._blocks(members)
    assert set(blocks.columns) == {"key", "block", "chunk", "asks", "node", "component", "inside"}
    # 600 ask in 2 chunks and meet 2000 in 4 blocks.
    assert blocks.count() == 2000 * 2 + 600 * 4
