import numpy as np
import plain

from clinicpulse.llm import multiindex

INF, NAN = float("inf"), float("nan")


def expected(rows, threshold=0.93):
    sound = []
    for id_, v, label in rows:
        ok = id_ is not None and label is not None and bool(v)
        ok = ok and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        sound.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None)
    counts, links = [0] * len(rows), []
    for i, a in enumerate(sound):
        for j in range(i):
            b, same = sound[j], rows[i][2] == rows[j][2]
            if a is not None and b is not None and same and len(a) == len(b) and a @ b >= threshold:
                counts[i] += 1
                counts[j] += 1
                links.append((rows[i][0], rows[j][0]))
    low = plain.components([r[0] for r in rows if r[0] is not None], links)
    return sorted([(r[0], n, low.get(r[0]), r[0] is None or low[r[0]] == r[0]) for r, n in zip(rows, counts, strict=True)], key=str)


def found(spark, rows, schema="vec_id bigint, embedding array<float>, label int", **settings):
    df = multiindex.near_duplicates(spark.createDataFrame(rows, schema), settings=multiindex.Settings(**settings))
    return sorted([tuple(r) for r in df.collect()], key=str)


def vectors(seed, n, dim=24, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    at = rng.integers(0, len(centres), n)
    noise = rng.choice([0, spread, 4 * spread], n)[:, None] * rng.normal(size=(n, dim))
    return (centres[at] + noise).astype(np.float32)


def test_agrees_with_all_pairs(spark):
    v = vectors(1, 600)
    rows = [(i, x.tolist(), int(i % 3)) for i, x in enumerate(v)]
    out, wanted = found(spark, rows, per_cell=20), expected(rows)
    assert [r[2:] for r in out] == [r[2:] for r in wanted]
    assert sum(r[1] for r in out) >= 0.99 * sum(r[1] for r in wanted)


def test_vectors_of_every_length_are_compared(spark):
    rows = []
    for k, dim in enumerate((24, 5, 1, 17, 33, 16)):
        rows += [(1000 * k + i, x.tolist(), int(i % 2)) for i, x in enumerate(vectors(k, 60, dim, 0.02))]
    rows += [(9000, [*rows[0][1], 0.0], 0), (9001, [1.0], 0), (9002, [], 0)]
    out = found(spark, rows, per_cell=8)
    assert out == expected(rows)
    assert {r[0] // 1000 for r in out if r[1]} == {0, 1, 2, 3, 4, 5, 9}


def test_recall_at_the_threshold_itself():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    partners = 0.93 * x + (1 - 0.93**2) ** 0.5 * aside
    grid = multiindex.learn(x, 60_000, multiindex.Settings())
    cells = grid.cells(partners)
    visits = grid.visits(x)
    met = np.mean([c in v for c, v in zip(cells, visits, strict=True)])
    assert met >= 0.99
    assert all(v[0] == o for v, o in zip(visits, grid.cells(x), strict=True))
    for i in range(20):
        excess = grid.excess(np.repeat(x[i : i + 1], len(visits[i]), 0), visits[i])
        assert (np.diff(excess) >= -1e-9).all() and (excess <= grid.reach + 1e-9).all()


def test_links_along_strong_directions(spark):
    """Links lie along four of 24 axes, and the vectors that sort first have none."""
    rng = np.random.default_rng(4)
    alone = rng.normal(size=(120, 24))
    alone[:, 0] = -2 * np.abs(alone[:, 0]) - 2
    flat = 0.02 * rng.normal(size=(1500, 24))
    flat[:, [1, 2, 13, 14]] += rng.normal(size=(1500, 4))
    flat[:, 0] = np.abs(flat[:, 0])
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.r_[alone, flat].astype(np.float32))]
    wanted = sum(r[1] for r in expected(rows))
    assert wanted > 20_000
    for recall, pairs in ((0.999, 100), (0.99, 400)):
        assert sum(r[1] for r in found(spark, rows, per_cell=10, recall=recall, pairs=pairs)) >= recall * wanted


def test_a_large_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    near = [(base + 0.01 * rng.normal(size=16)).astype(np.float32).tolist() for _ in range(1200)]
    rows = [(i, v, 1) for i, v in enumerate(near)] + [(5000 + i, near[0], 1) for i in range(800)]
    out = found(spark, rows)
    assert {r[1:3] for r in out} == {(1999, 0)}


def test_odd_vectors_ties_repeats_and_clashing_columns(spark):
    a = [1.0, 2.0, 3.0]
    rows = [
        (1, a, 1), (2, [2.0, 4.0, 6.0], 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1),
        (7, [1.0, None, 3.0], 1), (8, [1.0, NAN, 3.0], 1), (9, [1.0, INF, 3.0], 1), (10, [], 1), (11, [1.0, 2.0], 1),
        (None, a, 1), (12, [-1.0, -2.0, -3.0], 1), (1, a, 1), (13, [1e-30, 2e-30, 3e-30], 1), (14, [1e30, 2e30, 3e30], 1),
    ]
    assert found(spark, rows) == expected(rows)
    wide = [(*r, 7, "x") for r in rows]
    assert found(spark, wide, "vec_id bigint, embedding array<float>, label int, n_links int, unit string") == expected(rows)


def test_empty_table_and_nothing_sound(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [0.0], None)]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_codebooks_keep_to_their_sample(spark):
    rows = [(i, x.tolist(), 0) for i, x in enumerate(vectors(5, 300))]
    out, wanted = found(spark, rows, sample=24 * 50, per_cell=10), expected(rows)
    assert sum(r[1] for r in out) >= 0.97 * sum(r[1] for r in wanted)
