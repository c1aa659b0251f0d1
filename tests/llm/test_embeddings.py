from __future__ import annotations

import math

import numpy as np

from flowcubes.llm import embedding_dedup as E
from flowcubes.llm.common import prepare


def brute(rows):
    ok = [i for i, (_, label, v) in enumerate(rows) if label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    unit = {i: np.array(rows[i][2], float) / np.abs(rows[i][2]).max() for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i < j and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= E.COSINE:
                links[i].add(j)
                links[j].add(i)
    low = list(range(len(rows)))
    ids = [r[0] for r in rows]
    for _ in rows:
        for i, own in links.items():
            for j in own:
                low[i] = low[j] = min(low[i], low[j])
    least = {c: min((ids[i] for i in range(len(rows)) if low[i] == c and ids[i] is not None), default=None) for c in set(low)}
    return [(ids[i], len(links[i]), least[low[i]]) for i in range(len(rows))]


def sample(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.standard_normal(24)
            for _ in range(int(rng.integers(1, 12))):
                rows.append((len(rows), label, (base + rng.standard_normal(24) * rng.uniform(0.02, 0.3)).tolist()))
    base = rng.standard_normal(24)
    rows += [(len(rows) + i, 1, base.tolist()) for i in range(20)]
    n = len(rows)
    rows += [(n, 0, None), (n + 1, 0, []), (n + 2, 0, [0.0] * 24), (n + 3, 0, [float("nan")] * 24), (n + 4, 0, [None, *[1.0] * 23]), (n + 5, 0, [1.0] * 23 + [float("inf")]), (n + 6, 0, [1.0, 2.0]), (n + 7, 0, [2.0, 4.0])]
    return rows + [(None, 1, base.tolist()), (5, rows[5][1], rows[5][2]), (n + 8, 0, [1e-300] * 24), (n + 9, 0, [1e300] * 24)]


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS rep", "'x' AS t").checkpoint()


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


def test_links_and_components_are_those_of_all_pairs(spark):
    rows = sample()
    got = [(r.vec_id, r.n_links, r.component_id) for r in E.links(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_blocks_of_a_hot_cell_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(i, 1, (base + rng.standard_normal(16) * 0.12).tolist()) for i in range(150)]
    monkeypatch.setattr(E, "BLOCK", 16)
    got = [(r.vec_id, r.n_links, r.component_id) for r in E.links(frame(spark, rows)).collect()]
    want = brute(rows)
    found, every = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= every and found >= 0.995 * every
    assert {r[0]: r[2] for r in got} == {r[0]: r[2] for r in want}


def test_recall_at_the_threshold_itself():
    """Pairs of just the threshold's cosine share a cell and pass the count."""
    rng = np.random.default_rng(11)
    size, n = 64, 4000
    a = rng.standard_normal((n, size))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.standard_normal((n, size))
    o -= (o * a).sum(1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = E.COSINE * a + math.sqrt(1 - E.COSINE**2) * o
    table, offset, counted = E.directions(size)
    cell = lambda x: np.floor((x @ table + offset) / E.CELL).reshape(n, E.TABLES, E.BITS)
    shared = (cell(a) == cell(b)).all(2).any(1)
    counts = (np.abs(a @ counted - b @ counted) <= 2 * E.spread(E.COSINE)).sum(1)
    assert (shared & (counts >= E.needed())).mean() > 0.99


def test_window_counts():
    rng = np.random.default_rng(2)
    q, d = rng.standard_normal((7, 5)), rng.standard_normal((9, 5))
    assert (E.collisions(q, d, 0.6) == (np.abs(q[:, None] - d[None]) <= 0.6).sum(2)).all()


def test_empty_table(spark):
    assert E.links(frame(spark, [(1, 1, [1.0])]).limit(0)).count() == 0


def test_pairs_at_the_threshold_share_a_cell_as_stated():
    rng = np.random.default_rng(11)
    lost, size, n = 0, 32, 2000
    table, offset, _ = E.directions(size)
    for _ in range(20):
        x = rng.standard_normal((n, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal((n, size))
        y -= (y * x).sum(1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        y = E.COSINE * x + np.sqrt(1 - E.COSINE**2) * y
        a, b = (np.floor((v @ table + offset) / E.CELL).reshape(n, E.TABLES, E.BITS) for v in (x, y))
        lost += n - int((a == b).all(2).any(1).sum())
    print(f"lost {lost} of 40000, {E.TABLES} tables")
    assert lost <= 16  # four expected at 0.9999


def test_hot_classes_and_components_are_broadcast(spark, monkeypatch):
    """Rows of frequent vectors and classes of large components take the other join."""
    rows = sample()
    monkeypatch.setattr(E, "HOT_ROWS", 3)
    monkeypatch.setattr(E, "HOT_SHARE", 10**6)
    got = [(r.vec_id, r.n_links, r.component_id) for r in E.links(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_single_precision_columns_and_small_cells(spark, monkeypatch):
    rows = [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in sample(4) if v is None or None in v or all(abs(x) < 1e30 and (x == 0 or abs(x) > 1e-30) for x in v)]
    monkeypatch.setattr(E, "LEAST_BITS", 9)
    got = E.links(frame(spark, rows).selectExpr("vec_id", "label", "cast(embedding as array<float>) as embedding"))
    got = [(r.vec_id, r.n_links, r.component_id) for r in got.collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_every_number_of_directions_keeps_the_recall():
    assert [E.bits_for(n) for n in (0, 1, 5_000, 10_000_000)] == [4, 4, 4, 14]
    for bits in range(E.LEAST_BITS, 30):
        tables = E.tables_for(bits)
        assert E.sharing(tables, bits=bits) >= E.RECALL > E.sharing(tables - 1, bits=bits)


def test_few_pairs_below_the_threshold_pass_the_count():
    rng = np.random.default_rng(8)
    counted = E.directions(64)[2]
    for cosine, most in ((0.5, 0.01), (0.8, 0.4)):
        a = rng.standard_normal((4000, 64))
        a /= np.linalg.norm(a, axis=1)[:, None]
        o = rng.standard_normal((4000, 64))
        o -= (o * a).sum(1)[:, None] * a
        b = cosine * a + math.sqrt(1 - cosine**2) * o / np.linalg.norm(o, axis=1)[:, None]
        counts = (np.abs(a @ counted - b @ counted) <= 2 * E.spread(E.COSINE)).sum(1)
        assert (counts >= E.needed()).mean() < most
