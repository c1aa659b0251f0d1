from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowcubes.llm import near_dedup as N
from flowcubes.llm.common import components
from llm_helpers import prose


def groups(pairs, nodes):
    low = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 50)]
    ring = [(200 + i, 200 + (i * 7 + 3) % 20) for i in range(20)] + [(200 + i, 200 + (i + 1) % 20) for i in range(20)]
    pairs = chain + star + ring + [(300, 300), (0, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    pairs.remove((300, 300))
    want = groups(pairs, {x for p in pairs for x in p})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.permutations(list(range(24))), st.integers(0, 6), st.integers(0, 6), st.booleans())
def test_banded_alignment_is_exact_at_and_above_the_threshold(order, cut, add, near):
    a = list(range(24))
    b = (a[cut:] + [100 + i for i in range(add)]) if near else order[cut:]
    m = lcs(a, b)
    exact = m / (len(a) + len(b) - m)
    got = N.aligned(np.array(a, "u8"), np.array(b, "u8"))
    assert (got >= N.SIMILARITY) == (exact >= N.SIMILARITY)
    if exact >= N.SIMILARITY:
        assert got == pytest.approx(exact)


def test_labels_tell_repeats_apart():
    plain, labelled = N.shingles("a b c d e a b c d e a b c d e".split())
    assert len(set(plain.tolist())) < len(plain)
    assert len(set(labelled.tolist())) == len(labelled)
    assert N.shingles(["x"])[0].shape == (1,) and N.shingles([])[0].shape == (0,)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at:at + 1] = rng.choice([[], ["zz"], [words[at], "yy"]])
    return words


def corpus(rng):
    texts = [prose(rng, rng.randint(30, 300)) for _ in range(30)]
    texts += [" ".join(edited(rng, texts[i % 12].split(), rng.randint(1, 12))) for i in range(60)]
    base = prose(rng, 200)
    for _ in range(25):  # a chain: each is near the one before
        base = " ".join(edited(rng, base.split(), 2))
        texts.append(base)
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(25)]
    return texts + ["", None, "a", "a b", "a b", "  a   b ", "x " * 400, "x " * 396, prose(rng, 20_000)] + texts[:5]


def brute(rows):
    sh = [N.shingles((t or "").split())[1] for _, t in rows]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (rows[i][1] or "").split() == (rows[j][1] or "").split()]
    for i, j in itertools.combinations(range(len(rows)), 2):
        m = lcs(sh[i].tolist(), sh[j].tolist()) if 0 < min(len(sh[i]), len(sh[j])) and min(len(sh[i]), len(sh[j])) >= 0.8 * max(len(sh[i]), len(sh[j])) and len(np.intersect1d(sh[i], sh[j])) > 5 else 0
        if m and m / (len(sh[i]) + len(sh[j]) - m) >= 0.8:
            pairs.append((i, j))
    return groups(pairs, range(len(rows)))


def test_groups_are_those_of_all_pairs(docs_of, rng, clash):
    rows = list(enumerate(corpus(rng)))
    docs = docs_of(rows, clash)
    got = N.classes(docs).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    stay = N.keep_one(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(want.values()))


def test_repeated_ids_nulls_and_empty_table(docs_of):
    rows = [(None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"), (None, None), (9, "other words here")]
    docs = docs_of(rows)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in N.classes(docs).collect() if r.doc_id) == [(4, 4, False), (4, 4, True), (9, 9, True)]
    assert N.keep_one(docs).count() == 3
    assert N.classes(docs_of([])).count() == 0 and N.keep_one(docs_of([])).count() == 0


def test_shared_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40_000, 3000)).astype("u8") for _ in range(9)]
    got = N.overlaps(sets[:4], sets[4:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]).all()


def test_blocks_of_a_bucket_lose_no_link(docs_of, rng, monkeypatch):
    """Copies with so many edits that pivots do not connect them all."""
    base = prose(rng, 150).split()
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 9)))) for i in range(120)]
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "PIVOT_ROUNDS", 1)
    assert {r.doc_id: r.component_id for r in N.classes(docs_of(rows)).collect()} == brute(rows)


def test_a_large_group_costs_a_few_comparisons_a_member(docs_of, rng, monkeypatch):
    base = prose(rng, 120).split()
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(300)]
    made = []
    real = N._verified
    monkeypatch.setattr(N, "_verified", lambda p, d, t: made.append(p.count()) or real(p, d, t))
    got = N.classes(docs_of(rows))
    assert got.where("kept").count() == 1
    assert sum(made) < 300 * 3 * N.SKETCHES
    assert got.agg(F.countDistinct("component_id")).first()[0] == 1


def likeliest(a, b, m):
    """Largest probability that two texts with m aligned shingles agree in a sketch."""
    u = a + b - m
    p = [comb(m, k) / comb(u, k) for k, least, most in N.ORDERS if all(least <= n <= (most or n) for n in (a, b))]
    return 1 - (1 - max(p, default=0)) ** N.SKETCHES


def test_pairs_of_any_length_share_a_bucket_as_stated():
    for u in range(5, 600):
        for m in range(-(-4 * u // 5), u):
            assert all(likeliest(a, u + m - a, m) > 0.9999 for a in range(m, u + 1))


def test_short_near_copies_are_found(docs_of, rng):
    texts = []
    for n in [8] * 40 + [9] * 40 + [12] * 40 + [rng.randint(1, 110) for _ in range(120)]:
        words = prose(rng, n).split()
        texts += [" ".join(words), " ".join(words + ["zz"]), " ".join(["yy"] + words[:-1])]
    got = {r.doc_id: r.component_id for r in N.classes(docs_of(list(enumerate(texts)))).collect()}
    sh = [N.shingles(t.split())[1].tolist() for t in texts]
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if texts[i].split() == texts[j].split()
            or set(sh[i]) & set(sh[j]) and (m := lcs(sh[i], sh[j])) / (len(sh[i]) + len(sh[j]) - m) >= 0.8]
    low = {n: n for n in range(len(texts))}
    for _ in range(9):
        for i, j in near:
            low[i] = low[j] = min(low[i], low[j])
    assert got == low


def test_rows_keep_their_numbers_when_the_scan_is_split_anew(spark, docs_of, rng, tmp_path, monkeypatch):
    """As on a cluster whose cores change between two plans."""
    texts = [prose(rng, 40) for _ in range(30)]
    rows = list(enumerate(texts + [t + " zz" for t in texts[:10]]))
    path = f"{tmp_path}/docs"
    docs_of(rows).repartition(8).write.parquet(path)
    split = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.minPartitionNum": "8"}
    before = {k: spark.conf.get(k, None) for k in split}
    real = N.linked

    def shifted(docs, reps, threshold):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return real(docs, reps, threshold)

    monkeypatch.setattr(N, "linked", shifted)
    try:
        for k, v in split.items():
            spark.conf.set(k, v)
        stay = sorted(r.doc_id for r in N.keep_one(spark.read.parquet(path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    assert stay == list(range(30))
