"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from conftest import SMOKE_DIR
from tillroll.llm import ann, queries


def brute(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if asked(i):
            s = (x * np.array(v)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def run(spark, rows, k, every=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(ann.nearest(df, lambda c: c % every == 0, k=k).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    for n, k in ((1, 3), (3, 5), (60, 7)):
        rows = [(i, (rng.normal(size=4) * (1 + i % 3)).tolist()) for i in range(n)]
        got, want = run(spark, rows, k), brute(rows, lambda i: i % 5 == 0, k)
        assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items() if v}
        for i, v in got.items():
            assert np.allclose([s for _, s in v], [s for _, s in want[i]], rtol=1e-14)


def test_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, -0.0]) for i in range(100)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(80)] + [(300, [2.0, 0.0, 0.0])]
    got, want = run(spark, rows, 6), brute(rows, lambda i: i % 5 == 0, 6)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


def test_unusable_vectors_take_no_part(spark):
    good = [(i, [float(i + 1), 1.0]) for i in range(10)]
    bad = [(20, None), (25, [0.0, 0.0]), (30, [None, 1.0]), (35, [math.nan, 1.0]), (40, [math.inf, 1.0]), (45, [1.0]), (50, []), (None, [1.0, 1.0])]
    got = run(spark, good + bad + good[:2], 3)
    want = brute(good, lambda i: i % 5 == 0, 3)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}
    assert run(spark, bad, 3) == {} and run(spark, [], 3) == {}


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_with_parts(spark, monkeypatch, clustered):
    monkeypatch.setattr(ann, "PART_ROWS", 150)
    monkeypatch.setattr(ann, "SAMPLE", 800)
    monkeypatch.setattr(ann, "BLOCK", 200)
    monkeypatch.setattr(ann, "QUERIES", 40)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 16)) * 2 if clustered else np.zeros((12, 16))
    rows = [(i, (centre[i % 12] + rng.normal(size=16)).tolist()) for i in range(2000)]
    got, want = run(spark, rows, 10, every=20), brute(rows, lambda i: i % 20 == 0, 10)
    hit = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert all(len(got[i]) == 10 for i in want)
    assert hit >= 0.9 * 10 * len(want)


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    part = ann.balanced_parts(ann.neighbour_graph(x, 8), x, 6)
    assert np.bincount(part, minlength=6).max() <= math.ceil(1.1 * 100) and part.min() >= 0


def test_query_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in queries.op6_neighbours(spark, SMOKE_DIR).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want)
    assert sum(len(got[i] & {j for j, _ in v}) for i, v in want.items()) >= 0.9 * 20 * len(want)


def test_distinct_vectors_of_equal_inner_product(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "SAMPLE", 50)
    rng = np.random.default_rng(6)
    binary = [[float(b) for b in np.binary_repr(i, 9)] for i in range(1, 512)]
    rows = list(zip(rng.permutation(900).tolist(), binary + binary[::2]))  # copies interleave with other vectors of the same score
    got, want = run(spark, rows, 20), brute(rows, lambda i: i % 5 == 0, 20)
    assert got == want
    small = [(i, [1.0 + i % 3, *rng.normal(size=3).tolist()]) for i in range(1, 400)] + [(0, [1.0, 0.0, 0.0, 0.0])]
    got, want = run(spark, small, 20), brute(small, lambda i: i % 5 == 0, 20)
    assert got[0] == want[0] and {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


def test_small_tables_use_the_learned_parts(spark, monkeypatch):
    made, fit = [], ann.fit_router
    monkeypatch.setattr(ann, "fit_router", lambda *a: made.append(fit(*a)) or made[-1])
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(500)]
    got, want = run(spark, rows, 20), brute(rows, lambda i: i % 5 == 0, 20)
    assert made[0].weights.shape[1] == 2 and made[0].weights.any() and set(made[0].part) == {0, 1}
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}
