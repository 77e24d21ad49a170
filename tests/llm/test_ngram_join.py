"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.llm import ngram_join as nj
from tillroll.llm import queries

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def shingles(text, n=5):
    w = WORD.findall((text or "").encode().lower())
    n = min(n, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows):
    """Links, class and copies of each row, by position."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in by[g]:
                if j != i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 5 * c >= 4 * (len(s) + len(sets[j]) - c):
                links[i] += 1
                root[find(i)] = find(j)
    classes = {}
    for i, (key, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(key)
    names = [min((k for k in classes[find(i)] if k is not None), default=None) for i in range(len(rows))]
    return links, names, [len(s) for s in sets]


def near_copies(seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 300))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8, 15])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def joined(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    return nj.near_duplicates(df, **options).collect()


@pytest.mark.parametrize("few", [nj.FEW_CLASSES, 2])
def test_against_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(nj, "FEW_CLASSES", few)
    rows = near_copies()
    links, names, _ = brute(rows)
    got = {r.doc_id: r for r in joined(spark, rows)}
    assert [(got[i].n_links, got[i].class_id) for i, _ in rows] == list(zip(links, names))


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, "..."), (4, "a b"), (5, "A, b!"), (6, "a b c"), (7, text), (7, text), (8, text + "."), (None, text),
            (9, text + " more"), (10, "é " * 30_000), (None, None)]
    got = joined(spark, rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].n_links == 0 and by[i][0].class_id == i and by[i][0].keeper for i in (1, 2, 3, 6, 10))
    assert [r.n_links for i in (4, 5) for r in by[i]] == [1, 1] and by[5][0].class_id == 4
    assert {r.n_links for i in (7, 8, 9) for r in by[i]} == {4} and {r.class_id for i in (7, 8, 9) for r in by[i]} == {7}
    assert by[9][0].copies_id == 9 and by[8][0].copies_id == 7
    assert joined(spark, []) == []


def test_one_row_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, "a"), (1, None, "a"), (7, text, "b"), (7, text, "c"), (8, text, "d"), (None, text, "e"), (9, "other words here", "f"), (2, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    out = nj.without_duplicates(df)
    assert out.columns == df.columns
    left = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert left == sorted([("1", None), ("1", None), ("7", text), ("9", "other words here"), ("2", "")], key=lambda x: (x[0], x[1]))
    assert nj.without_duplicates(df.limit(0)).collect() == []


def test_prefix_length():
    for trees, depth in ((24, 8), (8, 8), (4, 3)):
        n = nj.prefix_length(trees, depth, 0.8, 0.9999)
        assert n == 1 or 1 - (1 - 0.8**n) ** trees >= 0.9999
        assert n == depth or 1 - (1 - 0.8 ** (n + 1)) ** trees < 0.9999


def test_common_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(12)]
    for i, common in nj.common_counts(sets[:5], sets):
        assert common.tolist() == [len(np.intersect1d(sets[i], s)) for s in sets]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in nj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    links, names, _ = brute(docs)
    got = {r.doc_id: (r.n_links, r.class_id) for r in queries.op8_ngram_join(spark, SMOKE_DIR).collect()}
    assert got == {k: (l, n) for (k, _), l, n in zip(docs, links, names)}
