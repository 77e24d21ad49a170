"""Seed-and-extend runs against all lags: small alphabets, nested periods, planted runs, edges."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.llm import periodic_runs, queries


def brute(w, least=6, times=4):
    """Every lag over the whole text; a stretch that a smaller period explains is left out."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if len(part) >= max(least, times * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def runs_of(w, least=6, times=4):
    number = {}
    code = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    return list(map(tuple, periodic_runs.runs_of(code, len(w), least, times).tolist()))


def samples(seed):
    rng = random.Random(seed)
    for _ in range(120):
        kind, n = rng.randrange(6), rng.randrange(90)
        if kind == 0:
            yield [rng.choice("ab") for _ in range(n)]
        elif kind == 1:  # blocks repeated within repeated blocks
            block = [rng.choice("abc") for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 7)
            yield (block + [rng.choice("abc")]) * rng.randrange(1, 7) + [rng.choice("ab") for _ in range(n // 4)]
        elif kind == 2:
            a, b = ["a"], ["a", "b"]
            for _ in range(rng.randrange(8)):
                a, b = b, b + a
            yield (b * 5)[:n]
        elif kind == 3:  # a long period whose short grams all stand twice
            half = [rng.choice("ab") for _ in range(rng.randrange(1, 20))]
            yield (half + half[::-1] + half) * 5
        elif kind == 4:
            yield ["a"] * n
        else:
            w = [rng.choice("abcd") for _ in range(n)]
            s, p = rng.randrange(n + 1), rng.randrange(1, 9)
            yield w[:s] + (w[s : s + p] * 40)[: 5 * p] + w[s:]


@pytest.mark.parametrize("seed", range(4))
def test_against_all_lags(seed):
    for w in samples(seed):
        assert runs_of(w) == brute(w), w
        assert runs_of(w, 2, 3) == brute(w, 2, 3), w
        assert runs_of(w, 37, 3) == brute(w, 37, 3), w
        assert runs_of(w, 10, 5) == brute(w, 10, 5), w


def test_times_below_three():
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.int64), 9, 6, 2)


def test_texts_of_a_slice_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHARS", 300)
    texts = [" ".join(w) for w in samples(9)] + ["a a a", "a a a", None, "", "a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("runs", F.lit("clash")).repartition(2)
    rows = periodic_runs.with_runs(df).collect()
    assert len(rows) == len(texts) and set(rows[0].asDict()) == {"id", "text", "runs", "collapsed"}
    for r in rows:
        w = (r.text or "").split()
        expected = brute(w)
        assert [tuple(x) for x in r.runs] == expected and r.collapsed == collapsed(w, expected)


def test_long_and_repetitive_texts():
    """Seeds stay one a word and band however often a gram repeats."""
    rng = random.Random(3)
    line = [str(rng.randrange(50)) for _ in range(997)]
    w = line * 300 + ["x"] * 200_000 + ["a", "b"] * 50_000
    assert set(runs_of(w)) >= {(0, 997 * 300, 997), (997 * 300, 200_000, 1), (997 * 300 + 200_000, 100_000, 2)}
    assert len(runs_of([str(i) for i in range(300_000)])) == 0


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a\x0ba\x0ca\ra\na\ta"), (5, "a " * 5), (5, "a " * 5), (None, "a " * 6), (7, "  " * 6 + "é" * 9), (8, "\x1c b " * 3 + "\x1c b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("collapsed", F.lit(1))
    got = periodic_runs.with_runs(df).collect()
    assert sorted((r.doc_id or 0, len(r.runs), r.collapsed) for r in got) == sorted(
        [(1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 1, "a"), (5, 0, "a a a a a"), (5, 0, "a a a a a"), (0, 1, "a"), (7, 1, "  " + "é" * 9), (8, 1, "\x1c b")]
    )
    assert periodic_runs.with_runs(df.limit(0)).collect() == []


def test_strongest_and_listed(spark):
    lists = [[], [(5, 8, 2)], [(0, 8, 2), (3, 9, 2), (9, 18, 4)], [(0, 40, 10), (7, 8, 2)], [(1, 2**31 - 1, 2**29 - 1), (2, 2**31 - 5, 2**29 - 2)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], f"i int, runs array<{periodic_runs.RUN}>")
    rows = df.select("i", periodic_runs.strongest(F.col("runs")).alias("b"), periodic_runs.listed(F.col("runs")).alias("t")).orderBy("i").collect()
    for r, runs in zip(rows, lists):
        assert (tuple(r.b) if r.b else None) == min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.t == "".join(f"{s},{n},{p}\n" for s, n, p in runs)


def test_query(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SMOKE_DIR).collect()}
    assert len(rows) == len(docs)
    planted = 0
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(w) if n < 3000 else runs_of(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        r = rows[d.doc_id]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted
