"""FM-index and contamination against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.llm import decontaminate as dc
from tillroll.llm import queries
from tillroll.llm.common import suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=13):
    """Words, hit words, items, judged word by word."""
    ws = words(text)
    hit, named = set(), set()
    for name, item in items:
        iw = words(item)
        n = min(window, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for j in range(len(ws) - n + 1):
                if ws[j : j + n] == iw[i : i + n]:
                    hit.update(range(j, j + n))
                    named.add(str(name))
    return len(ws), len(hit), sorted(named)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, [2, 3, 9, 400][seed], 300), 0)
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("sigma", [2, 3, 17])
def test_index_finds_all_places(sigma):
    rng = np.random.default_rng(sigma)
    text = rng.integers(1, sigma, 500)
    index = dc.FMIndex(text, sigma)
    for n in (1, 2, 5):
        phrases = np.array([text[i : i + n] for i in rng.integers(0, 490, 20)] + [rng.integers(1, sigma, n) for _ in range(20)])
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_merged_spans():
    begin, end = dc.merged(np.array([0, 2, 5, 9]), np.array([3, 4, 6, 12]))
    assert list(zip(begin.tolist(), end.tolist())) == [(0, 4), (5, 6), (9, 12)]


def cases():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["École", "école", "Ça"]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, item(20)), (2, item(13)), (3, "w1 w2, w3"), (4, ""), (5, None), (6, "  ...  "), (None, item(14)), (7, item(20))]
    items.append((8, items[0][1]))
    docs = [None, "", "...", "w1 W2 w3", "w1 w2 w3 w1 w2 w3", items[0][1], items[1][1].upper(), item(200)]
    for _ in range(40):
        text = [rng.choice(vocabulary + ["unknown"]) for _ in range(rng.randrange(1, 120))]
        if rng.random() < 0.7:
            source = (rng.choice([x for x in items if x[1]])[1]).split()
            a = rng.randrange(len(source)) if len(source) > 1 else 0
            text[rng.randrange(len(text)) : 0] = source[a:]
        docs.append((", " if rng.random() < 0.5 else " ").join(text))
    docs += docs[:9]
    docs.append("lead " * 30_000 + items[0][1])
    return items, docs


@pytest.mark.parametrize("slice_words", [dc.SLICE_WORDS, 3])
def test_against_plain_search(spark, monkeypatch, slice_words):
    monkeypatch.setattr(dc, "SLICE_WORDS", slice_words)
    items, texts = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_hit int")
    rows = dc.find(docs, benchmark, keep=["doc_id", "n_hit"]).collect()
    assert len(rows) == len(texts)
    small = [(i, t) for i, t in items]
    for r in rows:
        text = texts[r.doc_id]
        if text and len(text) > 100_000:
            assert r.n_hit >= 20 and "1" in r["items"]
            continue
        n, hit, named = brute(text, [x for x in small if x[0] is not None], 13)
        alln, allhit, _ = brute(text, small, 13)
        assert (r.n_words, r.n_hit, r["items"]) == (alln, allhit, named), text
        ws = [m.span() for m in WORD.finditer((text or "").translate(LOWER))]
        assert [(s.start, s.end) for s in r.spans] == [(ws[s.start][0], ws[s.end - 1][1]) for s in r.word_spans]


def test_slices_agree_on_documents_that_move(spark, monkeypatch):
    """Documents that come in another order each time they are computed, over several slices."""
    monkeypatch.setattr(dc, "SLICE_WORDS", 5)
    items, texts = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:-1])], "doc_id long, text string")
    moving = docs.repartition(5).withColumn("r", F.rand()).orderBy("r").drop("r").repartition(4, F.rand())
    for r in dc.find(moving, benchmark, keep=["doc_id"]).collect():
        n, hit, _ = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit) == (n, hit)


def test_without_spans(spark):
    df = spark.createDataFrame([("éa bc de",), (None,)], "text string")
    spans = F.array(*(F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((0, 2), (6, 8))))
    assert [r[0] for r in df.select(dc.without_spans(F.col("text"), spans)).collect()] == [" bc ", None]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in dc.find(docs, none).collect()] == [(3, 0, [])]
    assert dc.find(docs.limit(0), none).collect() == []


def test_query_digest(spark):
    rows = {r.doc_id: r for r in queries.op2_decontaminate(spark, SMOKE_DIR).collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    windows = {}
    for name, item in items:
        ws = words(item)
        n = min(13, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(str(name))
    lengths = {len(w) for w in windows}
    for d in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect():
        ws, hit, named = words(d.text), set(), set()
        for n in lengths:
            for j in range(len(ws) - n + 1):
                if found := windows.get(tuple(ws[j : j + n])):
                    hit.update(range(j, j + n))
                    named |= found
        r = rows[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (len(ws), len(hit), len(named))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(ws))


def test_plan_holds_one_slice(spark, monkeypatch):
    """However many slices the benchmark has, the plan carries the phrases of the first only."""
    items, texts = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    whole = sorted(map(str, dc.find(docs, benchmark, keep=["doc_id"]).collect()))
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(dc, "SLICE_WORDS", -(-size // 30))
    found = dc.find(docs, benchmark, keep=["doc_id"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(str, found.collect())) == whole
