"""SON phrase mining against brute force: small vocabularies, shards, ties, edges."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import collocations


def brute(rows, longest=3, least=10, top=2000, percent=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {(lang, g): a for (lang, g), a in f.items() if len(g) > 1 and a >= least}
    out = []
    for lang in n:
        rows = []
        for (x, g), a in candidates.items():
            if x != lang:
                continue
            inside = [b for (y, h), b in candidates.items() if y == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if any(100 * b >= percent * a for b in inside):
                continue
            cuts = [(1_000_000 * a * a // (f[x, g[:k]] * f[x, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(g).encode(), f[x, g[:k]], f[x, g[k:]]))
        for i, (s, a, g, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(df, **options):
    return sorted(map(tuple, collocations.collocations(df, **options).collect()))


def texts(seed, n, alphabet, marks=" "):
    rng = random.Random(seed)
    return [("".join(rng.choice(alphabet) + rng.choice(marks) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None])) for _ in range(n)]


@pytest.mark.parametrize("seed,alphabet,marks", [(1, "ab", " "), (2, ["A", "a", "é", "É", "x-1"], [" ", "  ", "\t", ". ", "\n", ",", " "]), (3, "abcdefgh", [" ", " ", " ", "!"])])
def test_against_brute_force(spark, seed, alphabet, marks):
    rows = texts(seed, 60, alphabet, marks)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert mined(df) == brute(rows)
    if seed == 3:
        assert mined(df, top=3, least=4, inside_percent=70, shards=2) == brute(rows, top=3, least=4, percent=70)


def test_longer_phrases(spark):
    rows = texts(5, 50, "abc", [" ", " ", " ", ";"])
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert mined(df, longest=4, least=5) == brute(rows, longest=4, least=5)


def test_one_shard_holds_all_of_a_language(spark):
    rows = [("p q r p q", "xx")] * 20 + [("p q", "yy")] * 9
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    found = mined(df)
    assert found == brute(rows) and {r[0] for r in found} == {"xx"}


def test_edges(spark):
    rows = [(None, "en"), ("", "en"), ("...", None), ("one", "en"), ("a b " * 50_000, "en"), ("a b " * 12, None), ("a b " * 12, "und")] + [("Ä b. ä B, \x00 \x00", "de")] * 11
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("shard", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("phrase", F.lit(1))
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []


def test_a_crowded_bitmap_changes_nothing(spark, monkeypatch):
    """With hardly any bits, and names, phrases share them; counts stay."""
    rows = texts(9, 40, "abcdef")
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    monkeypatch.setattr(collocations, "BITS", 1 << 15)
    monkeypatch.setattr(collocations, "names_of", lambda lang, words: (words[0] % 3).astype("int64"))
    assert mined(df, least=5) == brute(rows, least=5)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_017
    phrases = spark.createDataFrame([("x", 1, "a", big), ("x", 1, "b", big + 5), ("x", 2, "a b", big - 8)], "lang string, size int, phrase string, f long")
    (row,) = collocations.scored(phrases).collect()
    assert (row.a, row.l, row.r, row.score) == (big - 8, big, big + 5, 1_000_000 * (big - 8) ** 2 // (big * (big + 5)))


def test_mining_moves_blocks_of_names(spark):
    """A slice leaves one row a block and support, not one a phrase; a block's bits are those of its frequent phrases."""
    rng = random.Random(4)
    some = [(" ".join(f"w{rng.randrange(40)}" for _ in range(30)), rng.choice(["en", "de"]), i % 2, 2 + i % 2) for i in range(400)]
    docs = spark.createDataFrame(some, "text string, lang string, shard int, need long").coalesce(1)
    every = spark.sparkContext.broadcast(np.full(collocations.BITS // 8, 255, np.uint8))
    counts = collocations.shard_counts(docs, 2, {1: every})
    f, need = Counter(), {0: 2, 1: 3}
    for text, lang, shard, _ in some:
        w = text.split()
        f.update((shard, lang, *w[i : i + 2]) for i in range(len(w) - 1))
    rows = counts.collect()
    blocks = collocations.BITS // collocations.BLOCK
    assert len(rows) == len({(r.block, r.shard, r.need) for r in rows}) and max(r.block for r in rows) < blocks
    times = np.concatenate([np.frombuffer(bytes(r.times), np.int32) for r in rows])
    assert len(times) == len(f) and times.sum() == sum(f.values())
    keep = {p[1:] for p, n in f.items() if n >= need[p[0]]}
    words = [collocations.hashed(list(x)) for x in zip(*sorted(keep))]
    names = collocations.names_of(words[0], words[1:])
    bits = collocations.put_together(collocations.locally_frequent(counts))
    assert collocations.held(bits, names).all() and np.unpackbits(bits).sum() == len(set(names.view(np.uint64) >> np.uint64(37)))


def test_shuffled_rows_of_mining_do_not_grow_with_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 1 << 17)
    docs = spark.createDataFrame([(" ".join(f"{i}x{j}" for j in range(500)), "en", 0, 1) for i in range(40)], "text string, lang string, shard int, need long").coalesce(1)
    every = spark.sparkContext.broadcast(np.full(1 << 14, 255, np.uint8))
    assert collocations.shard_counts(docs, 2, {1: every}).count() == 4  # 19,960 phrases in four blocks


def test_hashes_of_words(spark):
    words = ["", "a", "\0", "a\0", "\0a", "é", "12345678", "123456789", "12345678\0", "x" * 255, "x" * 256, "x" * 257, "x" * 5_000]
    assert len(set(collocations.hashed(words).tolist())) == len(words) and not len(collocations.hashed([]))
    data, begin, end, opens, owner = collocations.found_words([" ".join(words[1:]), None, "A, b"], np.array([5, 6, 7]))
    assert collocations.hashes_in(data, begin, end).tolist() == collocations.hashed([*words[1:], "a", "b"]).tolist()
    assert opens.tolist() == [True, *[False] * 11, True, True] and owner.tolist() == [5] * 12 + [7, 7]


def test_supports_of_shards(spark):
    words = spark.createDataFrame([("en", 0, 7), ("en", 1, 93), ("de", 1, 3), ("fr", 0, 0)], "lang string, shard int, n long")
    docs = spark.createDataFrame([("en", 0), ("en", 1), ("de", 1), ("fr", 0)], "lang string, shard int")
    found = {(r.lang, r.shard): r.need for r in collocations.with_need(docs, words, 10).collect()}
    assert found == {("en", 0): 1, ("en", 1): 10, ("de", 1): 10, ("fr", 0): 1}


def test_shard_sizes_beyond_a_broadcast(spark, monkeypatch):
    rows = texts(11, 60, "abc")
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    monkeypatch.setattr(collocations, "SIZES", 0)
    assert mined(df) == brute(rows)
