"""Pattern grammar: composition against running the machines in turn, clauses, learning, held-out accuracy, edges."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, toxicity
from tillroll.llm.toxicity import CARRIED, DIRECTED, END, INSULT, NEGATED, OTHER, POINTED, QUOTE, REPORTED, SYMBOLS

LEXICON = toxicity.Lexicon(toxicity.learned_arcs([], 0, 0, 0))


def run(machine, symbols):
    state, out = 0, []
    for s in symbols:
        state, w = machine.step(state, s)
        out.append(w)
    return out


def test_composition_is_running_in_turn():
    rng = random.Random(2)
    parts = [toxicity.negation(), toxicity.reported(), toxicity.threat(), toxicity.target()]
    for _ in range(400):
        symbols = [rng.choice([*range(8), END, OTHER, OTHER]) for _ in range(40)]
        expected = symbols
        for p in parts:
            expected = run(p, expected)
        state, got = 0, []
        for s in symbols:
            state, w = toxicity.GRAMMAR[state][s]
            got.append(w)
        assert got == expected


def written(text):
    words = toxicity.tokens(text)
    state, out = 0, []
    for s in bytes(map(LEXICON.__getitem__, words)):
        state, w = toxicity.GRAMMAR[state][s]
        out.append(w)
    return words, out


@pytest.mark.parametrize(
    "text,word,symbol",
    [
        ("this is trash", "trash", INSULT),
        ("You are an idiot.", "idiot", DIRECTED),
        ("that idiot, you know", "you", POINTED),
        ("you are not an idiot", "idiot", NEGATED),
        ("it is not so, idiot", "idiot", INSULT),
        ("not one of the six words: idiot", "idiot", INSULT),
        ("she said he is an idiot", "idiot", REPORTED),
        ("they said so. What an idiot", "idiot", INSULT),
        ('the word "idiot" stands here', "idiot", REPORTED),
        ('the word "fool" is old, idiot', "idiot", INSULT),
        ("I will kill you", "you", CARRIED),
        ("I will not kill you", "you", toxicity.TARGET),
        ("he said I will kill you", "you", toxicity.TARGET),
        ("kill the old lights now and here for you", "you", toxicity.TARGET),
        ("Du bist ein Trottel", "trottel", DIRECTED),
    ],
)
def test_clauses(text, word, symbol):
    words, out = written(text)
    assert out[words.index(word)] == symbol


def test_clause_weights():
    words = toxicity.tokens('What trash. Nothing here. You idiot, I will kill you! "scum" is a word')
    clauses = toxicity.clause_weights(words, LEXICON)
    assert [words[b] for b, _, _ in clauses] == ["what", "you", '"']
    assert np.allclose([w for _, _, w in clauses], [toxicity.SEED, 1.25 * toxicity.SEED + 4.0, 0.3 * toxicity.SEED])
    assert toxicity.clause_weights(toxicity.tokens("nothing at all"), LEXICON) == []
    assert all(len(row) == SYMBOLS for row in toxicity.GRAMMAR) and QUOTE in range(SYMBOLS)


def corpus(spark, n=400):
    """Toxic texts hold one whole word or words of one stem; other texts hold neither."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        w = [f"word{rng.randrange(60)}" for _ in range(40)]
        y = i % 4 == 0
        if y:
            w[rng.randrange(40)] = "zork" if i % 8 else f"grimbl{rng.choice('abcdefghijklmnop')}{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
        labels.append((i, int(y)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_stems(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels.filter("doc_id < 300"))
    assert "zork$" in model.arcs and any("grimbl".startswith(a[:6]) for a in model.arcs)
    fresh = spark.createDataFrame([(1, "a b zork c"), (2, "so grimblqx is it"), (3, "word1 word2 word3"), (4, "grim zor")], "i int, text string")
    rows = {r.i: r.predicted for r in toxicity.with_toxicity(fresh, model).collect()}
    assert rows == {1: 1, 2: 1, 3: 0, 4: 0}
    rows = toxicity.with_toxicity(docs, model).join(labels, "doc_id").filter("doc_id >= 300").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)


def test_edges(spark):
    docs, labels = corpus(spark, 120)
    odd = [(1000, None), (1001, ""), (1002, " \n "), (None, "zork"), (1003, "zork " * 100_000), (1004, "İ zork. ok"), (1005, "x" * 300_000)]
    both = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    both = both.unionByName(both.filter("doc_id = 4")).withColumn("score", F.lit("clash")).withColumn("clauses", F.lit(1))
    extra = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (6, 1), (99999, 1)], "doc_id long, toxic int")).unionByName(labels)
    model = toxicity.fit(both, extra)
    rows = toxicity.with_toxicity(both, model).collect()
    assert len(rows) == 128 and all(0 <= r.score <= 1 for r in rows)
    none = [r.score for r in rows if r.doc_id in (1000, 1001, 1002)]
    assert len(set(none)) == 1 and none[0] < 0.3
    by = {r.doc_id: r for r in rows}
    assert by[1003].predicted == by[1004].predicted == 1
    (span,) = by[1004].clauses
    assert (span.start, span.end) == (0, 6)
    assert toxicity.with_toxicity(both.limit(0), model).collect() == []


@pytest.mark.parametrize("labels,expected", [([], 0), ([0, 0], 0), ([1, 1], 1)])
def test_one_label_or_none(spark, labels, expected):
    docs = spark.createDataFrame([(i, "a b idiot") for i in range(2)], "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.with_toxicity(docs, toxicity.fit(docs, known)).collect()} == {expected}


def test_significance_against_scipy_free_formula():
    """Against the direct sum over the four cells of the table."""
    a, b, n1, n0 = 17, 9, 60, 500
    cells = [(a, n1 * (a + b) / (n1 + n0)), (n1 - a, n1 - n1 * (a + b) / (n1 + n0)), (b, n0 * (a + b) / (n1 + n0)), (n0 - b, n0 - n0 * (a + b) / (n1 + n0))]
    direct = 2 * sum(o * np.log(o / e) for o, e in cells)
    assert abs(toxicity.significance(np.array([a]), np.array([b]), n1, n0)[0] - direct) < 1e-9


def test_held_out_accuracy(spark):
    """Labels of crc32 mod 4 = 2 are never read; nearly all toxic documents are caught and clean ones left alone."""
    sf = "/root/testdata/sf0.1"
    rows = queries.op12_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    caught = [r.predicted for r in held if r.toxic == 1]
    alone = [1 - r.predicted for r in held if r.toxic == 0]
    assert np.mean(caught) >= 0.9 and np.mean(alone) >= 0.99
