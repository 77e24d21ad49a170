"""Language identification: held-out accuracy, spans, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.llm import language_id as li
from tillroll.llm import queries

EN = "the and of that with from this have which their would there about could other into more some time people"
DE = "der die und das nicht mit sich auf für ist dem eine als auch wenn noch nach nur oder aber vor durch"
RU = "и в не на что он как это по но из у за так же от бы для только его было мне еще нет"


def model(spark):
    rows = [(i, " ".join(EN.split()[i % 7 :] * 3), "en") for i in range(30)]
    rows += [(100 + i, " ".join(DE.split()[i % 7 :] * 3), "de") for i in range(30)]
    rows += [(200 + i, " ".join(RU.split()[i % 5 :] * 3), "ru") for i in range(10)]
    rows += [(300, None, "en"), (301, "xyz", None), (302, "", "en")]
    return li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def labelled(spark, texts, m):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("clash"))
    return sorted(li.with_language(docs, m).collect(), key=lambda r: r.doc_id)


def test_edges_and_spans(spark):
    m = model(spark)
    assert m.languages == ["de", "en", "ru"]
    mixed = EN + ". " + DE
    texts = [None, "", "123 !?", EN, DE, RU, mixed, "漢字", "a" * 50_000, EN + " " + RU + "\U0001d400"]
    rows = labelled(spark, texts, m)
    assert [(r.lang_pred, r.score) for r in rows[:3]] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in rows[3:6]] == ["en", "de", "ru"]
    assert all(r.score == 1.0 for r in rows[3:6])
    spans = rows[6].lang_spans
    assert [s.lang for s in spans] == ["en", "de"]
    assert mixed[spans[0].start : spans[0].end] == EN and mixed[spans[1].start : spans[1].end] == DE
    assert rows[7].lang_pred in m.languages  # no learned language has the script: all alike, the first wins
    assert [s.lang for s in rows[9].lang_spans][:2] == ["en", "ru"]
    assert all(0 <= r.score <= 1 for r in rows)


def words_of(text):
    begin, end, _, at, _, script = li.Letters().read([text])
    return [text[a : a + e - b] for a, b, e in zip(at, begin, end)], [li.SCRIPTS[s] for s in script]


def test_marks_belong_to_words_and_scripts_part_them():
    assert words_of("हिन्दी में लिखा")[0] == ["हिन्दी", "में", "लिखा"]
    assert words_of("cafe\u0301 na\u0308iv")[0] == ["cafe\u0301", "na\u0308iv"]
    assert words_of("می\u200cخواهم")[0] == ["می\u200cخواهم"]
    assert words_of("helloпривет, abcδε") == (["hello", "привет", "abc", "δε"], ["Latin", "Cyrillic", "Latin", "Greek"])
    assert words_of("食べる日本")[0] == ["食べる日本"] and words_of("日本한국")[0] == ["日本", "한국"]
    assert words_of("\u0301 1\u0301 -\u200d")[0] == [] and words_of("") == ([], [])
    assert words_of("а\u0301b")[0] == ["а\u0301", "b"]
    begin, end, owner, at, bucket, _ = li.Letters().read(["ab cд", None, "é"])
    assert owner.tolist() == [0, 0, 0, 2] and at.tolist() == [0, 3, 4, 0] and (end - begin).sum() == len(bucket) == 5


def test_no_rows_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    m = li.train(none)
    assert m.languages == []
    assert [r.lang_pred for r in labelled(spark, ["text", None], m)] == ["und", "und"]
    assert li.with_language(none, model(spark)).collect() == []


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(1)
    size = np.array([4, 1, 6])
    score = rng.normal(size=(11, 3)).astype(np.float32)
    got = li.viterbi(score, size, 1.5)
    for begin, n in zip([0, 4, 5], size):
        def worth(labels, begin=begin):
            return sum(score[begin + i, l] for i, l in enumerate(labels)) - 1.5 * sum(a != b for a, b in zip(labels, labels[1:]))

        best = max(np.ndindex(*[3] * n), key=worth)
        assert abs(worth(tuple(got[begin : begin + n])) - worth(best)) < 1e-4


def test_held_out_accuracy(spark):
    rows = queries.op1_language(spark, SMOKE_DIR)
    truth = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "lang")
    got = rows.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 30 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert rows.count() == truth.count()


def test_lang_and_source_are_no_inputs(spark):
    docs = spark.createDataFrame([(1, EN, "de", "x"), (2, EN, None, None)], "doc_id long, text string, lang string, source string")
    assert {r.lang_pred for r in li.with_language(docs, model(spark)).collect()} == {"en"}
