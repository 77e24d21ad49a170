"""Ordinal quality classifier: probabilities, separation, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import quality, queries


def corpus(spark, n=240):
    rows, ratings = [], []
    for i in range(n):
        base = [f"word{(i * 7 + j * 3) % 50}" for j in range(30)]
        grade = i % 3
        if grade == 0:
            base[i % 25] = "nasty" if i % 2 else "vile"
        text = " ".join(base) if grade else " ".join(base)
        if grade == 1:
            text = " ".join(w.upper() + "!!" for w in base)
        rows.append((i, text))
        ratings.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(ratings, "doc_id long, grade int")


def test_separates_grades(spark):
    docs, ratings = corpus(spark)
    model = quality.fit(docs, ratings.filter("doc_id < 150"), levels=3)
    assert np.all(np.diff(model.thresholds) >= 0)
    rows = quality.with_quality(docs, model, least=0.5).join(ratings, "doc_id").filter("doc_id >= 150").collect()
    assert sum(r.keep == (r.grade == 2) for r in rows) >= 0.95 * len(rows)
    means = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    assert means[2] > means[1] and means[2] > means[0]
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_edges(spark):
    docs, ratings = corpus(spark, 60)
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "   \n"), (None, "word1 word2"), (1003, "x " * 200_000)], "doc_id long, text string")
    both = docs.unionByName(odd).unionByName(odd).withColumn("keep", F.lit("clash"))
    extra = ratings.unionByName(spark.createDataFrame([(None, 1), (5, None), (99999, 2)], "doc_id long, grade int")).unionByName(ratings)
    model = quality.fit(both, extra, levels=3)
    rows = quality.with_quality(both, model).collect()
    assert len(rows) == 70
    for i in (1000, 1001):
        assert len({r.tail_probability for r in rows if r.doc_id == i}) == 1
    assert quality.with_quality(both.limit(0), model).collect() == []


@pytest.mark.parametrize("grades", [[], [2, 2], [0, 0]])
def test_one_grade_or_none(spark, grades):
    docs = spark.createDataFrame([(i, "a b") for i in range(2)], "doc_id long, text string")
    ratings = spark.createDataFrame(list(enumerate(grades)), "doc_id long, grade int")
    rows = quality.with_quality(docs, quality.fit(docs, ratings, levels=3)).collect()
    assert all(r.keep == (not grades or grades[0] == 2) for r in rows)


def test_grade_of(spark):
    rows = [(1, 1), (0, 0), (1, 0), (None, 1), (0, None), (1, None), (None, None)]
    df = spark.createDataFrame(rows, "q int, t int").select(quality.grade_of(F.col("q"), F.col("t")).alias("g"))
    assert [r.g for r in df.collect()] == [0, 1, 2, 0, 1, None, None]


def test_gradient_against_differences():
    """The fitted model is near a maximum of the likelihood on separable-free data."""
    rng = np.random.default_rng(0)
    rows = [np.array(sorted(set(rng.integers(0, 4, 3).tolist())), np.int32) for _ in range(400)]
    grades = np.array([min(2, max(0, int(3 * rng.random() + (0 in r) - (1 in r)))) for r in rows])
    model = quality.fit_ordinal(rows, grades, 3, epochs=30, decay=0.0)

    def loss(w, t):
        s = np.array([w[r].sum() for r in rows])
        upper = np.where(grades < 2, quality.logistic(np.append(t, np.inf)[grades] - s), 1)
        lower = np.where(grades > 0, quality.logistic(np.append(-np.inf, t)[grades] - s), 0)
        return -np.log(np.maximum(upper - lower, 1e-12)).mean()

    base = loss(model.weights.astype(float), model.thresholds)
    for j in range(4):
        for step in (-0.3, 0.3):
            w = model.weights.astype(float)
            w[j] += step * (w[j] != 0)
            assert loss(w, model.thresholds) >= base - 0.003


def test_rare_buckets_get_weights():
    """A word of four toxic documents only counts, whatever its chi-square at these numbers of labels."""
    rng = np.random.default_rng(4)
    grades = np.repeat([0, 1, 2], [51, 49, 299])
    fresh = lambda y, i: np.array(sorted({*rng.integers(100, 160, 20).tolist(), *([10 + i % 12] if y == 0 else [50] if y == 1 else [])}), np.int32)
    rows = [fresh(y, i) for i, y in enumerate(grades)]
    model = quality.fit_ordinal(rows, grades, 3)
    assert (model.weights[np.unique(np.concatenate(rows))] != 0).all()
    assert (model.weights[10:22] < 2 * model.weights[100:160].min()).all()
    unseen = [fresh(y, i) for i, y in enumerate(grades)]
    kept = model.tails(np.array([model.weights[r].sum() for r in unseen]))[:, 1] >= 0.5
    assert (kept == (grades == 2)).mean() >= 0.98


def test_gradient_of_the_penalised_loss():
    rng = np.random.default_rng(5)
    rows = [np.array(sorted(set(rng.integers(0, 9, 4).tolist())), np.int32) for _ in range(60)]
    some = quality.Fit(rows, rng.integers(0, 3, 60), 3)
    x = rng.normal(size=len(some.at))
    slope = some.loss(x, 0.1)[1]
    for j, step in enumerate(np.eye(len(x)) * 1e-5):
        assert abs((some.loss(x + step, 0.1)[0] - some.loss(x - step, 0.1)[0]) / 2e-5 - slope[j]) < 1e-6


def test_fit_against_plain_gradient_descent():
    """The model that L-BFGS finds is the minimum that plain descent on numeric slopes finds."""
    rng = np.random.default_rng(11)
    rows = [np.array(sorted(set(rng.integers(0, 5, 3).tolist())), np.int32) for _ in range(150)]
    grades = np.array([min(2, max(0, int(3 * rng.random() + (0 in r) - (1 in r)))) for r in rows])
    decay = 0.02
    some = quality.Fit(rows, grades, 3)
    scale = dict(zip(some.buckets.tolist(), some.scale))

    def loss(x):
        """Written out from the definition, row by row."""
        t = [x[5], x[5] + np.exp(x[6])]
        total = 0.0
        for r, y in zip(rows, grades):
            s = sum(x[j] * scale[j] for j in r)
            upper = 1.0 if y == 2 else 1 / (1 + np.exp(s - t[y]))
            lower = 0.0 if y == 0 else 1 / (1 + np.exp(s - t[y - 1]))
            total -= np.log(upper - lower)
        return total / len(rows) + decay / 2 * sum(v * v for v in x[:5])

    x = np.array([0.0] * 5 + [-1.0, 0.0])
    for _ in range(250):
        slope = np.array([(loss(x + e) - loss(x - e)) / 2e-5 for e in np.eye(7) * 1e-5])
        x = x - 0.8 * slope / np.maximum(1, np.abs(slope).max()) * np.array([0.2] * 5 + [1, 1])
    model = some.run(decay, 200)
    mine = np.concatenate([model.weights[:5] / np.array([scale[j] for j in range(5)]), [model.thresholds[0], np.log(model.thresholds[1] - model.thresholds[0])]])
    assert loss(mine) <= loss(x) + 1e-4
    assert np.allclose(mine, x, atol=0.15)


def test_query_against_the_labels(spark):
    """Over a whole table: every document once, probabilities in order, labelled ones mostly told apart."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_quality(spark, sf).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    assert sorted(got) == sorted(docs)
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 and r.keep == (r.tail_probability >= 0.3) for r in got.values())
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r.doc_id].keep for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [got[r.doc_id].keep for r in labels if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.3


def test_a_repeated_key_counts_once(spark, monkeypatch):
    docs, ratings = corpus(spark, 60)
    many = docs.unionByName(docs.filter("doc_id = 4").crossJoin(spark.range(500)).select("doc_id", "text"))
    many = many.unionByName(spark.range(300).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("other text "), "id").alias("text")))
    sizes, plain = [], quality.fit_ordinal
    monkeypatch.setattr(quality, "fit_ordinal", lambda rows, grades, levels: (sizes.append(np.bincount(grades).tolist()), plain(rows, grades, levels))[1])
    quality.fit(many, ratings, levels=3)
    assert sizes == [[20, 20, 20]]
