"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text becomes a set of hashed features: its words, the beginnings of its
words, and the forms of its words and lines (case, attached symbols,
repetition). One weight per bucket is shared by all grades; ordered thresholds
turn the score s into P(grade <= k) = logistic(threshold_k - s). From these
come the expected grade and the tail probability P(grade >= keep_from) by
which documents are selected.

The model is fitted on the driver from a bounded sample: ``per_grade`` rated
documents of each grade, those whose keys hash lowest, each with one of its texts (the one
with the smallest hash). Every bucket of the sample gets a
weight, however rare it is: the penalty on a weight falls with the chi-square
of its bucket against the grade, and its strength is chosen by cross-validation
on the sample. Scoring covers every document, text as a whole, with the model
broadcast (``BUCKETS`` weights).

Defined cases: null and empty texts have the feature "empty" only; ratings
without a grade are left out, and of several ratings of a document the lowest
counts; without any rating, or with one grade only, every document gets that
grade (the top grade if there is none) and is kept accordingly; repeated rows
score alike; other columns pass through and clashing output names are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import release_memory, words

BUCKETS = 1 << 18
PER_GRADE = 2000
#: Penalties that cross-validation chooses from, and its folds.
DECAYS, FOLDS = (0.1, 0.03, 0.01, 0.003, 0.001), 3
MEMO = 200_000


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) % BUCKETS


def word_buckets(word: bytes) -> tuple[int, ...]:
    """The word itself and its beginnings of three to six bytes."""
    return (bucket(b"w" + word), *(bucket(b"p" + word[:n]) for n in (3, 4, 5, 6) if len(word) > n))


def share(part: float, whole: float) -> int:
    """A share in twelfths, so that forms become a few features."""
    return round(12 * part / whole) if whole else 0


def form_features(text: str) -> Iterator[str]:
    """What the text looks like, whatever its words are."""
    chunks = text.split()
    if not chunks:
        yield "empty"
        return
    n = len(chunks)
    letters = sum(map(str.isalpha, text))
    lines = [x for x in text.split("\n") if x.strip()]
    yield f"length {n.bit_length()}"
    yield f"upper {share(sum(map(str.isupper, text)), letters)}"
    yield f"letters {share(letters, len(text))}"
    yield f"symbols {share(sum(not c[-1].isalnum() and c[-1] not in '.,' for c in chunks), n)}"
    yield f"bare {share(sum(not any(map(str.isalnum, c)) for c in chunks), n)}"
    yield f"repeated lines {share(len(lines) - len(set(lines)), len(lines))}"
    yield f"commonest {share(Counter(chunks).most_common(1)[0][1], n) if n > 9 else 0}"
    yield f"stutter {share(sum(a == b for a, b in zip(chunks, chunks[1:])), n)}"
    yield f"distinct {share(len(set(chunks)), n) if n > 9 else 12}"
    yield f"line length {(n // max(1, len(lines))).bit_length()}"


class Features:
    """Features of texts, with the buckets of the words seen last remembered."""

    def __init__(self):
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, found = self.memo, set()
        for w in set(words(text)):
            known = memo.get(w)
            if known is None:
                known = memo[w] = word_buckets(w)
            found.update(known)
        found.update(bucket(f.encode()) for f in form_features(text or ""))
        return np.fromiter(found, np.int32, len(found))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; grades are 0 to len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return 1 - logistic(self.thresholds[None, :] - np.asarray(score)[:, None])


def prior_scale(rows: list[np.ndarray], grades: np.ndarray, levels: int) -> np.ndarray:
    """How far a bucket's weight may go, from 0 to 5: the more its presence depends on the grade (chi-square), the further.

    It scales the prior of the weight and cuts nothing: every bucket that a row holds gets a weight.
    """
    total = np.bincount(grades, minlength=levels).astype(float)
    held = np.stack([np.bincount(np.concatenate([np.empty(0, np.int32), *(r for r, y in zip(rows, grades) if y == k)]), minlength=BUCKETS) for k in range(levels)])
    share_in = held.sum(axis=0) / total.sum()
    expected = share_in[None, :] * total[:, None]
    spread = np.maximum(expected * (1 - share_in[None, :]), 1e-9)
    chi = ((held - expected) ** 2 / spread).sum(axis=0)
    return 5 * np.maximum(chi**2, 1) / (np.maximum(chi**2, 1) + 900)


class Fit:
    """Penalised likelihood of rows: weights are the scale of their bucket times a value with the penalty decay / 2 * value^2."""

    def __init__(self, rows: list[np.ndarray], grades: np.ndarray, levels: int):
        self.grades, self.levels = grades, levels
        size = np.array([len(r) for r in rows])
        self.buckets, self.idx = np.unique(np.concatenate(rows), return_inverse=True)
        self.start, self.of = np.cumsum(size) - size, np.repeat(np.arange(len(rows)), size)
        self.scale = prior_scale(rows, grades, levels)[self.buckets]
        # Values of the buckets, the first threshold, and the logarithms of the steps between thresholds.
        self.at = np.concatenate([np.zeros(len(self.buckets)), [-1.0], np.zeros(levels - 2)])

    def thresholds(self, x: np.ndarray) -> np.ndarray:
        n = len(self.buckets)
        return x[n] + np.concatenate([[0], np.cumsum(np.exp(np.clip(x[n + 1 :], -40, 40)))])

    def loss(self, x: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
        """The penalised loss and its gradient."""
        n, y, levels = len(self.buckets), self.grades, self.levels
        score = np.add.reduceat((x[:n] * self.scale)[self.idx], self.start)
        bounds = np.concatenate([[-np.inf], self.thresholds(x), [np.inf]])
        above, below = logistic(bounds[y + 1] - score), logistic(bounds[y] - score)
        above[y == levels - 1], below[y == 0] = 1.0, 0.0
        p = np.maximum(above - below, 1e-12)
        slope = 1 - above - below  # of the loss, along the score
        g = np.bincount(self.idx, slope[self.of], n) * self.scale / len(y) + decay * x[:n]
        t = np.bincount(y, below * (1 - below) / p, levels)[1:] - np.bincount(y, above * (1 - above) / p, levels)[:-1]
        t = np.cumsum(t[::-1])[::-1] / len(y)
        t[1:] *= np.exp(np.clip(x[n + 1 :], -40, 40))
        return float(-np.log(p).mean() + decay / 2 * x[:n] @ x[:n]), np.concatenate([g, t])

    def run(self, decay: float, epochs: int) -> OrdinalModel:
        """Minimum of the loss by L-BFGS, from where the last run ended."""
        x, moves = self.at, []
        f, g = self.loss(x, decay)
        for _ in range(epochs):
            d, along = -g, []
            for s, c in reversed(moves):
                along.append((s @ d) / (s @ c))
                d = d - along[-1] * c
            d = d * ((moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1, np.linalg.norm(g)))
            for (s, c), a in zip(moves, reversed(along)):
                d = d + (a - (c @ d) / (s @ c)) * s
            step, down = 1.0, g @ d
            while (new := self.loss(x + step * d, decay))[0] > f + 1e-4 * step * down and step > 1e-6:
                step /= 2
            if new[0] >= f:
                break
            s, c = step * d, new[1] - g
            if s @ c > 1e-12:
                moves = [*moves[-9:], (s, c)]
            done = f - new[0] < 1e-5 * max(1, abs(f))
            x, f, g = x + s, *new
            if done:
                break
        self.at = x
        weights = np.zeros(BUCKETS, np.float32)
        weights[self.buckets] = x[: len(self.buckets)] * self.scale
        return OrdinalModel(weights, self.thresholds(x))


def held_out_loss(model: OrdinalModel, rows: list[np.ndarray], grades: np.ndarray) -> float:
    """Sum of the negative log-likelihood."""
    tails = model.tails(np.array([float(model.weights[r].sum(dtype=np.float64)) for r in rows]))
    tails = np.column_stack([np.ones(len(rows)), tails, np.zeros(len(rows))])
    at = np.arange(len(rows))
    return float(-np.log(np.maximum(tails[at, grades] - tails[at, grades + 1], 1e-9)).sum())


def chosen_decay(rows: list[np.ndarray], grades: np.ndarray, levels: int, epochs: int) -> float:
    """The decay with the least loss on rows left out in turn; each grade is dealt evenly to the folds."""
    lost = np.zeros(len(DECAYS))
    folds = min(FOLDS, len(rows))
    of = np.empty(len(rows), np.int64)
    of[np.lexsort((np.random.default_rng(7).permutation(len(rows)), grades))] = np.arange(len(rows)) % folds
    for fold in range(folds):
        use = of != fold
        some = Fit([r for r, u in zip(rows, use) if u], grades[use], levels)
        rest = [r for r, u in zip(rows, use) if not u]
        lost += [held_out_loss(some.run(decay, epochs), rest, grades[~use]) for decay in DECAYS]
    return DECAYS[int(lost.argmin())]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, levels: int, epochs: int = 60, decay: float | None = None) -> OrdinalModel:
    """Penalised maximum likelihood over all buckets of the rows; without ``decay`` it is chosen by cross-validation."""
    if decay is None:
        decay = chosen_decay(rows, grades, levels, epochs)
    return Fit(rows, grades, levels).run(decay, epochs)


def rated_sample(ratings: DataFrame, key: str, grade: str, per_grade: int) -> DataFrame:
    """At most ``per_grade`` rated keys of each grade, always the same ones."""
    rated = ratings.filter(F.col(key).isNotNull() & F.col(grade).isNotNull())
    rated = rated.groupBy(F.col(key).alias("_key")).agg(F.min(grade).cast("int").alias("_grade"))
    levels = [r[0] for r in rated.select("_grade").distinct().orderBy("_grade").limit(100).collect()]
    out = rated.limit(0)
    for level in levels:
        out = out.unionByName(rated.filter(F.col("_grade") == level).orderBy(F.xxhash64("_key"), "_key").limit(per_grade))
    return out


def fit(docs: DataFrame, ratings: DataFrame, levels: int, key: str = "doc_id", text: str = "text", grade: str = "grade", per_grade: int = PER_GRADE) -> OrdinalModel:
    """Fit on a bounded sample of ``ratings`` (key, grade 0 to levels - 1) of ``docs``."""
    sample = rated_sample(ratings, key, grade, per_grade)  # at most levels x per_grade rows of two numbers

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            sets = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["grade", "features"])

    rated = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), "_key")
        # One document of each key, however many rows have it.
        .groupBy("_key", "_grade").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("first"))
        .select("_grade", "first._text").mapInArrow(featured, "grade int, features binary").collect()
    )
    rated.sort(key=lambda r: (r["grade"], bytes(r["features"])))
    found = {r["grade"] for r in rated}
    if len(found) < 2:
        only = found.pop() if found else levels - 1
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.where(np.arange(levels - 1) < only, -50.0, 50.0))
    return fit_ordinal([np.frombuffer(r["features"], np.int32) for r in rated], np.array([r["grade"] for r in rated]), levels)


def tail_probabilities(text: Column, model: OrdinalModel) -> Column:
    """Array of P(grade >= 1), P(grade >= 2), ... of a text."""

    @F.pandas_udf("array<double>")
    def tails(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            score = np.array([float(model.weights[features(t)].sum(dtype=np.float64)) for t in texts])
            yield pd.Series(list(model.tails(score)))
            release_memory()
        del features
        release_memory()

    return tails(text)


def with_quality(
    docs: DataFrame, model: OrdinalModel, text: str = "text", keep_from: int | None = None, least: float = 0.3,
    expected: str = "expected_grade", tail: str = "tail_probability", keep: str = "keep",
) -> DataFrame:
    """``docs`` with the expected grade, P(grade >= keep_from) and whether that is at least ``least``."""
    top = len(model.thresholds) if keep_from is None else keep_from
    scored = docs.withColumn("_tails", tail_probabilities(F.col(text), model))
    return (
        scored.withColumn(expected, F.aggregate("_tails", F.lit(0.0), lambda a, x: a + x))
        .withColumn(tail, F.element_at("_tails", top))
        .withColumn(keep, F.col(tail) >= least)
        .drop("_tails")
    )


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grade 0 for toxic, 1 for low quality, 2 for good texts; null if neither is known to be bad and one is unknown."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)
