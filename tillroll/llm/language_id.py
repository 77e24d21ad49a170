"""Language identification of mixed-language text.

A word's script (by code point ranges) leaves the languages that use it as
candidates. Each candidate scores the word by letter trigrams; Viterbi over a
document's words, with a penalty for every switch, labels spans. The document's
language is the one with the most letters, its score that share.

The model holds trigram counts in ``BUCKETS`` hashed buckets per language,
summed by Spark over a bounded sample: about ``per_language`` documents of each
language, chosen by key hash. Labelling covers every document as a whole.

A word is a run of letters of one script with the marks on them (vowel signs,
accents, joiners); Han and Kana, and scripts without a name here, do not part.

Defined cases: a null text, or one without a letter, is "und" with score 0;
words in a script of no learned language score alike for all languages; ties
go to the language that sorts first; null keys and repeated rows are
labelled each; with no rows to learn from everything is "und"; other
columns pass through and clashing output names are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_slices

BUCKETS = 1 << 16
PER_LANGUAGE = 3000
#: Cost of a switch, in nats.
SWITCH = 12.0
#: A language uses a script if so much of its letters are in it.
USES = 0.02
UND = "und"
#: Characters scored at a time, and scores held for one Viterbi run.
CHARS, SCORES = 1_000_000, 5_000_000

# First code points of the ranges of scripts, in order.
SCRIPT_RANGES = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0750, "Arabic"), (0x0780, "other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "other"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"),
    (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "other"),
    (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "other"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF21, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x20000, "Han"), (0x32000, "other"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})


class Letters:
    """Letter trigrams and words of texts as arrays."""

    def __init__(self):
        plane = [chr(c) for c in range(0x10000)]
        self.is_letter = np.array([c.isalpha() for c in plane])
        self.is_mark = np.array([unicodedata.category(c)[0] == "M" or c in "\u200c\u200d" for c in plane])
        self.lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in plane], np.uint32)
        self.starts = np.array([a for a, _ in SCRIPT_RANGES])
        self.group = np.array([-1 if s == "other" else SCRIPTS.index("Han") if s == "Kana" else i for i, s in enumerate(SCRIPTS)])
        self.script_of = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])

    def read(self, texts: list[str | None]):
        """Of the texts one after another: words' begins, ends, owners, buckets of all letters, words' scripts."""
        parts = [(t or "").encode("utf-32-le", "replace") for t in texts]
        sizes = np.array([len(p) // 4 + 1 for p in parts])
        code = np.frombuffer((" ".encode("utf-32-le")).join([*parts, b""]), np.uint32)
        low = np.minimum(code, 0xFFFF)
        letter = self.is_letter[low] & (code <= 0xFFFF)
        for i in np.flatnonzero(code > 0xFFFF):
            letter[i] = chr(code[i]).isalpha()
        # A mark belongs to the letter that it stands on, and to its script.
        mark = self.is_mark[low] & (code <= 0xFFFF)
        base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(code)))) if len(code) else np.empty(0, np.int64)
        letter = letter | (mark & letter[base])
        script = self.script_of[np.searchsorted(self.starts, code[base], "right") - 1]
        code = np.where(letter, np.where(code <= 0xFFFF, self.lower[low], code), 32).astype(np.uint32)
        begin = np.flatnonzero(letter & (np.diff(letter, prepend=False) | self.parts(script)))
        opens = np.zeros(len(code) + 1, bool)
        opens[begin] = True
        end = np.flatnonzero(letter & (opens[1:] | ~np.append(letter[1:], False))) + 1
        first = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.searchsorted(first, begin, "right") - 1
        at = np.flatnonzero(letter)
        around = np.concatenate([[32], code, [32]]).astype(np.uint32)
        mixed = around[at] * np.uint32(0x9E3779B1) ^ around[at + 1] * np.uint32(0x85EBCA77) ^ around[at + 2] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
        return begin, end, owner, begin - first[owner], bucket, script[begin]

    def parts(self, script: np.ndarray) -> np.ndarray:
        """Where a character's script parts it from the character before."""
        group = self.group[script]
        out = np.zeros(len(script), bool)
        out[1:] = (group[1:] != group[:-1]) & (group[1:] >= 0) & (group[:-1] >= 0)
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # buckets x languages, log probabilities
    uses: np.ndarray  # scripts x languages


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from about ``per_language`` labelled texts of each language."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    held = rows.groupBy("l").agg(F.count("*").alias("n"))
    share = held.select("l", F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n")).alias("share"))
    sample = rows.join(F.broadcast(share), "l").filter(  # one row per language
        F.pmod(F.xxhash64("k", "t"), F.lit(1_000_003)) < F.col("share") * 1_000_003
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        trigrams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == name]
                for a, b in text_slices(own, CHARS):
                    begin, end, _, _, bucket, script = letters.read(own[a:b])
                    trigrams[name] = trigrams.get(name, 0) + np.bincount(bucket, minlength=BUCKETS)
                    scripts[name] = scripts.get(name, 0) + np.bincount(script, end - begin, len(SCRIPTS))
        for name in trigrams:
            for kind, array in (("trigram", trigrams[name]), ("script", scripts[name])):
                some = np.flatnonzero(array)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array([kind] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(array[some].astype(np.int64))],
                    names=["l", "kind", "at", "n"],
                )

    counts = sample.select("t", "l").mapInArrow(count, "l string, kind string, at long, n long")
    # At most (buckets + scripts) x languages rows.
    found = counts.groupBy("l", "kind", "at").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(found["l"].unique())
    grams, scripts = np.zeros((BUCKETS, len(names))), np.zeros((len(SCRIPTS), len(names)))
    for i, name in enumerate(names):
        for kind, into in (("trigram", grams), ("script", scripts)):
            own = found[(found["l"] == name) & (found["kind"] == kind)]
            into[own["at"].to_numpy(np.int64), i] = own["n"].to_numpy()
    scores = np.log((grams + 0.2) / (grams.sum(axis=0) + 0.2 * BUCKETS)).astype(np.float32)
    uses = scripts >= USES * np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel(names, scores, uses)


def word_scores(model: LanguageModel, bucket: np.ndarray, length: np.ndarray, script: np.ndarray) -> np.ndarray:
    """Words x languages: log probability of the word's letters; candidates of another script lose."""
    starts = np.cumsum(length) - length
    out = np.add.reduceat(model.scores[bucket], starts, axis=0) if len(length) else np.zeros((0, len(model.languages)), np.float32)
    out -= out.max(axis=1, keepdims=True)
    allowed = model.uses[script]
    known = allowed.any(axis=1)
    # A foreign script costs as much as any word can; a script of no language tells nothing.
    out[known[:, None] & ~allowed] = -60.0
    out[~known] = 0.0
    return np.maximum(out, -60.0)


def viterbi(score: np.ndarray, size: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word. score: words x languages, documents one after another; size: their words."""
    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size) - size)[order]
    size = size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # documents with more than t words
    label = np.zeros(len(score), np.int16)
    came = np.zeros(score.shape, bool)  # whether the best way to this label is a switch
    best_before = np.zeros(len(score), np.int16)
    state = np.zeros((len(size), score.shape[1]), np.float32)
    for t in range(longest):
        n = active[t]
        at = start[:n] + t
        now = state[:n]
        if t:
            best = now.argmax(axis=1)
            top = now[np.arange(n), best] - switch
            better = top[:, None] > now
            came[at] = better
            best_before[at] = best
            now = np.where(better, top[:, None], now)
            now -= now.max(axis=1, keepdims=True)
        state[:n] = now + score[at]
    last = state.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        label[at] = last[:n]
        jumped = came[at, last[:n]]
        last[:n] = np.where(jumped, best_before[at], last[:n])
    return label


def labeller(model: LanguageModel, switch: float):
    """Task function on batches of texts: language, score and spans."""

    def label(texts: list[str | None], letters: Letters):
        reads, held = [], 0
        for a, b in text_slices(texts, CHARS):
            begin, end, owner, at, bucket, script = letters.read(texts[a:b])
            small = ((owner + a).astype(np.int32), at.astype(np.int32), (end - begin).astype(np.int32))
            reads.append((*small, word_scores(model, bucket, end - begin, script)))
            held += reads[-1][3].size
            if held >= SCORES or b == len(texts):
                yield from decide(reads, texts)
                reads, held = [], 0

    def decide(reads, texts):
        owner, at, length, score = (np.concatenate([r[i] for r in reads]) for i in range(4))
        if not len(owner):
            return
        docs, size = np.unique(owner, return_counts=True)
        best = viterbi(score, size, switch)
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(owner)]]) - 1
        mass = np.zeros((len(docs), len(model.languages)))
        np.add.at(mass, (np.searchsorted(docs, owner), best), length)
        top = mass.argmax(axis=1)
        share = mass[np.arange(len(docs)), top] / mass.sum(axis=1)
        bounds = np.searchsorted(owner[first], docs), np.searchsorted(owner[first], docs, "right")
        for i, doc in enumerate(docs.tolist()):
            spans = [
                {"lang": model.languages[best[f]], "start": int(at[f]), "end": int(at[e] + length[e])}
                for f, e in zip(first[bounds[0][i] : bounds[1][i]], last[bounds[0][i] : bounds[1][i]])
            ]
            yield doc, model.languages[top[i]], float(share[i]), spans

    return label


def language(text: Column, model: LanguageModel, switch: float = SWITCH) -> Column:
    """Struct of lang, score and spans (lang, start, end: code points, end exclusive) of a text."""
    label = labeller(model, switch)

    @F.pandas_udf("lang string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = Letters()
        for texts in batches:
            names, scores, spans = [UND] * len(texts), [0.0] * len(texts), [[] for _ in range(len(texts))]
            if model.languages:
                for i, names[i], scores[i], spans[i] in label(texts.tolist(), letters):
                    pass
            yield pd.DataFrame({"lang": names, "score": scores, "spans": spans})

    return labelled(text)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score", spans: str = "lang_spans") -> DataFrame:
    """``docs`` with its language, the share of letters in it and the labelled spans."""
    found = docs.withColumn("_found", language(F.col(text), model))
    return found.withColumn(lang, F.col("_found.lang")).withColumn(score, F.col("_found.score")).withColumn(spans, F.col("_found.spans")).drop("_found")
