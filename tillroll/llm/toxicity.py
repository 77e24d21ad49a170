"""Toxicity by a weighted finite-state pattern grammar.

A text is read as clauses of tokens. Every token has one symbol: insult,
threat, target, negation, report, quotation mark, comma or other. Transducers
rewrite that string one after another:

- negation: insults and threats up to ``SCOPE`` words after a negation (no
  comma between) become negated ones;
- reported speech: after a reporting verb, or between quotation marks, they
  become reported ones;
- threat: a threat needs a target within ``REACH`` words behind it; only then
  the target leaves as a threat carried out on somebody;
- target: a plain insult near a target becomes a directed one.

Their composition is one deterministic machine (``GRAMMAR``), whose arcs carry
weights: an insult counts in full, a directed one more, a negated or reported
one little, a complete threat as two insults. The insult's own weight comes from the insult
transducer, a weighted trie of word beginnings. Its arcs are learned: of a
bounded sample of labelled texts it keeps beginnings whose presence in toxic
texts is significant (log-likelihood ratio test, threshold growing with the
logarithm of the number of beginnings tried); the weight is the smoothed log
ratio of their shares in both classes. Of the arcs on a word's path the most
significant one decides. Fixed insults of four languages weigh ``SEED`` where
the sample says nothing of them.

A clause's weight is the sum along its path. The text's score is a logistic
function of the sum, the greatest clause and the sum by length, fitted on the
same sample and weighted so that classes count as often as they are labelled.

Learning reads at most ``per_label`` texts of each label, those whose keys hash
lowest, of each key one text. Scoring covers every text as a whole; it depends
on the text alone.

Defined cases: null, empty and blank texts have no clause and the score of a
text without any match; labels that are null are left out, of several labels of
a key the highest counts; with one label or none the score is 0 or 1 where all
known labels say so, else 0, and only fixed insults match; repeated rows score
alike; an empty table gives no rows; other columns pass through and clashing
output names are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import release_memory, text_slices

# Fixed values of the grammar: words of English, German, French and Spanish.
INSULTS = """
idiot moron stupid loser scum trash clown worthless pathetic disgusting dumb fool imbecile bastard
dumm dummkopf trottel abschaum versager arschloch widerlich wertlos
imbécile crétin connard salaud ordure minable dégoûtant débile
idiota imbécil estúpido basura escoria payaso asqueroso inútil
""".split()
THREATS = """
kill hurt destroy beat punch stab shoot smash burn hang
töten umbringen schlagen vernichten erschießen
tuer frapper détruire crever
matar golpear destruir quemar
""".split()
TARGETS = """
you your yours yourself u they them their she her he him people everyone
du dich dir dein deine ihr euch euer sie
tu te toi vous ton votre
tú ti usted ustedes vosotros tus
""".split()
NEGATIONS = "not no never nor neither isn aren wasn don doesn didn won cannot without nicht kein keine nie niemals ne pas jamais sans nunca jamás sin".split()
REPORTS = """
said says say told tells claimed claims wrote writes called calls quoted reported according
sagte sagt behauptete schrieb nannte laut
dit disait déclare écrit appelle selon
dijo dice afirma escribe llamó según
""".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, COMMA = range(8)
#: What the machine writes besides these: rewritten insults and threats.
NEGATED, REPORTED, DIRECTED, POINTED, CARRIED = range(8, 13)
END = 13
SYMBOLS = END + 1
SCOPE, REACH = 3, 4
#: Weight of each written symbol; an insult's is multiplied with its word's. ``POINTED`` is a target behind an insult.
WEIGHTS = {INSULT: 1.0, NEGATED: 0.2, REPORTED: 0.3, DIRECTED: 1.25}
EXTRA = {POINTED: 0.5, CARRIED: 4.0}
SEED = 3.0

PER_LABEL = 4000
#: Word beginnings on the trie: three to eight letters, and the whole word.
BEGINNINGS = range(3, 9)
LEAST_TEXTS = 3
#: An arc's likelihood ratio statistic is this many times the logarithm of the beginnings tried, or more.
STRICT = 1.5
#: A beginning gives way to a longer one that holds this share of its toxic texts: it is one word's, not a stem.
ONE_WORD = 0.8
#: Distinct words whose symbol a task remembers, and the longest that it remembers.
MEMO, LONGEST = 300_000, 40
CHARS = 2_000_000
FEATURES = 4

TOKEN = re.compile(r"[^\W_]+|[.!?;:\n,\"“”„«»]")
MARKS = {**dict.fromkeys(".!?;:\n", END), ",": COMMA, **dict.fromkeys('"“”„«»', QUOTE)}


@dataclass
class Transducer:
    """Deterministic: arcs (state, read) -> (state, written). What no arc reads passes unchanged, by ``otherwise`` of its state."""

    states: int
    arcs: dict[tuple[int, int], tuple[int, int]]
    otherwise: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, read: int) -> tuple[int, int]:
        return self.arcs.get((state, read)) or (self.otherwise.get(state, state), read)


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The machine that lets ``second`` read what ``first`` writes; only states that can be reached."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for read in range(SYMBOLS):
            a2, between = first.step(a, read)
            b2, written = second.step(b, between)
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            arcs[number[a, b], read] = (number[a2, b2], written)
    return Transducer(len(number), arcs)


def within(reach: int, opener: list[int], closers: list[int], rewrites: dict[int, int], opened_as: dict[int, int] | None = None) -> Transducer:
    """State n > 0 means that ``opener`` stood at most ``reach`` words ago, n words are left; there ``rewrites`` hold."""
    arcs, otherwise = {}, {0: 0}
    for state in range(reach + 1):
        otherwise[state] = max(0, state - 1)
        arcs |= {(state, s): (0, s) for s in closers}
        arcs |= {(state, s): (state, s) for s in (QUOTE, COMMA) if s not in closers}
        if state:
            arcs |= {(state, s): (max(0, state - 1), w) for s, w in rewrites.items()}
        arcs |= {(state, s): (reach, (opened_as or {}).get(s, s) if not state else arcs.get((state, s), (0, s))[1]) for s in opener}
    return Transducer(reach + 1, arcs, otherwise)


def negation() -> Transducer:
    return within(SCOPE, [NEGATION], [COMMA, END], {INSULT: NEGATED, THREAT: OTHER})


def reported() -> Transducer:
    """State 1: after a reporting verb, to the clause's end; state 2: between quotation marks, across clauses."""
    soft = {INSULT: REPORTED, THREAT: OTHER}
    arcs = {(0, REPORT): (1, REPORT), (0, QUOTE): (2, QUOTE), (1, QUOTE): (2, QUOTE), (2, QUOTE): (0, QUOTE), (1, END): (0, END)}
    arcs |= {(state, s): (state, w) for state in (1, 2) for s, w in soft.items()}
    return Transducer(3, arcs)


def threat() -> Transducer:
    return within(REACH, [THREAT], [END], {TARGET: CARRIED}, None)


def target() -> Transducer:
    """States 0: nothing near; 1 to REACH: a target stood before; beyond: an undirected insult stood before."""
    arcs, otherwise = {}, {}
    for state in range(2 * REACH + 1):
        near, behind = 0 < state <= REACH, state > REACH
        otherwise[state] = state - 1 if near or state > REACH + 1 else 0
        arcs[state, END] = (0, END)
        arcs |= {(state, s): (state, s) for s in (QUOTE, COMMA)}
        arcs[state, INSULT] = (otherwise[state], DIRECTED) if near else (2 * REACH, INSULT)
        arcs |= {(state, s): (REACH, POINTED if behind and s == TARGET else s) for s in (TARGET, CARRIED)}
    return Transducer(2 * REACH + 1, arcs, otherwise)


def table_of(machine: Transducer) -> list[list[tuple[int, int]]]:
    return [[machine.step(state, s) for s in range(SYMBOLS)] for state in range(machine.states)]


GRAMMAR = table_of(composed(composed(composed(negation(), reported()), threat()), target()))


def beginnings(word: str) -> Iterator[str]:
    """The states on a word's path through the trie; the last one is the whole word."""
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n]
    yield word + "$"


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


class Lexicon(dict):
    """Symbol of each token, looked up once; the insult transducer's weights are in ``insults``."""

    def __init__(self, arcs: dict[str, tuple[float, float]]):
        super().__init__(MARKS)
        self.arcs, self.insults = arcs, {}
        self.fixed = {w: s for s, words in ((TARGET, TARGETS), (THREAT, THREATS), (REPORT, REPORTS), (NEGATION, NEGATIONS)) for w in words}

    def __missing__(self, word: str) -> int:
        weight = self.weight(word)
        symbol = INSULT if weight > 0 else self.fixed.get(word, OTHER)
        if len(self) > MEMO:
            self.clear()
            self.update(MARKS)
            self.insults = {}
        if len(word) <= LONGEST:
            self[word] = symbol
        if weight > 0:
            self.insults[word] = weight
        return symbol

    def weight(self, word: str) -> float:
        """Weight of the most significant arc on the path; 0 if there is none."""
        found = [self.arcs[b] for b in beginnings(word) if b in self.arcs]
        return max(found)[1] if found else 0.0


def clause_weights(words: list[str], lexicon: Lexicon) -> list[tuple[int, int, float]]:
    """Clauses with weight: (first token, end, weight)."""
    symbols = bytes(map(lexicon.__getitem__, words))
    if INSULT not in symbols and THREAT not in symbols:
        return []
    out, state, begin, total = [], 0, 0, 0.0
    for i, read in enumerate(symbols):
        state, written = GRAMMAR[state][read]
        if written in WEIGHTS:
            total += WEIGHTS[written] * (lexicon.insults.get(words[i]) or lexicon.weight(words[i]))
        elif written in EXTRA:
            total += EXTRA[written]
        elif written == END:
            if total:
                out.append((begin, i, total))
            begin, total = i + 1, 0.0
    if total:
        out.append((begin, len(words), total))
    return out


def features(words: list[str], clauses: list[tuple[int, int, float]]) -> list[float]:
    total = sum(c[2] for c in clauses)
    most = max((c[2] for c in clauses), default=0.0)
    return [1.0, math.log1p(total), math.log1p(most), math.log1p(100 * total / max(len(words), 10))]


@dataclass
class ToxicityModel:
    arcs: dict[str, tuple[float, float]]  # beginning: significance, weight
    weights: np.ndarray  # of the features

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.asarray(x).reshape(-1, FEATURES) @ self.weights, -40, 40)))


def significance(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Twice the log-likelihood ratio of one share for both classes against one for each."""

    def fit(k, n, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log1p(-p)

    both = (a + b) / (n1 + n0)
    return 2 * (fit(a, n1, a / n1) + fit(b, n0, b / n0) - fit(a, n1, both) - fit(b, n0, both))


def learned_arcs(found: list[tuple[str, int, int]], tried: int, n1: int, n0: int) -> dict[str, tuple[float, float]]:
    """Arcs of beginnings in ``a`` toxic and ``b`` other texts, of ``tried`` beginnings; fixed insults where the sample says nothing."""
    arcs = {w + "$": (0.0, SEED) for w in INSULTS}
    if found and n1 and n0:
        a, b = (np.array([f[i] for f in found], float) for i in (1, 2))
        sure = significance(a, b, n1, n0)
        least = STRICT * math.log(max(tried, 2))
        weight = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
        strong = {found[i][0]: i for i in np.flatnonzero((sure >= least) & (weight > 0)).tolist()}
        longer = dict.fromkeys(strong, 0.0)  # toxic texts of the strongest longer arc
        for name, i in strong.items():
            for n in BEGINNINGS:
                if n < len(name) - name.endswith("$") or (n == len(name) - 1 and name.endswith("$")):
                    longer[name[:n]] = max(longer.get(name[:n], 0.0), a[i])
        for name, i in strong.items():
            if longer[name] < ONE_WORD * a[i]:
                arcs[name] = (float(sure[i]), float(weight[i]))
        for i, (name, _, _) in enumerate(found):
            if arcs.get(name) == (0.0, SEED) and weight[i] <= 0:
                del arcs[name]  # the sample knows the word, and not as toxic
    return arcs


def logistic_fit(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the penalty leaves the first weight alone."""
    w = np.zeros(x.shape[1])
    keep = ridge * np.array([0.01] + [1.0] * (x.shape[1] - 1))

    def loss(v):
        s = x @ v
        return float((times * (np.logaddexp(0, s) - y * s)).sum() + (keep * v * v).sum() / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (times * (p - y)) + keep * w
        h = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step, size = np.linalg.solve(h, g), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(labels: DataFrame, key: str, label: str, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_label`` keys of each label, always the same, and how many keys have each label."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg((F.max(label) > 0).cast("int").alias("_label"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}  # two rows
    parts = [known.filter(F.col("_label") == y).orderBy(F.xxhash64("_key"), "_key").limit(per_label) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), counts


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = PER_LABEL) -> ToxicityModel:
    """Learn from a bounded sample of ``labels`` (key, label: 1 or 0) of ``docs``."""
    sample, counts = labelled_sample(labels, key, label, per_label)
    rated = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), "_key")  # at most 2 x per_label rows of two numbers
        .groupBy("_key", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("first"))
        .select("_label", F.col("first._text").alias("_text")).groupBy("_text").agg(F.max("_label").alias("_label"))
    )
    shared = rated.select("_label", "_text").persist()
    try:
        return fit_sample(shared, counts)
    finally:
        shared.unpersist()


def fit_sample(rated: DataFrame, counts: dict[int, int]) -> ToxicityModel:
    """``rated``: (_label, _text), a bounded number of texts; ``counts``: labelled keys of each label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in text_slices(texts, CHARS):
                held = (Counter(), Counter())
                for y, t in zip(labels[a:b], texts[a:b]):
                    held[y].update({p for w in set(tokens(t)) if w not in MARKS for p in beginnings(w)})
                names = list(held[0] | held[1])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([held[y][p] for p in names], pa.int64()) for y in (1, 0))], names=["p", "a", "b"])

    n = {r["_label"]: r["n"] for r in rated.groupBy("_label").agg(F.count("*").alias("n")).collect()}  # two rows
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        only = 40.0 if n1 else -40.0
        return ToxicityModel(learned_arcs([], 0, n1, n0), np.array([only, 0, 0, 0]))
    held = rated.mapInArrow(count, "p string, a long, b long").groupBy("p").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    held = held.filter(F.col("a") + F.col("b") >= LEAST_TEXTS).persist()
    tried = held.count()
    # A bounded sample has a bounded number of beginnings; those more usual in toxic texts reach the driver.
    some = held.filter((F.col("a") * n0 > F.col("b") * n1) | F.col("p").isin([w + "$" for w in INSULTS]))
    arcs = learned_arcs([tuple(r) for r in some.collect()], tried, n1, n0)
    held.unpersist()

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(arcs)
        for batch in batches:
            words = map(tokens, batch.column(1).to_pylist())
            x = [features(w, clause_weights(w, lexicon)) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    rows = rated.mapInArrow(featured, "y int, x array<double>").collect()  # at most 2 x per_label rows
    rows.sort(key=lambda r: (r["y"], r["x"]))
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float)
    times = np.where(y == 1, counts[1] / n1, counts[0] / n0) / (counts[1] / n1 + counts[0] / n0)
    return ToxicityModel(arcs, logistic_fit(x, y, times))


def with_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", least: float = 0.3, score: str = "score", predicted: str = "predicted", clauses: str = "clauses") -> DataFrame:
    """``docs`` with the score, whether it is ``least`` or more, and the matched clauses (start, end: code points, end exclusive; weight)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # an arc for each significant beginning of the sample

    @F.pandas_udf("score double, clauses array<struct<start:bigint,end:bigint,weight:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        lexicon = Lexicon(known.arcs)
        for texts in batches:
            x, found = [], []
            for t in texts.tolist():
                words = tokens(t)
                own = clause_weights(words, lexicon)
                x.append(features(words, own))
                found.append(spans(t, own) if own else [])
            yield pd.DataFrame({"score": known.score(np.array(x)), "clauses": found})
            release_memory()

    both = docs.withColumn("_found", scored(F.col(text)))
    return both.withColumn(score, F.col("_found.score")).withColumn(predicted, (F.col("_found.score") >= least).cast("int")).withColumn(clauses, F.col("_found.clauses")).drop("_found")


def spans(text: str, clauses: list[tuple[int, int, float]]) -> list[dict]:
    """Clauses by the places of their first and last tokens; lower case keeps the places unless it changes the length."""
    low = text.lower()
    at = [m.span() for m in TOKEN.finditer(low if len(low) == len(text) else text)]
    return [{"start": at[b][0], "end": at[e - 1][1], "weight": w} for b, e, w in clauses if e <= len(at)]
