"""Periodic runs of words, by seeds extended along diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(least, times * q)`` words, which no
neighbouring word extends. It is a stretch of the diagonal of lag q, where a
text is laid against itself q words further, of ``max(least, times * q) - q``
matches at least.

Periods are taken in bands of lo to 2 lo - 1. The minimum of those guaranteed
overlaps over a band and the later ones is the length k of its grams: every run of the band holds
a gram of k words at one place and again q words later. As k is not below q (so
``times`` must be 3 or more), the gram does not stand in between, and pairs of
neighbouring occurrences of a gram in one text are all the seeds that are
needed: at most one for each word and band, however often a gram repeats. Seeds
of one lag follow the text; a table keeps for each lag how far that diagonal is
covered, and a covered seed is not extended again. A neighbouring pair at a
multiple of a shorter period does not exist, so that found periods are smallest
ones.

Grams have exact names: those of 2 m words are numbered pairs of names of m
words. A place whose gram stands nowhere else in its text drops out of all
longer ones, so ordinary text is done after the first bands. Texts are worked
on in slices, rows do not move between tasks, a very long text is a slice of
its own with memory in proportion to its words.

Removing from each run all that follows its first period leaves the collapsed
text: the remaining words joined by one space.

Defined cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; repeated rows have equal results; an empty table gives no rows;
other columns pass through and clashing output names are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import release_memory, text_slices

#: What stands between blanks; the same class for Python and for Java.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of the texts that are worked on at once.
CHARS = 2_000_000

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def overlap(period: int, least: int, times: int) -> int:
    """Matches that a run of this period has on its diagonal at least."""
    return max(least, times * period) - period


def bands(longest: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(first period, end, words of a gram) until a run no longer fits into ``longest`` words."""
    lo = 1
    while max(least, times * lo) <= longest:
        yield lo, 2 * lo, min(overlap(q, least, times) for q in range(lo, max(2 * lo, least // times + 2)))
        lo *= 2


class Names:
    """Names of the grams of 1, 2, 4, ... words at each place; -1 where the gram stands only once."""

    def __init__(self, code: np.ndarray):
        self.size, self.name = 1, repeated(np.arange(len(code)), code, len(code))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of grams of ``k`` words (not fewer than before) that can be repeated, and their keys."""
        while 2 * self.size <= k:
            self.name = repeated(*self.pairs(self.size), len(self.name))
            self.size *= 2
        return self.pairs(k - self.size)

    def pairs(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        name = self.name
        at = np.flatnonzero((name[: len(name) - shift] >= 0) & (name[shift:] >= 0))
        return at, name[at] * (len(name) + 1) + name[at + shift]


def repeated(at: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the keys that stand at two places or more, at their places; elsewhere -1."""
    number = pd.factorize(key)[0]
    many = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.empty(0, bool)
    out = np.full(n, -1, np.int64)
    out[at[many]] = number[many]
    return out


def seeds(at: np.ndarray, key: np.ndarray, lo: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Lags from ``lo`` to ``end`` - 1 between neighbouring places of a key and the place, by lag, then place.

    A seed that directly follows another one of its lag lies on the same stretch and is left out.
    """
    order = np.argsort(key, kind="stable")
    place, same = at[order], key[order][1:] == key[order][:-1]
    lag = place[1:] - place[:-1]
    use = same & (lag >= lo) & (lag < end)
    place, lag = place[:-1][use], lag[use]
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    follows = (lag[1:] == lag[:-1]) & (place[1:] == place[:-1] + 1)
    first = np.concatenate([[True], ~follows]) if len(place) else np.empty(0, bool)
    return lag[first], place[first]


def matches(left: np.ndarray, right: np.ndarray) -> int:
    """How many first words of both are identical, compared in growing pieces."""
    n, at, step = min(len(left), len(right)), 0, 32
    while at < n:
        other = np.flatnonzero(left[at : min(n, at + step)] != right[at : min(n, at + step)])
        if len(other):
            return at + int(other[0])
        at, step = at + step, 2 * step
    return n


def runs_of(code: np.ndarray, longest: int, least: int, times: int) -> np.ndarray:
    """Rows of start, length and period, by start, then period.

    ``code`` may hold several texts one after another, if these share no
    number: then no gram that touches two texts can be repeated. ``longest`` is
    the number of words of the longest text.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    found = []
    names = Names(code)
    for lo, end, k in bands(longest, least, times):
        if k > len(code) or not (names.name >= 0).any():
            break
        lags, places = seeds(*names.grams(k), lo, end)
        covered: dict[int, int] = {}
        for lag, i in zip(lags.tolist(), places.tolist()):
            if i < covered.get(lag, 0):
                continue
            here, there = code[: len(code) - lag], code[lag:]
            stop = i + matches(here[i:], there[i:])
            start = i - matches(here[:i][::-1], there[:i][::-1])
            covered[lag] = stop
            if stop - start + lag >= max(least, times * lag):
                found.append((start, stop - start + lag, lag))
    out = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64)
    return out.reshape(-1, 3)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def analysed(texts: list[str | None], least: int, times: int) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each text."""
    word = re.compile(WORD)
    split = [word.findall(t) if t else [] for t in texts]
    codes, total = [], 0
    for words in split:
        number: dict[str, int] = {}
        codes.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) + total)
        total += len(number)
    size = np.array([len(w) for w in split])
    first = np.cumsum(size) - size
    runs = runs_of(np.concatenate(codes), int(size.max()), least, times)
    keep = kept_words(int(size.sum()), runs)
    # Texts without words start where the next one does: the last text that starts there owns the run.
    owner = np.searchsorted(first, runs[:, 0], "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, words in enumerate(split):
        own = runs[bounds[i] : bounds[i + 1]]
        if len(own):
            left = keep[first[i] : first[i] + size[i]].tolist()
            words = [w for w, k in zip(words, left) if k]
        yield [{"start": s - int(first[i]), "length": n, "period": p} for s, n, p in own.tolist()], " ".join(words)


def with_runs(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of each text (start: number of a word, length, period; by start, then period) and the collapsed text."""

    @F.pandas_udf(f"runs array<{RUN}>, collapsed string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts, rows = texts.tolist(), []
            for a, b in text_slices(texts, CHARS):
                rows += analysed(texts[a:b], least, times)
            yield pd.DataFrame(rows, columns=["runs", "collapsed"])
            del texts, rows
            release_memory()

    both = docs.withColumn("_found", found(F.col(text)))
    return both.withColumn(runs, F.col("_found.runs")).withColumn(collapsed, F.col("_found.collapsed")).drop("_found")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; of equal ones the first. Null without runs."""
    return F.aggregate(
        runs,
        F.lit(None).cast(RUN),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )


def listed(runs: Column) -> Column:
    """``start,length,period`` of each run, each ended by a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def tiled(words: Column, start: Column, period: Column) -> Column:
    """The words with all from ``start`` on replaced by repetitions of the ``period`` words that stand there; as many as before."""
    n = F.size(words)
    block = F.slice(words, start + 1, period)
    times = F.ceil((n - start) / period).cast("int")
    return F.slice(F.concat(F.slice(words, F.lit(1), start), F.flatten(F.array_repeat(block, times))), F.lit(1), n)
