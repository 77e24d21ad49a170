"""Benchmark decontamination with an FM-index per training shard.

A shard is a stretch of a task's documents. Its word stream keeps only runs
that can hold a phrase (every adjacent pair of words is adjacent in a phrase;
the rest cannot match and is replaced by a separator, so nothing is lost). The
stream gets a suffix array, its Burrows-Wheeler transform goes into a wavelet
matrix with rank directories, phrases are found by backward search, their places by
walking to the next sampled suffix, and overlapping occurrences are merged.

Phrases travel to the tasks in slices of bounded size; a benchmark that
exceeds one slice is searched slice by slice and the documents' hits merged. The
hits of a slice are kept before the next one is read, so the driver and the plan
hold the first slice and one more, however many there are. For several slices the
documents are numbered and kept once, and each slice reads the kept ones.

Defined cases: null texts and texts without words have no words and no hits;
an item with fewer words than a window is one window, without words none; a
null item_id counts for hit words but is not listed; repeated documents
are judged each; an empty benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import WORD, release_memory, settled, suffix_array, words

WINDOW = 13
#: Columns that ``find`` adds.
FOUND = ("n_words", "n_hit", "items", "word_spans", "spans")
#: Words of phrases that go to the tasks at once.
SLICE_WORDS = 500_000
#: Every so many text positions a suffix position is kept for locating.
SAMPLE = 16
#: A shard's index is built when its stream has so many words, or its documents so many characters.
SHARD_WORDS, SHARD_CHARS = 400_000, 40_000_000


class FMIndex:
    """Full-text index of a sequence of the symbols 1 to sigma - 1; 0 ends it."""

    def __init__(self, text: np.ndarray, sigma: int):
        text = np.append(text, 0)
        self.n, n = len(text), len(text)
        sa = suffix_array(text)
        self.bits = max(1, int(sigma - 1).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        bwt = text[sa - 1]
        # Wavelet matrix: one bit plane a level, zeros moved before ones.
        self.ones, self.zeros, self.planes = [], [], []
        level = bwt
        for k in range(self.bits - 1, -1, -1):
            bit = (level >> k) & 1
            self.planes.append(bit.astype(bool))
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        self.kept = sa % SAMPLE == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(self.kept, dtype=np.int32)])
        self.kept_at = sa[self.kept]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``row`` of the transform."""
        low, high = np.zeros_like(row), row
        for level, k in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> k) & 1).astype(bool)
            a, b = self.ones[level][low], self.ones[level][high]
            low = np.where(one, self.zeros[level] + a, low - a)
            high = np.where(one, self.zeros[level] + b, high - b)
        return high - low

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one position earlier."""
        at, symbol = row, np.zeros_like(row)
        for level in range(self.bits):
            one = self.planes[level][at]
            a = self.ones[level][at]
            symbol = symbol * 2 + one
            at = np.where(one, self.zeros[level] + a, at - a)
        return self.first[symbol] + self.rank(symbol, row)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (a row of equal length)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for symbol in phrases.T[::-1]:
            low = self.first[symbol] + self.rank(symbol, low)
            high = np.maximum(low, self.first[symbol] + self.rank(symbol, high))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to a sampled one."""
        place = np.zeros(len(rows), np.int64)
        todo, at, walked = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.kept[at]
            place[todo[hit]] = self.kept_at[self.kept_rank[at[hit]]] + walked
            todo, at = todo[~hit], at[~hit]
            at = self.step(at)
            walked += 1
        return place


class Phrases:
    """Windows of benchmark items as integer rows, with what can rule text out."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        v = self.size = len(self.vocabulary) + 1
        found: dict[tuple[int, ...], set[str]] = {}
        pairs = set()
        for item, ws in items:
            ids = [self.vocabulary[w] for w in ws]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                found.setdefault(tuple(ids[i : i + n]), set()).update([] if item is None else [item])
            pairs.update(a * v + b for a, b in zip(ids, ids[1:]))
        self.pairs = np.array(sorted(pairs), np.int64)
        self.by_length = {}
        for n in sorted({len(w) for w in found}):
            some = [w for w in found if len(w) == n]
            self.by_length[n] = (np.array(some, np.int64), [sorted(found[w]) for w in some])
        self.shortest = min(self.by_length, default=0)

    def runs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the runs of ``ids`` that can hold a phrase."""
        known = ids > 0
        linked = np.zeros(len(ids) + 1, bool)  # linked[i]: i - 1 and i are adjacent in a phrase
        key = ids[:-1] * self.size + ids[1:]
        both = np.flatnonzero(known[:-1] & known[1:])
        if len(self.pairs):
            at = np.searchsorted(self.pairs, key[both])
            linked[both[self.pairs[np.minimum(at, len(self.pairs) - 1)] == key[both]] + 1] = True
        begin = np.flatnonzero(known & ~linked[:-1])
        end = np.flatnonzero(known & ~linked[1:]) + 1
        long = end - begin >= self.shortest
        return begin[long], end[long]


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals sorted by begin, as disjoint intervals."""
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    return begin[new], np.concatenate([reach[np.flatnonzero(new)[1:] - 1], reach[-1:]])


def search_task(phrases: Phrases):
    """Task function: per document its number of words, merged word spans and items."""

    def hits_of(stream, owner, place, docs):
        index = FMIndex(stream, phrases.size + 1)
        found = [([], [], set()) for _ in range(docs)]
        for n, (rows, items) in phrases.by_length.items():
            low, high = index.search(rows)
            which = np.repeat(np.arange(len(rows)), high - low)
            if not len(which):
                continue
            nth = np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            at = index.locate(low[which] + nth)
            for doc, begin, w in zip(owner[at].tolist(), place[at].tolist(), which.tolist()):
                found[doc][0].append(begin)
                found[doc][1].append(begin + n)
                found[doc][2].update(items[w])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = phrases.vocabulary.get
        keys, texts, counts, streams, owners, places, held, chars = [], [], [], [], [], [], 0, 0

        def flush():
            nonlocal keys, texts, counts, streams, owners, places, held, chars
            empty = [([], [], set())] * len(counts)
            found = hits_of(*map(np.concatenate, (streams, owners, places)), len(counts)) if held else empty
            spans, points, items = [], [], []
            for text, (begin, end, names) in zip(texts, found):
                if not begin:
                    spans.append([])
                    points.append([])
                    items.append([])
                    continue
                order = np.argsort(begin, kind="stable")
                b, e = merged(np.array(begin)[order], np.array(end)[order])
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(b, e)])
                raw = text.encode("utf-8")
                at = [m.span() for m in WORD.finditer(raw.lower())]
                points.append([{"start": len(raw[: at[x][0]].decode()), "end": len(raw[: at[y - 1][1]].decode())} for x, y in zip(b, e)])
                items.append(sorted(names))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(points, span), pa.array(items, pa.list_(pa.string()))],
                names=["_row", "n_words", "word_spans", "spans", "items"],
            )
            keys, texts, counts, streams, owners, places, held, chars = [], [], [], [], [], [], 0, 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                keys.append(some.column(0))
                for text in some.column(1).to_pylist():
                    found = words(text)
                    doc = len(counts)
                    chars += len(text) if text else 0
                    counts.append(len(found))
                    hit = False
                    if found and phrases.shortest:
                        ids = np.array([get(w, 0) for w in found], np.int64)
                        for b, e in zip(*phrases.runs(ids)):
                            streams.append(np.append(ids[b:e], phrases.size))  # a symbol of no phrase
                            owners.append(np.full(e - b + 1, doc))
                            places.append(np.arange(b, e + 1))
                            held += e - b + 1
                            hit = True
                    texts.append(text if hit else None)
                if held >= SHARD_WORDS or chars >= SHARD_CHARS:
                    yield flush()
        if counts:
            yield flush()
        release_memory()

    return run


def find(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default), n_words, n_hit, items, word_spans and spans (code points, end exclusive)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    items = items.filter(F.octet_length("text") > 0)
    # A word has a byte at least, and so many bytes bound what one slice holds.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = 1 + int(size) // (6 * SLICE_WORDS)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in FOUND]
    source = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("text"))
    if slices > 1:
        # Numbered once and kept: each slice is a job of its own, and all must see the same numbers.
        source = settled(source.withColumn("_row", F.struct("_row", F.monotonically_increasing_id().alias("at"))))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        source.schema["_row"], T.StructField("n_words", T.LongType()), T.StructField("word_spans", span),
        T.StructField("spans", span), T.StructField("items", T.ArrayType(T.StringType())),
    ])
    parts = []
    for k in range(slices):
        some = items.filter(F.pmod(F.xxhash64("text"), F.lit(slices)) == k)
        phrases = Phrases([(r["item"], words(r["text"])) for r in some.collect()], window)
        part = source.mapInArrow(search_task(phrases), schema)
        if k:
            # The first slice brings the documents and their numbers of words; of the others the hits count.
            unnamed = F.struct(F.lit(None).cast(source.schema["_row"].dataType["_row"].dataType).alias("_row"), F.col("_row.at").alias("at"))
            part = settled(part.filter(F.size("word_spans") > 0).withColumn("_row", unnamed))
        parts.append(part)
    found = parts[0]
    if slices > 1:
        for more in parts[1:]:
            found = found.unionByName(more)
        found = found.groupBy("_row.at").agg(
            F.first("_row._row", ignorenulls=True).alias("_row"),
            F.first("n_words").alias("n_words"),
            union_of_spans(F.flatten(F.collect_list("word_spans"))).alias("word_spans"),
            union_of_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("_row.*", "n_words", hit.alias("n_hit"), "items", "word_spans", "spans")


def union_of_spans(spans: Column) -> Column:
    """Disjoint union of an array of (start, end)."""
    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"]),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(spans), empty, add)


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """A document is contaminated when a twentieth of its words, one at least, is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the code points of disjoint, ordered ``spans``."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["done"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))).alias("done"), s["end"].alias("at")),
        lambda a: F.concat(a["done"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)
