"""Phrase collocations by SON partitioning, per language.

The corpus is dealt into ``shards`` parts (a Spark partition belongs to one of
them). Each shard is mined completely, level by level: a phrase is extended
only if its two shorter parts can be frequent. A shard's support is the global
one lowered in proportion to the words that it holds of the language, so every
phrase that is frequent in the corpus is frequent in one shard at least. The
union of the locally frequent phrases are the candidates; a last scan counts
them over the whole corpus exactly.

Every scan turns texts into word numbers in Arrow and numpy and adds up equal
phrases of a slice before they are shuffled. What a scan must know of the level
below (frequent words, then candidates) reaches it as a bitmap of ``BITS`` bits
with one bit per phrase, whatever the corpus holds. Shards are mined under
64-bit names of phrases, whose highest bits are the phrase's place in the
bitmap. The sorted names of a slice are shuffled as one row for each ``BLOCK``
bits of it, so that a row carries many phrases; a task adds up one block
at a time and leaves its bits. Phrases that share a name or a bit can only make
a shard or a scan count too much: the last scan counts by phrase, and what falls
short of the support is dropped there.

Counts are exact, ``least`` is an absolute number of occurrences, overlaps
count. The score of a candidate with a occurrences, cut after k words into
parts with l and r, is floor(1,000,000 a a / (l r)) in 38-digit arithmetic,
which holds while a stays below 10^16; the lowest-scoring cut counts.

Defined cases: null and empty texts have no words; a null language is ``und``;
repeated rows count as often as they stand; phrases never cross a piece, a text
or a language; an empty table gives no rows; other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import drop_unused, release_memory, settled, splittable_join, text_slices

UND = "und"
#: Bits of the bitmap that says which phrases the level below left: 16 MB, whatever the corpus.
BITS = 1 << 27
#: Bits of the bitmap whose phrases are counted together, 4 KB.
BLOCK = 1 << 15
#: Rows of the table of shard sizes (shards x languages) up to which it is broadcast; a larger one is joined.
SIZES = 20_000
#: Characters that a scan numbers at once.
CHARS = 4_000_000
#: Bytes of the longest word that is hashed beside the others.
LONG = 256
#: Parts of a language that are ranked before its first phrases are ranked together.
SALTS = 256

#: A-Z in lower case, tab as space, every piece end as a line feed.
_BYTES = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
#: Masks that leave the first 0 to 8 bytes of eight.
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def found_words(texts: list[str | None], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts one after another: bytes that hold them, begin, end, whether a word opens a piece, its owner."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw).translate(_BYTES), np.uint8)
    edge = np.diff((data != 32) & (data != 10), prepend=False, append=False)
    at = np.flatnonzero(edge)
    begin, end = at[0::2], at[1::2]
    piece = np.cumsum(data == 10)[begin]  # pieces ended up to here
    opens = np.diff(piece, prepend=-1) != 0
    first = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    return data, begin, end, opens, owner[np.searchsorted(first, begin, "right") - 1]


def numbered(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word, and the words by number."""
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    inner = data[(data != 32) & (data != 10)].tobytes()
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(inner)])
    coded = packed.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.large_string())


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in this order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashes_in(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes, eight bytes at a time; of one above ``LONG``, its digest."""
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    length = end - begin
    out = length.astype(np.uint64)
    for i in np.flatnonzero(length > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    which = np.flatnonzero(length <= LONG)
    at, left = begin[which], length[which]
    while len(which):
        out[which] = mixed(out[which], eight[at] & _FIRST_BYTES[np.minimum(left, 8)])
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return out


def hashed(strings: list[str]) -> np.ndarray:
    raw = [s.encode("utf-8", "replace") for s in strings]
    length = np.array([len(r) for r in raw], np.int64)
    end = np.cumsum(length)
    return hashes_in(np.frombuffer(b"".join(raw), np.uint8), end - length, end)


def names_of(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """The 64-bit name of each phrase, from the hashes of its language and words."""
    h = lang
    for w in words:
        h = mixed(h, w)
    return h.view(np.int64)


def named(words: DataFrame) -> DataFrame:
    """The names of words (lang, phrase)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, word = (hashed(batch.column(i).to_pylist()) for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(names_of(lang, [word]))], names=["name"])

    return words.select("lang", "phrase").mapInArrow(name, "name long")


def unused_bits(bits: int) -> int:
    """How many of a name's 64 bits do not tell its place in a bitmap of ``bits`` bits."""
    return 65 - bits.bit_length()


def put_together(blocks: DataFrame) -> np.ndarray:
    """The bitmap of the rows (block, bits): ``BITS`` / ``BLOCK`` rows of 4 KB at most reach the driver."""
    size = BLOCK // 8
    out = np.zeros(BITS // 8, np.uint8)
    for r in blocks.select("block", "bits").collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)[:size]
        out[r["block"] * size : r["block"] * size + len(part)] = part
    return out


def bitmap(names: DataFrame) -> np.ndarray:
    """The bits of phrases' names."""
    at = names.select(F.shiftrightunsigned("name", unused_bits(BITS)).alias("at"))
    block = F.floor(F.col("at") / BLOCK).cast("int").alias("block")
    return put_together(at.groupBy(block).agg(F.bitmap_construct_agg(F.col("at") % BLOCK).alias("bits")))


def held(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = names.view(np.uint64) >> np.uint64(unused_bits(len(bits) * 8))
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def added_up(names: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names in their order, and how often each stands there (or the sum of its ``times``)."""
    if times is None:
        names = np.sort(names)
    else:
        order = np.argsort(names, kind="stable")
        names, times = names[order], times[order]
    begin = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return names[begin], np.diff(begin, append=len(names)) if times is None else np.add.reduceat(times, begin)


def shard_counts(docs: DataFrame, size: int, below: dict[int, "object"]) -> DataFrame:
    """Partial counts of the phrases of ``size`` words by shard and need: (block, shard, need, names, times).

    A row holds the phrases of a slice in one block of the bitmap, as 64-bit
    names and 32-bit counts. ``docs`` is (lang, text, shard, need), where need
    is the shard's support for the language. ``below`` has the broadcast bitmaps
    of all shorter phrases that count: a phrase must have the bits of its parts.
    """
    unused, block_bits = np.uint64(unused_bits(BITS)), np.uint64(BLOCK.bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: b.value for k, b in below.items()}
        for batch in batches:
            langs, texts, shards, needs = (batch.column(c).to_pylist() for c in ("lang", "text", "shard", "need"))
            for a, b in text_slices(texts, CHARS):
                key = sorted(set(zip(langs[a:b], shards[a:b], needs[a:b])))
                number = {k: i for i, k in enumerate(key)}
                owner = np.array([number[k] for k in zip(langs[a:b], shards[a:b], needs[a:b])], np.int64)
                yield from counted(texts[a:b], owner, key, known)
            release_memory()

    def counted(texts, owner, key, known) -> Iterator[pa.RecordBatch]:
        data, begin, end, opens, of = found_words(texts, owner)
        if len(begin) < size:
            return
        lang_hash, word_hash = hashed([k[0] for k in key])[of], hashes_in(data, begin, end)
        del data, begin, end
        good = np.ones(len(of), bool)
        for k in range(1, size + 1):
            if k > 1:
                good = good[:-1] & good[1:] & ~opens[k - 1 :]
            where = np.flatnonzero(good)
            names = names_of(lang_hash[where], [word_hash[where + i] for i in range(k)])
            if k < size:
                good[where] = held(known[k], names)
        names, of = names.view(np.uint64), of[where]
        for shard, need in sorted({k[1:] for k in key}):
            mine = np.array([k[1:] == (shard, need) for k in key])[of]
            if mine.any():
                some, times = added_up(names[mine])
                for i in range(0, len(some), CHARS):
                    yield rows(shard, need, some[i : i + CHARS], times[i : i + CHARS])

    def rows(shard, need, names, times) -> pa.RecordBatch:
        block = (names >> unused) >> block_bits
        begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        ends = np.append(begin, len(names)).astype(np.int32)
        m = len(begin)
        packed = lambda values, width: pa.BinaryArray.from_buffers(pa.binary(), m, [None, pa.py_buffer(ends * np.int32(width)), pa.py_buffer(values)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[begin].astype(np.int32)),
                pa.array(np.full(m, shard, np.int32)),
                pa.array(np.full(m, need, np.int64)),
                packed(names, 8),
                packed(times.astype(np.int32), 4),
            ],
            names=["block", "shard", "need", "names", "times"],
        )

    return docs.mapInArrow(count, "block int, shard int, need long, names binary, times binary")


def locally_frequent(counts: DataFrame) -> DataFrame:
    """The bitmap's rows (block, bits) of the phrases that a shard holds ``need`` times or more; a task adds up one block at a time."""
    unused = np.uint64(unused_bits(BITS))

    def frequent(table: pa.Table) -> pa.Table:
        parts: dict[tuple, tuple[list, list]] = {}
        for shard, need, names, times in zip(*(table.column(c).to_pylist() for c in ("shard", "need", "names", "times"))):
            some = parts.setdefault((shard, need), ([], []))
            some[0].append(names)
            some[1].append(times)
        bits = np.zeros(BLOCK, bool)
        for (_, need), (names, times) in parts.items():
            name, n = added_up(np.frombuffer(b"".join(names), np.uint64), np.frombuffer(b"".join(times), np.int32).astype(np.int64))
            bits[(name[n >= need] >> unused) & np.uint64(BLOCK - 1)] = True
        block = table.column("block")[:1].combine_chunks()
        return pa.table({"block": block, "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    return counts.groupBy("block").applyInArrow(frequent, "block int, bits binary")


def scan(docs: DataFrame, sizes: list[int], below: dict[int, "object"]) -> DataFrame:
    """Partial counts (lang, shard, size, phrase, n) of the phrases of ``sizes``.

    ``below[k]`` is the broadcast bitmap of the phrases of k words that count:
    a phrase that ``below`` covers must have its bit, and a longer one those of
    its two parts of the longest size covered. Size 0 counts the words of each
    shard; counts of phrases have no shard. ``docs`` is (lang, text, shard).
    """
    top = max(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: b.value for k, b in below.items()}
        for batch in batches:
            names, texts, shard = (batch.column(i).to_pylist() for i in range(3))
            for a, b in text_slices(texts, CHARS):
                key = sorted({(x, s) for x, s in zip(names[a:b], shard[a:b])})
                number = {k: i for i, k in enumerate(key)}
                owner = np.array([number[k] for k in zip(names[a:b], shard[a:b])], np.int64)
                yield from counted(texts[a:b], owner, key, known)
            release_memory()

    def counted(texts, owner, key, known) -> Iterator[pa.RecordBatch]:
        data, begin, end, opens, of = found_words(texts, owner)
        n = len(begin)
        if not n:
            return
        code, vocab = numbered(data, begin, end)
        if known:
            lang_hash, word_hash = hashed([k[0] for k in key])[of], hashes_in(data, begin, end)
        del data, begin, end
        ident = of * len(vocab) + code  # phrases of one word and owner
        good = np.ones(n, bool)
        if 0 in sizes:
            yield rows(0, None, np.bincount(of, minlength=len(key)), np.arange(len(key)), key)
        for k in range(1, top + 1):
            if k > 1:
                if n < k:
                    return
                good = good[:-1] & good[1:] & ~opens[k - 1 :]
                # Two phrases of k - 1 words that overlap in k - 2 make the one of k words.
                ident = np.where(good, ident[:-1] * (ident.max() + 1) + ident[1:], -1)
            ident = pd.factorize(ident)[0].astype(np.int64)
            if k in known:
                where = np.flatnonzero(good)
                good[where] = held(known[k], names_of(lang_hash[where], [word_hash[where + i] for i in range(k)]))
            if k in sizes:
                where = np.flatnonzero(good)
                number, times = np.unique(ident[where], return_counts=True)
                first = np.empty(ident.max() + 1, np.int64)
                first[ident[where]] = where
                at = first[number]
                words = [vocab.take(pa.array(code[at + i])) for i in range(k)]
                yield rows(k, pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())), times, of[at], key)

    def rows(size, phrase, times, of, key) -> pa.RecordBatch:
        names, shard = pa.array([k[0] for k in key], pa.string()), pa.array([k[1] for k in key], pa.int32())
        m = len(times)
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(of)),
                pa.nulls(m, pa.int32()) if size else shard.take(pa.array(of)),
                pa.array(np.full(m, size, np.int32)),
                pa.nulls(m, pa.string()) if phrase is None else phrase.cast(pa.string()),
                pa.array(np.asarray(times, np.int64)),
            ],
            names=["lang", "shard", "size", "phrase", "n"],
        )

    return docs.mapInArrow(count, "lang string, shard int, size int, phrase string, n long")


def summed(partial: DataFrame, *keys: str) -> DataFrame:
    return partial.groupBy(*keys).agg(F.sum("n").alias("n"))


def exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def with_need(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``docs`` with the support of their shard, the least n with n / n_shard >= ``least`` / n_lang; ``words`` is (lang, shard, n)."""
    whole = summed(words, "lang").withColumnRenamed("n", "n_lang")
    need = F.expr(f"cast((cast(n as decimal(20,0)) * {least} + n_lang - 1) div n_lang as long)").alias("need")
    sizes = words.filter("n > 0").join(whole, "lang").select("lang", "shard", need)
    if len(sizes.limit(SIZES + 1).collect()) <= SIZES:  # shards x languages
        sizes = F.broadcast(sizes)
    return docs.join(sizes, ["lang", "shard"], "left").withColumn("need", F.coalesce("need", F.lit(1)))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, shards: int = 4) -> tuple[DataFrame, DataFrame]:
    """Words of each language (lang, n), and every phrase of 1 to ``longest`` words with ``least`` occurrences or more (lang, size, phrase, f)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"), F.col(text).alias("text"), (F.spark_partition_id() % shards).alias("shard"))

    first = settled(summed(scan(rows, [0, 1], {}), "lang", "shard", "size", "phrase").filter(f"size = 0 or n >= {least}"))
    words = first.filter("size = 0").select("lang", "shard", "n")
    below = {1: spark.sparkContext.broadcast(bitmap(named(first.filter("size = 1"))))}
    lengths = list(range(2, longest + 1))
    dealt = with_need(rows, words, least)
    for k in lengths:
        below[k] = spark.sparkContext.broadcast(put_together(locally_frequent(shard_counts(dealt, k, below))))
        drop_unused(spark)
    # Candidates of every length in one scan; what shares a bit or a name with one falls short of the support.
    phrases = first.filter("size = 1").select("lang", "size", "phrase", "n")
    if lengths:
        counts = summed(scan(rows, lengths, below), "lang", "size", "phrase").filter(F.col("n") >= least)
        phrases = settled(phrases.unionByName(counts))
        del counts
        drop_unused(spark)
    return summed(words, "lang"), phrases.select("lang", "size", "phrase", F.col("n").alias("f"))


def words_of(phrase: Column) -> Column:
    return F.split(phrase, " ")


def part(phrase: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words_of(F.col(phrase)), start, length), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with their weakest cut: a, l, r, score."""
    counts = phrases.select("lang", "phrase", "f")
    cuts = (
        phrases.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .withColumn("left", part("phrase", F.lit(1), F.col("k")))
        .withColumn("right", part("phrase", F.col("k") + 1, F.col("size") - F.col("k")))
    )
    for side, name in (("left", "l"), ("right", "r")):
        of = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = splittable_join(cuts, of, ["lang", side])
    share = F.expr("(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * 1000000) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    cuts = cuts.withColumn("score", share)
    best = F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k"))
    return cuts.groupBy("lang", "size", "phrase").agg(best.alias("best")).select("lang", "size", "phrase", "best.*")


def not_contained(found: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """``found`` without phrases that stand inside a longer one with ``percent`` of their occurrences or more."""
    longer = phrases.filter("size > 2")
    start = lambda i, n: F.slice(F.col("w"), i + 1, n)
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(0), F.col("size") - n), lambda i: F.array_join(start(i, n), " ")),
        )
    )
    inside = (
        longer.withColumn("w", words_of(F.col("phrase"))).select("lang", "f", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    )
    joined = found.join(inside, ["lang", "phrase"], "left")
    return joined.filter(F.col("most").isNull() | (exact(F.col("most")) * 100 < exact(F.col("a")) * percent)).drop("most")


def first_of_each(found: DataFrame, top: int, *order: Column) -> DataFrame:
    """The first ``top`` rows of each language with their rank; a language is ranked in parts first."""
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    own = Window.partitionBy("lang", "_salt").orderBy(*order)
    some = salted.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= top).drop("_salt", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, top: int = 2000, inside_percent: int = 50, shards: int = 4
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases inside a longer one that has ``inside_percent`` of their occurrences are left out.
    """
    n, phrases = phrase_counts(docs, text, lang, longest, least, shards)
    found = not_contained(scored(phrases), phrases, inside_percent)
    first = first_of_each(found, top, F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return first.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
