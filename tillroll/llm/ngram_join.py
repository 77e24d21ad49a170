"""N-gram Jaccard self-join with banded MinHash.

Texts are sets of hashed word shingles. Equal sets are one class, which is
compared once. Fixed bands stand in for an LSH forest: there are no tries and no
labels, and nothing is shortened by what the data hold. Every class has
``trees`` bands of as many MinHash values, ``depth`` at most, as the constants
allow for a pair at the threshold to be missed by all bands with a probability
below 1 - ``recall`` (24 bands of 5); classes that share a band are candidates.
Candidates are gathered into components by star
edges, never by all pairs of a bucket, and inside a component exact Jaccard
similarity is computed for all pairs whose sizes allow it, block against block,
by counting common shingles. What leaves a task is, per class, its number of
links and the smallest class it hangs together with.

Component members are cut into blocks of bounded size by set size, so a
component of any size is spread over many tasks; only blocks whose sizes can
reach the threshold meet.

Defined cases: null texts and texts without words are alone and have no links;
a text with fewer words than a shingle is one shingle; shingles are equal when
their 64-bit hashes are; null and repeated keys are compared each; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import release_memory, settled, splittable_join, words

WORDS = 5
SIMILARITY = 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Classes of a block: few while that makes at most ``BLOCKS`` of them, then more, so
#: that rows are not copied to ever more meetings. Shingles of a block at most.
FEW_CLASSES, BLOCK_CLASSES, BLOCKS, BLOCK_SHINGLES = 100, 1500, 64, 1_500_000
MEMO = 300_000


def prefix_length(trees: int, depth: int, similarity: float, recall: float) -> int:
    """The most values of a band, up to ``depth``, with which the bands find a pair at the threshold with the asked probability."""
    for length in range(depth, 1, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    return 1


class Shingles:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, n: int):
        self.n, self.memo = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = words(text)
        if not found:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        for w in set(found):
            if w not in memo:
                memo[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
        size = min(self.n, len(h))
        value = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):
            value = (value ^ h[j : len(h) - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        return np.unique(value)


def minhash(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over the set."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        out = np.minimum(out, (factors[:, None] * shingles[None, at : at + 2048]).min(axis=1))
    return out


def signed(n: int, trees: int, depth: int, prefix: int):
    """Task function: (key, row, text) to key, row, class, size and the hash of each band."""
    factors = np.random.default_rng(5).integers(1, 2**63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    used = factors.reshape(trees, depth)[:, :prefix].ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                names, sizes, keys = [], [], []
                for text in some.column(2).to_pylist():
                    s = shingles(text)
                    sizes.append(len(s))
                    if not len(s):
                        names.append(None)
                        keys.append(None)
                        continue
                    names.append(xxhash.xxh3_128_digest(s.tobytes()))
                    label = minhash(s, used).reshape(trees, prefix)
                    keys.append([xxhash.xxh64_intdigest(x.tobytes(), seed=t) - 2**63 for t, x in enumerate(label)])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["key", "row", "class", "size", "prefixes"],
                )
        del shingles
        release_memory()

    return run


def shingled(n: int):
    """Task function: text to class and shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                raw = [shingles(t).tobytes() for t in batch.column(0).slice(at, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary())], names=["class", "shingles"])
        del shingles
        release_memory()

    return run


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of ``edges`` (a, b).

    Large-star and small-star steps alternate: neighbours are tied to the
    smallest one around until nothing changes. The smallest neighbour is an
    aggregate, so a node with very many neighbours needs no single task.
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        tied = splittable_join(both, low, ["a"])  # a node may have very many neighbours
        out = tied.filter(F.col("b") > F.col("a")) if not small else tied
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return (out.unionByName(low.select("a", F.col("m").alias("b"))) if small else out).filter(F.col("a") != F.col("b")).distinct()

    # An edge points from the larger to the smaller node.
    e = settled(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(most_rounds):
        large = star(e, small=False).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        e = settled(star(large, small=True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def common_counts(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of a, its number of common shingles with every set of b."""
    flat = np.concatenate(sets_b)
    owner = np.repeat(np.arange(len(sets_b)), [len(s) for s in sets_b])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i, s in enumerate(sets_a):
        low, high = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        size = high - low
        at = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        yield i, np.bincount(owner[at], minlength=len(sets_b))


def linker(similarity: float):
    """Task function: rows of two blocks (or one) to each class's links and the smallest class it is linked with."""
    schema = pa.schema([("class", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def linked(rows: pa.Table) -> pa.Table:
        names, copies = rows["class"].to_pylist(), rows["copies"].to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in rows["shingles"]]
        side = rows["side"].to_numpy()
        size = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right) and not rows["meets"][0].as_py()
        if alone:
            right = left
        if not len(left) or not len(right):
            return schema.empty_table()
        links = np.zeros(len(names), np.int64)
        by_name = sorted(range(len(names)), key=names.__getitem__)
        root = np.empty(len(names), np.int64)  # rank of the smallest name that a set hangs together with
        root[by_name] = np.arange(len(names))

        for i, common in common_counts([sets[j] for j in left], [sets[j] for j in right]):
            a = left[i]
            close = right[common * (1 + similarity) >= similarity * (size[a] + size[right]) - 1e-9]
            close = close[close != a]
            if not len(close):
                continue
            links[a] += copies[close].sum()
            if not alone:
                links[close] += copies[a]
            met = np.unique(root[np.append(close, a)])
            if len(met) > 1:
                root[np.isin(root, met)] = met[0]
        some = np.flatnonzero(links)
        return pa.table([pa.array([names[i] for i in some], pa.binary()), pa.array(links[some]), pa.array([names[by_name[root[i]]] for i in some.tolist()], pa.binary())], schema=schema)

    return linked


def links(classes: DataFrame, texts: DataFrame, similarity: float, n: int) -> DataFrame:
    """class, links, root: verified links of ``classes`` (class, copies, row, size, prefixes); ``texts`` has row and text."""
    each = classes.select("class", F.explode("prefixes").alias("bucket"))
    # The band's number is part of its hash, so equal bands are equal buckets.
    shared = each.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter(F.col("low") != F.col("high"))
    stars = splittable_join(each, shared, ["bucket"]).filter(F.col("class") != F.col("low")).select(F.col("class").alias("a"), F.col("low").alias("b"))
    whole = components(stars).withColumnRenamed("node", "class").withColumnRenamed("root", "component")
    members = settled(classes.select("class", "copies", "row", "size").join(whole, "class"))

    # Sizes of sets that can reach the threshold lie in the same or the next step.
    members = members.withColumn("step", F.floor(F.log(F.col("size").cast("double") + 1e-6) / math.log(1 / similarity)).cast("int"))
    held = members.groupBy("component", "step").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    by_classes = F.least(F.col("c") / FEW_CLASSES, F.greatest(F.lit(BLOCKS), F.col("c") / BLOCK_CLASSES))
    blocks = F.ceil(F.greatest(by_classes, F.col("s") / BLOCK_SHINGLES)).cast("int")
    held = held.withColumn("blocks", blocks)
    next_step = Window.partitionBy("component").orderBy("step")  # steps of a component: a few dozen at most
    held = held.withColumn("above", F.when(F.lead("step").over(next_step) == F.col("step") + 1, F.lead("blocks").over(next_step)).otherwise(0))
    held = held.withColumn("below", F.when(F.lag("step").over(next_step) == F.col("step") - 1, F.lag("blocks").over(next_step)).otherwise(0))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")

    def meeting(step, i, other, j, side, meets):
        return F.struct(step.alias("step"), i.alias("i"), other.alias("other"), j.alias("j"), F.lit(side).alias("side"), F.lit(meets).alias("meets"))

    step, b = F.col("step"), F.col("block")
    upto = lambda column: F.filter(F.sequence(F.lit(0), F.greatest(F.col(column) - 1, F.lit(0))), lambda _: F.col(column) > 0)
    meetings = F.concat(
        F.array(meeting(step, b, step, b, 0, False)),
        F.transform(F.filter(upto("blocks"), lambda j: j > b), lambda j: meeting(step, b, step, j, 0, True)),
        F.transform(F.filter(upto("blocks"), lambda j: j < b), lambda j: meeting(step, j, step, b, 1, True)),
        F.transform(upto("above"), lambda j: meeting(step, b, step + 1, j, 0, True)),
        F.transform(upto("below"), lambda j: meeting(step - 1, j, step, b, 1, True)),
    )
    placed = (
        splittable_join(members, held.select("component", "step", "blocks", "above", "below"), ["component", "step"])
        .withColumn("block", block).withColumn("meeting", F.explode(meetings))
        .select("class", "copies", "component", F.col("meeting.*"))
    )
    sets = (
        texts.join(members.select("row").distinct(), "row", "left_semi").select("text")
        .mapInArrow(shingled(n), "class binary, shingles binary").dropDuplicates(["class"])
    )
    return (
        placed.join(sets, "class").groupBy("component", "step", "i", "other", "j")
        .applyInArrow(linker(similarity), "class binary, links long, root binary")
    )


def row_key(key: str, text: str):
    """Equal for rows with equal key and text."""
    return F.xxhash64(F.col(key), F.col(text))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, n: int = WORDS,
    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
) -> DataFrame:
    """One row per document: key, row (a hash of key and text), copies_id, class_id, keeper, n_links.

    ``copies_id`` and ``class_id`` are the smallest keys among the documents
    with an equal shingle set and among those linked directly or in a chain;
    ``n_links`` counts the other documents at the similarity or above, equal
    ones included; ``keeper`` tells the row of the class that should stay.
    Documents without words have their own key, and all of them are keepers.
    """
    source = docs.select(F.col(key).alias("key"), row_key(key, text).alias("row"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    prefix = prefix_length(trees, depth, similarity, recall)
    signatures = settled(source.mapInArrow(
        signed(n, trees, depth, prefix), f"key {kind}, row long, class binary, size int, prefixes array<long>"
    ))
    first = F.struct(F.col("key").isNull().alias("unnamed"), F.col("key").alias("key"), F.col("row").alias("row"))
    classes = settled(signatures.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.count("*").alias("copies"), F.min(first).alias("first"), F.max("size").alias("size"), F.min("prefixes").alias("prefixes")
    ).withColumn("row", F.col("first.row")))
    found = settled(links(classes, source.select("row", "text"), similarity, n))
    count = found.groupBy("class").agg(F.sum("links").alias("links"))
    chains = components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    grouped = classes.select("class", "copies", "first").join(chains, "class", "left").join(count, "class", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "class"))
    best = grouped.groupBy("root").agg(F.min("first").alias("best"))
    grouped = splittable_join(grouped, best, ["root"]).select(
        "class", F.col("first.key").alias("copies_id"), F.col("best.key").alias("class_id"), F.col("best.row").alias("kept_row"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return (
        signatures.select("key", "row", "class").join(grouped, "class", "left")
        .select(
            F.col("key").alias(key), "row",
            F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("copies_id")).alias("copies_id"),
            F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
            (F.col("class").isNull() | (F.col("kept_row") == F.col("row"))).alias("keeper"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class; rows equal in key and text count as one document, unless they have no words."""
    found = near_duplicates(docs, key, text, **options)
    keep = found.filter("keeper").groupBy("row").agg(F.count("*").alias("times"), F.max(F.col("n_links") > 0).alias("linked"))
    rows = splittable_join(docs.select(row_key(key, text).alias("row"), F.struct(*docs.columns).alias("doc")), keep, ["row"])
    again = (F.col("times") > 1) & F.col("linked")
    return rows.filter(~again).unionByName(rows.filter(again).dropDuplicates(["row"])).select("doc.*")
