"""Nearest neighbours by learned partitions.

A bounded sample of the vectors gets an exact neighbour graph; the graph is cut
into balanced parts with few neighbours torn apart; a softmax classifier learns
the part of a vector from the vector. Every row is indexed under its most
probable part; a query goes to its several most probable parts (as many as
recover ``target`` of the sample's true neighbours) and all rows there are
ranked by exact inner product in double precision. A row leaves its task only
if it can be among the best: as many rows of the sample score no less. Of rows
with equal scores those with the smallest ids stay, however many they are.

Equal vectors are one class: it is ranked once and stands for its smallest ids,
as many as a result can hold, so a vector with very many copies costs no more
than another. Parts are worked on in blocks of bounded numbers of classes and
queries.

Defined cases: vectors that are null, zero, hold null or non-finite components,
or differ in length from most take no part, as do rows without id; a repeated
row counts once; ties go to the smaller id; with fewer candidates than asked
for all are returned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import settled

#: Vectors that the graph and the classifier are fitted on, at most.
SAMPLE = 8192
#: Rows of a part that are worth a part of their own (two parts at least); parts at most.
PART_ROWS, MOST_PARTS = 1500, 96
#: Classes and queries that one task compares at a time.
BLOCK, QUERIES = 8192, 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row by inner product."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, x: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 8) -> np.ndarray:
    """A part for each vertex, none with over ``slack`` times the mean, few edges torn.

    Parts grow from far-apart seeds; then each vertex moves to the part with
    most of its neighbours that still has room, round after round.
    """
    n = len(graph)
    room = math.ceil(slack * n / parts)
    rng = np.random.default_rng(11)
    seeds = [int(rng.integers(n))]
    nearest = x @ x[seeds[0]]
    for _ in range(parts - 1):
        seeds.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[seeds[-1]])
    like = x @ x[seeds].T
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for v in np.argsort(-like.max(axis=1), kind="stable"):
        p = int(np.argmax(np.where(size < room, like[v], -np.inf)))
        part[v] = p
        size[p] += 1
    both = [[] for _ in range(n)]
    for v, row in enumerate(graph.tolist()):
        both[v].extend(row)
        for u in row:
            both[u].append(v)
    both = [np.array(b) for b in both]
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n).tolist():
            held = np.bincount(part[both[v]], minlength=parts)
            held[size >= room] = np.where(np.arange(parts) == part[v], held, -1)[size >= room]
            p = int(held.argmax())
            if held[p] > held[part[v]]:
                size[part[v]] -= 1
                size[p] += 1
                part[v] = p
                moved += 1
        if moved < n // 200:
            break
    return part


class Router:
    """Softmax classifier over parts; vectors are lifted so that inner products become angles."""

    def __init__(self, longest: float, weights: np.ndarray, probes: int, sample: np.ndarray, k: int):
        self.longest, self.weights, self.probes, self.sample, self.k = longest, weights, probes, sample, k
        self.part = self.order(sample, query=False)[:, 0]

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        return lifted(x, self.longest, query)

    def order(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Parts from the most to the least probable one."""
        return np.argsort(-(self.lifted(x, query) @ self.weights), axis=1, kind="stable")


    def least(self, x: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """A score that each query's k-th best row in its parts reaches, as k rows of the sample in them do."""
        if len(self.sample) < self.k:
            return np.full(len(x), -np.inf)
        asked = np.zeros((len(x), self.weights.shape[1]), bool)
        np.put_along_axis(asked, parts, True, axis=1)
        scores = np.where(asked[:, self.part], x @ self.sample.T, -np.inf)
        least = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
        return least - rounding(np.linalg.norm(x, axis=1), self.longest)


def lifted(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Unit vectors: rows get a coordinate that fills them up to the longest one, queries a zero; then a constant."""
    norm = np.linalg.norm(x, axis=1)
    if query:
        y = np.column_stack([x / norm[:, None], np.zeros(len(x))])
    else:
        y = np.column_stack([x / longest, np.sqrt(np.maximum(0, 1 - np.minimum(1, norm / longest) ** 2))])
    return np.column_stack([y, np.ones(len(x))])


def softmax_fit(y: np.ndarray, part: np.ndarray, parts: int, steps: int = 250, rate: float = 0.1) -> np.ndarray:
    """Weights of a multinomial logistic regression, by Adam on the whole sample."""
    w, m, v = (np.zeros((y.shape[1], parts)) for _ in range(3))
    goal = np.eye(parts)[part]
    for t in range(1, steps + 1):
        z = y @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = y.T @ (p - goal) / len(y) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def fit_router(sample: np.ndarray, parts: int, k: int, target: float) -> Router:
    """Partition the sample's neighbour graph, learn it, and find how many parts a query needs."""
    longest = float(np.linalg.norm(sample, axis=1).max())
    y = lifted(sample, longest, False)
    parts = max(1, min(parts, len(sample) // (4 * k) or 1))
    if parts == 1:
        return Router(longest, np.zeros((y.shape[1], 1)), 1, sample, k + 1)
    graph = neighbour_graph(y[:, :-1], min(k // 2, len(sample) - 1))
    part = balanced_parts(graph, y[:, :-1], parts)
    router = Router(longest, softmax_fit(y, part, parts), parts, sample, k + 1)
    own = router.part
    asked = sample[:1000]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    place = np.argsort(router.order(asked, query=True), axis=1)  # of each part in the query's order
    needed = np.take_along_axis(place, own[near], axis=1)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    # One part more than the sample needs: the whole table is denser than the sample.
    router.probes = min(parts, int(np.searchsorted(found, target)) + 2)
    return router


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    # A negative zero equals zero; with it, equal vectors are equal arrays.
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (sizes["n"] if sizes else 0))


def rounding(query: np.ndarray, longest: float) -> np.ndarray:
    """By how much inner products summed in different orders can differ, from the lengths of the vectors; generously."""
    return 1e-12 * query * longest


def first(query: np.ndarray, score: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` largest scores, the smaller number first among equal ones."""
    order = np.lexsort((number, -score, query))
    of = query[order]
    return order[np.arange(len(of)) - np.searchsorted(of, of) < k]


def comparer(k: int):
    """Task function: the ``k`` best (query, id, score) of a block of classes and a block of queries."""

    def matrix(column) -> np.ndarray:
        column = column.combine_chunks()
        flat = column.values if isinstance(column, pa.ListArray) else column.flatten()
        return np.asarray(flat).reshape(len(column), -1)

    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def compared(key, classes: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(classes) or not len(queries):
            return schema.empty_table()
        x, ids = matrix(classes["v"]), classes["ids"].to_pylist()
        q, names, least = matrix(queries["v"]), queries["query"].to_numpy(), queries["least"].to_numpy()
        smallest = np.array([own[0] for own in ids], np.int64)
        size = np.array([len(own) for own in ids])
        flat, start = np.concatenate([np.asarray(own, np.int64) for own in ids]), np.cumsum(size) - size
        room = rounding(np.linalg.norm(q, axis=1), float(np.linalg.norm(x, axis=1).max()))
        out = []
        take = min(k, len(x))
        for a in range(0, len(q), 256):
            scores = q[a : a + 256] @ x.T
            # Every class that reaches the last place: of equal scores the smaller ids count, not the places here.
            last = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
            at_q, at_c = np.nonzero(scores >= (np.maximum(last, least[a : a + 256]) - room[a : a + 256])[:, None])
            at_q += a
            # Each pair alone, so that its score does not depend on the block.
            score = np.concatenate([np.empty(0), *((q[at_q[i : i + 50_000]] * x[at_c[i : i + 50_000]]).sum(axis=1) for i in range(0, len(at_q), 50_000))])
            some = first(at_q, score, smallest[at_c], k)  # classes that can hold one of the k best ids
            at_q, at_c, score = at_q[some], at_c[some], score[some]
            n = size[at_c]
            at_q, score = np.repeat(at_q, n), np.repeat(score, n)
            own = flat[np.arange(n.sum()) + np.repeat(start[at_c] - (np.cumsum(n) - n), n)]
            some = first(at_q, score, own, k)
            out.append((names[at_q[some]], own[some], score[some]))
        return pa.table([pa.array(np.concatenate(column)) for column in zip(*out)], schema=schema)

    return compared


def routed(rows: DataFrame, router: Router, probes: int, query: bool) -> DataFrame:
    """``rows`` once for each of its ``probes`` most probable parts, as ``part``;
    queries with ``least``, the score below which a row is none of the best."""
    extra = [T.StructField("part", T.IntegerType())] + [T.StructField("least", T.DoubleType())] * query

    def route(batches):
        for batch in batches:
            x = np.array(batch.column(batch.schema.get_field_index("v")).to_pylist(), float)
            for a in range(0, len(x), 256):
                parts = router.order(x[a : a + 256], query)[:, :probes]
                at = np.repeat(np.arange(len(parts)), parts.shape[1])
                some = batch.slice(a, 256).take(pa.array(at)).append_column("part", pa.array(parts.ravel().astype(np.int32)))
                if query:
                    some = some.append_column("least", pa.array(router.least(x[a : a + 256], parts)[at]))
                yield some

    return rows.mapInArrow(route, T.StructType(rows.schema.fields + extra))


def nearest(rows: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", target: float = 0.98) -> DataFrame:
    """The ``k`` rows of the largest inner product for each row that meets ``is_query`` (a function of the id column)."""
    spark = rows.sparkSession
    rows = usable(rows, vec_id, vector).distinct()
    keep = Window.partitionBy("v").orderBy("id")
    classes = (
        rows.withColumn("nth", F.row_number().over(keep)).filter(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))  # at most k + 1 of a class
    )
    classes = settled(classes.withColumn("query", F.col("ids")[0]))
    n = classes.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = classes.orderBy(F.xxhash64("query"), "query").limit(SAMPLE).select("v").collect()  # SAMPLE vectors at most
    router = fit_router(np.array([r["v"] for r in sample]), min(MOST_PARTS, max(2, n // PART_ROWS)), k, target)

    asking = rows.filter(is_query(F.col("id")))
    # Which class a query belongs to: its vector's, by the vector itself.
    asking = settled(asking.join(classes.select("v", "query"), "v").select(F.col("id").alias("query_id"), "query"))
    queries = routed(classes.join(asking.select("query").distinct(), "query", "left_semi").select("query", "v"), router, router.probes, True)
    index = routed(classes.select("query", "ids", "v"), router, 1, False)

    held = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asked = queries.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("groups"))
    sizes = F.broadcast(held.join(asked, "part"))  # MOST_PARTS rows at most
    index = (
        index.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")))
        .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    )
    queries = (
        queries.join(sizes, "part").withColumn("group", F.pmod(F.xxhash64("query"), F.col("groups")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    )
    key = ["part", "block", "group"]
    pairs = (
        index.select(*key, "ids", "v").groupBy(*key)
        .cogroup(queries.select(*key, "query", "v", "least").groupBy(*key))
        .applyInArrow(comparer(k + 1), "query long, id long, score double")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = pairs.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    lists = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda r: r["id"] != F.col("query_id")), 1, k)
    return (
        asking.join(lists, "query")
        .select("query_id", F.posexplode(others).alias("at", "r"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.id").alias("vec_id"), F.col("r.score").alias("score"))
    )
