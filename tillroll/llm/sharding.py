"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of the ring. A row hashes to a place on the
ring and goes to the next point clockwise; rows that find that point's shard
full continue clockwise to the next shard with room. Room is the exact share:
with n rows over s shards, n mod s shards (those whose first point comes first)
hold one row more than the others, so all rows fit and counts differ by one at
most.

Only the number of rows per arc, ``virtual`` x shards figures, reaches the
driver, where the arcs' surplus is carried clockwise. A row finds its shard by
its rank within its arc. Ranks come from counts of fine cells of the arc, of
about ``cell_rows`` rows each, and a window inside a cell.

Defined cases: null keys hash like any value; equal keys with different texts
get different places; equal rows (same key and tie columns) are interchangeable
and are first counted, then dealt to consecutive ranks; an empty table gives no
rows; other columns pass through under any name, clashing names of the output are
replaced.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import settled


#: Points of a shard on the ring. More points make the arcs' shares more even, so that fewer
#: rows walk on when shards are added; the arcs' counts, virtual x shards figures, reach the driver.
VIRTUAL = 256
#: Pieces of the ring among which a row's next point is looked up.
CUTS = 4096
#: Copies of a row that one task gives back.
COPIES = 10_000


def ring(shards: int, virtual: int) -> list[tuple[float, int]]:
    """The ring's points as (place in [0, 1), shard), clockwise."""
    def place(shard: int, v: int) -> float:
        return int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:6], "big") / 2.0**48

    return sorted((place(s, v), s) for s in range(shards) for v in range(virtual))


def dealt(points: list[tuple[float, int]], counts: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) for the rows of each arc.

    Every arc's rows go to its own shard as far as there is room, arcs
    clockwise; then the surplus of each arc walks on clockwise.
    """
    first = {}
    for place, s in points:
        first.setdefault(s, place)
    total = sum(counts)
    rank = {s: i for i, s in enumerate(sorted(first, key=first.get))}
    room = [total // shards + (rank[s] < total % shards) for s in range(shards)]
    used = [0] * shards
    taken = [0] * len(points)
    out = []

    def take(arc: int, shard: int) -> None:
        n = min(counts[arc] - taken[arc], room[shard] - used[shard])
        if n > 0:
            out.append((arc, taken[arc], taken[arc] + n, shard, used[shard]))
            taken[arc] += n
            used[shard] += n

    for arc, (_, s) in enumerate(points):
        take(arc, s)
    for arc in range(len(points)):
        for step in range(1, len(points)):
            if taken[arc] == counts[arc]:
                break
            take(arc, points[(arc + step) % len(points)][1])
    return out


def assign(
    rows: DataFrame, key: list[str], tie: list[str], shards: int = 8, virtual: int = VIRTUAL, cell_rows: int = 1_000
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``key`` gives the place on the ring; ``tie`` names the other columns that
    tell rows apart. ``rows`` should be narrow: join texts to the result.
    """
    rows = rows.drop("shard", "slot")
    points = ring(shards, virtual)
    place = F.pmod(F.xxhash64(*key, *tie), F.lit(1 << 48)).cast("double") / F.lit(float(1 << 48))
    # Equal rows are counted before they move, then given back as many times. The row
    # travels as one column, so that its names cannot clash.
    equal = rows.select(F.struct(*rows.columns).alias("row"), place.alias("place")).groupBy("row", "place").agg(F.count("*").alias("n"))
    equal = settled(with_arc(equal, points))
    total = equal.agg(F.sum("n")).first()[0] or 0
    cells = max(1, math.ceil(total / cell_rows))
    equal = equal.withColumn("cell", F.floor(F.col("place") * cells).cast("long"))
    held = equal.groupBy("arc", "cell").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    held = settled(held.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))))
    counts = [0] * len(points)
    for r in held.groupBy("arc").agg(F.sum("held").alias("n")).collect():  # at most one row per point
        counts[r["arc"]] = r["n"]
    spans = dealt(points, counts, shards)
    deal = rows.sparkSession.createDataFrame(spans or [], "arc int, begin long, end long, shard int, first long")  # at most points x shards rows
    order = ["place", *(F.col("row")[c] for c in (*key, *tie))]
    inside = Window.partitionBy("arc", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        equal.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(held.select("arc", "cell", "before"), ["arc", "cell"])
        .withColumn("rank", F.col("before") + F.col("within"))
    )
    low, high = F.greatest("rank", "begin"), F.least(F.col("rank") + F.col("n"), F.col("end"))
    placed = ranked.join(F.broadcast(deal), "arc").select("row", "shard", (F.col("first") - F.col("begin")).alias("shift"), low.alias("low"), high.alias("high"))
    few = placed.filter((F.col("low") < F.col("high")) & (F.col("high") - F.col("low") <= COPIES))
    many = placed.filter(F.col("high") - F.col("low") > COPIES)
    # Copies beyond that are given back by several tasks, in pieces.
    pieces = many.withColumn("low", F.explode(F.sequence("low", F.col("high") - 1, F.lit(COPIES))))
    pieces = pieces.withColumn("high", F.least("high", F.col("low") + COPIES)).repartition("shard", "low")
    return few.unionByName(pieces).withColumn("each", F.explode(F.sequence("low", F.col("high") - 1))).select("row.*", "shard", (F.col("shift") + F.col("each")).alias("slot"))


def with_arc(rows: DataFrame, points: list[tuple[float, int]]) -> DataFrame:
    """``rows`` with the number of the next point clockwise of their ``place``: beyond the last one it is the first.

    The ring is cut into ``CUTS`` pieces, and a row looks only at its piece's points.
    """
    at = [p for p, _ in points]
    edges = [bisect.bisect_left(at, i / CUTS) for i in range(CUTS + 1)]
    cuts = [(i, edges[i], at[edges[i] : edges[i + 1]]) for i in range(CUTS)]
    table = rows.sparkSession.createDataFrame(cuts, "cut int, lower int, points array<double>")
    near = F.col("lower") + F.size(F.filter("points", lambda p: p < F.col("place")))
    joined = rows.withColumn("cut", F.floor(F.col("place") * CUTS).cast("int")).join(F.broadcast(table), "cut")  # CUTS rows and the ring's points
    return joined.withColumn("arc", F.when(near == len(points), 0).otherwise(near).cast("int")).drop("cut", "lower", "points")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
