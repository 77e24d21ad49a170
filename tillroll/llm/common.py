"""Small helpers that several operators share."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tillroll.session import shared_dir

#: ASCII-lower-cased UTF-8 bytes that form a word: digits, a-z and every
#: non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, everything else as it is."""
    return WORD.findall(text.encode("utf-8").lower()) if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    Later stages read the kept rows, also after an executor was lost.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_unused(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nobody holds any more.

    Its cleaner waits for the driver's garbage collector, which may not run
    for half an hour; an operator of several passes asks for it in between.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def splittable_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join whose hot keys adaptive execution can split.

    It splits a join only where both sides come through a shuffle that the
    planner added; an aggregate's result would be joined as it lies. The hash
    of the keys in the condition adds no selectivity, but brings about both.
    """
    h = F.xxhash64(*keys).alias("_h")
    return left.select("*", h).join(right.select("*", h), [*keys, "_h"]).drop("_h")


def release_memory() -> None:
    """Give what a task has freed back to the system: its worker lives on beside the next ones."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def text_slices(texts: list[str | None], most_chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold about ``most_chars`` characters, one text at least."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text) if text else 0
        if held >= most_chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by doubling the compared length until all suffixes differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        key = rank * (n + 1)
        key[: n - length] += rank[length:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        length *= 2
        if length >= n:
            return order
