"""Results that are published together.

A run claims a number, writes all its results under ``versions/<number>`` and
then creates the empty file ``commits/<number>``: the one step that makes them
visible. Readers take the greatest committed number, so they see either all
results of a run or none of them; a run that fails leaves the earlier version
as it is. Creating an empty file is atomic on every store that Spark writes to,
and no rename is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.sources.readers import load_parquet
from tillroll.sources.writers import save_parquet

#: Committed versions that stay readable; older ones are removed by the next run.
KEPT = 2


class _Store:
    """The few file operations, through Spark's own Hadoop file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self.path("/".join([self.root, *parts]))

    def numbers(self, folder: str) -> list[int]:
        """The numbered entries of a folder, rising; there are few."""
        if not self.fs.exists(self.at(folder)):
            return []
        return sorted(int(s.getPath().getName()) for s in self.fs.listStatus(self.at(folder)) if s.getPath().getName().isdigit())

    def create(self, folder: str, number: int) -> bool:
        """Whether the empty file is new; of several callers one gets True."""
        return self.fs.createNewFile(self.at(folder, f"{number:012d}"))

    def remove(self, folder: str, number: int) -> None:
        self.fs.delete(self.at(folder, f"{number:012d}"), True)


def claimed(store: _Store) -> int:
    """The next number that no other run has."""
    number = max([0, *store.numbers("claims"), *store.numbers("commits")]) + 1
    while not store.create("claims", number):
        number += 1
    return number


def version_path(root: str, number: int, name: str) -> str:
    return f"{root.rstrip('/')}/versions/{number:012d}/{name}"


def published_version(spark: SparkSession, root: str) -> int | None:
    """The number of the version that readers see; None before the first one."""
    return max(_Store(spark, root).numbers("commits"), default=None)


def publish(spark: SparkSession, root: str, results: Mapping[str, DataFrame], keep: int = KEPT) -> int:
    """Write all ``results`` and commit them as one version; its number.

    When a write fails, nothing is committed and the error goes on to the
    caller. Afterwards versions below the ``keep`` latest committed ones go,
    failed ones among them; a run that still writes has a greater number than
    any of these, or loses to a later one and may be removed.
    """
    store = _Store(spark, root)
    number = claimed(store)
    for name, df in results.items():
        save_parquet(df, version_path(root, number, name))
    store.create("commits", number)
    committed = store.numbers("commits")
    for old in set(store.numbers("claims")) | set(committed):
        if old < committed[-min(keep, len(committed))]:
            # First the commit, so that no reader is sent to a version that is going.
            for folder in ("commits", "versions", "claims"):
                store.remove(folder, old)
    return number


def load_published(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """One result of the published version, or of a committed ``version``.

    To read several results of the same run, take :func:`published_version`
    once and pass it.
    """
    store = _Store(spark, root)
    committed = store.numbers("commits")
    number = version if version is not None else max(committed, default=None)
    if number is None or number not in committed:
        raise FileNotFoundError(f"{root} has no published version{'' if number is None else f' {number}'}")
    return load_parquet(spark, version_path(root, number, name), schema)
