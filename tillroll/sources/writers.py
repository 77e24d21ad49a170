"""Sinks: Parquet (plain and guarded), audit JSON, CSV preview, and the audit
path next to a data path."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse, urlunparse

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.readers import CSV_QUOTING


def save_parquet(df: DataFrame, path: str) -> None:
    """Overwrite ``path``. The write goes through Spark's commit protocol, so
    a lost executor only re-runs its tasks and a re-run job replaces the
    output instead of appending to it. (For lines by month, see
    :mod:`tillroll.sources.layouts`.)"""
    df.write.mode("overwrite").parquet(path)


def save_all(results: list[tuple[DataFrame, str]]) -> None:
    """Overwrite several paths, none of them before all frames are written.

    Each frame goes to a folder beside its path; then the folders are renamed.
    A failing write leaves every path as it was. The renames are quick but
    separate: for one atomic step, see :mod:`tillroll.sources.publication`.
    """
    if not results:
        return
    spark = results[0][0].sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    tag = uuid.uuid4().hex[:12]
    staged = [(path.rstrip("/"), f"{path.rstrip('/')}.staged-{tag}") for _, path in results]
    conf = spark._jsc.hadoopConfiguration()
    try:
        for (df, _), (_, beside) in zip(results, staged):
            df.write.parquet(beside)
        for path, beside in staged:
            system = path_of(path).getFileSystem(conf)
            system.delete(path_of(path), True)
            if not system.rename(path_of(beside), path_of(path)):
                raise OSError(f"cannot rename {beside} to {path}")
    finally:
        for path, beside in staged:
            path_of(beside).getFileSystem(conf).delete(path_of(beside), True)


def save_parquet_guarded(df: DataFrame, path: str) -> None:
    """As :func:`save_parquet`, but an empty frame is an error and leaves
    ``path`` as it was. The frame is computed once, by its write to a folder
    beside ``path``; what was written is checked, then renamed."""
    spark, path = df.sparkSession, path.rstrip("/")
    beside = f"{path}.staged-{uuid.uuid4().hex[:12]}"
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(beside)
        if spark.read.schema(df.schema).parquet(beside).isEmpty():
            raise ValueError("the frame to save is empty; run the pipeline first")
        system.delete(path_of(path), True)
        if not system.rename(path_of(beside), path_of(path)):
            raise OSError(f"cannot rename {beside} to {path}")
    finally:
        system.delete(path_of(beside), True)


@contextmanager
def unsorted_write(spark: SparkSession, folders: int) -> Iterator[None]:
    """For a partitioned write to at most ``folders`` folders: a task keeps a file
    open in each instead of holding and sorting its rows by folder first. (When
    as many files are open as allowed, Spark sorts the rest; hence one more.)"""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(folders + 1, int(before or 0))))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def save_audit(df: DataFrame, path: str) -> None:
    """Overwrite a JSON-lines audit table (a few rows: one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV files, each with a header; a field with a
    comma, quote or line feed is quoted and its quotes are doubled, as other
    CSV readers expect. Blanks around a text stay."""
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(header="true", **CSV_QUOTING, **spaces).csv(path)


def export_csv_preview(df: DataFrame, path: str, n: int = 10) -> None:
    """First ``n`` rows as one CSV file with a header."""
    save_csv(df.limit(n).coalesce(1), path)


def audit_path(data_path: str, marker: str, job: str) -> str:
    """Audit folder beside a data folder: ``.../<marker>`` becomes
    ``.../debug_counts_<job>``, any other path gets ``_debug_<job>``. The URI
    scheme and authority are kept."""
    parsed = urlparse(data_path)
    path = parsed.path.rstrip("/")
    if path.endswith("/" + marker):
        path = path[: -len(marker) - 1] + f"/debug_counts_{job}"
    else:
        path = path + f"_debug_{job}"
    return urlunparse(parsed._replace(path=path + "/"))
