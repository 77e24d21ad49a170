"""Sources: catalog tables, Parquet, CSV with header, optional inputs,
result folders and in-memory audit rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import normalize_headers
from tillroll.schemas import AUDIT
from tillroll.sources.footers import listed_files

CATALOG_PREFIX = "catalog:"

#: A quote inside a quoted field is doubled, and such a field may hold line feeds.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def load_catalog_table(spark: SparkSession, table_name: str, database: str | None = None) -> DataFrame:
    """A table registered in the session catalog (Hive metastore or other)."""
    return spark.table(f"{database}.{table_name}" if database else table_name)


def conform(df: DataFrame, schema: T.StructType, source: str) -> DataFrame:
    """The columns of ``schema`` from ``df``, found by name whatever the header's
    case and padding, and cast; text that does not fit a type becomes null.
    Other columns are left out; an absent column is an error."""
    named = normalize_headers(df, schema.names)
    absent = [c for c in schema.names if c not in named.columns]
    if absent:
        raise ValueError(f"{source} lacks the columns {absent}; it has {df.columns}")
    return named.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields))


def load_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with the file's own types; with a schema, checked and cast to it."""
    df = spark.read.parquet(path)
    return df if schema is None else conform(df, schema, path)


def csv_reader(spark: SparkSession, multiline: bool = True):
    """Reader of CSV with a header row and quoted fields.

    With ``multiline`` a quoted field may hold line feeds; a file is then read
    by one task from its beginning, so large exports should come as many files.
    Without it Spark splits files, and a line feed always ends a row. Where
    rows end with CR LF, one inside a field is read as a line feed.
    """
    return spark.read.options(header="true", multiLine=str(multiline).lower(), **CSV_QUOTING)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = True) -> DataFrame:
    """CSV with a header row, read as text (no inference pass over the data);
    quoted fields may hold commas, doubled quotes and line feeds, and an empty
    field is null, quoted or not. With a
    schema, columns are selected by their header and cast; see
    :mod:`tillroll.sources.quarantine` for rows that do not fit."""
    df = csv_reader(spark, multiline).csv(path)
    return df if schema is None else conform(df, schema, path)


def load_source(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """``catalog:db.table``, a ``.csv`` path, or Parquet otherwise."""
    if source.startswith(CATALOG_PREFIX):
        df = load_catalog_table(spark, source[len(CATALOG_PREFIX):])
        return df if schema is None else conform(df, schema, source)
    if source.lower().rstrip("/").endswith(".csv"):
        return load_csv(spark, source, schema)
    return load_parquet(spark, source, schema)


def load_optional(spark: SparkSession, source: str | None, schema: T.StructType | None = None) -> DataFrame | None:
    """The source, or None when no source is given or the path is missing
    (callers skip the results that need it)."""
    if not source:
        return None
    try:
        df = load_source(spark, source, schema)
        df.schema  # resolves the path
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "TABLE_OR_VIEW_NOT_FOUND" in str(exc):
            return None
        raise


def load_result_dir(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files under ``folder`` (sub-folders included); an error
    when there are none."""
    if listed_files(spark, folder, recursive=True).isEmpty():
        raise FileNotFoundError(f"no parquet in {folder}")
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(folder)
    return df if schema is None else conform(df, schema, folder)


def audit_frame(spark: SparkSession, rows: Iterable[tuple[str, int]]) -> DataFrame:
    """Small (step, row_count) table from driver-side counters."""
    return spark.createDataFrame([(s, int(n)) for s, n in rows], AUDIT)
