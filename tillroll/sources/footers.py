"""Footers of Parquet files, read by tasks.

The file list comes from Spark's listing and stays distributed; each task opens
the files that it was dealt and reads their last bytes only. Stores that
pyarrow's file systems open (``OPENED``) are read that way; a file in another
store is read through Spark's own binary reader, as a whole and up to 2 GB.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need pyarrow, not an installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Schemes that pyarrow opens itself.
OPENED = ("", "file", "hdfs", "s3", "s3a", "gs")
#: Footers that a task fetches at once: the wait is the store's answer, not work.
AT_ONCE = 16

FOOTER = "path string, file_bytes long, modificationTime timestamp, columns string, schema_sha256 string, num_rows long, row_groups int"


def listed_files(spark: SparkSession, folder: str, recursive: bool = False, *more: str) -> DataFrame:
    """(path, length, modificationTime, ``more``) of the Parquet files of a folder, from Spark's own listing."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", "length", "modificationTime", *more)


def described(metadata) -> tuple[str, str, int, int]:
    """Column list, fingerprint of names and types, rows and row groups of a footer."""
    schema = metadata.schema.to_arrow_schema()
    kinds = "\n".join(f"{f.name}:{f.type}" for f in schema)
    return ",".join(schema.names), hashlib.sha256(kinds.encode()).hexdigest(), metadata.num_rows, metadata.num_row_groups


def footer(path: str) -> tuple[str, str, int, int]:
    """As :func:`described`, of a file that pyarrow opens."""
    import pyarrow.fs
    import pyarrow.parquet

    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        system, name = pyarrow.fs.LocalFileSystem(), path.removeprefix("file:")
    else:
        system, name = pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with system.open_input_file(name) as file:
        return described(pyarrow.parquet.read_metadata(file))


def read_footers(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """One row per Parquet file of ``folder``: ``FOOTER``. No call per file is made on the driver."""
    opened = urlparse(folder).scheme in OPENED

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for batch in batches:
                if opened:
                    found = list(pool.map(footer, batch.column(0).to_pylist()))
                else:
                    found = [described(pyarrow.parquet.read_metadata(pa.BufferReader(c.as_buffer()))) for c in batch.column(3)]
                columns, sha, rows, groups = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), batch.column(2), pa.array(columns, pa.string()), pa.array(sha, pa.string()),
                        pa.array(rows, pa.int64()), pa.array(groups, pa.int32()),
                    ],
                    names=["path", "file_bytes", "modificationTime", "columns", "schema_sha256", "num_rows", "row_groups"],
                )

    files = listed_files(spark, folder, recursive, *(() if opened else ("content",)))
    return files.mapInArrow(read, FOOTER)


def plain_path(path: str) -> Column:
    """A local path without its scheme."""
    return F.regexp_replace(path, "^file:/+", "/")
