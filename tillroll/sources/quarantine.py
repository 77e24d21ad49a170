"""CSV ingestion that keeps every record: accepted with its types, or rejected
with the reason.

A record is rejected when it has more or fewer fields than the header, or when
a field does not fit the type of its column. One pass parses the files once and
writes both kinds; each record of the input stands in exactly one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import WHOLE_NUMBER, normalize_headers
from tillroll.sources.readers import CSV_QUOTING, csv_reader
from tillroll.sources.writers import unsorted_write

MALFORMED = "_malformed_record"
#: What a rejected record carries besides the fields that could be read.
REASON, RECORD, SOURCE = "reject_reason", "reject_record", "reject_file"
REJECTED = "rejected"
#: Text that may be a number: digits with a point, an exponent or a type letter, or a word for one.
NUMBER = r"(?i)^[\x00-\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+|inf|infinity|nan)(e[+-]?[0-9]+)?[df]?[\x00-\x20]*$"


@dataclass(frozen=True)
class IngestCounts:
    accepted: int
    rejected: int


def header_of(spark: SparkSession, path: str, multiline: bool = True) -> list[str]:
    """Column names of the first file's header row, as Spark names them."""
    return csv_reader(spark, multiline).csv(path).columns


def _typed(text: Column, kind: T.DataType) -> Column:
    """A field as its type, or null. Text that cannot fit is not tried: a failed
    cast costs an exception inside the task, a regex miss does not."""
    if isinstance(kind, T.IntegralType):
        return F.when(text.rlike(WHOLE_NUMBER), text.try_cast(kind))
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DatetimeType)):
        likely = "[0-9]" if isinstance(kind, T.DatetimeType) else NUMBER
        return F.when(text.rlike(likely), text.try_cast(kind))
    return text.try_cast(kind)


def _misfit(text: Column, kind: T.DataType, name: str) -> Column:
    """Why a field does not fit, else null. A missing field fits every type."""
    said = F.concat(F.lit(f"{name} is no {kind.simpleString()}: "), text)
    return F.when(text.isNotNull() & _typed(text, kind).isNull(), said)


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """All records of the CSV files: the columns of ``schema``, then reason,
    record and file, which are null for accepted records.

    Columns are found by header, whatever its case and padding; all files must
    have the first file's header (Spark checks each one). An absent column is
    an error. Fields that do not fit are null in their column; the record
    keeps them as text. The reasons of one record are joined by ``; ``.
    """
    names = header_of(spark, path, multiline)
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
    # Every field is parsed: a pruned record would not show how many it has.
    reader = csv_reader(spark, multiline).options(columnNameOfCorruptRecord=MALFORMED, columnPruning="false", enforceSchema="false")
    raw = reader.schema(text).csv(path).select("*", F.col("_metadata.file_path").alias(SOURCE))
    found = normalize_headers(raw.select(*(F.col(f"`{c}`") for c in names)), schema.names).columns
    absent = [c for c in schema.names if c not in found]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}; it has {names}")
    own = {f.name: F.col(f"`{names[found.index(f.name)]}`") for f in schema.fields}
    misfits = [_misfit(own[f.name], f.dataType, f.name) for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    reason = F.when(F.col(MALFORMED).isNotNull(), F.lit(f"not {len(names)} fields")).otherwise(F.concat_ws("; ", *misfits) if misfits else F.lit(""))
    fields = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names)), CSV_QUOTING)
    record = F.coalesce(F.col(MALFORMED), fields)
    rows = raw.select(*(_typed(c, schema[n].dataType).alias(n) for n, c in own.items()), F.nullif(reason, F.lit("")).alias(REASON), record.alias(RECORD), SOURCE)
    bad = F.col(REASON).isNotNull()
    return rows.select(*schema.names, REASON, F.when(bad, F.col(RECORD)).alias(RECORD), F.when(bad, F.col(SOURCE)).alias(SOURCE))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON, RECORD, SOURCE)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull()).select(REASON, RECORD, SOURCE)


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, out: str, multiline: bool = True) -> IngestCounts:
    """Write the records as Parquet under ``out``, accepted and rejected ones in
    folders of their own, in one pass; counts are observed on the way."""
    checked = checked_csv(spark, path, schema, multiline)
    seen = Observation("ingest")
    bad = F.col(REASON).isNotNull()
    counted = checked.observe(seen, F.count(F.lit(1)).alias("all"), F.count(F.when(bad, 1)).alias("bad"))
    with unsorted_write(spark, 2):
        counted.withColumn(REJECTED, bad.cast("int")).write.mode("overwrite").partitionBy(REJECTED).parquet(out)
    got = seen.get
    return IngestCounts(got["all"] - got["bad"], got["bad"])


def _ingested(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    more = [T.StructField(c, T.StringType()) for c in (REASON, RECORD, SOURCE)]
    return spark.read.schema(T.StructType([*schema.fields, *more, T.StructField(REJECTED, T.IntegerType())])).parquet(out)


def load_accepted(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The accepted rows of an ingestion; the other folder is not read."""
    return _ingested(spark, out, schema).filter(F.col(REJECTED) == 0).select(*schema.names)


def load_rejected(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Reason, record as text and file of the rejected ones."""
    return _ingested(spark, out, schema).filter(F.col(REJECTED) == 1).select(REASON, RECORD, SOURCE)
