"""Results that grow by a batch of lines without reading the old lines again.

- distinct invoices per country, month and hour, as bitmaps over numbered
  invoices: a month's state is a few kilobytes for every 32,768 invoices, and
  states of several months are merged by OR;
- new lines without those that the history holds: a Bloom filter of the
  history's rows lets most new lines pass; the rest are compared with the
  history's rows of their own months.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import month_bucket
from tillroll.sources.layouts import MONTH, load_by_month
from tillroll.sources.writers import save_parquet

# --- numbered invoices ----------------------------------------------------------

NUMBERS = T.StructType([T.StructField("InvoiceNo", T.StringType()), T.StructField("number", T.LongType())])


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of one folder per batch, which may have no batch yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def add_invoice_numbers(lines: DataFrame, path: str) -> DataFrame:
    """Give every invoice that has none the next number, from 1 without gaps;
    all invoices with their numbers. A number never changes.

    New invoices are written once with their place in their task; only the
    tasks' counts meet to form the offsets. Their folder under ``path`` is named
    by the first new number, so a run that failed half-way is overwritten.
    """
    spark = lines.sparkSession
    known = _read(spark, path, NUMBERS)
    distinct = lines.select(F.col("InvoiceNo").cast("string").alias("InvoiceNo")).filter(F.col("InvoiceNo").isNotNull()).distinct()
    fresh = distinct.join(known.select("InvoiceNo"), "InvoiceNo", "left_anti")
    first = (known.agg(F.max("number")).first()[0] or 0) + 1
    places = f"{path.rstrip('/')}_places"
    row = F.monotonically_increasing_id()
    save_parquet(fresh.select("InvoiceNo", F.shiftright(row, 33).alias("task"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), places)
    rows = spark.read.parquet(places)
    counts = {r["task"]: r["n"] for r in rows.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per task of one write
    at, offsets = first, []
    for task in sorted(counts):
        offsets.append((task, at))
        at += counts[task]
    if offsets:
        deal = spark.createDataFrame(offsets, "task long, begin long")
        numbered = rows.join(deal, "task").select("InvoiceNo", (F.col("begin") + F.col("place")).alias("number"))
        save_parquet(numbered, os.path.join(path, f"{first:015d}"))
    _remove(spark, places)
    return _read(spark, path, NUMBERS)


# --- distinct invoices as bitmaps -----------------------------------------------

#: What is counted by: name and how a line gives it.
DIMENSIONS = ("country", "month", "hour")
STATE = T.StructType(
    [
        T.StructField("dimension", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType()),
    ]
)


def invoice_state(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the invoices of each country, month and hour in ``lines``:
    (dimension, value, InvoiceMonth, block of 32,768 numbers, 4 KB of bits)."""
    month = month_bucket("InvoiceDate")
    values = {"country": F.col("Country"), "month": month, "hour": F.hour("InvoiceDate").cast("string")}
    # One row per invoice, country, month and hour before the numbers are joined, however many
    # lines it has; the dimensions unfold after the join. A bit may be set more than once.
    groups = lines.select(F.col("InvoiceNo").cast("string").alias("InvoiceNo"), month.alias(MONTH), *(values[d].alias(f"_{d}") for d in DIMENSIONS))
    kinds = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(f"_{d}").alias("value")) for d in DIMENSIONS))
    numbered = groups.distinct().join(numbers, "InvoiceNo").select(MONTH, "number", F.inline(kinds))
    return numbered.groupBy("dimension", "value", MONTH, F.expr("bitmap_bucket_number(number)").alias("block")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bits")
    )


def merged_counts(state: DataFrame) -> DataFrame:
    """Distinct invoices of each dimension and value over all months of ``state``."""
    merged = state.groupBy("dimension", "value", "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    return merged.groupBy("dimension", "value").agg(F.sum(F.expr("bitmap_count(bits)")).alias("invoices"))


def update_invoice_state(lines: DataFrame, root: str) -> None:
    """Take a batch of whole months into the state under ``root``: its months
    replace what was there, the other months' lines are not needed."""
    numbers = add_invoice_numbers(lines, os.path.join(root, "numbers"))
    state = invoice_state(lines, numbers)
    state.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(os.path.join(root, "state"))


def stored_invoice_counts(spark: SparkSession, root: str) -> DataFrame:
    return merged_counts(load_by_month(spark, os.path.join(root, "state"), STATE))


# --- de-duplication against the history -----------------------------------------

#: Bits of the Bloom filter: 32 MB as 8,192 rows of 4 KB, whatever the history holds. A
#: fuller filter lets fewer lines pass unseen and costs comparisons, never a line.
FILTER_BITS, HASHES = 1 << 28, 3
BLOCK_BITS = 1 << 15
#: Where the filter's blocks stand; another name for another form.
FILTER_FOLDER = "filter-by-block"
#: Months of a batch up to which they are named to the history's scan; beyond that it reads all.
MONTHS = 1000
FILTER = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])


@dataclass(frozen=True)
class BatchCounts:
    """Distinct lines of a batch, those that the filter could not pass, and those that were new."""

    distinct: int
    compared: int
    added: int


def _row_hash(df: DataFrame, seed: int) -> Column:
    """Hash of a whole row; null and absent text differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in df.columns]
    return F.xxhash64(F.lit(seed), *parts)


def _block_of(key: Column) -> Column:
    """The filter's block of a row, by its hash."""
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(FILTER_BITS // BLOCK_BITS)).cast("long")


def _bits_of(key: Column) -> list[Column]:
    """A row's bits, all in its block: one row per line is dealt and looked up, not one per bit."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("long") for i in range(1, HASHES + 1)]


def filter_blocks(lines: DataFrame) -> DataFrame:
    """The Bloom filter of ``lines`` (with ``_key``): the blocks that have a bit."""
    key = F.col("_key")
    sets = [F.bitmap_construct_agg(at).alias(f"b{i}") for i, at in enumerate(_bits_of(key))]
    blocks = lines.groupBy(_block_of(key).alias("block")).agg(*sets)
    parts = blocks.select("block", F.explode(F.array(*(f"b{i}" for i in range(HASHES)))).alias("bits"))
    return parts.groupBy("block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def _bit(bits: Column, at: Column) -> Column:
    """Whether a bit of a block is set."""
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def possible_repeats(new: DataFrame, blocks: DataFrame) -> DataFrame:
    """``new`` (distinct, with ``_key``) and ``_maybe``: false only for lines that the filtered history cannot hold.

    The whole filter, of fixed size, goes to every executor; the lines do not move."""
    merged = blocks.groupBy("block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    key = F.col("_key")
    found = new.withColumn("block", _block_of(key)).join(F.broadcast(merged), "block", "left")
    hit = F.lit(True)
    for at in _bits_of(key):
        hit = hit & _bit(F.col("bits"), at)
    return found.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("block", "bits")


def add_new_lines(lines: DataFrame, root: str, batch: str) -> BatchCounts:
    """Append to the history under ``root`` the distinct rows of ``lines`` that it does not hold.

    Equality is that of a full-row distinct: nulls are equal. Only rows that
    the filter cannot rule out are compared, and only with the history of their
    own months, of which the join keeps the rows with an equal hash. The
    filter's part of a batch is written before its lines: a failure in between
    costs comparisons only, and the batch can be run again under its name.
    """
    spark, columns = lines.sparkSession, lines.columns
    history, scratch = os.path.join(root, "history"), os.path.join(root, "scratch", batch)
    bits = os.path.join(root, FILTER_FOLDER)
    hashed = T.StructType([*lines.schema.fields, T.StructField("_key", T.LongType())])
    new = lines.dropDuplicates()
    new = new.withColumn("_key", _row_hash(new, 17)).withColumn(MONTH, month_bucket("InvoiceDate"))
    if _exists(spark, history) and not _exists(spark, bits):
        # A history whose filter has an earlier form: its hashes are stored with its lines.
        save_parquet(filter_blocks(load_by_month(spark, history, hashed)), os.path.join(bits, "earlier batches"))
    save_parquet(possible_repeats(new, _read(spark, bits, FILTER)), scratch)
    marked = spark.read.parquet(scratch)
    fresh = marked
    if _exists(spark, history):
        maybe = marked.filter("_maybe")
        fresh = marked.filter("not _maybe").unionByName(not_in_history(maybe, load_by_month(spark, history, hashed), columns))
    # All of the batch: a second run of it adds the same bits, whatever the first one has appended.
    save_parquet(filter_blocks(marked), os.path.join(bits, batch))
    seen = Observation("added")
    # Dealt by month: a task opens files of few months, not one of every month. Counted
    # behind that, as an empty batch leaves nothing to count before it.
    counted = fresh.select(*columns, "_key", MONTH).hint("rebalance", MONTH).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("append").partitionBy(MONTH).parquet(history)
    asked = marked.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_maybe"), 1)).alias("m")).first()
    _remove(spark, scratch)
    return BatchCounts(asked["n"], asked["m"], seen.get["n"])


def not_in_history(maybe: DataFrame, history: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``maybe`` without an equal one in ``history``, of which only the asked months and hashes are read and kept."""
    months = [r[0] for r in maybe.select(MONTH).distinct().limit(MONTHS + 1).collect()]
    if len(months) <= MONTHS:
        named = F.col(MONTH).isin([m for m in months if m is not None])
        history = history.filter(named | F.col(MONTH).isNull() if None in months else named)
    asked = maybe.select(F.col("_key").alias("_k")).distinct()
    old = history.join(asked, history["_key"] == F.col("_k"), "left_semi").alias("o")
    same = F.lit(True)
    for c in columns:
        same = same & maybe[c].eqNullSafe(F.col(f"o.{c}"))
    # Both sides stand by hash: a conditional is no join key, so they are neither dealt nor sorted by whole rows.
    return maybe.join(old, (maybe["_key"] == F.col("o._key")) & F.when(same, True).otherwise(False), "left_anti")
