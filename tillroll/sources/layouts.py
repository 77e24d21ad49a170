"""Storage layouts of the invoice lines that save later jobs reading or moving them.

- by month: partitions that a rerun replaces one by one and that filters and
  joins on the month prune;
- clustered: a space-filling order over several columns, so that row groups
  have narrow ranges in each of them and filters on any skip most;
- co-located: lines and bridge bucketed by invoice, so that joining them moves
  neither; invoices too large for one bucket's task are stored apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import month_bucket
from tillroll.operators.joins import normalize_supplier
from tillroll.session import shared_dir
from tillroll.sources.writers import save_parquet, unsorted_write

MONTH = "InvoiceMonth"

# --- by month -------------------------------------------------------------------


def _by_month(lines: DataFrame) -> DataFrame:
    """Lines with their month, dealt so that a month is few files and a large one several tasks."""
    named = lines.drop(MONTH).withColumn(MONTH, month_bucket("InvoiceDate"))
    return named.hint("rebalance", MONTH)


def save_by_month(lines: DataFrame, path: str) -> None:
    """Replace the months that ``lines`` hold; the other months under ``path`` stay. Lines without a date are a month of their own."""
    _by_month(lines).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def replace_months(lines: DataFrame, path: str, months: Iterable[str]) -> None:
    """Rerun of ``months``: their lines are replaced, and a month that has no
    line any more goes. Lines of other months are an error, found before
    anything is replaced."""
    wanted = sorted(set(months))
    named = lines.drop(MONTH).withColumn(MONTH, month_bucket("InvoiceDate"))
    checked = F.when(F.coalesce(F.col(MONTH).isin(wanted), F.lit(False)), F.col(MONTH)).otherwise(
        F.raise_error(F.concat(F.lit("a line of another month: "), F.coalesce(MONTH, F.lit("no date")))).cast("string")
    )
    seen = Observation("months")
    counted = named.withColumn(MONTH, checked).observe(seen, *(F.count(F.when(F.col(MONTH) == m, 1)).alias(m) for m in wanted))
    counted.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    spark = lines.sparkSession
    for m in wanted:
        if not seen.get[m]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MONTH}={m}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def load_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines and their month; a filter or join on ``InvoiceMonth`` reads only its partitions."""
    month = T.StructType([T.StructField(MONTH, T.StringType())])
    return spark.read.schema(T.StructType([*schema.fields, *month.fields])).parquet(path)


def lines_of_months(lines: DataFrame, months: DataFrame) -> DataFrame:
    """Lines whose month is listed in ``months`` (column ``InvoiceMonth``); over lines stored by month only those partitions are read."""
    return lines.join(months.select(MONTH).distinct(), MONTH, "left_semi")


# --- clustered ------------------------------------------------------------------

#: Rows that the ranges of the columns are taken from, and bits of a column's place in the order.
SAMPLE, BITS = 4096, 5


def range_bounds(df: DataFrame, column: str, bits: int = BITS) -> list:
    """At most 2^bits - 1 values that cut ``SAMPLE`` rows (those with the lowest hashes) into equal parts."""
    kept = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("v"), F.xxhash64(*df.columns).alias("h"))
    values = sorted(r["v"] for r in kept.orderBy("h", "v").limit(SAMPLE).collect())
    cuts = [values[i * len(values) >> bits] for i in range(1, 1 << bits)] if values else []
    return sorted(set(cuts))


def range_number(column: str, bounds: list, kind: str) -> Column:
    """How many of the bounds a value reaches; null values come first."""
    out = F.lit(0)
    for b in bounds:
        out = out + F.coalesce(F.col(column) >= F.lit(b).cast(kind), F.lit(False)).cast("int")
    return out


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turn, highest first: near in this order is near in each number."""
    out = F.lit(0)
    for bit in reversed(range(bits)):
        for n in numbers:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(n, bit).bitwiseAND(F.lit(1)))
    return out


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` ordered along a space-filling curve over ``columns``.

    The ranges come from a bounded sample, which only shapes the order: every
    row stays. Rows of one cell are dealt to several tasks if they are many.
    """
    kinds = dict(df.dtypes)
    numbers = {f"_range{i}": range_number(c, range_bounds(df, c), kinds[c]) for i, c in enumerate(columns)}
    # Columns of their own: every bit of a number is asked for, the number is found once.
    cells = df.withColumns(numbers).withColumn("_cell", interleaved([F.col(n) for n in numbers])).withColumn("_spread", F.rand(11))
    return cells.repartitionByRange("_cell", "_spread").sortWithinPartitions("_cell", *columns).drop("_cell", "_spread", *numbers)


def save_clustered(df: DataFrame, path: str, columns: list[str], row_group_bytes: int | None = None) -> None:
    """Overwrite ``path`` with :func:`clustered` rows; smaller row groups skip more and cost more footer."""
    writer = clustered(df, columns).write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


# --- co-located -----------------------------------------------------------------

#: Lines or bridge rows of one invoice above which it is stored apart.
HOT_ROWS = 1_000_000


def _tables(name: str) -> dict[str, str]:
    return {k: f"{name}_{k}" for k in ("lines", "hot_lines", "bridge", "hot_bridge")}


def save_colocated(lines: DataFrame, supplier: DataFrame, name: str, buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Store lines and bridge as tables ``<name>_lines`` and ``<name>_bridge``
    bucketed and sorted by invoice, and the rows of invoices with more than
    ``hot_rows`` lines or bridge rows (also those without a number) in
    ``<name>_hot_…``, which later jobs join with the usual skew handling."""
    spark, tables = lines.sparkSession, _tables(name)
    sides = {"lines": lines.withColumn("InvoiceNo", F.col("InvoiceNo").cast("string")), "bridge": normalize_supplier(supplier)}
    root = shared_dir(spark, f"colocated-{uuid.uuid4().hex}")
    try:
        # Each side is read four times below: computed once, marked once.
        staged = {kind: _staged(df, f"{root}/{kind}") for kind, df in sides.items()}
        counted = [df.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows) for df in staged.values()]
        # At most rows / hot_rows invoices of each side.
        hot = counted[0].unionByName(counted[1]).filter(F.col("InvoiceNo").isNotNull()).select(F.col("InvoiceNo").alias("_invoice")).distinct()
        hot = _staged(hot, f"{root}/hot").withColumn("_hot", F.lit(True))
        for kind, df in staged.items():
            apart = F.coalesce(F.col("_hot"), F.col("InvoiceNo").isNull())
            marked = df.join(hot, F.col("InvoiceNo") == F.col("_invoice"), "left").withColumn("_apart", apart).drop("_invoice", "_hot")
            with unsorted_write(spark, 2):
                marked.write.mode("overwrite").partitionBy("_apart").parquet(f"{root}/marked_{kind}")
            marked = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_apart", T.BooleanType())])).parquet(f"{root}/marked_{kind}")
            # Dealt by invoice first, so that a bucket is one file and not one per task.
            cold = marked.filter("not _apart").drop("_apart").repartition(buckets, "InvoiceNo")
            cold.write.mode("overwrite").format("parquet").bucketBy(buckets, "InvoiceNo").sortBy("InvoiceNo").saveAsTable(tables[kind])
            marked.filter("_apart").drop("_apart").write.mode("overwrite").format("parquet").saveAsTable(tables[f"hot_{kind}"])
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _staged(df: DataFrame, path: str) -> DataFrame:
    save_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def colocated_supplier_sales(spark: SparkSession, name: str) -> DataFrame:
    """Sales per supplier over tables of :func:`save_colocated`: neither the
    lines nor the bridge move; the hot invoices go through the shuffling plan."""
    from tillroll.operators.aggregates import supplier_contributions

    t = {k: spark.table(v) for k, v in _tables(name).items()}
    totals = t["lines"].groupBy("InvoiceNo").agg(F.sum("TotalAmount").alias("amount"))
    pairs = t["bridge"].groupBy("InvoiceNo", "SupplierID").agg(F.count(F.lit(1)).alias("copies"))
    cold = totals.join(pairs, "InvoiceNo", "left").select("SupplierID", (F.col("amount") * F.coalesce("copies", F.lit(1))).alias("amount"))
    hot = supplier_contributions(t["hot_lines"], t["hot_bridge"].withColumnRenamed("SupplierID", "Fournisseur"), keep_unmatched=True)
    return (
        cold.unionByName(hot).groupBy("SupplierID").agg(F.round(F.sum("amount"), 2).alias("TotalAmount")).orderBy(F.desc("TotalAmount"))
    )
