"""Data-quality and catalogue operators: audit counts, profiles, chart data
and the manifest of a folder of Parquet result files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.config import (
    CLEANING_STEPS,
    CRITICAL_COLUMNS,
    DEST_EMPTY,
    DEST_SUPPLIER_FIRST,
    DEST_SUPPLIER_REST,
    DEST_SUPPLIER_SECOND,
    DEST_UNKNOWN,
    SUPPLIER_FAMILY,
    CleaningRules,
)
from tillroll.functions.columns import is_cancelled, nice_number, run_id_from_file_name, share_of_max
from tillroll.operators.cleaning import normalize_types
from tillroll.schemas import DATASET_SIGNATURES
from tillroll.sources.footers import plain_path, read_footers


def _stack(pairs: list[tuple[str, Column]]) -> Column:
    """Array of (step, row_count) structs for ``inline``."""
    return F.array(*[F.struct(F.lit(s).alias("step"), c.cast("long").alias("row_count")) for s, c in pairs])


def cleaning_conditions(rules: CleaningRules = CleaningRules()) -> dict[str, Column]:
    """Row predicates of the cluster cleaning steps, cumulative."""
    missing_ok = F.lit(True)
    for c in CRITICAL_COLUMNS:
        missing_ok = missing_ok & F.col(c).isNotNull()
    missing_ok = missing_ok & (F.col("Description") != "") & (F.col("Country") != "")
    valid = missing_ok & ~is_cancelled("InvoiceNo")
    (qlo, qhi), (plo, phi) = rules.quantity_bounds, rules.unit_price_bounds
    bounded = valid & F.col("Quantity").between(qlo, qhi) & F.col("UnitPrice").between(plo, phi)
    return {"missing": missing_ok, "valid": valid, "outliers": bounded}


def distinct_with_copies(normalized: DataFrame) -> DataFrame:
    """Distinct rows with their copy count ``_copies`` (one shuffle, combined
    map-side, so a row copied a million times is one row per task)."""
    return normalized.groupBy(*normalized.columns).agg(F.count(F.lit(1)).alias("_copies"))


def waterfall_counters(rules: CleaningRules = CleaningRules()) -> list[tuple[str, Column]]:
    """(step, aggregate over the distinct rows with copy counts) of the 13
    audit steps."""
    cond = cleaning_conditions(rules)
    raw = F.coalesce(F.sum("_copies"), F.lit(0))
    dedup = F.count(F.lit(1))
    missing = [F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS]
    after_missing = F.count_if(cond["missing"])
    after_valid = F.count_if(cond["valid"])
    after_outliers = F.count_if(cond["outliers"])
    return list(zip(CLEANING_STEPS, [raw, raw, raw, dedup, *missing, after_missing, after_valid, after_outliers, after_outliers]))


def waterfall_from_groups(groups: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The 13 audit rows of the cluster cleaning job from the distinct rows
    with copy counts, in one global aggregate."""
    counters = waterfall_counters(rules)
    totals = groups.agg(*[c.alias(f"c{i}") for i, (_, c) in enumerate(counters)])
    return totals.select(F.inline(_stack([(s, F.col(f"c{i}")) for i, (s, _) in enumerate(counters)])))


def cleaning_waterfall(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """(step, row_count) after every cleaning step, computed in one pass
    instead of one count per step: the distinct-row aggregate gives both the
    raw total (sum of copies) and the de-duplicated total, then cumulative
    ``count_if`` gives the later steps."""
    normalized = normalize_types(raw, rules.date_formats, fence=False)
    return waterfall_from_groups(distinct_with_copies(normalized), rules)


def missing_counts(df: DataFrame, columns=CRITICAL_COLUMNS) -> DataFrame:
    """Null count per column as (step, row_count) rows, one aggregate."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return totals.select(F.inline(_stack([(f"missing_{c}", F.col(c)) for c in columns])))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(step, row_count) for named datasets, as one union of count
    aggregates (shared sub-plans reuse their shuffles within the query)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("step"), "row_count")
        for name, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, position, row and column counts.
    The row count is one aggregate; the column rows are generated from it."""
    fields = df.dtypes
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.lit(i).alias("ordinal"))
            for i, (c, t) in enumerate(fields, start=1)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(rows), "row_count", F.lit(len(fields)).alias("column_count"))


def chart_dataset(df: DataFrame, label_col: str, value_col: str, top_n: int = 15) -> DataFrame:
    """Bar-chart data: rows with both fields, top ``top_n`` by value (ties by
    label), a short value label and the share of the largest value."""
    order = [F.desc(value_col), F.asc(label_col)]
    top = df.select(label_col, value_col).dropna().orderBy(*order).limit(top_n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("int").alias("position"),
        label_col,
        value_col,
        nice_number(value_col).alias("value_label"),
        share_of_max(value_col).alias("share"),
    )


def line_chart_dataset(df: DataFrame, x_col: str, y_col: str) -> DataFrame:
    """Line-chart data: rows with both fields in ``x`` order, value label and
    share of the largest value. The maximum is a scalar subquery of the plan, so
    no single task sees all points and nothing runs before the plan."""
    points = df.select(x_col, y_col).dropna()
    top = points.agg(F.max(F.col(y_col).cast("double")).alias("top"))
    scale = top.select(F.when(F.col("top") == 0, 1.0).otherwise(F.col("top"))).scalar()
    return (
        points.orderBy(x_col)
        .select(x_col, y_col, nice_number(y_col).alias("value_label"), (F.col(y_col) / scale).alias("share"))
    )


# --- result folders -------------------------------------------------------------


def folder_profile(results: Mapping[str, DataFrame], preview_rows: int = 10) -> DataFrame:
    """Per dataset and column: type, position, row and column counts, and the
    first ``preview_rows`` values (by all columns) as text."""

    def cell(i: int):
        return lambda row: row[i]

    parts = []
    for name, df in results.items():
        head = df.orderBy(*(F.col(c).asc_nulls_first() for c in df.columns)).limit(preview_rows)
        order = Window.orderBy(*(F.col(c).asc_nulls_first() for c in df.columns))  # preview_rows rows
        texts = F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns))
        first = head.select(F.row_number().over(order).alias("at"), texts.alias("v"))
        shown = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda r: r["v"])).scalar()
        rows = F.array(*[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.lit(i + 1).alias("ordinal"),
                F.array_join(F.transform("_shown", cell(i)), "|").alias("preview"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ])
        # All columns stay alive in the count, so that it shares the shuffles of the first rows
        # instead of computing the result a second time.
        counted = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.xxhash64(*df.columns)).alias("_kept"))
        counted = counted.filter((F.col("row_count") == 0) | F.col("_kept").isNotNull()).drop("_kept")
        parts.append(
            counted.withColumn("_shown", shown)
            .select(F.lit(name).alias("dataset"), F.inline(rows), "row_count", F.lit(len(df.columns)).alias("column_count"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- manifest of a folder of Parquet files -------------------------------------


def file_manifest(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """One row per ``*.parquet`` file: path, name, run id, column list,
    fingerprint of names and types, rows, bytes and modification time.

    The listing is Spark's; column lists and rows come from the files' footers,
    which tasks read (a few kilobytes a file). Nothing per file passes through
    the driver, which is why this is the engine's one plan with a Python node.
    """
    files = read_footers(spark, folder, recursive)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        plain_path("path").alias("path"), name.alias("file_name"), run_id_from_file_name(name).alias("run_id"),
        "columns", "schema_sha256", "num_rows", "file_bytes", "modificationTime",
    )


def classify_columns(columns: Column) -> Column:
    """Dataset name from the exact ordered column list, else ``unknown``."""
    out = F.lit("unknown")
    for cols, label in DATASET_SIGNATURES.items():
        out = F.when(columns == ",".join(cols), label).otherwise(out)
    return out


def run_manifest(files: DataFrame) -> DataFrame:
    """Per run id: file count, column list, total rows, latest modification
    time and the number of distinct column lists (1 when consistent)."""
    return files.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.min("columns").alias("columns"),
        F.countDistinct("columns").alias("schema_variants"),
        F.sum("num_rows").alias("total_rows"),
        F.max("modificationTime").alias("latest_mtime"),
    )


def check_consistent_schemas(manifest: DataFrame, shown: int = 20) -> None:
    """Raise when files of one run disagree on their columns; the error states
    how many runs do and names the first ``shown``."""
    bad = manifest.filter(F.col("schema_variants") > 1)
    total = bad.count()
    if total:
        names = [r.run_id for r in bad.select("run_id").orderBy("run_id").limit(shown).collect()]
        raise ValueError(f"{total} runs with differing schemas: {names}{' and more' if total > shown else ''}")


def resolve_destinations(manifest: DataFrame) -> DataFrame:
    """Destination folder per run: the dataset name from its columns; empty
    runs -> ``legacy_empty``; unknown columns -> ``unknown_schema``. Runs of
    the supplier family are ordered by rows then recency: first
    ``supplier_sales``, second ``supplier_sales_uk_2011``, the rest
    ``legacy_supplier_extra``. Only the first two of the family are ranked (a
    top-2 per task before the window); other runs need no rank."""
    named = manifest.withColumn("family", classify_columns(F.col("columns")))
    order = Window.partitionBy("family").orderBy(F.desc("total_rows"), F.desc("latest_mtime"), F.asc("run_id"))
    first_two = (
        named.filter(F.col("family") == SUPPLIER_FAMILY)
        .withColumn("family_rank", F.row_number().over(order))
        .filter(F.col("family_rank") <= 2)
        .select("run_id", "family_rank")
    )
    ranked = named.join(first_two, "run_id", "left")
    supplier = (
        F.when(F.col("family_rank") == 1, DEST_SUPPLIER_FIRST)
        .when(F.col("family_rank") == 2, DEST_SUPPLIER_SECOND)
        .otherwise(DEST_SUPPLIER_REST)
    )
    destination = (
        F.when(F.col("family") == SUPPLIER_FAMILY, supplier)
        .when(F.col("total_rows") == 0, DEST_EMPTY)
        .when(F.col("family") == "unknown", DEST_UNKNOWN)
        .otherwise(F.col("family"))
    )
    return ranked.withColumn("destination", destination).drop("family_rank")
