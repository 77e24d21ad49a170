"""Sales aggregates and scalar answers over enriched invoice lines.

Money sums are rounded to 2 decimals (cluster rule) unless the name says
otherwise. Scalar answers come back as one-row DataFrames built by a global
aggregate, so they never pull a group to the driver and are null when the
input is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.config import (
    DEFAULT_BEST_PRODUCT_COUNTRY,
    DEFAULT_MARKET_COUNTRY,
    DEFAULT_MARKET_YEAR,
)
from tillroll.functions.columns import in_year, is_cancelled, month_bucket, stripped_text, trimmed_text
from tillroll.operators.joins import normalize_mapping, normalize_supplier


def _money(c: Column, rounded: bool = True) -> Column:
    return F.round(F.sum(c), 2) if rounded else F.sum(c)


def _top1(df: DataFrame, value: str, score: str, out: str) -> DataFrame:
    """Value with the highest score, ties to the smallest value; one row,
    null when ``df`` is empty. A global aggregate with partial merge, so the
    candidates are reduced on the executors."""
    rank_key = F.struct((-F.col(score)).alias("s"), F.col(value).alias("v"))
    return df.agg(F.min_by(F.col(value), rank_key).alias(out))


# --- invoice grain ------------------------------------------------------------


def invoice_grain(enriched: DataFrame) -> DataFrame:
    """Sales per (Country, InvoiceMonth, InvoiceNo): one pass over the lines
    from which the country, month, supplier, market and continent results all
    follow. The grain is accepted by these functions in place of the lines."""
    return enriched.groupBy(
        "Country", _month(enriched), F.col("InvoiceNo").cast("string").alias("InvoiceNo")
    ).agg(F.sum("TotalAmount").alias("TotalAmount"))


def _month(lines: DataFrame) -> Column:
    """The month of lines, or of the invoice grain."""
    return F.col("InvoiceMonth") if "InvoiceMonth" in lines.columns else month_bucket("InvoiceDate").alias("InvoiceMonth")


# --- A1 -----------------------------------------------------------------------


def group_by_country(enriched: DataFrame) -> DataFrame:
    """Sales and distinct invoices per country, largest first."""
    return (
        enriched.groupBy("Country")
        .agg(_money(F.col("TotalAmount")).alias("TotalAmount"), F.countDistinct("InvoiceNo").alias("TransactionCount"))
        .orderBy(F.desc("TotalAmount"), F.desc("TransactionCount"))
    )


def group_by_country_sum_only(enriched: DataFrame) -> DataFrame:
    """Single-machine form: raw sum per country, no invoice count; a null
    country is not a group."""
    return (
        enriched.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.sum("TotalAmount").alias("TotalAmount"))
        .orderBy(F.desc("TotalAmount"))
    )


# --- A2 -----------------------------------------------------------------------


def aggregate_monthly_data(enriched: DataFrame, rounded: bool = True) -> DataFrame:
    """Sales and distinct invoices per ``yyyy-MM`` month, in month order
    (``rounded=False``: raw sums, the single-machine rule)."""
    return (
        enriched.groupBy(_month(enriched))
        .agg(
            _money(F.col("TotalAmount"), rounded).alias("TotalSales"),
            F.countDistinct("InvoiceNo").alias("TransactionCount"),
        )
        .orderBy("InvoiceMonth")
    )


# --- A3 / A4 ------------------------------------------------------------------


def supplier_contributions(enriched: DataFrame, supplier: DataFrame, keep_unmatched: bool) -> DataFrame:
    """(SupplierID, amount) rows whose per-supplier sum equals the sum of
    ``lines LEFT JOIN bridge`` grouped by supplier.

    Lines are summed per invoice first, so the join sees one row per invoice
    instead of one per line; a bridge row repeated ``k`` times contributes
    ``k`` times, as the row-level fan-out would. Matched invoices go through an
    inner join (adaptive execution may split a hot invoice on either side);
    unmatched ones are those without a count of bridge rows and form the null
    supplier group. (An anti join would say the same, but the planner moves it
    below the sum of the lines, which are then read again.)

    Both branches read one shuffle of the totals and one of the bridge. The
    join key is a struct, which is never null itself, so the planner adds no
    null filter to one branch that would keep it from sharing the other's scan.
    """
    totals = enriched.groupBy(F.struct(F.col("InvoiceNo").cast("string").alias("InvoiceNo")).alias("_invoice")).agg(
        F.sum("TotalAmount").alias("amount")
    )
    bridge = (
        normalize_supplier(supplier)
        .filter(F.col("InvoiceNo").isNotNull())
        .groupBy(F.struct("InvoiceNo").alias("_invoice"), "SupplierID")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # The totals come out of an aggregate already hash-partitioned on the
    # invoice, so the planner would feed them to the join without a shuffle,
    # and adaptive execution only splits skewed joins whose inputs are both
    # planner shuffles. Joining on (invoice, hash of invoice) - the hash adds no
    # selectivity - makes both sides arrive through such a shuffle, so an
    # invoice listed with a third of all suppliers is split across tasks.
    ih = F.xxhash64("_invoice").alias("_ih")
    matched = (
        totals.select("_invoice", ih, "amount")
        .join(bridge.select("_invoice", ih, "SupplierID", "copies"), on=["_invoice", "_ih"], how="inner")
        .select("SupplierID", (F.col("amount") * F.col("copies")).alias("amount"))
    )
    if not keep_unmatched:
        return matched
    supplier_type = dict(bridge.dtypes)["SupplierID"]
    # The count stays alive, else it is pruned here and the bridge scanned again.
    known = bridge.groupBy("_invoice").agg(F.sum("copies").alias("n")).filter(F.col("n") > 0)
    unmatched = totals.join(known, on="_invoice", how="left").filter(F.col("n").isNull()).select(
        F.lit(None).cast(supplier_type).alias("SupplierID"), "amount"
    )
    return matched.unionByName(unmatched)


def aggregate_supplier_data(enriched: DataFrame, supplier: DataFrame) -> DataFrame:
    """Sales per supplier through the invoice bridge; invoices without a
    supplier form the null group. Largest first."""
    return (
        supplier_contributions(enriched, supplier, keep_unmatched=True)
        .groupBy("SupplierID")
        .agg(_money(F.col("amount")).alias("TotalAmount"))
        .orderBy(F.desc("TotalAmount"))
    )


def aggregate_supplier_data_matched_only(enriched: DataFrame, supplier: DataFrame) -> DataFrame:
    """Single-machine form: raw sums, and no null supplier group."""
    return (
        supplier_contributions(enriched, supplier, keep_unmatched=False)
        .filter(F.col("SupplierID").isNotNull())
        .groupBy("SupplierID")
        .agg(F.sum("amount").alias("TotalAmount"))
        .orderBy(F.desc("TotalAmount"))
    )


def filter_country_year(enriched: DataFrame, country: str, year: int) -> DataFrame:
    """Country equality and calendar year, the year as a pushable range of dates
    or, on the invoice grain, of months."""
    if "InvoiceMonth" in enriched.columns:
        in_range = F.col("InvoiceMonth").between(f"{year:04d}-01", f"{year:04d}-12")
    else:
        in_range = in_year("InvoiceDate", year)
    return enriched.filter((F.col("Country") == country) & in_range)


def aggregate_supplier_market(
    enriched: DataFrame,
    supplier: DataFrame,
    country: str = DEFAULT_MARKET_COUNTRY,
    year: int = DEFAULT_MARKET_YEAR,
) -> DataFrame:
    """Sales per supplier for one country and year."""
    return aggregate_supplier_data(filter_country_year(enriched, country, year), supplier)


# --- A5 / A6 / A10 ------------------------------------------------------------


def aggregate_world_data(
    enriched: DataFrame, mapping: DataFrame, rounded: bool = True, keep_unmapped: bool = True
) -> DataFrame:
    """Sales per continent; unmapped countries form the null group unless
    ``keep_unmapped=False`` (single-machine rule, with raw sums).

    Sales are summed per country first, so the join sees one row per country.
    """
    per_country = enriched.groupBy("Country").agg(F.sum("TotalAmount").alias("TotalAmount"))
    joined = per_country.join(normalize_mapping(mapping), on="Country", how="left")
    if not keep_unmapped:
        joined = joined.filter(F.col("Continent").isNotNull())
    return (
        joined.groupBy("Continent")
        .agg(_money(F.col("TotalAmount"), rounded).alias("TotalAmount"))
        .orderBy(F.desc("TotalAmount"))
    )


def cancelled_invoices(raw: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """(InvoiceNo text untrimmed, Country trimmed) of cancelled raw lines. The
    case-sensitive, single-machine form strips all white space of Country, the
    other one spaces only."""
    country = stripped_text("Country") if case_sensitive else trimmed_text("Country")
    typed = raw.select(F.col("InvoiceNo").cast("string").alias("InvoiceNo"), country.alias("Country"))
    return typed.filter(is_cancelled("InvoiceNo", case_sensitive=case_sensitive))


def build_cancellations_by_continent(
    raw: DataFrame, mapping: DataFrame, case_sensitive: bool = False, keep_unmapped: bool = True
) -> DataFrame:
    """Distinct cancelled invoices per continent, from the raw (uncleaned)
    lines. Distinct (Country, InvoiceNo) pairs are formed before the join. The
    single-machine rule is ``case_sensitive=True, keep_unmapped=False``."""
    pairs = cancelled_invoices(raw, case_sensitive).distinct()
    joined = pairs.join(normalize_mapping(mapping), on="Country", how="left")
    if not keep_unmapped:
        joined = joined.filter(F.col("Continent").isNotNull())
    return (
        joined.groupBy("Continent")
        .agg(F.countDistinct("InvoiceNo").alias("CancelledOperations"))
        .orderBy(F.desc("CancelledOperations"))
    )


def top_cancelled_continent(cancellations: DataFrame) -> DataFrame:
    """Continent with the most cancellations (ties -> alphabetical); the null
    group is not a candidate. One row."""
    named = cancellations.filter(F.col("Continent").isNotNull())
    return _top1(named, "Continent", "CancelledOperations", "top_cancelled_continent")


# --- A7 -----------------------------------------------------------------------


def best_product_in_country(enriched: DataFrame, country: str = DEFAULT_BEST_PRODUCT_COUNTRY) -> DataFrame:
    """Description with the largest raw sum of sales in ``country`` (matched in
    any case), ties to the first name. Lines without a description are no
    product, and a product needs an amount. One row, null when the country has
    no such lines."""
    per_product = (
        enriched.filter((F.lower(F.col("Country")) == country.lower()) & F.col("Description").isNotNull())
        .groupBy("Description")
        .agg(F.sum("TotalAmount").alias("sales"))
        .filter(F.col("sales").isNotNull())
    )
    return _top1(per_product, "Description", "sales", "best_product")


# --- A8 / A9 ------------------------------------------------------------------


def transactions_by_hour(df: DataFrame, ts_col: str = "InvoiceDate", id_col: str = "InvoiceNo") -> DataFrame:
    """Distinct transactions per hour of day, busiest first. Output columns
    keep the reference names: InvoiceHour, InvoiceNo (the distinct count)."""
    return (
        df.groupBy(F.hour(F.col(ts_col)).cast("int").alias("InvoiceHour"))
        .agg(F.countDistinct(F.col(id_col)).alias("InvoiceNo"))
        .orderBy(F.desc("InvoiceNo"), "InvoiceHour")
    )


def peak_hour(by_hour: DataFrame) -> DataFrame:
    """Hour with the most transactions (ties -> earliest). One row."""
    named = by_hour.filter(F.col("InvoiceHour").isNotNull())
    return _top1(named, "InvoiceHour", "InvoiceNo", "peak_hour")
