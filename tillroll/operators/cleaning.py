"""Cleaning steps. Each is ``DataFrame -> DataFrame`` for use with
``df.transform``; the full chains are :func:`clean_standard` (cluster
semantics, the default) and :func:`clean_lenient` (single-machine semantics).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.config import (
    CRITICAL_COLUMNS,
    DEFAULT_DATE_FORMATS,
    DEFAULT_QUANTITY_BOUNDS,
    DEFAULT_UNIT_PRICE_BOUNDS,
    MISSING_CUSTOMER_ID,
    CleaningRules,
)
from tillroll.functions.columns import (
    decimal_text_to_double,
    decimal_text_to_int,
    field_type,
    is_cancelled,
    parse_timestamp,
    parse_timestamp_lenient,
    stripped_text,
    to_customer_id,
    trimmed_text,
)

_TEXT_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Country")
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _has(df: DataFrame, name: str) -> bool:
    return field_type(df, name) is not None


def _to_int(df: DataFrame, name: str) -> Column:
    dt = field_type(df, name)
    if isinstance(dt, T.IntegerType):
        return F.col(name)
    if isinstance(dt, _NUMERIC):
        # Same value as the text round trip (number -> text -> double -> int).
        return F.col(name).try_cast("double").try_cast("int")
    return decimal_text_to_int(name)


def _to_double(df: DataFrame, name: str) -> Column:
    dt = field_type(df, name)
    if isinstance(dt, T.DoubleType):
        return F.col(name)
    if isinstance(dt, _NUMERIC):
        return F.col(name).try_cast("double")
    return decimal_text_to_double(name)


def _to_long_id(df: DataFrame, name: str) -> Column:
    dt = field_type(df, name)
    if isinstance(dt, T.LongType):
        return F.col(name)
    if isinstance(dt, _INTEGRAL):
        return F.col(name).cast("long")
    if isinstance(dt, _NUMERIC):
        return F.col(name).try_cast("long")
    return to_customer_id(name)


def _to_timestamp(df: DataFrame, name: str, formats: Iterable[str], lenient: bool = False) -> Column:
    dt = field_type(df, name)
    if isinstance(dt, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    parse = parse_timestamp_lenient if lenient else parse_timestamp
    return parse(name, formats)


def normalize_types(
    df: DataFrame, date_formats: Iterable[str] = DEFAULT_DATE_FORMATS, fence: bool = True
) -> DataFrame:
    """Coerce the retail columns once (one projection, not a chain).

    Text columns are trimmed; Quantity/UnitPrice accept a decimal comma;
    CustomerID accepts ``12345.0``; InvoiceDate tries the patterns in order.
    Columns already of the target type pass through untouched, which gives the
    same values as the text round trip but keeps Parquet pushdown possible.
    A missing CustomerID column is allowed.

    ``fence`` (default on) keeps later row filters from re-evaluating the text
    parses (see :func:`_evaluate_once`); turn it off when no filter follows,
    where the fence only adds a row copy.
    """
    formats = tuple(date_formats)
    out: dict[str, Column] = {}
    for name in _TEXT_COLUMNS:
        out[name] = trimmed_text(name)
    out["Quantity"] = _to_int(df, "Quantity")
    out["UnitPrice"] = _to_double(df, "UnitPrice")
    if _has(df, "CustomerID"):
        out["CustomerID"] = _to_long_id(df, "CustomerID")
    out["InvoiceDate"] = _to_timestamp(df, "InvoiceDate", formats)
    normalized = df.withColumns(out)
    parses_text = any(isinstance(field_type(df, c), T.StringType) for c in ("Quantity", "UnitPrice", "InvoiceDate"))
    return _evaluate_once(normalized) if (parses_text and fence) else normalized


def _evaluate_once(df: DataFrame) -> DataFrame:
    """Fence for expensive projections.

    Catalyst pushes a later row filter (``InvoiceDate IS NOT NULL``, the
    outlier bounds) below the projection by inlining its expressions, so every
    text parse would run twice: once in the filter, once in the projection.
    Filters on a generator's output cannot be pushed below the generator, so
    passing the row through a one-element ``inline`` evaluates each parse
    once. Used only when normalisation parses text; typed inputs keep full
    pushdown to the scan.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.array(row)))


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Full-row distinct (nulls compare equal). Map-side partial aggregation
    collapses repeated copies before the shuffle, so one heavily copied row
    does not load a single task."""
    return df.dropDuplicates()


def fill_missing_customer(df: DataFrame) -> DataFrame:
    if not _has(df, "CustomerID"):
        return df
    return df.fillna({"CustomerID": MISSING_CUSTOMER_ID})


def drop_missing_critical(df: DataFrame, columns: Iterable[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_blank_text(df: DataFrame) -> DataFrame:
    return df.filter((F.col("Description") != "") & (F.col("Country") != ""))


def handle_missing_values(df: DataFrame) -> DataFrame:
    """Cluster rule: drop rows with a null critical column or blank
    Description/Country; missing CustomerID becomes -1."""
    return df.transform(drop_missing_critical).transform(drop_blank_text).transform(fill_missing_customer)


def price_quantity_positive(df: DataFrame) -> DataFrame:
    """UnitPrice > 0 and Quantity != 0 (negative quantities are kept)."""
    return df.filter((F.col("UnitPrice") > 0) & (F.col("Quantity") != 0))


def handle_missing_values_lenient(df: DataFrame) -> DataFrame:
    """Single-machine rule: drop null critical columns, keep UnitPrice > 0 and
    Quantity != 0, and fill CustomerID with -1 (as a long) when the column
    exists."""
    out = df.transform(drop_missing_critical).transform(price_quantity_positive).transform(fill_missing_customer)
    if _has(out, "CustomerID"):
        out = out.withColumn("CustomerID", _to_long_id(out, "CustomerID"))
    return out


def filter_valid_transactions(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Drop cancelled invoices (number starting with ``C``; any case unless
    ``case_sensitive``). A null invoice number is dropped in the default rule
    and kept in the case-sensitive (single-machine) rule."""
    cancelled = is_cancelled("InvoiceNo", case_sensitive=case_sensitive)
    if case_sensitive:
        return df.filter(~F.coalesce(cancelled, F.lit(False)))
    return df.filter(~cancelled)


def cancelled_only(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return df.filter(is_cancelled("InvoiceNo", case_sensitive=case_sensitive))


def filter_outliers(
    df: DataFrame,
    quantity_bounds: tuple[int, int] = DEFAULT_QUANTITY_BOUNDS,
    unit_price_bounds: tuple[float, float] = DEFAULT_UNIT_PRICE_BOUNDS,
) -> DataFrame:
    """Inclusive bounds on Quantity and UnitPrice; plain column predicates so
    they are pushed to the scan when the columns come straight from Parquet."""
    (qlo, qhi), (plo, phi) = quantity_bounds, unit_price_bounds
    return df.filter(F.col("Quantity").between(qlo, qhi) & F.col("UnitPrice").between(plo, phi))


def clean_standard(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Cluster cleaning chain: normalize -> de-duplicate -> missing values ->
    cancelled invoices -> outliers."""
    return (
        df.transform(normalize_types, rules.date_formats)
        .transform(remove_duplicates)
        .transform(handle_missing_values)
        .transform(filter_valid_transactions)
        .transform(filter_outliers, rules.quantity_bounds, rules.unit_price_bounds)
    )


def normalize_lenient(df: DataFrame, date_formats: Iterable[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """Single-machine normalisation: lenient date parse (unparsable rows are
    dropped), StockCode as text, Description/Country stripped of all
    surrounding whitespace. InvoiceNo is left untrimmed."""
    normalized = df.withColumns(
        {
            "InvoiceDate": _to_timestamp(df, "InvoiceDate", tuple(date_formats), lenient=True),
            "StockCode": F.col("StockCode").cast("string"),
            "Country": stripped_text("Country"),
            "Description": stripped_text("Description"),
        }
    )
    if isinstance(field_type(df, "InvoiceDate"), T.StringType):
        normalized = _evaluate_once(normalized)
    return normalized.dropna(subset=["InvoiceDate"])


def coerce_numbers(df: DataFrame, fence: bool = True) -> DataFrame:
    """Type Quantity/UnitPrice/CustomerID the way a typed reader would; used
    before the single-machine chain when the input arrives as text. With
    ``fence``, later filters on the numbers do not re-run the parsing (see
    :func:`_evaluate_once`)."""
    out = {"Quantity": _to_int(df, "Quantity"), "UnitPrice": _to_double(df, "UnitPrice")}
    if _has(df, "CustomerID"):
        out["CustomerID"] = _to_long_id(df, "CustomerID")
    coerced = df.withColumns(out)
    parses_text = any(isinstance(field_type(df, c), T.StringType) for c in ("Quantity", "UnitPrice"))
    return _evaluate_once(coerced) if (parses_text and fence) else coerced


def clean_lenient(df: DataFrame, date_formats: Iterable[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """Single-machine cleaning chain: de-duplicate -> missing values (with the
    price/quantity rule) -> case-sensitive cancelled filter -> normalise."""
    return (
        df.transform(remove_duplicates)
        .transform(handle_missing_values_lenient)
        .transform(filter_valid_transactions, True)
        .transform(normalize_lenient, date_formats)
    )
