"""Scalar column expressions. All are JVM built-ins and stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.config import DEFAULT_DATE_FORMATS

__all__ = [
    "as_col",
    "trimmed_text",
    "stripped_text",
    "decimal_text_to_double",
    "decimal_text_to_int",
    "to_customer_id",
    "parse_timestamp",
    "parse_timestamp_lenient",
    "line_amount",
    "month_bucket",
    "is_cancelled",
    "in_year",
    "run_id_from_file_name",
    "nice_number",
    "share_of_max",
    "normalize_headers",
]


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed_text(c: str | Column) -> Column:
    """Text with leading/trailing spaces removed (spaces only; tabs stay)."""
    return F.trim(as_col(c).cast("string"))


def stripped_text(c: str | Column) -> Column:
    """Text with all leading/trailing whitespace removed (tabs, newlines too)."""
    return F.regexp_replace(as_col(c).cast("string"), r"^\s+|\s+$", "")


def decimal_text_to_double(c: str | Column) -> Column:
    """Number written with a decimal comma or point -> double; bad text -> null.

    Every comma becomes a point, so ``1.234,5`` is null and ``1,234`` is 1.234.
    """
    return F.regexp_replace(as_col(c).cast("string"), ",", ".").try_cast("double")


def decimal_text_to_int(c: str | Column) -> Column:
    """As :func:`decimal_text_to_double`, then truncated toward zero to int."""
    return decimal_text_to_double(c).try_cast("int")


#: Text that a cast to a whole number can read; blanks and control characters around it are allowed.
WHOLE_NUMBER = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"


def to_customer_id(c: str | Column) -> Column:
    """Customer id -> long. Text such as ``12345.0`` gives 12345, not null.

    A failed cast costs an exception inside the task, a regex miss does not, so
    only whole numbers are tried as such.
    """
    col = as_col(c)
    whole = F.when(col.cast("string").rlike(WHOLE_NUMBER), col.try_cast("long"))
    return F.coalesce(whole, col.try_cast("double").try_cast("long"))


# Pattern letters that only ever read digits.
_NUMERIC_LETTERS = set("yuMLdDHhkKmsSn")


def pattern_shape(pattern: str) -> str | None:
    """A regex every text parsable by the datetime ``pattern`` matches (each
    numeric field becomes ``\\d+``, other characters stay literal), or None
    when the pattern has text fields or quotes. Used as a cheap guard: a
    failed pattern parse costs an exception inside the task, a regex miss
    does not."""
    import re

    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        j = i
        while j < len(pattern) and pattern[j] == ch:
            j += 1
        if ch.isalpha():
            if ch not in _NUMERIC_LETTERS or (ch in "ML" and j - i > 2):
                return None
            out.append(r"\d+")
        elif ch == "'":
            return None
        else:
            out.append(re.escape(pattern[i:j]))
        i = j
    return "^" + "".join(out) + "$"


def _try_pattern(col: Column, fmt: str) -> Column:
    parsed = F.try_to_timestamp(col, F.lit(fmt))
    shape = pattern_shape(fmt)
    return parsed if shape is None else F.when(col.rlike(shape), parsed)


def parse_timestamp(c: str | Column, formats: Iterable[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Text -> wall-clock timestamp; the first pattern that parses wins, then
    ISO text; anything else is null."""
    col = as_col(c).cast("string")
    tries = [_try_pattern(col, f) for f in formats]
    return F.coalesce(*tries, F.try_to_timestamp(col)).cast("timestamp_ntz")


def parse_timestamp_lenient(c: str | Column, formats: Iterable[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Lenient parse: ISO text first, then the month-first patterns; bad -> null."""
    col = as_col(c).cast("string")
    tries = [_try_pattern(col, f) for f in formats]
    return F.coalesce(F.try_to_timestamp(col), *tries).cast("timestamp_ntz")


def line_amount(quantity: str | Column = "Quantity", price: str | Column = "UnitPrice", rounded: bool = True) -> Column:
    amount = as_col(quantity) * as_col(price)
    return F.round(amount, 2) if rounded else amount


def month_bucket(c: str | Column) -> Column:
    """``yyyy-MM`` text of a timestamp."""
    return F.date_format(as_col(c), "yyyy-MM")


def is_cancelled(invoice_no: str | Column, case_sensitive: bool = False) -> Column:
    """Invoice number starts with ``C`` (any case unless ``case_sensitive``)."""
    text = as_col(invoice_no).cast("string")
    return text.startswith("C") if case_sensitive else F.upper(text).startswith("C")


def in_year(c: str | Column, year: int) -> Column:
    """``year(c) == year`` written as a half-open range, so Parquet min/max
    statistics can skip row groups and the filter reaches the scan."""
    col = as_col(c)
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (col >= start) & (col < end)


# Fixed value: the part-file name pattern whose middle group is the run id.
RUN_ID_PATTERN = r"(?i)^part-\d{5}-([0-9a-f-]+)-c\d+\.snappy\.parquet$"


def run_id_from_file_name(file_name: str | Column) -> Column:
    """Run id from a part-file name; otherwise the name without its extension."""
    name = as_col(file_name)
    run_id = F.regexp_extract(name, RUN_ID_PATTERN, 1)
    stem = F.regexp_replace(name, r"\.[^./]*$", "")
    return F.when(run_id != "", run_id).otherwise(stem)


def _fixed(v: Column, digits: int) -> Column:
    """``v`` with a fixed number of decimals, half-way values to the even digit
    and without group separators."""
    return F.call_function("format_number", v, F.lit("0." + "0" * digits))


def nice_number(c: str | Column) -> Column:
    """Short label: ``1.2M``, ``3.4K``, ``42`` or ``3.14``; half-way values go
    to the even digit (1250 -> ``1.2K``)."""
    v = as_col(c).cast("double")
    mag = F.abs(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(mag >= 1_000_000, F.concat(_fixed(v / 1_000_000, 1), F.lit("M")))
        .when(mag >= 1_000, F.concat(_fixed(v / 1_000, 1), F.lit("K")))
        .when(v == F.floor(v), v.cast("long").cast("string"))
        .otherwise(_fixed(v, 2))
    )


def share_of_max(c: str | Column) -> Column:
    """Value divided by the column maximum (a maximum of 0 counts as 1).

    The window has no partition key, so use it only on a bounded frame such
    as a top-N result.
    """
    from pyspark.sql import Window

    col = as_col(c).cast("double")
    top = F.max(col).over(Window.partitionBy())
    return col / F.coalesce(F.nullif(top, F.lit(0.0)), F.lit(1.0))


def normalize_headers(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Strip header whitespace and rename columns matching ``wanted``
    case-insensitively to the wanted spelling."""
    stripped = df.toDF(*[c.strip() for c in df.columns])
    by_lower = {w.lower(): w for w in wanted}
    renamed = [F.col(f"`{c}`").alias(by_lower.get(c.lower(), c)) for c in stripped.columns]
    return stripped.select(*renamed)


def field_type(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f.dataType
    return None
