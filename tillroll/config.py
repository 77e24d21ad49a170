"""Parameters of the cleaning rules and of the three batch jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Timestamp patterns tried in this order; the first that parses
# wins, then the session's default ISO parsing.
DEFAULT_DATE_FORMATS = ("M/d/yyyy H:mm", "MM/dd/yyyy HH:mm", "M/d/yyyy H:mm:ss")

# Columns whose null drops the row.
CRITICAL_COLUMNS = ("Description", "Quantity", "UnitPrice", "Country", "InvoiceDate")

# Inclusive outlier bounds.
DEFAULT_QUANTITY_BOUNDS = (1, 10_000)
DEFAULT_UNIT_PRICE_BOUNDS = (0.01, 10_000.0)

# The country and year of the single-market supplier ranking.
DEFAULT_MARKET_COUNTRY = "United Kingdom"
DEFAULT_MARKET_YEAR = 2011

# The country of the best-product answer.
DEFAULT_BEST_PRODUCT_COUNTRY = "France"

# Fixed value: customer id given to lines without one.
MISSING_CUSTOMER_ID = -1

# Audit step names of the cleaning job, in reporting order.
CLEANING_STEPS = (
    "raw_retail",
    "initial dataset",
    "after normalize_types",
    "after remove_duplicates",
    "missing_Description",
    "missing_Quantity",
    "missing_UnitPrice",
    "missing_Country",
    "missing_InvoiceDate",
    "after handle_missing_values",
    "after filter_valid_transactions",
    "after filter_outliers",
    "cleaned",
)

# Audit step names of the other two jobs, in reporting order.
ENRICH_STEPS = ("cleaned_input", "enriched_output")
AGGREGATION_STEPS = (
    "enriched_input",
    "raw_retail",
    "supplier",
    "mapping",
    "country_sales",
    "monthly_stats",
    "supplier_sales",
    "supplier_uk_2011",
    "continent_sales",
    "cancellations_by_continent",
)

# Destination names of the result-folder plan.
DEST_EMPTY = "legacy_empty"
DEST_UNKNOWN = "unknown_schema"
DEST_SUPPLIER_FIRST = "supplier_sales"
DEST_SUPPLIER_SECOND = "supplier_sales_uk_2011"
DEST_SUPPLIER_REST = "legacy_supplier_extra"
SUPPLIER_FAMILY = "supplier_sales_family"


@dataclass(frozen=True)
class CleaningRules:
    quantity_bounds: tuple[int, int] = DEFAULT_QUANTITY_BOUNDS
    unit_price_bounds: tuple[float, float] = DEFAULT_UNIT_PRICE_BOUNDS
    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS


# The field names of the three job configurations are fixed values: the names
# under which users pass the jobs' arguments.


@dataclass(frozen=True)
class CleaningJobConfig:
    """Job 1: raw retail table -> cleaned Parquet + audit JSON."""

    retail_source: str
    cleaned_output_path: str
    rules: CleaningRules = field(default_factory=CleaningRules)


@dataclass(frozen=True)
class EnrichJobConfig:
    """Job 2: cleaned Parquet -> enriched Parquet + audit JSON."""

    cleaned_input_path: str
    enriched_output_path: str
    by_month: bool = False


@dataclass(frozen=True)
class AggregationJobConfig:
    """Job 3: enriched Parquet + raw retail + supplier + mapping -> 6 results."""

    enriched_input_path: str
    retail_source: str
    supplier_source: str
    mapping_source: str | None
    country_output_path: str
    monthly_output_path: str
    supplier_output_path: str
    supplier_market_output_path: str
    world_output_path: str
    cancellation_output_path: str
    market_country: str = DEFAULT_MARKET_COUNTRY
    market_year: int = DEFAULT_MARKET_YEAR
    # With a folder here, the six results are published under it as one version instead.
    publish_root: str | None = None
