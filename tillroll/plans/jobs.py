"""The batch jobs: clean -> enrich -> aggregate, each writing Parquet plus a
JSON audit of row counts, and an all-in-one runner.

Compared with running every step and counting after each one, every job here
computes each output once, by its write; audit counts come from one aggregate
or from the footers of what was just written.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from tillroll.config import (
    DEFAULT_BEST_PRODUCT_COUNTRY,
    AGGREGATION_STEPS,
    ENRICH_STEPS,
    AggregationJobConfig,
    CleaningJobConfig,
    CleaningRules,
    EnrichJobConfig,
)
from tillroll.operators import aggregates as agg
from tillroll.operators.cleaning import fill_missing_customer, normalize_types
from tillroll.operators.enrich import total_amount
from tillroll.operators.joins import with_continent
from tillroll.operators.quality import cleaning_conditions, distinct_with_copies, waterfall_counters
from tillroll.schemas import CANCELLATIONS, CONTINENT_SALES, ENRICHED, MAPPING, RETAIL_COLUMNS, SUPPLIER
from tillroll.session import shared_dir
from tillroll.sources.readers import audit_frame, conform, load_parquet, load_source
from tillroll.sources.layouts import MONTH, load_by_month, save_by_month
from tillroll.sources.publication import publish, version_path
from tillroll.sources.writers import audit_path, save_all, save_audit, save_parquet, save_parquet_guarded

Source = "str | DataFrame"


def _frame(spark: SparkSession, src, schema=None) -> DataFrame:
    """A required input: a frame, or a source that must exist."""
    return src if isinstance(src, DataFrame) else load_source(spark, src, schema)


def _written_count(spark: SparkSession, path: str) -> int:
    return load_parquet(spark, path).count()


# --- job 1 --------------------------------------------------------------------


def cleaning_job(
    spark: SparkSession, retail, cleaned_output_path: str, rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """Normalise, de-duplicate and filter the raw lines; write the cleaned
    table and the 13-step audit. Returns the audit frame.

    The distinct rows (with copy counts) are the one shuffle of the job, and
    the cleaned write is its one action: the audit counters are observed on the
    distinct rows as the write reads them.
    """
    normalized = normalize_types(_frame(spark, retail), rules.date_formats, fence=False)
    seen = Observation("cleaning")
    counters = waterfall_counters(rules)
    groups = distinct_with_copies(normalized).observe(seen, *(c.alias(f"c{i}") for i, (_, c) in enumerate(counters)))
    cols = [c for c in RETAIL_COLUMNS if c in normalized.columns]
    cleaned = groups.filter(cleaning_conditions(rules)["outliers"]).select(*cols).transform(fill_missing_customer)
    save_parquet(cleaned, cleaned_output_path)
    got = seen.get
    audit = audit_frame(spark, [(step, got[f"c{i}"]) for i, (step, _) in enumerate(counters)])
    save_audit(audit, audit_path(cleaned_output_path, "cleaned", "cleaning_job"))
    return audit


def run_cleaning_job(spark: SparkSession, cfg: CleaningJobConfig) -> DataFrame:
    return cleaning_job(spark, load_source(spark, cfg.retail_source), cfg.cleaned_output_path, cfg.rules)


# --- job 2 --------------------------------------------------------------------


def enrich_job(spark: SparkSession, cleaned_input_path: str, enriched_output_path: str, by_month: bool = False) -> DataFrame:
    """Cleaned Parquet -> TotalAmount -> enriched Parquet, and the audit. With
    ``by_month`` the lines are partitioned by month and only the months at hand
    are replaced."""
    cleaned = load_parquet(spark, cleaned_input_path)
    save = save_by_month if by_month else save_parquet
    save(total_amount(cleaned), enriched_output_path)
    audit = audit_frame(
        spark,
        [
            (ENRICH_STEPS[0], _written_count(spark, cleaned_input_path)),
            (ENRICH_STEPS[1], _written_count(spark, enriched_output_path)),
        ],
    )
    save_audit(audit, audit_path(enriched_output_path, "enriched", "transformations_job"))
    return audit


def run_enrich_job(spark: SparkSession, cfg: EnrichJobConfig) -> DataFrame:
    return enrich_job(spark, cfg.cleaned_input_path, cfg.enriched_output_path, cfg.by_month)


# --- job 3 --------------------------------------------------------------------


@dataclass(frozen=True)
class AggregationOutputs:
    country: str
    monthly: str
    supplier: str
    supplier_market: str
    world: str
    cancellation: str


#: Names of the six results, in the order of the job's audit and outputs.
RESULTS = AGGREGATION_STEPS[4:]


def aggregation_job(
    spark: SparkSession,
    enriched_input_path: str,
    retail,
    supplier,
    mapping,
    out: AggregationOutputs | str,
    market_country: str,
    market_year: int,
    raw_count: int | None = None,
) -> DataFrame:
    """Six result tables from the enriched Parquet plus the raw lines,
    supplier bridge and country mapping; then the audit of input and output
    volumes.

    ``out`` names six paths, or one folder. Under a folder the six results are
    published as one version (:mod:`tillroll.sources.publication`), which
    readers see as a whole or not at all. Six paths are replaced after all six
    results have been written; a failing write leaves them as they were.

    The lines are read once, into an invoice-grain table from which the five
    sales results follow; the cancellations read the raw lines. Without a
    mapping (None) the two continent results are written empty, so none of an
    earlier run stays, and are left out of the audit; a mapping that is named
    but absent is an error. ``raw_count``, when the caller already knows it
    (the cleaning audit), saves a second pass over the raw lines."""
    # Lines stored by month keep that column, so the market's year prunes partitions.
    stored = load_parquet(spark, enriched_input_path)
    enriched = load_by_month(spark, enriched_input_path, ENRICHED) if MONTH in stored.columns else conform(stored, ENRICHED, enriched_input_path)
    raw = _frame(spark, retail)
    bridge = _frame(spark, supplier, SUPPLIER)
    world = None if mapping is None else _frame(spark, mapping, MAPPING)

    grain_path = shared_dir(spark, f"invoice-grain-{spark.sparkContext.applicationId}")
    save_parquet(agg.invoice_grain(enriched), grain_path)
    grain = load_parquet(spark, grain_path)
    frames = [
        agg.group_by_country(grain),
        agg.aggregate_monthly_data(grain),
        agg.aggregate_supplier_data(grain, bridge),
        agg.aggregate_supplier_market(grain, bridge, market_country, market_year),
        spark.createDataFrame([], CONTINENT_SALES) if world is None else agg.aggregate_world_data(grain, world),
        spark.createDataFrame([], CANCELLATIONS) if world is None else agg.build_cancellations_by_continent(raw, world),
    ]
    if isinstance(out, str):
        version = publish(spark, out, dict(zip(RESULTS, frames)))
        paths = [version_path(out, version, name) for name in RESULTS]
    else:
        paths = [out.country, out.monthly, out.supplier, out.supplier_market, out.world, out.cancellation]
        save_all(list(zip(frames, paths)))

    inputs = [
        _written_count(spark, enriched_input_path),
        raw_count if raw_count is not None else raw.count(),
        bridge.count(),
    ]
    counts = list(zip(AGGREGATION_STEPS, inputs))
    if world is not None:
        counts.append((AGGREGATION_STEPS[3], world.count()))
    counts += [(name, _written_count(spark, path)) for name, path in list(zip(RESULTS, paths))[: 4 if world is None else 6]]
    audit = audit_frame(spark, counts)
    save_audit(audit, audit_path(paths[0], "country_sales", "aggregations_job"))
    return audit


def run_aggregation_job(spark: SparkSession, cfg: AggregationJobConfig) -> DataFrame:
    out = AggregationOutputs(
        cfg.country_output_path,
        cfg.monthly_output_path,
        cfg.supplier_output_path,
        cfg.supplier_market_output_path,
        cfg.world_output_path,
        cfg.cancellation_output_path,
    )
    return aggregation_job(
        spark,
        cfg.enriched_input_path,
        load_source(spark, cfg.retail_source),
        load_source(spark, cfg.supplier_source, SUPPLIER),
        cfg.mapping_source,
        cfg.publish_root or out,
        cfg.market_country,
        cfg.market_year,
    )


# --- all in one ---------------------------------------------------------------


def world_analysis(enriched: DataFrame, mapping: DataFrame, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """Continent sales, cancellations per continent, the top continent and
    the continent-joined lines (lazy frames)."""
    out = {
        "continent_sales": agg.aggregate_world_data(enriched, mapping),
        "world_df": with_continent(enriched, mapping),
    }
    if raw is not None:
        cancellations = agg.build_cancellations_by_continent(raw, mapping)
        out["cancellations_by_continent"] = cancellations
        out["top_cancelled_continent"] = agg.top_cancelled_continent(cancellations)
    return out


def run_all(
    spark: SparkSession,
    retail,
    supplier,
    mapping,
    out_root: str,
    *,
    rules: CleaningRules = CleaningRules(),
    market_country: str = "United Kingdom",
    market_year: int = 2011,
    best_product_country: str = DEFAULT_BEST_PRODUCT_COUNTRY,
) -> dict:
    """The whole pipeline in one application, results under ``out_root``.

    Returns the output paths and the scalar answers (best product, peak hour,
    most-cancelling continent; continent answers only with a mapping).
    """
    p = lambda name: os.path.join(out_root, name)
    raw = _frame(spark, retail)
    world = None if mapping is None else _frame(spark, mapping, MAPPING)
    cleaning_audit = {r.step: r.row_count for r in cleaning_job(spark, raw, p("cleaned"), rules).collect()}
    enrich_job(spark, p("cleaned"), p("enriched"))
    outs = AggregationOutputs(
        p("country_sales"), p("monthly_sales"), p("supplier_sales"), p("supplier_sales_uk_2011"),
        p("continent_sales"), p("cancellations_by_continent"),
    )
    aggregation_job(
        spark, p("enriched"), raw, supplier, world, outs, market_country, market_year,
        raw_count=cleaning_audit["raw_retail"],
    )

    enriched = load_parquet(spark, p("enriched"), ENRICHED)
    save_parquet(agg.transactions_by_hour(enriched), p("transactions_by_hour"))
    hours = load_parquet(spark, p("transactions_by_hour"))
    answers = {
        "best_product": agg.best_product_in_country(enriched, best_product_country).first()[0],
        "peak_hour": agg.peak_hour(hours).first()[0],
    }
    if world is not None:
        cancellations = load_parquet(spark, p("cancellations_by_continent"))
        answers["top_cancelled_continent"] = agg.top_cancelled_continent(cancellations).first()[0]
    return {"root": out_root, "answers": answers}


def stored_inputs(spark: SparkSession, retail: DataFrame, supplier: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Raw lines and bridge written under ``root`` and read back: jobs read
    them several times, and views would join and group anew each time."""
    paths = [os.path.join(root, "raw"), os.path.join(root, "bridge")]
    for df, path in zip((retail, supplier), paths):
        save_parquet(df, path)
    return load_parquet(spark, paths[0]), load_parquet(spark, paths[1])


def run_all_on_driver_tables(spark: SparkSession, sf_dir: str, out_root: str) -> dict:
    """:func:`run_all` over the driver's tables (retail-shaped views)."""
    from tillroll.plans.params import BEST_PRODUCT_COUNTRY, MARKET_COUNTRY, MARKET_YEAR
    from tillroll.sources import driver_views as views

    raw, bridge = stored_inputs(spark, views.retail(spark, sf_dir), views.bridge(spark, sf_dir), out_root)
    return run_all(
        spark,
        raw,
        bridge,
        views.mapping(spark, sf_dir),
        out_root,
        market_country=MARKET_COUNTRY,
        market_year=MARKET_YEAR,
        best_product_country=BEST_PRODUCT_COUNTRY,
    )


def single_machine_results(
    retail: DataFrame,
    supplier: DataFrame,
    mapping: DataFrame | None = None,
    *,
    market_country: str = "United Kingdom",
    market_year: int = 2011,
    best_product_country: str = DEFAULT_BEST_PRODUCT_COUNTRY,
    date_formats=CleaningRules().date_formats,
) -> dict:
    """The single-machine pipeline's results, as lazy frames.

    Lenient cleaning, unrounded line amounts, raw sums, no null groups,
    case-sensitive cancellations; world results only with a mapping. The
    one-row frames hold the scalar answers.
    """
    from tillroll.operators.cleaning import clean_lenient, coerce_numbers
    from tillroll.operators.enrich import total_amount_unrounded

    cleaned = clean_lenient(coerce_numbers(retail), date_formats)
    lines = total_amount_unrounded(cleaned)
    by_hour = agg.transactions_by_hour(lines)
    market = agg.filter_country_year(lines, market_country, market_year)
    results = {
        "cleaned_df": lines,
        "country_sales": agg.group_by_country_sum_only(lines),
        "monthly_stats": agg.aggregate_monthly_data(lines, rounded=False),
        "best_product": agg.best_product_in_country(lines, best_product_country),
        "transaction_peak_hour": by_hour,
        "peak_hour": agg.peak_hour(by_hour),
        "supplier_sales": agg.aggregate_supplier_data_matched_only(lines, supplier),
        "supplier_sales_uk_2011": agg.aggregate_supplier_data_matched_only(market, supplier),
        "world_results": None,
    }
    if mapping is not None:
        cancellations = agg.build_cancellations_by_continent(retail, mapping, case_sensitive=True, keep_unmapped=False)
        results["world_results"] = {
            "continent_sales": agg.aggregate_world_data(lines, mapping, rounded=False, keep_unmapped=False),
            "cancellations_by_continent": cancellations,
            "top_cancelled_continent": agg.top_cancelled_continent(cancellations),
            "world_df": with_continent(lines, mapping),
        }
    return results


def run_single_machine(retail: DataFrame, supplier: DataFrame, output_path: str, mapping: DataFrame | None = None, **options) -> dict:
    """:func:`single_machine_results`, and the final lines saved as Parquet; an
    empty result is an error."""
    results = single_machine_results(retail, supplier, mapping, **options)
    save_parquet_guarded(results["cleaned_df"], output_path)
    return results
