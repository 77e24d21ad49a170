"""The three jobs end to end, then the manifest of what they wrote."""

import os

import pytest
from pyspark.errors import AnalysisException

from tillroll.operators import quality
from tillroll.plans.jobs import run_all_on_driver_tables
from tillroll.plans import catalog, jobs
from tillroll.sources import driver_views as views
from tillroll.sources.readers import load_result_dir
from tillroll.sources.writers import save_parquet_guarded

from conftest import SMOKE_DIR


def test_pipeline_outputs_and_manifest(spark, scratch):
    root = os.path.join(scratch, "out")
    result = run_all_on_driver_tables(spark, SMOKE_DIR, root)

    country = load_result_dir(spark, os.path.join(root, "country_sales"))
    expected = catalog.queries()["country_sales"](spark, SMOKE_DIR)
    assert sorted(map(tuple, country.collect())) == sorted(map(tuple, expected.collect()))

    audit = {r.step: r.row_count for r in spark.read.json(os.path.join(root, "debug_counts_cleaning_job")).collect()}
    assert audit["cleaned"] == spark.read.parquet(os.path.join(root, "cleaned")).count()
    agg_audit = {r.step: r.row_count for r in spark.read.json(os.path.join(root, "debug_counts_aggregations_job")).collect()}
    assert agg_audit["country_sales"] == country.count()
    assert agg_audit["raw_retail"] == audit["raw_retail"] == catalog.queries()["total_amount_unrounded"](spark, SMOKE_DIR).count()
    assert set(result["answers"]) == {"best_product", "peak_hour", "top_cancelled_continent"}

    files = quality.file_manifest(spark, root, recursive=True)
    manifest = quality.run_manifest(files)
    quality.check_consistent_schemas(manifest)
    dest = {r.destination for r in quality.resolve_destinations(manifest).collect()}
    for name in ("cleaned", "enriched", "country_sales", "monthly_sales", "continent_sales",
                 "cancellations_by_continent", "supplier_sales", "supplier_sales_uk_2011"):
        assert name in dest


def test_manifest_flags_mixed_schemas(spark, scratch):
    import pandas as pd

    folder = os.path.join(scratch, "flat")
    os.makedirs(folder)
    run = "0a1b2c3d-0000-1111-2222-333344445555"
    pd.DataFrame({"Country": ["FR"], "TotalAmount": [1.0], "TransactionCount": [1]}).to_parquet(
        os.path.join(folder, f"part-00000-{run}-c000.snappy.parquet"))
    pd.DataFrame({"Continent": ["EU"], "TotalAmount": [1.0]}).to_parquet(
        os.path.join(folder, f"part-00001-{run}-c000.snappy.parquet"))
    pd.DataFrame({"SupplierID": [], "TotalAmount": []}).to_parquet(os.path.join(folder, "old.parquet"))
    manifest = quality.run_manifest(quality.file_manifest(spark, folder))
    with pytest.raises(ValueError):
        quality.check_consistent_schemas(manifest)
    dest = {r.run_id: r.destination for r in quality.resolve_destinations(manifest).collect()}
    assert dest["old"] == "supplier_sales"  # the only supplier-family run ranks first, even empty


def test_single_machine_results(spark):
    from tillroll.plans.jobs import single_machine_results
    from tillroll.sources import driver_views as views

    res = single_machine_results(
        views.dirty(spark, SMOKE_DIR), views.bridge(spark, SMOKE_DIR), views.mapping(spark, SMOKE_DIR),
        market_country="NATION_7", market_year=1998, best_product_country="nation_3",
    )
    assert res["cleaned_df"].count() > 0
    assert res["country_sales"].columns == ["Country", "TotalAmount"]
    assert res["supplier_sales"].filter("SupplierID IS NULL").count() == 0
    world = res["world_results"]
    assert world["continent_sales"].filter("Continent IS NULL").count() == 0
    assert world["top_cancelled_continent"].count() == 1
    assert res["peak_hour"].first()[0] is not None


def test_config_driven_jobs(spark, scratch):
    from tillroll.config import AggregationJobConfig, CleaningJobConfig, EnrichJobConfig
    from tillroll.plans.jobs import run_aggregation_job, run_cleaning_job, run_enrich_job
    from tillroll.sources import driver_views as views

    retail = os.path.join(scratch, "retail")
    supplier = os.path.join(scratch, "supplier")
    mapping = os.path.join(scratch, "mapping.csv")
    views.retail(spark, SMOKE_DIR).write.parquet(retail)
    views.bridge(spark, SMOKE_DIR).write.parquet(supplier)
    views.mapping(spark, SMOKE_DIR).coalesce(1).write.option("header", "true").csv(mapping)

    out = os.path.join(scratch, "out")
    audit1 = run_cleaning_job(spark, CleaningJobConfig(retail, os.path.join(out, "cleaned")))
    audit2 = run_enrich_job(spark, EnrichJobConfig(os.path.join(out, "cleaned"), os.path.join(out, "enriched")))
    cfg = AggregationJobConfig(
        enriched_input_path=os.path.join(out, "enriched"),
        retail_source=retail,
        supplier_source=supplier,
        mapping_source=mapping,
        country_output_path=os.path.join(out, "country_sales"),
        monthly_output_path=os.path.join(out, "monthly_sales"),
        supplier_output_path=os.path.join(out, "supplier_sales"),
        supplier_market_output_path=os.path.join(out, "supplier_sales_uk_2011"),
        world_output_path=os.path.join(out, "continent_sales"),
        cancellation_output_path=os.path.join(out, "cancellations_by_continent"),
        market_country="NATION_7",
        market_year=1998,
    )
    audit3 = {r.step: r.row_count for r in run_aggregation_job(spark, cfg).collect()}

    cleaned = {r.step: r.row_count for r in audit1.collect()}
    enriched = {r.step: r.row_count for r in audit2.collect()}
    assert cleaned["cleaned"] == enriched["cleaned_input"] == enriched["enriched_output"] == audit3["enriched_input"]
    assert audit3["continent_sales"] == 5 and audit3["mapping"] == 20
    assert os.path.isdir(os.path.join(out, "debug_counts_aggregations_job"))

    # a mapping that is named but absent is an error
    with pytest.raises(AnalysisException):
        run_aggregation_job(spark, AggregationJobConfig(**{**cfg.__dict__, "mapping_source": os.path.join(scratch, "absent.csv")}))
    # without one the continent results of the run before do not stay
    audit4 = {r.step: r.row_count for r in run_aggregation_job(spark, AggregationJobConfig(**{**cfg.__dict__, "mapping_source": None})).collect()}
    assert "continent_sales" not in audit4 and "country_sales" in audit4
    assert spark.read.parquet(os.path.join(out, "continent_sales")).count() == 0


def test_missing_required_input_raises(spark, scratch):
    from tillroll.plans.jobs import cleaning_job

    with pytest.raises(AnalysisException):
        cleaning_job(spark, os.path.join(scratch, "absent"), os.path.join(scratch, "cleaned"))


def test_cleaning_audit_is_observed(spark, scratch):
    from tillroll.operators.quality import cleaning_waterfall
    from tillroll.plans.jobs import cleaning_job
    from tillroll.sources import driver_views as views

    dirty = views.dirty(spark, SMOKE_DIR)
    audit = cleaning_job(spark, dirty, os.path.join(scratch, "cleaned"))
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, cleaning_waterfall(dirty).collect()))


def test_command_line(spark, scratch, capsys):
    from tillroll.run import main, parser
    from tillroll.sources import driver_views as views

    retail, cleaned, enriched = (os.path.join(scratch, n) for n in ("retail", "cleaned", "enriched"))
    views.retail(spark, SMOKE_DIR).write.parquet(retail)
    main(["clean", "--retail-source", retail, "--cleaned-output-path", cleaned], spark)
    main(["enrich", "--cleaned-input-path", cleaned, "--enriched-output-path", enriched], spark)
    assert "enriched_output:" in capsys.readouterr().out
    assert "TotalAmount" in spark.read.parquet(enriched).columns
    with pytest.raises(SystemExit):
        parser().parse_args(["aggregate", "--enriched-input-path", enriched])


def test_single_machine_save_refuses_empty(spark, scratch):
    from tillroll.plans.jobs import run_single_machine
    from tillroll.sources import driver_views as views

    bridge = views.bridge(spark, SMOKE_DIR)
    with pytest.raises(ValueError):
        run_single_machine(views.dirty(spark, SMOKE_DIR).filter("false"), bridge, os.path.join(scratch, "out"))


def test_stages_stay_below_the_size_that_the_jvm_compiles(spark):
    """joining, building and parsing the lines in one generated method ran interpreted."""
    from tillroll.session import HUGE_METHOD, compiled_only

    name, value = HUGE_METHOD
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        views.dirty(spark, SMOKE_DIR)
        assert spark.conf.get(name) == value
        spark.conf.set(name, "4000")
        assert compiled_only(spark).conf.get(name) == "4000"
    finally:
        spark.conf.set(name, before)


def test_a_guarded_save_computes_its_rows_once(spark, scratch):
    """also with several partitions, of which the first have no row."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 1000, 1, 4).mapInArrow(counted, "id long").filter("id > 600")
    save_parquet_guarded(rows, scratch + "/out")
    assert spark.read.parquet(scratch + "/out").count() == 399 and seen.value == 1000
    with pytest.raises(ValueError):
        save_parquet_guarded(rows.filter("id < 0"), scratch + "/out")
    assert spark.read.parquet(scratch + "/out").count() == 399
    assert sorted(os.listdir(scratch)) == ["out"]


def test_jobs_read_stored_inputs(spark, scratch, monkeypatch):
    """the views' joins run once, to store the lines and the bridge."""
    files = []
    job = jobs.aggregation_job
    monkeypatch.setattr(jobs, "aggregation_job", lambda s, path, raw, bridge, *more, **named: files.extend(raw.inputFiles() + bridge.inputFiles()) or job(s, path, raw, bridge, *more, **named))
    catalog.queries()["published_results"](spark, SMOKE_DIR)
    jobs.run_all_on_driver_tables(spark, SMOKE_DIR, scratch)
    assert files and not [f for f in files if "/root/testdata" in f]


def test_a_profiled_result_is_computed_once(spark):
    """rows and first rows share the shuffles of a result."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 1000, 1, 4).mapInArrow(counted, "id long")
    result = rows.groupBy((rows["id"] % 7).alias("k")).count().orderBy("k")
    got = quality.folder_profile({"r": result}, preview_rows=3).collect()
    assert [(r.column_name, r.preview, r.row_count) for r in got] == [("k", "0|1|2", 7), ("count", "143|143|143", 7)]
    assert seen.value == 1000
    assert quality.folder_profile({"r": result.filter("k < 0")}).first().row_count == 0
