"""Sources and sinks: optional inputs, result folders, audit JSON, CSV preview."""

import os
import subprocess
import sys

import pytest

from tillroll.schemas import AUDIT, COUNTRY_SALES, ENRICHED, MAPPING, SUPPLIER
from tillroll.session import shared_dir
from tillroll.sources.readers import (
    audit_frame,
    load_catalog_table,
    load_csv,
    load_optional,
    load_parquet,
    load_result_dir,
    load_source,
)
from tillroll.sources.writers import export_csv_preview, save_audit, save_parquet


def test_optional_source_missing_is_none(spark, scratch):
    assert load_optional(spark, None) is None
    assert load_optional(spark, os.path.join(scratch, "nope.csv"), MAPPING) is None
    assert load_optional(spark, os.path.join(scratch, "nope")) is None


def test_result_dir_recursive_and_empty(spark, scratch):
    save_parquet(spark.range(5), os.path.join(scratch, "a", "b"))
    assert load_result_dir(spark, os.path.join(scratch, "a")).count() == 5
    os.makedirs(os.path.join(scratch, "empty"))
    with pytest.raises(FileNotFoundError):
        load_result_dir(spark, os.path.join(scratch, "empty"))


def test_audit_json_round_trip(spark, scratch):
    path = os.path.join(scratch, "audit")
    save_audit(audit_frame(spark, [("raw_retail", 10), ("cleaned", 7)]), path)
    back = spark.read.schema(AUDIT).json(path)
    assert sorted(map(tuple, back.collect())) == [("cleaned", 7), ("raw_retail", 10)]


def test_csv_preview_has_header_and_n_rows(spark, scratch):
    path = os.path.join(scratch, "preview")
    export_csv_preview(spark.range(100).withColumnRenamed("id", "n"), path, n=10)
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["n"] and back.count() == 10


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("tillroll_tmp_tbl")
    assert load_catalog_table(spark, "tillroll_tmp_tbl").count() == 3


def test_csv_columns_by_header(spark, scratch):
    path = os.path.join(scratch, "supplier.csv")
    with open(path, "w") as f:
        f.write("id,Fournisseur, invoiceno \n1,F100,536365\n")
    assert load_csv(spark, path, SUPPLIER).collect() == [("536365", "F100")]
    path = os.path.join(scratch, "mapping.csv")
    with open(path, "w") as f:
        f.write("id,Country\n1,France\n")
    with pytest.raises(ValueError, match="Continent"):
        load_csv(spark, path, MAPPING)


def test_parquet_is_checked_and_cast(spark, scratch):
    path = os.path.join(scratch, "supplier")
    spark.createDataFrame([(536365, "F100")], "InvoiceNo bigint, Fournisseur string").write.parquet(path)
    assert load_parquet(spark, path, SUPPLIER).collect() == [("536365", "F100")]
    with pytest.raises(ValueError, match="TotalAmount"):
        load_parquet(spark, path, ENRICHED)


def test_text_that_does_not_fit_becomes_null(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    with open(path, "w") as f:
        f.write("Country,TransactionCount,TotalAmount\nFR,two,1.5\n")
    assert load_csv(spark, path, COUNTRY_SALES).collect() == [("FR", 1.5, None)]


def test_catalog_prefix(spark):
    spark.createDataFrame([(7, "F1")], "invoiceno int, fournisseur string").createOrReplaceTempView("tillroll_tmp_bridge")
    assert load_source(spark, "catalog:tillroll_tmp_bridge", SUPPLIER).collect() == [("7", "F1")]


def test_shared_dir_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_session_defaults_leave_the_launcher_its_own():
    code = (
        "from tillroll.session import get_spark\n"
        "s = get_spark(master='local[1]')\n"
        "print('ZONE', s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.enabled'))\n"
    )
    env = os.environ | {
        "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.session.timeZone=Europe/Paris pyspark-shell",
        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
    }
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "ZONE Europe/Paris true" in out.stdout, out.stderr[-500:]


def test_manifest_works_from_another_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "import __spark_entry__ as e\n"
        "from tillroll.session import get_spark\n"
        "s = get_spark(master='local[2]', shuffle_partitions=2)\n"
        "print('ROWS', e.queries()['run_manifest_classified'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 9" in out.stdout, out.stderr[-800:]
