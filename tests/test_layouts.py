"""Lines by month, clustered and co-located; counts and distinct rows that grow by batches."""

import datetime as dt
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from tillroll.operators import aggregates as agg
from tillroll.operators import incremental
from tillroll.plans import catalog, jobs
from tillroll.schemas import ENRICHED, RETAIL
from tillroll.sources import driver_views as views
from tillroll.sources import layouts
from tillroll.sources.readers import load_parquet


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines"))
    catalog.enriched(spark, SMOKE_DIR).write.mode("overwrite").parquet(path)
    return load_parquet(spark, path, ENRICHED)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


# --- by month -------------------------------------------------------------------


def test_a_rerun_of_one_month_leaves_the_others(spark, lines, scratch):
    odd = lines.limit(3).withColumn("InvoiceDate", F.lit(None).cast("timestamp_ntz"))
    layouts.save_by_month(lines.unionByName(odd), scratch)
    stored = layouts.load_by_month(spark, scratch, ENRICHED)
    assert rows_of(stored.drop("InvoiceMonth")) == rows_of(lines.unionByName(odd))
    months = sorted(r[0] for r in stored.select("InvoiceMonth").distinct().collect() if r[0])
    first, second, third = months[:3]
    files = {m: sorted(os.listdir(f"{scratch}/InvoiceMonth={m}")) for m in months}
    layouts.save_by_month(lines.filter(F.date_format("InvoiceDate", "yyyy-MM") == first).limit(2), scratch)
    layouts.replace_months(lines.filter(F.date_format("InvoiceDate", "yyyy-MM") == second).limit(1), scratch, [second, third])
    counts = {r[0]: r[1] for r in layouts.load_by_month(spark, scratch, ENRICHED).groupBy("InvoiceMonth").count().collect()}
    assert counts[first] == 2 and counts[second] == 1 and third not in counts and counts[None] == 3
    assert all(sorted(os.listdir(f"{scratch}/InvoiceMonth={m}")) == files[m] for m in months[3:])
    with pytest.raises(Exception, match="another month"):
        layouts.replace_months(lines, scratch, [second])
    assert {r[0]: r[1] for r in layouts.load_by_month(spark, scratch, ENRICHED).groupBy("InvoiceMonth").count().collect()} == counts


def test_the_year_prunes_partitions(spark, lines, scratch):
    layouts.save_by_month(lines, scratch)
    stored = layouts.load_by_month(spark, scratch, ENRICHED)
    bridge = spark.createDataFrame([("1", "F1")], "InvoiceNo string, Fournisseur string")
    plan = plan_text(agg.aggregate_supplier_market(stored, bridge, "NATION_1", 1995))
    assert "PartitionFilters: [isnotnull(InvoiceMonth" in plan and "1995-01" in plan.split("PartitionFilters")[1][:200]
    few = agg.filter_country_year(stored, "NATION_1", 1995).select(F.input_file_name().alias("f")).distinct().collect()
    assert few and all("InvoiceMonth=1995" in r.f for r in few)


def test_listed_months_prune_while_the_query_runs(spark, lines, scratch):
    layouts.save_by_month(lines, scratch)
    spark.createDataFrame([("1995-03", 1), ("1996-07", 0)], "InvoiceMonth string, chosen int").write.parquet(scratch + "_months")
    months = spark.read.parquet(scratch + "_months").filter("chosen = 1")
    found = layouts.lines_of_months(layouts.load_by_month(spark, scratch, ENRICHED), months)
    assert "dynamicpruning" in plan_text(found)
    assert rows_of(found.drop("InvoiceMonth")) == rows_of(lines.filter(F.date_format("InvoiceDate", "yyyy-MM") == "1995-03"))


def test_the_jobs_over_lines_by_month(spark, lines, scratch):
    lines.drop("TotalAmount").write.parquet(scratch + "/cleaned")
    jobs.enrich_job(spark, scratch + "/cleaned", scratch + "/enriched", by_month=True)
    assert any(x.startswith("InvoiceMonth=") for x in os.listdir(scratch + "/enriched"))
    raw, bridge, mapping = views.retail(spark, SMOKE_DIR), views.bridge(spark, SMOKE_DIR), views.mapping(spark, SMOKE_DIR)
    audit = jobs.aggregation_job(spark, scratch + "/enriched", raw, bridge, mapping, scratch + "/out", "NATION_1", 1995)
    lines.write.parquet(scratch + "/plain")
    same = jobs.aggregation_job(spark, scratch + "/plain", raw, bridge, mapping, scratch + "/out2", "NATION_1", 1995)
    assert sorted(audit.collect()) == sorted(same.collect())


# --- clustered ------------------------------------------------------------------


def groups_read(path, wanted):
    """Row groups whose ranges meet all wanted ranges, and all row groups."""
    read = total = 0
    for name in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        columns = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(columns[c]).statistics for c in wanted}
            total += 1
            read += all(stats[c].min <= hi and stats[c].max >= lo for c, (lo, hi) in wanted.items())
    return read, total


def test_clustered_lines_skip_more_row_groups(spark, scratch):
    rng = random.Random(1)
    start = dt.datetime(2010, 1, 1)
    data = [(f"land {rng.randrange(24):02d}", start + dt.timedelta(hours=rng.randrange(17000)), rng.random() * 1000, i) for i in range(40_000)]
    df = spark.createDataFrame(data, "Country string, InvoiceDate timestamp_ntz, UnitPrice double, i long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        layouts.save_clustered(df, scratch + "/z", ["Country", "InvoiceDate", "UnitPrice"])
        df.repartition(64).write.parquet(scratch + "/plain")
        df.repartitionByRange(64, "InvoiceDate").write.parquet(scratch + "/dates")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(scratch + "/z").agg(F.sum("i"), F.count("i")).first() == (sum(range(40_000)), 40_000)
    market = {"Country": ("land 07", "land 07"), "InvoiceDate": (dt.datetime(2010, 6, 1), dt.datetime(2010, 9, 1))}
    bounds = {"UnitPrice": (990.0, 1000.0)}
    for wanted in (market, bounds, market | bounds):
        read, total = groups_read(scratch + "/z", wanted)
        plain, plain_total = groups_read(scratch + "/plain", wanted)
        assert total >= 48 and plain == plain_total and read <= 0.45 * total, (wanted, read, total)
    # an order by date alone skips nothing for prices
    assert groups_read(scratch + "/dates", bounds)[0] >= 60


def test_clustering_keeps_every_row(spark, scratch):
    data = [("x", None, 1.0)] * 500 + [(None, dt.datetime(2011, 1, 1), None)] * 3 + [("y", dt.datetime(2012, 1, i % 27 + 1), float(i)) for i in range(50)]
    df = spark.createDataFrame(data, "Country string, InvoiceDate timestamp_ntz, UnitPrice double")
    layouts.save_clustered(df, scratch + "/z", ["Country", "InvoiceDate", "UnitPrice"], row_group_bytes=1 << 20)
    assert rows_of(spark.read.parquet(scratch + "/z")) == rows_of(df)
    layouts.save_clustered(df.limit(0), scratch + "/none", ["Country", "UnitPrice"])
    assert spark.read.schema(df.schema).parquet(scratch + "/none").count() == 0


# --- co-located -----------------------------------------------------------------


@pytest.fixture()
def database(spark, scratch):
    spark.sql(f"CREATE DATABASE layouts_test LOCATION '{scratch}/db'")
    yield "layouts_test"
    spark.sql("DROP DATABASE layouts_test CASCADE")


def test_join_without_an_exchange_and_a_hot_invoice(spark, database):
    data = [(str(i % 90), 1.0 + i % 7) for i in range(900)] + [("hot", 2.0)] * 3000 + [(None, 5.0)] * 4 + [("alone", 1.5)]
    lines = spark.createDataFrame(data, "InvoiceNo string, TotalAmount double").repartition(6)
    bridge = spark.createDataFrame(
        [(str(i % 80), f"S{i % 11}") for i in range(240)] + [("hot", "S1"), ("hot", "S2"), ("hot", "S2")] + [("wide", f"S{i}") for i in range(500)] + [(None, "S9")],
        "InvoiceNo string, Fournisseur string",
    )
    layouts.save_colocated(lines, bridge, f"{database}.t", buckets=4, hot_rows=100)
    assert {r[0] for r in spark.table(f"{database}.t_hot_lines").select("InvoiceNo").distinct().collect()} == {"hot", None}
    assert {r[0] for r in spark.table(f"{database}.t_hot_bridge").select("InvoiceNo").distinct().collect()} == {"hot", "wide", None}
    got = layouts.colocated_supplier_sales(spark, f"{database}.t")
    want = agg.aggregate_supplier_data(lines, bridge)
    assert {r.SupplierID: r.TotalAmount for r in got.collect()} == {r.SupplierID: r.TotalAmount for r in want.collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = spark.table(f"{database}.t_lines").groupBy("InvoiceNo").agg(F.sum("TotalAmount").alias("a"))
        pairs = spark.table(f"{database}.t_bridge").groupBy("InvoiceNo", "SupplierID").count()
        joined = final_plan(totals.join(pairs, "InvoiceNo", "left"))
        assert "Join" in joined and "Exchange" not in joined
        # the whole query moves only the hot rows and the suppliers' sums
        plan = final_plan(layouts.colocated_supplier_sales(spark, f"{database}.t"))
        bucketed = [p for p in plan.split("\n") if "Bucketed: true" in p or "SelectedBucketsCount" in p]
        assert len(bucketed) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# --- stored counts --------------------------------------------------------------


def direct(lines):
    out = None
    values = {"country": F.col("Country"), "month": F.date_format("InvoiceDate", "yyyy-MM"), "hour": F.hour("InvoiceDate").cast("string")}
    for name, value in values.items():
        df = lines.groupBy(value.alias("value")).agg(F.countDistinct("InvoiceNo").alias("invoices")).select(F.lit(name).alias("dimension"), "value", "invoices")
        out = df if out is None else out.unionByName(df)
    return sorted(map(str, out.filter("invoices > 0").collect()))


def test_a_month_added_to_the_state_equals_a_full_recount(spark, scratch):
    rng = random.Random(2)
    day = lambda: dt.datetime(2011, rng.randrange(1, 7), rng.randrange(1, 28), rng.randrange(24))
    data = [(rng.choice([f"C{rng.randrange(300)}", str(rng.randrange(70_000)), None]), rng.choice(["FR", "DE", None]), day()) for _ in range(20_000)]
    lines = spark.createDataFrame(data, "InvoiceNo string, Country string, InvoiceDate timestamp_ntz").repartition(5)
    month = F.date_format("InvoiceDate", "yyyy-MM")
    for some in (["2011-01", "2011-02"], ["2011-05"], ["2011-03", "2011-04", "2011-06"]):
        incremental.update_invoice_state(lines.filter(month.isin(some)), scratch)
    assert sorted(map(str, incremental.stored_invoice_counts(spark, scratch).collect())) == direct(lines)
    numbers = [r.number for r in spark.read.option("recursiveFileLookup", "true").parquet(scratch + "/numbers").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
    # a corrected month replaces its old state and nothing else
    fewer = lines.filter((month != "2011-05") | (F.col("Country") == "FR"))
    incremental.update_invoice_state(fewer.filter(month == "2011-05"), scratch)
    assert sorted(map(str, incremental.stored_invoice_counts(spark, scratch).collect())) == direct(fewer)


# --- distinct rows --------------------------------------------------------------


def test_batches_against_the_distinct_union(spark, scratch):
    rng = random.Random(3)
    row = lambda: (
        rng.choice(["1", "2", None]), "s", rng.choice(["d", "", None, "\x00null"]), rng.choice([1, 2, None]),
        rng.choice([dt.datetime(2011, 1 + rng.randrange(3), 1, rng.randrange(24)), None]), rng.choice([0.0, 1.5, None]), rng.choice([None, 7]), "FR",
    )
    batches = [[row() for _ in range(400)] for _ in range(3)]
    every = None
    for i, data in enumerate(batches):
        df = spark.createDataFrame(data, RETAIL).repartition(3)
        every = df if every is None else every.unionByName(df)
        counts = incremental.add_new_lines(df, scratch, f"batch {i}")
        assert counts.distinct == df.distinct().count() and counts.added <= counts.distinct
        assert (counts.compared == 0) == (i == 0)
        history = layouts.load_by_month(spark, scratch + "/history", RETAIL).drop("InvoiceMonth")
        assert rows_of(history) == rows_of(every.dropDuplicates())
    # the last batch once more: all of it is known
    again = incremental.add_new_lines(df, scratch, "batch 2")
    assert again.added == 0 and again.compared == again.distinct
    assert rows_of(layouts.load_by_month(spark, scratch + "/history", RETAIL).drop("InvoiceMonth")) == rows_of(every.dropDuplicates())
    assert incremental.add_new_lines(df.limit(0), scratch, "none") == incremental.BatchCounts(0, 0, 0)


def test_new_rows_pass_the_filter_unseen(spark, scratch):
    make = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("InvoiceNo"), F.lit(dt.datetime(2011, 1, 1)).alias("InvoiceDate"))
    incremental.add_new_lines(make(0, 5000), scratch, "a")
    counts = incremental.add_new_lines(make(4990, 10_000), scratch, "b")
    assert counts.distinct == 5010 and counts.added == 5000 and 10 <= counts.compared < 30


def test_a_full_filter_loses_nothing(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "FILTER_BITS", 1 << 15)
    monkeypatch.setattr(incremental, "BLOCK_BITS", 1 << 15)
    make = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("InvoiceNo"), F.lit(dt.datetime(2011, 1, 1)).alias("InvoiceDate"))
    incremental.add_new_lines(make(0, 60_000), scratch, "a")
    counts = incremental.add_new_lines(make(59_000, 61_000), scratch, "b")
    assert counts.added == 1000 and counts.compared > 1900


def test_the_history_is_reduced_before_it_is_compared(spark, scratch):
    """Only the asked months and hashes reach the comparison."""
    make = lambda m: spark.range(200).select(F.col("id").cast("string").alias("InvoiceNo"), F.lit(dt.datetime(2011, m, 1)).alias("InvoiceDate"))
    for m in (1, 2, 3):
        incremental.add_new_lines(make(m), scratch, f"m{m}")
    schema = make(1).schema
    history = layouts.load_by_month(spark, scratch + "/history", schema.add("_key", "long"))
    maybe = history.filter("InvoiceMonth = '2011-02'").limit(5)
    maybe.write.parquet(scratch + "/maybe")
    asked = incremental.not_in_history(spark.read.parquet(scratch + "/maybe"), history, ["InvoiceNo", "InvoiceDate"])
    plan = plan_text(asked)
    assert "PartitionFilters: [" in plan and "(InvoiceMonth#" in plan and "= 2011-02)" in plan
    # the semi join on hashes stands below the comparison of whole rows
    assert plan.index("LeftAnti") < plan.index("LeftSemi") and asked.count() == 0


def test_the_order_is_taken_over_stored_lines(spark, monkeypatch):
    """the passes that find ranges and order read lines written once."""
    files, save = [], layouts.save_clustered
    monkeypatch.setattr(layouts, "save_clustered", lambda df, *more: files.extend(df.inputFiles()) or save(df, *more))
    catalog.queries()["clustered_market_lines"](spark, SMOKE_DIR)
    assert files and not [f for f in files if "/root/testdata" in f]


def test_sides_are_computed_once_before_they_are_stored_apart(spark, scratch):
    """counts, marks and both tables of a side follow from one run of it."""
    database = "once_" + os.path.basename(scratch).replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch}/db'")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    lines = spark.range(0, 600, 1, 3).mapInArrow(counted, "id long").select((F.col("id") % 50 + (F.col("id") < 300).cast("int") * 100).cast("string").alias("InvoiceNo"), F.lit(1.0).alias("TotalAmount"))
    lines = lines.withColumn("InvoiceNo", F.when(F.col("InvoiceNo") != "7", F.col("InvoiceNo")))
    bridge = spark.range(40).select(F.col("id").cast("string").alias("InvoiceNo"), (F.col("id") % 3).cast("string").alias("Fournisseur"))
    layouts.save_colocated(lines, bridge, f"{database}.t", buckets=2, hot_rows=5)
    assert seen.value == 600
    assert spark.table(f"{database}.t_lines").count() + spark.table(f"{database}.t_hot_lines").count() == 600
    direct = agg.aggregate_supplier_data(lines, bridge)
    assert rows_of(layouts.colocated_supplier_sales(spark, f"{database}.t")) == rows_of(direct)


def test_dimensions_unfold_after_the_numbers_are_joined(spark):
    """an invoice's row is joined once, not once for every dimension."""
    lines = spark.createDataFrame([("1", "FR", dt.datetime(2011, 1, 1, 8)), ("1", "FR", dt.datetime(2011, 1, 1, 8)), ("2", None, None)], "InvoiceNo string, Country string, InvoiceDate timestamp_ntz")
    numbers = spark.createDataFrame([("1", 1), ("2", 2)], "InvoiceNo string, number long")
    state = incremental.invoice_state(lines, numbers)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join")
    got = {(r.dimension, r.value): r.invoices for r in incremental.merged_counts(state).collect()}
    assert got == {("country", "FR"): 1, ("month", "2011-01"): 1, ("hour", "8"): 1, ("country", None): 1, ("month", None): 1, ("hour", None): 1}


def test_lines_are_looked_up_where_they_are(spark, scratch):
    """a line has all its bits in one block, is not dealt for the lookup, and a history with an earlier filter gets this one."""
    make = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("InvoiceNo"), F.lit(dt.datetime(2011, 1, 1)).alias("InvoiceDate"))
    new = make(0, 100).withColumn("_key", F.xxhash64("InvoiceNo"))
    found = incremental.possible_repeats(new, incremental.filter_blocks(new.filter("_key % 2 = 0")))
    plan = plan_text(found)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert found.filter("_key % 2 = 0 and not _maybe").count() == 0 and found.count() == 100
    incremental.add_new_lines(make(0, 50), scratch, "a")
    os.rename(f"{scratch}/{incremental.FILTER_FOLDER}", f"{scratch}/filter")
    counts = incremental.add_new_lines(make(40, 60), scratch, "b")
    assert (counts.distinct, counts.added) == (20, 10)
