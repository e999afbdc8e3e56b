"""End-to-end batch jobs on the smallest test data."""

import datetime as dt
import pathlib
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import SMALL
from ledger.params import RunParams
from ledger.plans import jobs, pricing, vm
from ledger.registry import QUERIES
from ledger.session import checkpoint_dir
from ledger.sources import fixtures
from ledger.sources.catalog import IncompleteCatalogError
from ledger.sources.schemas import FACT_TABLES, GOLD, TABLE_COMMENTS

AS_OF = dt.date(2000, 6, 30)
def NOW():
    return F.lit("2000-07-01 00:30:00").cast("timestamp")


def _shared(spark):
    return pathlib.Path(checkpoint_dir(spark).removeprefix("file:"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_job_matches_queries_and_is_idempotent(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    before = [x.name for x in _shared(spark).iterdir() if x.name.startswith(("usage-rollup-", "estimates-", "upsert-"))]
    jobs.run_daily(spark, src, wh, RunParams(as_of=AS_OF, lookback_days=None, bounded=False), now=NOW())
    cols = [c for c in QUERIES["daily_cost_summary"](spark, SMALL).columns]

    def stored(name):
        return spark.read.parquet(wh.path(name)).select(*cols)

    expected = QUERIES["daily_cost_summary"](spark, SMALL).select(*cols)
    from ledger.registry import boundary
    assert _same(boundary(stored("daily_cost_summary")), expected)
    for name in FACT_TABLES:  # the audit column holds the time of the run
        assert [str(r[0]) for r in spark.read.parquet(wh.path(name)).select("_etl_updated_at").distinct().collect()] == ["2000-07-01 00:30:00"]
    # the reference's daily cadence: recompute 90 days and upsert -> same table
    jobs.run_daily(spark, src, wh, RunParams(as_of=AS_OF, lookback_days=90, bounded=False), now=NOW())
    assert _same(boundary(stored("daily_cost_summary")), expected)
    vm_cols = QUERIES["vm_cost_estimate"](spark, SMALL).columns
    vm_stored = boundary(spark.read.parquet(wh.path("daily_cost_with_vm_estimate"))).select(*vm_cols)
    assert _same(vm_stored, QUERIES["vm_cost_estimate"](spark, SMALL))
    assert spark.read.parquet(wh.path("gcp_vm_reference_prices")).count() == 82
    # two runs leave no staging folder behind
    left = [x.name for x in _shared(spark).iterdir() if x.name.startswith(("usage-rollup-", "estimates-", "upsert-"))]
    assert sorted(left) == sorted(before)


def test_alert_job_deduplicates_across_runs(spark, tmp_path):
    src = fixtures.load(spark, "/root/testdata/sf0.01")
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    p = RunParams(as_of=AS_OF, lookback_days=None)
    jobs.run_daily(spark, src, wh, p, now=NOW())
    first = jobs.run_alerts(spark, src.alert_config, wh, p, now=NOW()).collect()[0]
    second = jobs.run_alerts(spark, src.alert_config, wh, p, now=NOW()).collect()[0]
    assert first.alerts_sent >= 1 and second.alerts_sent == 0
    assert first.total_sent_today == second.total_sent_today == first.alerts_sent
    files = sorted(x.name for x in pathlib.Path(wh.path("alert_history")).glob("*.parquet"))
    jobs.run_alerts(spark, src.alert_config, wh, p, now=NOW())
    assert files == sorted(x.name for x in pathlib.Path(wh.path("alert_history")).glob("*.parquet"))
    hist = spark.read.parquet(wh.path("alert_history"))
    assert hist.count() == first.alerts_sent and hist.select("alert_id").distinct().count() == first.alerts_sent


def test_setup_creates_tables_and_redeploy_keeps_created_at(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))

    def row(threshold, at):
        return spark.createDataFrame(
            [(1, Decimal(threshold), "ops@example.com", True, "25,50,75,90,100")],
            "config_id int, daily_threshold_dollars decimal(20,2), recipient_emails string, is_active boolean, "
            "threshold_percentages string",
        ).withColumn("created_at", F.lit(at).cast("timestamp")).withColumn("updated_at", F.lit(at).cast("timestamp"))

    jobs.setup(spark, wh, row(1000, "2000-01-01 00:00:00"), F.lit("2000-01-01 00:00:00").cast("timestamp"))
    jobs.setup(spark, wh, row(300, "2000-02-01 00:00:00"), F.lit("2000-02-01 00:00:00").cast("timestamp"))
    cfg = jobs.read_table(spark, wh, "alert_config").collect()
    assert len(cfg) == 1 and float(cfg[0].daily_threshold_dollars) == 300
    assert str(cfg[0].created_at) == "2000-01-01 00:00:00" and str(cfg[0].updated_at) == "2000-02-01 00:00:00"
    assert jobs.read_table(spark, wh, "alert_history").count() == 0


def test_declared_schema_read_adds_missing_column(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    old = QUERIES["vm_cost_estimate"](spark, SMALL).drop("vm_cost_source")
    jobs.with_month(old).write.partitionBy("usage_month").parquet(wh.path("daily_cost_with_vm_estimate"))
    t = jobs.read_table(spark, wh, "daily_cost_with_vm_estimate")
    assert "vm_cost_source" in t.columns and t.where(F.col("vm_cost_source").isNotNull()).count() == 0


def test_sources_are_conformed(spark, tmp_path):
    """TIMESTAMP and DOUBLE columns, and struct fields in another order, give the same tables."""
    src = fixtures.load(spark, SMALL)
    p = RunParams(as_of=AS_OF, lookback_days=90)
    loose = replace(
        src,
        usage=src.usage.withColumns({c: F.col(c).cast("timestamp") for c in ("usage_start_time", "usage_end_time")})
        .withColumn("usage_quantity", F.col("usage_quantity").cast("double"))
        .withColumn("product_features", F.struct(F.lit(1).alias("other"), F.col("product_features.is_serverless").alias("is_serverless"))),
        node_timeline=src.node_timeline.withColumns({c: F.col(c).cast("timestamp") for c in ("start_time", "end_time")}))
    tables = []
    for name, s in (("a", src), ("b", loose)):
        wh = jobs.Warehouse(str(tmp_path / name))
        jobs.run_daily(spark, s, wh, p, now=NOW())
        tables.append([jobs.read_table(spark, wh, t) for t in ("daily_cost_summary", "daily_cost_with_vm_estimate")])
    assert all(_same(x, y) for x, y in zip(*tables))


def test_a_run_for_a_past_day_leaves_out_later_usage(spark):
    src = fixtures.load(spark, SMALL)
    past = dt.date(1998, 6, 30)
    last = lambda p: pricing.usage_window(src.usage, p).agg(F.max("usage_date")).first()[0]
    assert last(RunParams(as_of=past)) <= past < last(RunParams(as_of=past, bounded=False))
    hours = vm.node_hours(src.node_timeline, RunParams(as_of=past, lookback_days=None))
    assert hours.agg(F.max("usage_date")).first()[0] <= past


def test_catalogue_prices_are_for_gcp_only(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    for cloud, live in (("GCP", True), ("AWS", False)):
        wh = jobs.Warehouse(str(tmp_path / cloud))
        got = jobs.refresh_vm_prices(spark, src, wh, RunParams(as_of=AS_OF, cloud=cloud), src.catalog_pages, NOW())
        assert (got.where(F.col("vcpus") == 0).count() > 0) == live


def test_stored_partition_and_comments(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.setup(spark, wh)
    for name, (schema, _) in GOLD.items():
        stored = jobs.read_table(spark, wh, name)
        assert ("usage_month" in stored.columns) == (name in FACT_TABLES)
        assert all(f.metadata.get("comment") for f in schema.fields)


def test_update_config_changes_only_what_is_named(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.setup(spark, wh, spark.sql("SELECT 1 AS config_id, CAST(100 AS DECIMAL(20,2)) AS daily_threshold_dollars, 'a@b.c' AS recipient_emails,"
                                    " true AS is_active, '50,100' AS threshold_percentages, current_timestamp() AS created_at, current_timestamp() AS updated_at"))
    row = jobs.update_config(spark, wh, 1, daily_threshold_dollars=F.lit("250").cast("decimal(20,2)")).collect()
    assert [(float(r.daily_threshold_dollars), r.recipient_emails, r.threshold_percentages) for r in row] == [(250.0, "a@b.c", "50,100")]
    with pytest.raises(ValueError):
        jobs.update_config(spark, wh, 1, created_at=None)


def _files(wh, names=tuple(FACT_TABLES)):
    return {(n, p.name): p.stat().st_mtime_ns for n in names for p in pathlib.Path(wh.path(n)).rglob("part-*")}


def test_a_rerun_on_equal_input_writes_no_fact_file(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    p = RunParams(as_of=AS_OF, lookback_days=90)
    jobs.run_daily(spark, src, wh, p, now=NOW())
    before = _files(wh)
    later = F.lit("2000-07-02 00:30:00").cast("timestamp")
    jobs.run_daily(spark, src, wh, p, now=later)
    assert before and _files(wh) == before
    # one price of the last month changes: only months with usage of it are written
    start = F.col("price_start_time")
    last = src.list_prices.agg(F.max("price_start_time")).first()[0]
    dearer = F.when((start == F.lit(last)) & (F.col("sku_name") == "PREMIUM_JOBS_COMPUTE"), F.col("pricing").withField("default", F.lit(9).cast("decimal(18,6)")).withField(
        "effective_list", F.struct(F.lit(9).cast("decimal(18,6)").alias("default")))).otherwise(F.col("pricing"))
    jobs.run_daily(spark, replace(src, list_prices=src.list_prices.withColumn("pricing", dearer)), wh, p, now=later)
    summary = spark.read.parquet(wh.path("daily_cost_summary"))
    written = {r[0] for r in summary.where("_etl_updated_at > timestamp'2000-07-01 12:00:00'").select("usage_month").distinct().collect()}
    months = {r[0] for r in summary.select("usage_month").distinct().collect()}
    assert written and written < months
    assert {k for k, v in _files(wh, ["daily_cost_summary"]).items() if before.get(k) == v}


def test_rolling_means_survive_a_rerun_with_carried_rows(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    whole, rerun = jobs.Warehouse(str(tmp_path / "whole")), jobs.Warehouse(str(tmp_path / "rerun"))
    everything = RunParams(as_of=AS_OF, lookback_days=None)
    jobs.run_daily(spark, src, whole, everything, now=NOW())
    jobs.run_daily(spark, src, rerun, everything, now=NOW())
    want = spark.read.parquet(whole.path("sku_daily_details"))
    short = RunParams(as_of=AS_OF, lookback_days=20)
    before = _files(rerun)
    jobs.run_daily(spark, src, rerun, short, now=NOW(), carry_rows=True)
    assert _same(spark.read.parquet(rerun.path("sku_daily_details")), want) and _files(rerun) == before
    # the reference's way, the default: frames begin with the window
    jobs.run_daily(spark, src, rerun, short, now=NOW())
    got = spark.read.parquet(rerun.path("sku_daily_details"))
    assert not _same(got.drop("_etl_updated_at"), want.drop("_etl_updated_at"))
    jobs.run_daily(spark, src, rerun, short, now=NOW(), carry_rows=True)
    assert _same(spark.read.parquet(rerun.path("sku_daily_details")), want)


def test_details_of_a_past_day_leave_later_days_alone(spark):
    from ledger.plans import cost
    from ledger.registry import Chain

    summary = Chain(spark, SMALL).summary
    day = dt.date(2000, 5, 31)
    got = cost.sku_daily_details(summary, RunParams(as_of=day, lookback_days=30))
    assert got.agg(F.max("usage_date")).first()[0] <= day


def test_tables_are_registered_with_their_comments(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "it's a warehouse"))
    jobs.setup(spark, wh)
    for _ in range(2):
        jobs.register_tables(spark, wh, "ledger_gold")
    try:
        for name in GOLD:
            assert spark.catalog.getTable(f"ledger_gold.{name}").description == TABLE_COMMENTS[name]
            told = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE ledger_gold.{name}").collect()}
            assert all(told[f.name] == f.metadata["comment"] for f in GOLD[name][0].fields)
            assert spark.table(f"ledger_gold.{name}").count() == 0
    finally:
        spark.sql("DROP DATABASE ledger_gold CASCADE")


def test_broken_page_chain_replaces_no_price(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    torn = src.catalog_pages.drop("nextPageToken").withColumn("nextPageToken", F.lit("more"))
    with pytest.raises(IncompleteCatalogError):
        jobs.refresh_vm_prices(spark, src, wh, RunParams(as_of=AS_OF), torn, NOW(), whole_catalog=True)
    assert not pathlib.Path(wh.path("gcp_vm_reference_prices")).exists()
