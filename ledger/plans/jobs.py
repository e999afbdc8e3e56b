"""Batch jobs: read sources -> plans -> persist the gold tables.

``run_daily``  the cost job: price refresh, daily summary, details, VM estimate
``run_alerts`` the alert job: tier check, de-duplication, history append

Tables are Parquet directories under ``warehouse``; the three fact tables are stored
partitioned by ``usage_month`` (first day of the usage month, an extra storage column).
Every report is month-scoped and the daily rerun touches about four months, so month
partitions prune exactly while keeping the partition count 30x below daily partitions.
Every step that re-reads data written earlier in the job reads it back from storage, so
no lineage spans the whole job and a lost executor only re-runs tasks of the current
stage.  Intermediate data goes to the folder named by ``spark.checkpoint.dir`` (shared
storage on a cluster) and is removed when its step has succeeded.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.functions.expressions import PARTITION_COL
from ledger.operators.upsert import remove, replace_table, table_exists, write_snapshot, write_upsert
from ledger.params import RunParams
from ledger.plans import alerts, cost, distinct, late, pricing, vm
from ledger.session import checkpoint_dir
from ledger.sources.catalog import require_whole_catalog
from ledger.sources.fixtures import Sources
from ledger.sources.schemas import (
    ALERT_HISTORY,
    FACT_TABLES,
    GOLD,
    DAILY_COST_SUMMARY_KEYS,
    DAILY_COST_WITH_VM_ESTIMATE_KEYS,
    SKU_DAILY_DETAILS_KEYS,
    TABLE_COMMENTS,
    VM_REFERENCE_PRICES,
    VM_REFERENCE_PRICES_KEYS,
    conform,
)


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def with_month(df: DataFrame) -> DataFrame:
    """Add the storage partition column ``usage_month`` = month start of ``usage_date``."""
    return df.withColumn(PARTITION_COL, F.trunc("usage_date", "month"))


def table_schema(name: str) -> T.StructType:
    """Declared schema of a stored gold table (fact tables carry the ``usage_month`` partition)."""
    schema = GOLD[name][0]
    if name in FACT_TABLES:
        schema = T.StructType(schema.fields + [T.StructField(PARTITION_COL, T.DateType())])
    return schema


def read_table(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame:
    """Read a gold table with its declared schema.

    Schema-on-read is the additive migration for Parquet: files written before a column
    existed (e.g. ``vm_cost_source``) read it as NULL; no file is rewritten.
    """
    return spark.read.schema(table_schema(name)).parquet(wh.path(name))


def register_tables(spark: SparkSession, wh: Warehouse, database: str) -> None:
    """Enter the stored gold tables in the session's catalog under ``database``, with the
    comments of tables and columns and the fact tables' partitions.  The files stay where they
    are (external tables); a table that is entered already is entered anew."""
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in GOLD:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(f.metadata['comment'])}" if "comment" in f.metadata else "")
                            for f in table_schema(name).fields)
        parted = f" PARTITIONED BY (`{PARTITION_COL}`)" if name in FACT_TABLES else ""
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet{parted} "
                  f"COMMENT {quoted(TABLE_COMMENTS[name])} LOCATION {quoted(wh.path(name))}")
        if parted:
            spark.catalog.recoverPartitions(f"`{database}`.`{name}`")


def setup(spark: SparkSession, wh: Warehouse, config_row: DataFrame | None = None,
          now: Column | None = None) -> None:
    """Create missing gold tables (empty, declared schema) and upsert the deploy-time alert
    configuration: a matching ``config_id`` takes the new threshold, recipients and tiers,
    is re-activated and keeps ``created_at``."""
    for name in GOLD:
        if not table_exists(spark, wh.path(name)):
            empty = spark.createDataFrame([], table_schema(name))
            write_snapshot(empty, wh.path(name), PARTITION_COL if name in FACT_TABLES else None)
    if config_row is None:
        return
    current = read_table(spark, wh, "alert_config")
    replace_table(alerts.alert_config_upsert(current, config_row, now), wh.path("alert_config"))


def update_config(spark: SparkSession, wh: Warehouse, config_id: int, **values) -> DataFrame:
    """Store ``UPDATE alert_config SET <values> WHERE config_id = :id``; other columns and
    rows stay.  Returns the stored table."""
    unknown = set(values) - {"daily_threshold_dollars", "recipient_emails", "is_active", "threshold_percentages", "updated_at"}
    if unknown:
        raise ValueError(f"not a setting of alert_config: {sorted(unknown)}")
    current = read_table(spark, wh, "alert_config")
    replace_table(alerts.alert_config_update(current, config_id, **values), wh.path("alert_config"))
    return read_table(spark, wh, "alert_config")


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def refresh_vm_prices(spark: SparkSession, src: Sources, wh: Warehouse, p: RunParams,
                      live_pages: DataFrame | None = None, now: Column | None = None,
                      whole_catalog: bool = False) -> DataFrame:
    """Upsert the day's price rows (live catalogue when it yields rows, else seeds), then
    append component estimates for node types still unpriced in the region.

    ``whole_catalog`` refuses pages that are no unbroken chain (``IncompleteCatalogError``)
    before any price is replaced."""
    path = wh.path("gcp_vm_reference_prices")
    new_rows = None
    # The catalogue prices GCP machines only.
    if live_pages is not None and p.cloud == "GCP":
        if whole_catalog:
            require_whole_catalog(live_pages)
        live = pricing.catalog_price_extract(live_pages, p.region, now)
        if not live.isEmpty():
            new_rows = live
    if new_rows is None:
        regions = spark.range(1).select(F.lit(p.region).alias("region"))
        new_rows = pricing.seed_prices(regions, now)
    write_upsert(spark, path, conform(new_rows, VM_REFERENCE_PRICES), VM_REFERENCE_PRICES_KEYS, None,
                 checkpoint_dir(spark), target_schema=table_schema("gcp_vm_reference_prices"))
    table = read_table(spark, wh, "gcp_vm_reference_prices")
    est = pricing.estimate_missing_prices(src.node_types, table, p.region, now)
    # estimates are computed from the table as read above; stage them before appending
    stage = _scratch(spark, "estimates")
    est.write.parquet(stage)
    spark.read.schema(est.schema).parquet(stage).write.mode("append").parquet(path)
    remove(spark, stage)
    return read_table(spark, wh, "gcp_vm_reference_prices")


def _both(first, second):
    """Run two independent steps as concurrent Spark jobs (driver threads); re-raise errors."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        a, b = pool.submit(first), pool.submit(second)
        return a.result(), b.result()


# Columns that tell when a row was written: a change in them alone rewrites nothing.
AUDIT = ("_etl_updated_at",)


def run_daily(spark: SparkSession, src: Sources, wh: Warehouse, p: RunParams,
              live_pages: DataFrame | None = None, now: Column | None = None, carry_rows: bool = False, split_days: bool = False,
              touched_days: bool = False, whole_catalog: bool = False, config_as_of: bool = False) -> DataFrame:
    """The daily cost job; returns the load statistics of the three fact tables.

    ``carry_rows`` computes the rolling means of the first rows of the window with the rows
    stored before it; without it their frames begin with the window (the reference's way).
    ``split_days`` charges node hours to the days they fall on, not to the day they start.
    ``touched_days`` keeps the usage rollup in the warehouse (``usage_state``) and reads only
    usage of days whose files or prices changed (``plans.late``); usage must then come from files.
    ``whole_catalog`` checks the price pages' chain first; ``config_as_of`` estimates a day by the
    cluster configuration of that day, not by the newest one.
    Months in which nothing changed but the time of the run are not written again.

    Dependency order (independent branches run as concurrent jobs):

        price refresh  ||  usage rollup (one pass over raw usage, persisted)
        daily_cost_summary upsert                      <- rollup
        sku_daily_details upsert  ||  VM estimate upsert  <- summary / rollup + prices
    """
    now = now if now is not None else F.current_timestamp()
    raw, src = src, src.conformed()
    ckpt = checkpoint_dir(spark)
    rollup_path = _scratch(spark, "usage-rollup")

    def rollup_step() -> DataFrame:
        if touched_days:
            return late.refresh_rollup(spark, raw.usage, raw.list_prices, p, wh.path("usage_state"))[0]
        cost.usage_rollup(pricing.price_usage(src.usage, src.list_prices, p)).write.parquet(rollup_path)
        return spark.read.parquet(rollup_path)

    prices, rollup = _both(lambda: refresh_vm_prices(spark, src, wh, p, live_pages, now, whole_catalog), rollup_step)

    summary_path = wh.path("daily_cost_summary")
    # one cloud per run and a GROUP BY on a superset of the merge key: unique by construction
    write_upsert(spark, summary_path, with_month(cost.daily_cost_summary(rollup, now)), DAILY_COST_SUMMARY_KEYS,
                 PARTITION_COL, ckpt, unique_source=True, target_schema=table_schema("daily_cost_summary"), aside=AUDIT)
    summary = read_table(spark, wh, "daily_cost_summary")

    def details_step():
        path = wh.path("sku_daily_details")
        stored = read_table(spark, wh, "sku_daily_details") if carry_rows and table_exists(spark, path) else None
        write_upsert(spark, path, with_month(cost.sku_daily_details(summary, p, loaded_at=now, stored=stored)),
                     SKU_DAILY_DETAILS_KEYS, PARTITION_COL, ckpt, unique_source=True,
                     target_schema=table_schema("sku_daily_details"), aside=AUDIT)

    def vm_step():
        used = vm.cluster_usage(rollup)
        config = vm.cluster_config_as_of(src.clusters, used) if config_as_of else vm.latest_cluster_config(src.clusters)
        estimate = vm.vm_cost_estimate(
            used, vm.node_hours(src.node_timeline, p, split_days), config, prices, p, loaded_at=now,
        )
        write_upsert(spark, wh.path("daily_cost_with_vm_estimate"), with_month(estimate),
                     DAILY_COST_WITH_VM_ESTIMATE_KEYS, PARTITION_COL, ckpt,
                     target_schema=table_schema("daily_cost_with_vm_estimate"), aside=AUDIT)

    _both(details_step, vm_step)
    remove(spark, rollup_path)
    return load_stats(spark, wh)


def refresh_month_states(spark: SparkSession, wh: Warehouse, p: RunParams) -> None:
    """Day masks and cluster bitmaps of the months of the run's window (``plans.distinct``)."""
    distinct.refresh_months(spark, read_table(spark, wh, "daily_cost_with_vm_estimate"), wh.path("month_states"), p.window_start)


def range_counts(spark: SparkSession, wh: Warehouse, first: dt.date, last: dt.date) -> DataFrame:
    """Distinct days and clusters of a range of months, from the states alone."""
    return distinct.range_counts(spark, wh.path("month_states"), first, last)


def load_stats(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Row count, date range and total cost of the three fact tables."""
    vm_table = read_table(spark, wh, "daily_cost_with_vm_estimate")
    return cost.load_stats({
        "daily_cost_summary": read_table(spark, wh, "daily_cost_summary"),
        "sku_daily_details": read_table(spark, wh, "sku_daily_details"),
        "daily_cost_with_vm_estimate": vm_table.withColumn("total_cost_usd", F.col("total_estimated_cost")),
    })


def run_alerts(spark: SparkSession, config: DataFrame, wh: Warehouse, p: RunParams,
               now: Column | None = None) -> DataFrame:
    """The alert job: returns the gate row (alerts sent, max tier, cost, threshold).

    The new rows are at most one per configured tier; they are staged before the append
    so the history is never read and written by the same plan.  A run without new alerts
    appends nothing.
    """
    now = now if now is not None else F.current_timestamp()
    hist_path = wh.path("alert_history")
    summary = read_table(spark, wh, "daily_cost_summary")
    history = (read_table(spark, wh, "alert_history") if table_exists(spark, hist_path)
               else spark.createDataFrame([], ALERT_HISTORY))
    active = alerts.active_config(config)
    today = alerts.today_cost(summary, p.as_of, active)
    sent_before = alerts.sent_on(history, p.as_of).first()["sent"]
    new = alerts.new_alerts(alerts.crossed_tiers(today), history, p.cloud, p.as_of)
    stage = _scratch(spark, "new-alerts")
    numbered = alerts.numbered_alerts(history, new, now)
    numbered.write.parquet(stage)
    staged = spark.read.schema(numbered.schema).parquet(stage)
    if not staged.isEmpty():  # an idle run leaves no file
        staged.write.mode("append").parquet(hist_path)
    gate = alerts.alert_gate(staged, today, F.lit(sent_before))
    gate = spark.createDataFrame(gate.collect(), gate.schema)  # one row; it must outlive the staged rows
    remove(spark, stage)
    return gate
