"""Named queries over a test-data directory: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each query derives the billing sources from the test tables (``sources.fixtures``), runs
one operator of the library on them and returns the result at the comparison boundary:
audit timestamps dropped, DECIMAL as DOUBLE, timestamps as wall-clock (NTZ) values.

Run parameters: ``as_of`` 2000-06-30 (alert day, default month), month ``Jun 2000``,
cloud GCP, region us-central1.  The daily tables are built over the **whole usage
history** (``lookback_days=None``); the reference's 90-day recompute window is the
``usage_window`` query and the source batch of ``upsert_daily_cost``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.params import RunParams
from ledger.plans import alerts, cost, distinct, pricing, reports, vm
from ledger.operators.upsert import upsert
from ledger.sources import fixtures
from ledger.sources.schemas import DAILY_COST_SUMMARY_KEYS, DAILY_COST_WITH_VM_ESTIMATE, conform

AS_OF = dt.date(2000, 6, 30)
MONTH = "Jun 2000"
P = RunParams(as_of=AS_OF, cloud="GCP", region="us-central1", lookback_days=None, bounded=False)
P90 = RunParams(as_of=AS_OF, cloud="GCP", region="us-central1", lookback_days=90)
# prices published from this time on were not yet known to the previous run (upsert_daily_cost)
LATE_PRICE_FROM = "2000-06-10 12:00:00"
# fixed audit / send times so every result is reproducible
LOADED_AT = "2000-07-01 00:30:00"
SENT_AT = "2000-06-30 23:00:00"

DROP = ("_etl_updated_at", "last_updated")


def _ts(s: str):
    return F.lit(s).cast("timestamp")


def boundary(df: DataFrame, drop=DROP) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ shared chains


class Chain:
    """Lazily built frames of one run (each built at most once per query)."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: RunParams = P):
        self.spark, self.sf_dir, self.p = spark, sf_dir, p
        self.src = fixtures.load(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def priced(self):
        return self._get("priced", lambda: pricing.price_usage(self.src.usage, self.src.list_prices, self.p))

    @property
    def summary(self):
        return self._get("summary", lambda: cost.daily_cost_summary(self.priced, _ts(LOADED_AT)))

    @property
    def details(self):
        return self._get("details", lambda: cost.sku_daily_details(self.summary, self.p, loaded_at=_ts(LOADED_AT)))

    @property
    def seeds(self):
        regions = self.spark.range(1).select(F.lit(self.p.region).alias("region"))
        return self._get("seeds", lambda: pricing.seed_prices(regions, _ts(LOADED_AT)))

    @property
    def vm_prices(self):
        return self._get(
            "vm_prices",
            lambda: pricing.build_vm_price_table(None, self.seeds, self.src.node_types, self.p.region, _ts(LOADED_AT)),
        )

    @property
    def cluster_usage(self):
        return self._get("cu", lambda: vm.cluster_usage(self.priced))

    @property
    def node_hours(self):
        return self._get("nh", lambda: vm.node_hours(self.src.node_timeline, self.p))

    @property
    def latest_config(self):
        return self._get("cfg", lambda: vm.latest_cluster_config(self.src.clusters))

    @property
    def vm(self):
        return self._get(
            "vm",
            lambda: vm.vm_cost_estimate(
                self.cluster_usage, self.node_hours, self.latest_config, self.vm_prices, self.p,
                loaded_at=_ts(LOADED_AT),
            ),
        )

    @property
    def active(self):
        return self._get("active", lambda: alerts.active_config(self.src.alert_config))

    @property
    def today(self):
        return self._get("today", lambda: alerts.today_cost(self.summary, self.p.as_of, self.active))

    @property
    def crossed(self):
        return self._get("crossed", lambda: alerts.crossed_tiers(self.today))

    @property
    def new_alerts(self):
        return self._get(
            "new", lambda: alerts.new_alerts(self.crossed, self.src.alert_history, self.p.cloud, self.p.as_of)
        )

    @property
    def history_after(self):
        return self._get(
            "hist", lambda: alerts.alert_history_append(self.src.alert_history, self.new_alerts, _ts(SENT_AT))
        )


# ------------------------------------------------------------------ queries


def q_usage_window(spark, d):
    c = Chain(spark, d, P90)
    u = pricing.usage_window(c.src.usage, P90)
    return boundary(u.select(
        "usage_date", "usage_start_time", "usage_end_time", "sku_name", "billing_origin_product", "cloud",
        "workspace_id", F.col("product_features.is_serverless").alias("is_serverless"),
        F.col("usage_metadata.cluster_id").alias("cluster_id"), "usage_quantity",
    ))


def q_priced_usage(spark, d):
    return boundary(Chain(spark, d).priced)


def q_daily_cost_summary(spark, d):
    return boundary(Chain(spark, d).summary)


def q_upsert_daily_cost(spark, d):
    """Yesterday's table (built before the last price generation was published) upserted
    with today's 90-day recompute: rows inside the window are corrected, older rows kept."""
    c = Chain(spark, d)
    early_prices = c.src.list_prices.where(F.col("price_start_time") < F.lit(LATE_PRICE_FROM).cast("timestamp_ntz"))
    old = cost.daily_cost_summary(pricing.price_usage(c.src.usage, early_prices, P), _ts(LOADED_AT))
    batch = cost.daily_cost_summary(pricing.price_usage(c.src.usage, c.src.list_prices, P90), _ts(LOADED_AT))
    return boundary(upsert(old, batch, DAILY_COST_SUMMARY_KEYS, check=False))  # the batch is grouped by the keys


def q_sku_daily_details(spark, d):
    return boundary(Chain(spark, d).details)


def q_load_stats(spark, d):
    c = Chain(spark, d)
    return boundary(cost.load_stats({"daily_cost_summary": c.summary, "sku_daily_details": c.details}))


def q_catalog_price_extract(spark, d):
    c = Chain(spark, d)
    return boundary(pricing.catalog_price_extract(c.src.catalog_pages, P.region, _ts(LOADED_AT)))


def q_seed_prices(spark, d):
    """Seed prices for every region the price catalogue serves."""
    c = Chain(spark, d)
    regions = pricing.catalog_regions(c.src.catalog_pages)
    return boundary(pricing.seed_prices(regions, _ts(LOADED_AT)))


def q_price_upsert(spark, d):
    """Seeded table of earlier runs (all catalogue regions) upserted with today's live rows."""
    c = Chain(spark, d)
    previous = pricing.seed_prices(pricing.catalog_regions(c.src.catalog_pages), _ts(LOADED_AT))
    live = pricing.catalog_price_extract(c.src.catalog_pages, P.region, _ts(LOADED_AT))
    return boundary(upsert(previous, live, ["node_type_id", "region"], check=False))  # one row per catalogue SKU


def q_estimate_missing_prices(spark, d):
    c = Chain(spark, d)
    return boundary(pricing.estimate_missing_prices(c.src.node_types, c.seeds, P.region, _ts(LOADED_AT)))


def q_price_source_counts(spark, d):
    return boundary(pricing.price_source_counts(Chain(spark, d).vm_prices, P.region))


def q_price_coverage(spark, d):
    c = Chain(spark, d)
    return boundary(pricing.price_coverage(c.src.node_types, c.vm_prices, P.region))


def q_price_overlap_check(spark, d):
    """A price list whose last generation begins a day early, so that it overlaps the one before."""
    c = Chain(spark, d)
    start = F.col("price_start_time")
    early = F.when(start >= F.lit(LATE_PRICE_FROM).cast("timestamp_ntz"), start - F.expr("INTERVAL 1 DAY")).otherwise(start)
    return boundary(pricing.price_overlap_check(c.src.usage, c.src.list_prices.withColumn("price_start_time", early), P))


def q_cluster_usage(spark, d):
    return boundary(Chain(spark, d).cluster_usage)


def q_node_hours(spark, d):
    return boundary(Chain(spark, d).node_hours)


def q_latest_cluster_config(spark, d):
    return boundary(Chain(spark, d).latest_config)


def q_cluster_config_as_of(spark, d):
    """The config in force on each cluster-day with usage."""
    c = Chain(spark, d)
    return boundary(vm.cluster_config_as_of(c.src.clusters, c.cluster_usage))


def q_vm_cost_estimate(spark, d):
    return boundary(Chain(spark, d).vm)


def q_vm_cost_by_source(spark, d):
    return boundary(vm.vm_cost_by_source(Chain(spark, d).vm))


def q_trailing_clusters(spark, d):
    """Distinct clusters of each month and of the 12 months up to it, from bitmaps."""
    c = Chain(spark, d)
    none = spark.createDataFrame([], distinct.NUMBERS)
    return boundary(distinct.trailing_clusters(distinct.cluster_bitmaps(c.cluster_usage, distinct.numbered_clusters(c.cluster_usage, none))))


def q_schema_conform(spark, d):
    """Rows written before the lineage column existed, read through the current schema."""
    old = Chain(spark, d).vm.drop("vm_cost_source")
    return boundary(conform(old, DAILY_COST_WITH_VM_ESTIMATE))


def q_alert_config_upsert(spark, d):
    c = Chain(spark, d)
    deploy = spark.range(1).select(
        F.lit(1).alias("config_id"),
        F.lit(1000).cast("decimal(20,2)").alias("daily_threshold_dollars"),
        F.lit("ops@example.com,finance@example.com").alias("recipient_emails"),
        F.lit(True).alias("is_active"),
        F.lit("25,50,75,90,100").alias("threshold_percentages"),
        _ts(LOADED_AT).alias("created_at"),
        _ts(LOADED_AT).alias("updated_at"),
    )
    return boundary(alerts.alert_config_upsert(c.src.alert_config, deploy, _ts(LOADED_AT)))


def q_alert_config_update(spark, d):
    c = Chain(spark, d)
    return boundary(
        alerts.alert_config_update(
            c.src.alert_config, 1, daily_threshold_dollars=F.lit("0.01").cast("decimal(20,2)"),
            updated_at=_ts(LOADED_AT),
        )
    )


def q_active_alert_config(spark, d):
    return boundary(Chain(spark, d).active)


def q_alert_tiers(spark, d):
    return boundary(alerts.alert_tiers(Chain(spark, d).src.alert_config))


def q_today_cost(spark, d):
    c = Chain(spark, d)
    return boundary(c.today.select("config_id", "usage_date", "today_cost", "daily_threshold_dollars", "pct_consumed"))


def q_crossed_tiers(spark, d):
    c = Chain(spark, d)
    return boundary(c.crossed.select("config_id", "usage_date", "threshold_pct", "threshold_amount", "today_cost"))


def q_new_alerts(spark, d):
    return boundary(Chain(spark, d).new_alerts)


def q_alert_history_append(spark, d):
    return boundary(Chain(spark, d).history_after)


def q_alert_gate(spark, d):
    c = Chain(spark, d)
    return boundary(alerts.alert_gate(c.new_alerts, c.today, alerts.sent_on(c.src.alert_history, P.as_of).scalar()))


def q_recent_alerts(spark, d):
    c = Chain(spark, d)
    return boundary(alerts.recent_alerts(c.history_after, 5, P.tz))


def q_month_picker(spark, d):
    return boundary(reports.month_picker(Chain(spark, d).summary, AS_OF))


def q_month_bounds(spark, d):
    c = Chain(spark, d)
    labels = reports.month_picker(c.summary, AS_OF).select("month_label")
    extra = spark.createDataFrame([("junk",), (None,), ("Feb 2000",)], "month_label string")
    return boundary(reports.month_bounds_frame(labels.unionByName(extra), AS_OF))


def q_cost_counters(spark, d):
    return boundary(reports.cost_counters(Chain(spark, d).summary, MONTH, AS_OF))


def q_daily_cost_trend(spark, d):
    return boundary(reports.daily_cost_trend(Chain(spark, d).summary, MONTH, AS_OF))


def q_top_skus(spark, d):
    return boundary(reports.top_skus(Chain(spark, d).summary, MONTH, AS_OF))


def q_sku_details_month(spark, d):
    return boundary(reports.sku_details(Chain(spark, d).details, MONTH, AS_OF))


def q_sku_details_filtered(spark, d):
    return boundary(
        reports.sku_details(
            Chain(spark, d).details, MONTH, AS_OF,
            skus=["PREMIUM_JOBS_COMPUTE", "PREMIUM_SQL_PRO_COMPUTE", "PREMIUM_JOBS_COMPUTE_(PHOTON)"],
            categories=["Compute", "SQL Warehouse"],
        )
    )


def q_vm_estimates_month(spark, d):
    return boundary(reports.vm_estimates(Chain(spark, d).vm, MONTH, AS_OF))


def q_vm_cost_counters(spark, d):
    return boundary(reports.vm_cost_counters(Chain(spark, d).vm, MONTH, AS_OF))


def q_vm_daily_trend(spark, d):
    return boundary(reports.vm_daily_trend(Chain(spark, d).vm, MONTH, AS_OF))


def q_vm_by_node_type(spark, d):
    return boundary(reports.vm_by_node_type(Chain(spark, d).vm, MONTH, AS_OF))


def q_vm_reference_prices(spark, d):
    return boundary(reports.vm_reference_prices(Chain(spark, d).vm_prices, P.tz))


def q_alert_config_view(spark, d):
    return boundary(reports.alert_config_view(Chain(spark, d).src.alert_config, P.tz))


def q_alert_history_month(spark, d):
    return boundary(reports.alert_history_month(Chain(spark, d).history_after, MONTH, AS_OF, 100, P.tz))


def q_threshold_gauge(spark, d):
    c = Chain(spark, d)
    return boundary(reports.threshold_gauge(c.summary, c.src.alert_config, MONTH, AS_OF))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
