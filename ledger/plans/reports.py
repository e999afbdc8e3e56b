"""Month-scoped report queries over the gold tables (R1-R13).

Every report takes a month label such as ``'Jun 2000'``; a junk or missing label means
the month of ``as_of``.  The bound is a foldable literal expression, so on a table
partitioned by ``usage_month`` the month filter prunes partitions at planning time.
Global aggregates produce exactly one row; they are combined as scalar subqueries
(computed once, no join).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger.functions.expressions import PARTITION_COL, display_time, in_month, month_start, on_or_after
from ledger.plans.alerts import active_config


def _month(df: DataFrame, date_col: str, label: str | None, as_of: dt.date, offset: int = 0) -> DataFrame:
    """Rows of the selected month.  On a stored table partitioned by ``usage_month`` the
    same bound is also applied to the partition column (implied by the date range, so
    the result is unchanged) and the scan reads one month's partition only."""
    out = df.where(in_month(date_col, label, as_of, offset))
    if PARTITION_COL in df.columns:
        ms = month_start(label, as_of)
        out = out.where(F.col(PARTITION_COL) == (F.add_months(ms, offset) if offset else ms))
    return out


def month_picker(summary: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """Distinct months with usage in the ``days`` days up to ``as_of``, newest first."""
    return (
        on_or_after(summary, "usage_date", F.date_sub(F.lit(as_of), days))
        .where(F.col("usage_date") <= F.lit(as_of))
        .select(
            F.date_format("usage_date", "MMM yyyy").alias("month_label"),
            F.date_trunc("MONTH", "usage_date").cast("date").alias("month_start"),
        )
        .distinct()
        .orderBy(F.col("month_start").desc())
    )


def month_bounds_frame(labels: DataFrame, as_of: dt.date, label_col: str = "month_label") -> DataFrame:
    """Start / end / previous start for each label (junk or NULL -> month of ``as_of``)."""
    ms = F.coalesce(F.try_to_date(F.col(label_col), "MMM yyyy"), F.lit(as_of.replace(day=1)))
    return labels.select(
        F.col(label_col).alias("month_label"),
        ms.alias("month_start"),
        F.add_months(ms, 1).alias("month_end"),
        F.add_months(ms, -1).alias("prev_month_start"),
    )


def cost_counters(summary: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    """Month total, average per day with usage, peak day, % change vs previous month."""
    cur = _month(summary, "usage_date", month, as_of)
    daily = cur.groupBy("usage_date").agg(F.sum("total_cost_usd").alias("daily_cost"))
    agg = daily.agg(
        F.sum("daily_cost").alias("month_total"),
        F.count_distinct("usage_date").alias("days_with_usage"),
        F.max("daily_cost").alias("peak_day_cost"),
    )
    prev = _month(summary, "usage_date", month, as_of, -1).agg(
        F.sum("total_cost_usd").alias("prev_total")
    )
    mt, pt = F.col("month_total"), F.col("prev_total")
    return agg.withColumn("prev_total", prev.scalar()).select(
        F.round(mt, 2).alias("month_total"),
        F.round(mt / F.nullif(F.col("days_with_usage"), F.lit(0)), 2).alias("avg_daily"),
        F.round(F.col("peak_day_cost"), 2).alias("peak_day"),
        F.round((mt - pt) / F.nullif(pt, F.lit(0)) * 100, 1).alias("pct_vs_prev_month"),
    )


def daily_cost_trend(summary: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    return (
        _month(summary, "usage_date", month, as_of)
        .groupBy("usage_date", "billing_origin_product")
        .agg(F.sum("total_cost_usd").alias("daily_cost"), F.sum("total_dbus").alias("daily_dbus"))
        .orderBy("usage_date", "billing_origin_product")
    )


def top_skus(summary: DataFrame, month: str | None, as_of: dt.date, n: int = 20) -> DataFrame:
    """Top ``n`` (sku, product) by month cost; ties broken by name for a stable cut."""
    return (
        _month(summary, "usage_date", month, as_of)
        .groupBy("sku_name", "billing_origin_product")
        .agg(F.sum("total_cost_usd").alias("total_cost"), F.sum("total_dbus").alias("total_dbus"))
        .orderBy(
            F.col("total_cost").desc_nulls_last(),
            F.col("sku_name").asc_nulls_first(),
            F.col("billing_origin_product").asc_nulls_first(),
        )
        .limit(n)
    )


def sku_details(details: DataFrame, month: str | None, as_of: dt.date, skus: Sequence[str] | None = None,
                categories: Sequence[str] | None = None) -> DataFrame:
    """Detail rows of the month, optionally narrowed to picked SKUs / categories
    (no pick = all rows)."""
    d = _month(details, "usage_date", month, as_of)
    if skus:
        d = d.where(F.col("sku_name").isin(list(skus)))
    if categories:
        d = d.where(F.col("product_category").isin(list(categories)))
    return d.select(
        "usage_date",
        "sku_name",
        "billing_origin_product",
        "product_category",
        "is_serverless",
        "total_dbus",
        "total_cost_usd",
        "cost_7d_avg",
        "cost_30d_avg",
        "cost_pct_change_7d",
    ).orderBy(F.col("usage_date").desc(), F.col("total_cost_usd").desc())


def vm_estimates(vm: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    return (
        _month(vm, "usage_date", month, as_of)
        .select(
            "usage_date",
            "cluster_id",
            "cluster_name",
            "sku_name",
            "driver_node_type",
            "worker_node_type",
            "num_workers",
            F.round("cluster_uptime_hours", 2).alias("cluster_uptime_hours"),
            F.round("dbu_cost_usd", 2).alias("dbu_cost_usd"),
            F.round("estimated_vm_cost_usd", 2).alias("estimated_vm_cost_usd"),
            F.round("total_estimated_cost", 2).alias("total_estimated_cost"),
            "driver_vm_type",
            "worker_vm_type",
        )
        .orderBy(F.col("usage_date").desc(), F.col("total_estimated_cost").desc())
    )


def vm_cost_counters(vm: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    cur = _month(vm, "usage_date", month, as_of)
    vm_sum = F.sum("estimated_vm_cost_usd")
    return cur.agg(
        F.round(vm_sum, 2).alias("month_vm_cost"),
        F.round(F.sum("dbu_cost_usd"), 2).alias("month_dbu_cost"),
        F.round(F.sum("total_estimated_cost"), 2).alias("month_total_cost"),
        F.round(vm_sum / F.nullif(F.count_distinct("usage_date"), F.lit(0)), 2).alias("avg_daily_vm_cost"),
    )


def vm_daily_trend(vm: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    return (
        _month(vm, "usage_date", month, as_of)
        .groupBy("usage_date")
        .agg(
            F.round(F.sum("dbu_cost_usd"), 2).alias("dbu_cost"),
            F.round(F.sum("estimated_vm_cost_usd"), 2).alias("vm_cost"),
            F.round(F.sum("total_estimated_cost"), 2).alias("total_cost"),
        )
        .orderBy("usage_date")
    )


def vm_by_node_type(vm: DataFrame, month: str | None, as_of: dt.date, n: int = 20) -> DataFrame:
    """VM cost per node type; a row counts once for its worker type and once for its
    driver type (T24).  One scan with ``explode(array(worker, driver))`` instead of a
    UNION ALL of two scans."""
    return (
        _month(vm, "usage_date", month, as_of)
        .select(
            F.explode(F.array("worker_node_type", "driver_node_type")).alias("node_type"), "estimated_vm_cost_usd"
        )
        .where(F.col("node_type").isNotNull())
        .groupBy("node_type")
        .agg(F.round(F.sum("estimated_vm_cost_usd"), 2).alias("total_vm_cost"))
        .orderBy(F.col("total_vm_cost").desc_nulls_last(), F.col("node_type"))
        .limit(n)
    )


def vm_reference_prices(prices: DataFrame, tz: str = "Asia/Kolkata") -> DataFrame:
    return prices.select(
        "node_type_id",
        "gcp_machine_type",
        "vcpus",
        "memory_gb",
        F.round("hourly_price_usd", 6).alias("hourly_price_usd"),
        "region",
        "price_source",
        display_time(F.col("last_updated"), tz).alias("last_updated_ist"),
    ).orderBy(F.col("hourly_price_usd").desc(), "node_type_id", "region")


def alert_config_view(config: DataFrame, tz: str = "Asia/Kolkata") -> DataFrame:
    return config.select(
        "config_id",
        "daily_threshold_dollars",
        "recipient_emails",
        "is_active",
        "threshold_percentages",
        display_time(F.col("updated_at"), tz).alias("updated_at_ist"),
    )


def alert_history_month(history: DataFrame, month: str | None, as_of: dt.date, n: int = 100,
                        tz: str = "Asia/Kolkata") -> DataFrame:
    return (
        _month(history, "alert_date", month, as_of)
        .orderBy(F.col("sent_at").desc_nulls_last(), F.col("alert_id").desc_nulls_last())
        .limit(n)
        .select(
            "alert_date",
            "threshold_pct",
            F.round("amount_at_alert", 2).alias("amount_at_alert"),
            F.round("threshold_amount", 2).alias("threshold_amount"),
            F.round("daily_threshold", 2).alias("daily_threshold"),
            "recipients",
            display_time(F.col("sent_at"), tz).alias("sent_at_ist"),
            "status",
        )
    )


def threshold_gauge(summary: DataFrame, config: DataFrame, month: str | None, as_of: dt.date) -> DataFrame:
    """Month spend, the active threshold and average daily spend as % of it."""
    spend = _month(summary, "usage_date", month, as_of).agg(
        F.coalesce(F.sum("total_cost_usd"), F.lit(0)).alias("month_spend"),
        F.count_distinct("usage_date").alias("days_in_month"),
    )
    cfg = active_config(config).select(F.col("daily_threshold_dollars").alias("threshold"))
    ms, th = F.col("month_spend"), F.col("threshold")
    # FROM spend, cfg: no active config -> no row
    return spend.where(cfg.exists()).withColumn("threshold", cfg.scalar()).select(
        F.round(ms, 2).alias("month_spend"),
        F.round(th, 2).alias("daily_threshold"),
        F.round(ms / F.nullif(F.col("days_in_month"), F.lit(0)) / F.nullif(th, F.lit(0)) * 100, 1).alias(
            "pct_avg_vs_threshold"
        ),
    )
