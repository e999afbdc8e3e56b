"""Daily cost tables.

* ``daily_cost_summary``  cost per (date, sku, product, cloud, workspace, serverless) (P7)
* ``sku_daily_details``   category, photon flag, rolling averages, % change (P9)
* ``load_stats``          rows / date range / total per table (P10)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger.functions.expressions import hours_between, is_photon, on_or_after, product_category
from ledger.params import RunParams
from ledger.sources.schemas import DAILY_COST_SUMMARY, SKU_DAILY_DETAILS, conform


ROLLUP_KEYS = ["usage_date", "sku_name", "billing_origin_product", "cloud", "workspace_id", "is_serverless",
               "cluster_id"]


def usage_rollup(priced: DataFrame) -> DataFrame:
    """One aggregation of priced usage at the finest grain either gold table needs.

    Both ``daily_cost_summary`` and ``cluster_usage`` re-aggregate this exactly (decimal
    sums and maxima are associative), so the raw usage is scanned, priced and shuffled
    once per run.  Columns keep the names of ``priced`` so either consumer accepts it.
    """
    return priced.groupBy(*ROLLUP_KEYS).agg(
        F.sum("usage_quantity").alias("usage_quantity"),
        F.max("unit_price").alias("unit_price"),
        F.sum(hours_between("usage_start_time", "usage_end_time")).alias("billed_hours"),
        F.sum(F.col("usage_quantity") * F.col("unit_price")).alias("exact_cost"),
    )


def daily_cost_summary(priced: DataFrame, loaded_at=None) -> DataFrame:
    """``SUM(qty) * MAX(price)`` per group (T3: the highest price of the day covers the
    whole group — kept; ``priced.exact_cost`` holds the exact per-row cost).

    One hash aggregate: partial sums/maxes are combined map-side, so a hot SKU sends one
    row per map task through the shuffle, not one per usage record.
    """
    g = priced.groupBy(
        "usage_date",
        "sku_name",
        "billing_origin_product",
        "cloud",
        F.col("workspace_id").cast("string").alias("workspace_id"),
        F.coalesce(F.col("is_serverless"), F.lit(False)).alias("is_serverless"),
    ).agg(F.sum("usage_quantity").alias("total_dbus"), F.max("unit_price").alias("list_price_per_dbu"))
    out = g.withColumn("total_cost_usd", F.col("total_dbus") * F.col("list_price_per_dbu")).withColumn(
        "_etl_updated_at", loaded_at if loaded_at is not None else F.current_timestamp()
    )
    return conform(out, DAILY_COST_SUMMARY)


# Rows of a SKU are in this order; a frame of 30 rows reaches 29 rows back.
ROW_ORDER = ["usage_date", "billing_origin_product", "is_serverless"]
CARRIED_ROWS = 29


def _carried(stored: DataFrame, start) -> DataFrame:
    """The last rows of each SKU before ``start`` (a limit by group on both sides of the shuffle)."""
    back = Window.partitionBy("sku_name").orderBy(*(F.col(c).desc_nulls_last() for c in ROW_ORDER))
    before = stored.where(F.col("usage_date") < F.lit(start))
    return before.withColumn("__back", F.row_number().over(back)).where(F.col("__back") <= CARRIED_ROWS).drop("__back")


def sku_daily_details(summary: DataFrame, p: RunParams, warmup_days: int = 0, frame: str = "rows",
                      loaded_at=None, stored: DataFrame | None = None) -> DataFrame:
    """Per (date, sku, product, serverless): totals over all clouds/workspaces (T10), the
    mean of the last 7 and 30 *rows* of the SKU (T11: rows, not calendar days; ties on
    the date are broken by product and serverless flag so the result is deterministic),
    and the % change against the 7-row mean (0 when that mean is not positive, T13).

    ``warmup_days`` reads further back so the first rows of the window get full frames,
    then filters (T12; 0 = the reference's behaviour).  ``frame="range"`` uses calendar
    days (``rangeBetween``) instead of rows.  ``stored``, the details table as it stands,
    carries over the last 29 *rows* of each SKU before the window, however many days back
    they lie, so a rerun of the window gives what one computation of the whole history would
    (rows beyond the run's ``as_of`` are left alone either way).

    The window partitions by SKU after aggregation: its input has at most one row per
    (date, product, serverless) per SKU, so no partition grows with usage volume.
    """
    start = p.window_start
    base = summary
    if start is not None:
        read_from = F.lit(start) if not warmup_days else F.date_sub(F.lit(start), warmup_days)
        base = on_or_after(base, "usage_date", read_from)
    if p.until is not None:
        base = base.where(F.col("usage_date") <= F.lit(p.until))
    agg = base.groupBy("usage_date", "sku_name", "billing_origin_product", "is_serverless").agg(
        F.sum("total_dbus").alias("total_dbus"), F.sum("total_cost_usd").alias("total_cost_usd")
    )
    if start is not None and stored is not None:
        agg = agg.unionByName(_carried(stored, start).select(*agg.columns))
    agg = agg.withColumn("product_category", product_category()).withColumn("is_photon", is_photon())
    if frame == "rows":
        w = Window.partitionBy("sku_name").orderBy(*(F.col(c).asc_nulls_first() for c in ROW_ORDER))
        w7, w30 = w.rowsBetween(-6, 0), w.rowsBetween(-29, 0)
    elif frame == "range":
        w = Window.partitionBy("sku_name").orderBy(F.unix_date("usage_date"))
        w7, w30 = w.rangeBetween(-6, 0), w.rangeBetween(-29, 0)
    else:
        raise ValueError(f"frame must be 'rows' or 'range', not {frame!r}")
    t = agg.withColumn("cost_7d_avg", F.avg("total_cost_usd").over(w7)).withColumn(
        "cost_30d_avg", F.avg("total_cost_usd").over(w30)
    )
    pct = F.when(
        F.col("cost_7d_avg") > 0,
        F.round((F.col("total_cost_usd") - F.col("cost_7d_avg")) / F.col("cost_7d_avg") * 100, 2),
    ).otherwise(F.lit(0))
    out = t.withColumn("cost_pct_change_7d", pct).withColumn(
        "_etl_updated_at", loaded_at if loaded_at is not None else F.current_timestamp()
    )
    if start is not None and (warmup_days or stored is not None):
        out = out.where(F.col("usage_date") >= F.lit(start))
    return conform(out, SKU_DAILY_DETAILS)


def load_stats(tables: Mapping[str, DataFrame], date_col: str = "usage_date",
               cost_col: str = "total_cost_usd") -> DataFrame:
    """One row per table: row count, first and last date, total cost (one agg each)."""
    frames = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(date_col).alias("min_date"),
            F.max(date_col).alias("max_date"),
            F.sum(F.col(cost_col).cast("decimal(38,6)")).alias("total_cost"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
