"""VM cost per cluster-day-SKU from sources of differing authority, with lineage.

* ``cluster_usage``          DBUs, billed hours, exact DBU cost per (date, cluster, sku) (P11)
* ``node_hours``             driver / worker node hours and types per (date, cluster) (P12)
* ``latest_cluster_config``  newest config per cluster, effective worker count (P13)
* ``cluster_config_as_of``   config in force at the end of each day of use
* ``vm_cost_estimate``       VM cost, total, lineage (P14)
* ``vm_cost_by_source``      rows and costs per lineage value (P15)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.functions.expressions import dec, hours_between, is_bundled
from ledger.params import RunParams
from ledger.sources.schemas import DAILY_COST_WITH_VM_ESTIMATE, conform


def cluster_usage(priced: DataFrame) -> DataFrame:
    """Clustered usage aggregated per (date, cluster, sku); billed hours are whole
    seconds / 3600 rounded per record to 6 places, then summed.  Partial aggregation
    map-side bounds what a hot cluster sends through the shuffle.

    Accepts priced usage rows or their ``usage_rollup`` (which carries ``billed_hours``
    and ``exact_cost`` already summed)."""
    rolled = "billed_hours" in priced.columns
    hours = F.col("billed_hours") if rolled else hours_between("usage_start_time", "usage_end_time")
    cost = F.col("exact_cost") if rolled else F.col("usage_quantity") * F.col("unit_price")
    return (
        priced.where(F.col("cluster_id").isNotNull())
        .groupBy("usage_date", "cluster_id", "sku_name")
        .agg(
            F.sum("usage_quantity").alias("total_dbus"),
            F.sum(hours).alias("billing_hours"),
            F.sum(cost).alias("dbu_cost_usd"),
        )
    )


def split_at_midnight(node_timeline: DataFrame, p: RunParams) -> DataFrame:
    """``usage_date, cluster_id, driver, node_type, seconds``: one row for each day that an
    interval touches within the run's window.

    Seconds are counted from the interval's start on both ends of a day, so the days of an
    interval add up to its whole seconds exactly, fractions included.  An open interval
    lasts until the end of the run's last day; where the run has no last day its length is
    unknown and its start day's seconds are NULL.  An interval that ends where it starts, or
    before, keeps its start day.
    """
    def midnight(day) -> Column:
        return F.lit(day).cast("timestamp_ntz")

    nt = node_timeline
    if p.until is not None:
        last = midnight(p.until + dt.timedelta(days=1))
        nt = nt.where(F.col("start_time") < last).withColumn("end_time", F.coalesce("end_time", last))
    if p.window_start is not None:
        nt = nt.where((F.col("end_time") > midnight(p.window_start)) | (F.col("start_time") >= midnight(p.window_start)))
    first = F.to_date("start_time")
    final = F.when(F.col("end_time") > F.col("start_time"), F.to_date(F.col("end_time") - F.expr("INTERVAL 1 MICROSECOND"))).otherwise(first)
    days = nt.select("cluster_id", "driver", "node_type", "start_time", "end_time", F.explode(F.sequence(first, F.coalesce(final, first))).alias("usage_date"))
    if p.window_start is not None:
        days = days.where(F.col("usage_date") >= F.lit(p.window_start))
    if p.until is not None:
        days = days.where(F.col("usage_date") <= F.lit(p.until))
    begin, day = F.col("start_time"), F.col("usage_date").cast("timestamp_ntz")
    since = lambda t: F.timestamp_diff("SECOND", begin, t)
    until = F.when(F.to_date("end_time") > F.col("usage_date"), F.date_add("usage_date", 1).cast("timestamp_ntz")).otherwise(F.col("end_time"))
    return days.select("usage_date", "cluster_id", "driver", "node_type", (since(until) - since(F.greatest(begin, day))).alias("seconds"))


def node_hours(node_timeline: DataFrame, p: RunParams, split_days: bool = False) -> DataFrame:
    """Per (start date, cluster): node hours by role and the (max) node type by role.

    An interval is charged wholly to the date it starts (T16); an open interval adds
    nothing; ``driver`` NULL counts for neither role (T17).  ``split_days`` charges each
    day with its own part of the interval instead (``split_at_midnight``).

    Two phases: the raw timeline is first reduced by a hash aggregate to one row per
    (day, cluster, role, node type) with summed hours — string keys, numeric buffer, map-
    side combining.  Only that small result feeds the string ``MAX`` (a sort-based
    aggregate in Spark), so raw rows are never sorted.  Sums are associative and an
    all-open group stays NULL, so the result equals the one-step formulation.
    """
    nt = node_timeline
    if split_days:
        typed = split_at_midnight(nt, p).groupBy("usage_date", "cluster_id", "driver", "node_type").agg((F.sum("seconds") / dec("3600.0")).alias("hours"))
    else:
        if p.window_start is not None:
            nt = nt.where(F.col("start_time") >= F.lit(p.window_start).cast("timestamp_ntz"))
        if p.until is not None:
            nt = nt.where(F.col("start_time") < F.lit(p.until + dt.timedelta(days=1)).cast("timestamp_ntz"))
        typed = nt.groupBy(F.to_date("start_time").alias("usage_date"), "cluster_id", "driver", "node_type").agg(
            F.sum(hours_between("start_time", "end_time")).alias("hours")
        )
    h = F.col("hours")
    drv, wrk = F.col("driver"), ~F.col("driver")
    return typed.groupBy("usage_date", "cluster_id").agg(
        F.sum(F.when(drv, h).otherwise(0)).alias("driver_hours"),
        F.sum(F.when(wrk, h).otherwise(0)).alias("worker_hours"),
        F.max(F.when(drv, F.col("node_type"))).alias("nt_driver_type"),
        F.max(F.when(wrk, F.col("node_type"))).alias("nt_worker_type"),
    )


CONFIG_ORDER = ("change_time", "cluster_name", "driver_node_type", "worker_node_type", "worker_count", "max_autoscale_workers")


def _newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in CONFIG_ORDER]


def _config_columns() -> list[Column]:
    return [
        F.col("cluster_name"),
        F.col("driver_node_type").alias("cc_driver_type"),
        F.col("worker_node_type").alias("cc_worker_type"),
        F.coalesce(F.col("worker_count"), F.col("max_autoscale_workers"), F.lit(1)).alias("cc_num_workers"),
    ]


def latest_cluster_config(clusters: DataFrame) -> DataFrame:
    """Newest change per cluster (T19: applied to all history).  Ties on ``change_time``
    are broken by the remaining columns so the pick is deterministic.

    ``row_number() ... = 1`` plans as a WindowGroupLimit before and after the shuffle,
    so each map task forwards one row per cluster however long its change log is.
    """
    w = Window.partitionBy("cluster_id").orderBy(*_newest_first())
    return clusters.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).select("cluster_id", *_config_columns())


def cluster_config_as_of(clusters: DataFrame, used: DataFrame) -> DataFrame:
    """``usage_date, cluster_id`` and the config of the last change up to the end of that day,
    for each cluster-day of ``used`` that has one (T19 the other way: no later change reaches
    back).  Ties on ``change_time`` are broken as in ``latest_cluster_config``.

    An as-of join by union and last value: changes and days of a cluster stand in one order
    and each day takes the last change before it.  The log is first cut to the last change of
    each cluster and day (a limit by group on both sides of the shuffle), so a partition of
    the window holds two rows a day at most, however long a cluster's log is."""
    w = Window.partitionBy("cluster_id", "usage_date").orderBy(*_newest_first())
    changes = (
        clusters.where(F.col("change_time").isNotNull() & F.col("cluster_id").isNotNull())
        .withColumn("usage_date", F.to_date("change_time"))
        .withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
        .select("usage_date", "cluster_id", F.struct(*_config_columns()).alias("config"))
    )
    days = used.select("usage_date", "cluster_id").distinct().withColumn("config", F.lit(None).cast(changes.schema["config"].dataType))
    both = changes.withColumn("day", F.lit(False)).unionByName(days.withColumn("day", F.lit(True)))
    order = Window.partitionBy("cluster_id").orderBy("usage_date", "day").rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("config", F.last("config", ignorenulls=True).over(order))
    return last.where(F.col("day") & F.col("config").isNotNull()).select("usage_date", "cluster_id", "config.*")


def vm_cost_estimate(cu: DataFrame, nh: DataFrame, cfg: DataFrame, vm_prices: DataFrame, p: RunParams,
                     allocate: str = "per_sku", loaded_at=None) -> DataFrame:
    """Join cluster usage to node hours, latest config and VM prices; pick the most
    authoritative source per row and record it in ``vm_cost_source``:

        BUNDLED_IN_DBU  serverless-like SKU (VM cost 0)
        node_timeline   node hours exist for the cluster-day
        cluster_config  only a config exists: billed hours x (driver + n x worker price)
        unknown         neither

    ``allocate="per_sku"`` (reference) gives every SKU row of a cluster-day the full VM
    cost (T20); ``"dbu_share"`` splits node-timeline cost by each SKU's DBU cost share.

    ``cfg`` holds one config for a cluster (``latest_cluster_config``, the reference's way) or
    one for each cluster-day (``cluster_config_as_of``).

    Plan: cluster usage and node hours are both per cluster-day aggregates and meet in one
    shuffle join on (date, cluster); the config side (one row per cluster) and the price
    table (one row per node type) are broadcast where the planner or AQE knows them small.
    """
    prices = vm_prices.where(F.col("region") == p.region).select(
        "node_type_id", "hourly_price_usd", "gcp_machine_type"
    )
    dvm = prices.select(
        F.col("node_type_id").alias("dvm_type"),
        F.col("hourly_price_usd").alias("dvm_price"),
        F.col("gcp_machine_type").alias("driver_vm_type"),
    )
    wvm = prices.select(
        F.col("node_type_id").alias("wvm_type"),
        F.col("hourly_price_usd").alias("wvm_price"),
        F.col("gcp_machine_type").alias("worker_vm_type"),
    )
    j = (
        cu.join(nh, ["usage_date", "cluster_id"], "left")
        .join(cfg, ["usage_date", "cluster_id"] if "usage_date" in cfg.columns else ["cluster_id"], "left")
        .withColumn("driver_node_type", F.coalesce("nt_driver_type", "cc_driver_type"))
        .withColumn("worker_node_type", F.coalesce("nt_worker_type", "cc_worker_type"))
    )
    j = j.join(dvm, F.col("driver_node_type") == F.col("dvm_type"), "left").join(
        wvm, F.col("worker_node_type") == F.col("wvm_type"), "left"
    )
    bundled = is_bundled("sku_name")
    has_nt = F.col("driver_hours").isNotNull()
    has_cc = F.col("cc_driver_type").isNotNull()
    dp, wp = F.coalesce(F.col("dvm_price"), F.lit(0)), F.coalesce(F.col("wvm_price"), F.lit(0))
    nt_cost = F.col("driver_hours") * dp + F.col("worker_hours") * wp
    if allocate == "dbu_share":
        day_dbu = F.sum("dbu_cost_usd").over(Window.partitionBy("usage_date", "cluster_id"))
        nt_cost = F.when(day_dbu > 0, nt_cost * F.col("dbu_cost_usd") / day_dbu).otherwise(nt_cost)
    elif allocate != "per_sku":
        raise ValueError(f"allocate must be 'per_sku' or 'dbu_share', not {allocate!r}")
    num_workers = F.coalesce(F.col("cc_num_workers"), F.lit(1))
    cc_cost = F.col("billing_hours") * (dp + num_workers * wp)
    vm_raw = F.when(bundled, F.lit(0)).when(has_nt, nt_cost).when(has_cc, cc_cost).otherwise(F.lit(0))
    vm_rounded = (
        F.when(bundled, F.lit(0)).when(has_nt, F.round(nt_cost, 6)).when(has_cc, F.round(cc_cost, 6)).otherwise(F.lit(0))
    )
    source = (
        F.when(bundled, "BUNDLED_IN_DBU").when(has_nt, "node_timeline").when(has_cc, "cluster_config").otherwise("unknown")
    )
    out = j.select(
        "usage_date",
        "cluster_id",
        "cluster_name",
        "sku_name",
        "driver_node_type",
        "worker_node_type",
        num_workers.alias("num_workers"),
        F.coalesce(F.col("driver_hours") + F.col("worker_hours"), F.col("billing_hours")).alias("cluster_uptime_hours"),
        "dbu_cost_usd",
        vm_rounded.alias("estimated_vm_cost_usd"),
        F.round(F.col("dbu_cost_usd") + vm_raw, 6).alias("total_estimated_cost"),
        "driver_vm_type",
        "worker_vm_type",
        source.alias("vm_cost_source"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("_etl_updated_at"),
    )
    return conform(out, DAILY_COST_WITH_VM_ESTIMATE)


def vm_cost_by_source(vm: DataFrame) -> DataFrame:
    return (
        vm.groupBy("vm_cost_source")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.sum("dbu_cost_usd"), 2).alias("dbu_cost"),
            F.round(F.sum("estimated_vm_cost_usd"), 2).alias("vm_cost"),
        )
        .orderBy(F.col("vm_cost").desc_nulls_last(), "vm_cost_source")
    )
