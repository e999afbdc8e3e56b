"""Usage pricing and the VM reference price table.

* ``usage_window``             one cloud, optional lookback (A1)
* ``price_usage``              usage + the list price active at usage start (E1, T1, T2)
* ``seed_prices``              built-in list prices x region markup (P2)
* ``catalog_price_extract``    priced Compute/OnDemand SKUs of a region from catalogue pages (P1)
* ``estimate_missing_prices``  component-priced rows for node types without a price (P4)
* ``price_source_counts``      rows per price source (P5)
* ``build_vm_price_table``     upsert the day's rows, then append estimates (P3 + P4)
* ``price_coverage``           data quality: node types with listed, estimated, no price (T21, T25)
* ``price_overlap_check``      data-quality: usage rows matching more than one price row (T4)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.functions.expressions import active_price, dec, money
from ledger.operators.temporal_join import overlapping_stretches, scd2_left_join
from ledger.operators.upsert import upsert
from ledger.params import RunParams
from ledger.sources.schemas import VM_REFERENCE_PRICES, VM_REFERENCE_PRICES_KEYS, conform
from ledger.sources.seed import (
    CATALOG_LABEL,
    ESTIMATE_LABEL,
    N1_GB_HOURLY,
    N1_VCPU_HOURLY,
    REGION_MARKUP,
    SEED_LABEL,
    SEED_MARKUP_LABEL,
    SEED_VM_PRICES,
)

PRICED_COLUMNS = [
    "usage_date",
    "usage_start_time",
    "usage_end_time",
    "sku_name",
    "billing_origin_product",
    "cloud",
    "workspace_id",
    "is_serverless",
    "cluster_id",
    "usage_quantity",
    "price_start_time",
    "unit_price",
    "exact_cost",
]


def usage_window(usage: DataFrame, p: RunParams) -> DataFrame:
    """``cloud = :cloud AND usage_date BETWEEN as_of - lookback AND as_of`` — all reach the scan."""
    cond = F.col("cloud") == p.cloud
    if p.window_start is not None:
        cond = cond & (F.col("usage_date") >= F.lit(p.window_start))
    if p.until is not None:
        cond = cond & (F.col("usage_date") <= F.lit(p.until))
    return usage.where(cond)


def price_usage(usage: DataFrame, list_prices: DataFrame, p: RunParams) -> DataFrame:
    """Each usage row of the window with the price version active at ``usage_start_time``.

    Unpriced rows get ``unit_price`` 0 (LEFT join + COALESCE).  ``exact_cost`` is
    quantity x price per row; the daily summary deliberately uses another formula (T3).
    Only prices of the run's cloud are needed, which keeps the broadcast side small.
    """
    u = usage_window(usage, p).select(
        "usage_date",
        "usage_start_time",
        "usage_end_time",
        "sku_name",
        "billing_origin_product",
        "cloud",
        "workspace_id",
        F.col("product_features.is_serverless").alias("is_serverless"),
        F.col("usage_metadata.cluster_id").alias("cluster_id"),
        "usage_quantity",
    )
    prices = list_prices.where(F.col("cloud") == p.cloud).select(
        "sku_name", "cloud", "price_start_time", "price_end_time", active_price().alias("unit_price")
    )
    # The run's window is the facts' span where it has both ends.
    span = (F.lit(p.window_start).cast("timestamp"), F.lit(p.until).cast("timestamp") + F.expr("INTERVAL 1 DAY")) if p.window_start and p.until else None
    j = scd2_left_join(u, prices, ["sku_name", "cloud"], "usage_start_time", "price_start_time", "price_end_time", span)
    unit = F.coalesce(F.col("unit_price"), F.lit(0))
    return j.withColumn("unit_price", unit).withColumn(
        "exact_cost", F.col("usage_quantity") * F.col("unit_price")
    ).select(*PRICED_COLUMNS)


def price_overlap_check(usage: DataFrame, list_prices: DataFrame, p: RunParams) -> DataFrame:
    """(sku, cloud, usage_start_time) matched by more than one price version; empty when
    clean.  Versions are counted distinct (several usage rows may share a start time).

    The price list is swept first, by itself; only usage that lies in a stretch of time with
    several active versions is looked for, and where there is none usage is not read."""
    keys = ["sku_name", "cloud"]
    stretches = overlapping_stretches(list_prices.where(F.col("cloud") == p.cloud), keys, "price_start_time", "price_end_time", "active_prices")
    u = usage_window(usage, p).select(*keys, "usage_start_time")
    if stretches.isEmpty():
        return usage.sparkSession.createDataFrame([], T.StructType([*u.schema.fields, T.StructField("active_prices", T.LongType())]))
    at = F.col("u.usage_start_time")
    inside = (at >= F.col("s.price_start_time")) & (F.col("s.price_end_time").isNull() | (at < F.col("s.price_end_time")))
    same = [F.col(f"u.{k}") == F.col(f"s.{k}") for k in keys]
    hit = u.alias("u").join(stretches.alias("s"), [*same, inside]).select(*(f"u.{k}" for k in keys), at, F.col("s.active_prices"))
    return hit.groupBy(*keys, "usage_start_time").agg(F.max("active_prices").cast("long").alias("active_prices"))


def price_coverage(node_types: DataFrame, prices: DataFrame, region: str) -> DataFrame:
    """Data quality: how many node types have a listed, an estimated or no price in
    ``region`` (T21, T25), and the price rows there that match no node type."""
    have = prices.where(F.col("region") == region).groupBy(F.col("node_type_id").alias("node_type")).agg(
        F.min(F.col("price_source").like("Estimated%")).alias("estimated"))
    known = node_types.select("node_type").distinct().withColumn("known", F.lit(True))
    state = (F.when(F.col("known").isNull(), "price without node type").when(F.col("estimated").isNull(), "no price")
             .when(F.col("estimated"), "estimated price").otherwise("listed price"))
    both = known.join(have, "node_type", "full_outer")
    return both.groupBy(state.alias("coverage")).agg(F.count(F.lit(1)).alias("node_types"))


# ------------------------------------------------------------------ VM price table


def _markup(region_col) -> F.Column:
    m = F.create_map(*[x for k, v in REGION_MARKUP.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, region_col), F.lit(1.0))


def _seed_rows() -> F.Column:
    return F.array(*[
        F.struct(F.lit(n).alias("node_type_id"), F.lit(v).alias("vcpus"), F.lit(m).alias("memory_gb"),
                 F.lit(p).alias("base_price"))
        for n, v, m, p in SEED_VM_PRICES
    ])


def seed_prices(regions: DataFrame, loaded_at=None) -> DataFrame:
    """Seeded list prices for each region in ``regions`` (column ``region``).

    us-central1 prices times the region's markup, rounded to 6 places; the label says
    whether a markup was applied.  The 36 seed rows are generated per region with
    ``inline`` — no join.
    """
    r = regions.select("region").distinct().select("region", F.inline(_seed_rows()))
    mk = _markup(F.col("region"))
    label = F.when(mk == 1.0, F.format_string(SEED_LABEL, F.col("region"))).otherwise(
        F.format_string(SEED_MARKUP_LABEL, mk.cast("string"), F.col("region"))
    )
    out = r.select(
        "node_type_id",
        F.col("node_type_id").alias("gcp_machine_type"),
        "vcpus",
        "memory_gb",
        F.round(F.col("base_price") * mk, 6).alias("hourly_price_usd"),
        "region",
        label.alias("price_source"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("last_updated"),
    )
    return conform(out, VM_REFERENCE_PRICES)


def catalog_regions(pages: DataFrame) -> DataFrame:
    """Distinct service regions named by catalogue SKUs."""
    return (
        pages.select(F.explode("skus").alias("sku"))
        .select(F.explode("sku.serviceRegions").alias("region"))
        .where(F.col("region").isNotNull())
        .distinct()
    )


def catalog_price_extract(pages: DataFrame, region: str, loaded_at=None) -> DataFrame:
    """Compute / OnDemand SKUs served in ``region`` with a positive first-tier hourly price.

    Only the first tier of the first pricing entry is read; units and nanos combine to a
    price.  The SKU id becomes ``node_type_id`` and ``vcpus`` is 0 (so these rows never
    match a node type — the reference's behaviour, kept).  A distributed explode/filter.
    """
    sku = F.col("sku")
    first_rate = F.get(F.get(sku["pricingInfo"], 0)["pricingExpression"]["tieredRates"], 0)
    unit = first_rate["unitPrice"]
    price = money(unit["units"], unit["nanos"])
    rows = (
        pages.select(F.explode("skus").alias("sku"))
        .where(
            (sku["category"]["resourceFamily"] == "Compute")
            & (sku["category"]["usageType"] == "OnDemand")
            & F.coalesce(F.array_contains(sku["serviceRegions"], region), F.lit(False))
            & first_rate.isNotNull()
        )
        .select(
            F.element_at(F.split(sku["name"], "/"), -1).alias("node_type_id"),
            F.lower(F.coalesce(sku["description"], F.lit(""))).alias("gcp_machine_type"),
            F.lit(0).alias("vcpus"),
            F.lit(0.0).alias("memory_gb"),
            price.alias("hourly_price_usd"),
            F.lit(region).alias("region"),
            F.lit(CATALOG_LABEL % region).alias("price_source"),
            (loaded_at if loaded_at is not None else F.current_timestamp()).alias("last_updated"),
        )
        .where(F.col("hourly_price_usd") > 0)
    )
    return conform(rows, VM_REFERENCE_PRICES)


def estimate_missing_prices(node_types: DataFrame, prices: DataFrame, region: str, loaded_at=None) -> DataFrame:
    """Rows for node types with no price in ``region``: vCPU and GB-hour component prices.

    ``LEFT JOIN ... IS NULL`` in the reference; written as ``left_anti`` because Catalyst
    does not rewrite the outer-join form.
    """
    have = prices.where(F.col("region") == region).select(F.col("node_type_id").alias("node_type"))
    gb = F.col("memory_mb") / dec("1024.0")
    est = node_types.join(have, "node_type", "left_anti").select(
        F.col("node_type").alias("node_type_id"),
        F.col("node_type").alias("gcp_machine_type"),
        F.col("core_count").cast("int").alias("vcpus"),
        F.round(gb, 1).alias("memory_gb"),
        F.round(F.col("core_count") * dec(N1_VCPU_HOURLY) + gb * dec(N1_GB_HOURLY), 6).alias("hourly_price_usd"),
        F.lit(region).alias("region"),
        F.lit(ESTIMATE_LABEL).alias("price_source"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("last_updated"),
    )
    return conform(est, VM_REFERENCE_PRICES).distinct()


def price_source_counts(prices: DataFrame, region: str) -> DataFrame:
    """Rows per price source in ``region``, flagging the component estimates."""
    return (
        prices.where(F.col("region") == region)
        .groupBy("price_source")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("is_estimate", F.col("price_source").like("Estimated%"))
    )


def build_vm_price_table(existing: DataFrame | None, new_rows: DataFrame, node_types: DataFrame,
                         region: str, loaded_at=None) -> DataFrame:
    """The refresh job: upsert the day's rows on (node_type_id, region), then append
    estimates for node types still unpriced in ``region``."""
    new_rows = conform(new_rows, VM_REFERENCE_PRICES)
    table = new_rows if existing is None else upsert(conform(existing, VM_REFERENCE_PRICES), new_rows,
                                                     VM_REFERENCE_PRICES_KEYS, check=False)
    return table.unionByName(estimate_missing_prices(node_types, table, region, loaded_at))
