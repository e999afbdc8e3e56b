"""Declared schemas of the five source tables and the six gold tables.

Gold-table column types are part of the result: values are rounded on store (a
DECIMAL(38,10) average lands in a DECIMAL(38,6) column), exactly what the reference's
typed tables do.  ``conform`` performs that store-assignment cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

D38_6 = T.DecimalType(38, 6)
D18_6 = T.DecimalType(18, 6)


def _s(*fields: tuple) -> T.StructType:
    out = []
    for f in fields:
        name, typ = f[0], f[1]
        meta = {"comment": f[2]} if len(f) > 2 else {}
        out.append(T.StructField(name, typ, True, meta))
    return T.StructType(out)


# ---------------------------------------------------------------- sources
USAGE = _s(
    ("usage_date", T.DateType()),
    ("usage_start_time", T.TimestampNTZType()),
    ("usage_end_time", T.TimestampNTZType()),
    ("sku_name", T.StringType()),
    ("billing_origin_product", T.StringType()),
    ("cloud", T.StringType()),
    ("workspace_id", T.LongType()),
    ("product_features", _s(("is_serverless", T.BooleanType()))),
    ("usage_metadata", _s(("cluster_id", T.StringType()))),
    ("usage_quantity", D18_6),
)

LIST_PRICES = _s(
    ("sku_name", T.StringType()),
    ("cloud", T.StringType()),
    ("price_start_time", T.TimestampNTZType()),
    ("price_end_time", T.TimestampNTZType()),
    ("pricing", _s(("default", D18_6), ("effective_list", _s(("default", D18_6))))),
)

NODE_TIMELINE = _s(
    ("cluster_id", T.StringType()),
    ("driver", T.BooleanType()),
    ("node_type", T.StringType()),
    ("start_time", T.TimestampNTZType()),
    ("end_time", T.TimestampNTZType()),
)

CLUSTERS = _s(
    ("cluster_id", T.StringType()),
    ("cluster_name", T.StringType()),
    ("change_time", T.TimestampNTZType()),
    ("driver_node_type", T.StringType()),
    ("worker_node_type", T.StringType()),
    ("worker_count", T.IntegerType()),
    ("max_autoscale_workers", T.IntegerType()),
)

NODE_TYPES = _s(
    ("node_type", T.StringType()),
    ("core_count", T.DoubleType()),
    ("memory_mb", T.LongType()),
)

# ---------------------------------------------------------------- gold tables
DAILY_COST_SUMMARY = _s(
    ("usage_date", T.DateType(), "UTC day the usage is billed to"),
    ("sku_name", T.StringType(), "Priced product variant"),
    ("billing_origin_product", T.StringType(), "Product line that caused the usage"),
    ("cloud", T.StringType(), "Cloud of the run"),
    ("workspace_id", T.StringType(), "Workspace as text; NULL for account-level usage"),
    ("is_serverless", T.BooleanType(), "Serverless flag, NULL read as false"),
    ("total_dbus", D38_6, "Sum of the usage quantities"),
    ("list_price_per_dbu", D38_6, "Highest unit price that applied that day"),
    ("total_cost_usd", D38_6, "total_dbus x list_price_per_dbu"),
    ("_etl_updated_at", T.TimestampType(), "Time of the run that wrote the row"),
)
DAILY_COST_SUMMARY_KEYS = ["usage_date", "sku_name", "workspace_id", "billing_origin_product", "is_serverless"]

SKU_DAILY_DETAILS = _s(
    ("usage_date", T.DateType(), "UTC day"),
    ("sku_name", T.StringType(), "Priced product variant"),
    ("billing_origin_product", T.StringType(), "Product line"),
    ("product_category", T.StringType(), "Report category of the product line"),
    ("is_serverless", T.BooleanType(), "Serverless flag"),
    ("is_photon", T.BooleanType(), "SKU name has the Photon mark"),
    ("total_dbus", D38_6, "Sum over clouds and workspaces"),
    ("total_cost_usd", D38_6, "Sum over clouds and workspaces"),
    ("cost_7d_avg", D38_6, "Mean cost of the last 7 rows of the SKU"),
    ("cost_30d_avg", D38_6, "Mean cost of the last 30 rows of the SKU"),
    ("cost_pct_change_7d", T.DecimalType(10, 2), "Cost against cost_7d_avg, in percent; 0 where that mean is not positive"),
    ("_etl_updated_at", T.TimestampType(), "Time of the run that wrote the row"),
)
SKU_DAILY_DETAILS_KEYS = ["usage_date", "sku_name", "billing_origin_product", "is_serverless"]

VM_REFERENCE_PRICES = _s(
    ("node_type_id", T.StringType(), "Node type, or catalogue SKU id"),
    ("gcp_machine_type", T.StringType(), "Machine family, or catalogue description"),
    ("vcpus", T.IntegerType(), "Virtual CPUs; 0 for catalogue rows"),
    ("memory_gb", T.DoubleType(), "Memory; 0 for catalogue rows"),
    ("hourly_price_usd", T.DecimalType(10, 6), "Price of one hour without discounts"),
    ("region", T.StringType(), "Region the price holds in"),
    ("price_source", T.StringType(), "Where the price comes from: seed, seed with markup, catalogue or estimate"),
    ("last_updated", T.TimestampType(), "Time of the refresh"),
)
VM_REFERENCE_PRICES_KEYS = ["node_type_id", "region"]

DAILY_COST_WITH_VM_ESTIMATE = _s(
    ("usage_date", T.DateType(), "UTC day"),
    ("cluster_id", T.StringType(), "Cluster"),
    ("cluster_name", T.StringType(), "Name in the newest change of the cluster"),
    ("sku_name", T.StringType(), "Priced product variant"),
    ("driver_node_type", T.StringType(), "From the node timeline, else the newest change"),
    ("worker_node_type", T.StringType(), "From the node timeline, else the newest change"),
    ("num_workers", T.LongType(), "Fixed size, else upper limit of autoscaling, else 1"),
    ("cluster_uptime_hours", T.DecimalType(20, 4), "Node hours of all roles, else billed hours"),
    ("dbu_cost_usd", D38_6, "Sum of quantity x unit price"),
    ("estimated_vm_cost_usd", D38_6, "Hours x machine price by the best source"),
    ("total_estimated_cost", D38_6, "dbu_cost_usd + estimated_vm_cost_usd"),
    ("driver_vm_type", T.StringType(), "Machine the driver price was found under"),
    ("worker_vm_type", T.StringType(), "Machine the worker price was found under"),
    ("vm_cost_source", T.StringType(), "node_timeline, cluster_config, BUNDLED_IN_DBU or unknown"),
    ("_etl_updated_at", T.TimestampType(), "Time of the run that wrote the row"),
)
DAILY_COST_WITH_VM_ESTIMATE_KEYS = ["usage_date", "cluster_id", "sku_name"]

ALERT_CONFIG = _s(
    ("config_id", T.IntegerType(), "Key; the smallest active one counts"),
    ("daily_threshold_dollars", T.DecimalType(20, 2), "Amount that is 100 percent"),
    ("recipient_emails", T.StringType(), "Addresses, separated by commas"),
    ("is_active", T.BooleanType(), "Inactive rows are never used"),
    ("threshold_percentages", T.StringType(), "Tiers in percent, separated by commas"),
    ("created_at", T.TimestampType(), "First deployment"),
    ("updated_at", T.TimestampType(), "Last change"),
)
ALERT_CONFIG_KEYS = ["config_id"]

ALERT_HISTORY = _s(
    ("alert_id", T.LongType(), "Running number over all alerts"),
    ("alert_date", T.DateType(), "Day whose cost crossed the tier"),
    ("threshold_pct", T.IntegerType(), "The tier"),
    ("amount_at_alert", T.DecimalType(20, 2), "The day's cost so far"),
    ("threshold_amount", T.DecimalType(20, 2), "daily_threshold x threshold_pct / 100"),
    ("daily_threshold", T.DecimalType(20, 2), "Threshold of the config at that time"),
    ("recipients", T.StringType(), "Addresses of the config at that time"),
    ("sent_at", T.TimestampType(), "Time of the run"),
    ("status", T.StringType(), "SENT, or FAILED (fires again)"),
)

# Table -> (schema, merge keys).
GOLD = {
    "daily_cost_summary": (DAILY_COST_SUMMARY, DAILY_COST_SUMMARY_KEYS),
    "sku_daily_details": (SKU_DAILY_DETAILS, SKU_DAILY_DETAILS_KEYS),
    "gcp_vm_reference_prices": (VM_REFERENCE_PRICES, VM_REFERENCE_PRICES_KEYS),
    "daily_cost_with_vm_estimate": (DAILY_COST_WITH_VM_ESTIMATE, DAILY_COST_WITH_VM_ESTIMATE_KEYS),
    "alert_config": (ALERT_CONFIG, ALERT_CONFIG_KEYS),
    "alert_history": (ALERT_HISTORY, ["alert_id"]),
}
TABLE_COMMENTS = {
    "daily_cost_summary": "Usage and cost of a day by product variant, cloud and workspace; list price of the day's dearest version",
    "sku_daily_details": "Cost of a day by product variant with its category, rolling means and change against the 7-row mean",
    "gcp_vm_reference_prices": "Hourly machine prices by region, with the place each price comes from",
    "daily_cost_with_vm_estimate": "Usage cost and estimated machine cost of a cluster's day, with the evidence that was used",
    "alert_config": "Budget thresholds and their recipients",
    "alert_history": "Alerts that were raised, one row for each tier and day",
}
# Stored partitioned by ``usage_month``, the first day of the month of ``usage_date``.
FACT_TABLES = ("daily_cost_summary", "sku_daily_details", "daily_cost_with_vm_estimate")


def _cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as ``want``; fields of a struct are matched by name.  A column that has the
    type already is left alone, so filters on it still reach the scan."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(_cast(c[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType, drop_extra: bool = True) -> DataFrame:
    """Store-assignment cast to a declared schema.

    Columns are cast to the declared type (decimal rounding as on insert), missing
    columns are added as typed NULLs (the additive ``ADD COLUMN`` migration), and the
    output follows the declared order.  One projection — no shuffle.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for f in schema.fields:
        c = _cast(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    if not drop_extra:
        declared = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols)
