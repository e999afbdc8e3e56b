"""Column expressions shared by the plans.  All built-in functions: JVM-side and codegen'd."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Billing products per reporting category, in the reference's order.
PRODUCT_CATEGORIES = [
    ("Compute", ["JOBS", "ALL_PURPOSE_COMPUTE", "JOBS_COMPUTE"]),
    ("SQL Warehouse", ["SQL", "SQL_WAREHOUSE", "SERVERLESS_SQL"]),
    ("Delta Live Tables", ["DLT", "DELTA_LIVE_TABLES"]),
    ("Model Serving", ["MODEL_SERVING", "FOUNDATION_MODEL_APIS"]),
    ("Vector Search", ["VECTOR_SEARCH"]),
    ("Interactive", ["INTERACTIVE", "NOTEBOOKS"]),
]
OTHER_CATEGORY = "Other"

# SKU LIKE patterns whose VM cost is bundled into the DBU price.
# '_' is a LIKE wildcard, exactly as in the reference (SQLXPRO matches %SQL_PRO%).
BUNDLED_SKU_PATTERNS = ["%SERVERLESS%", "%REAL_TIME_INFERENCE%", "%SQL_PRO%", "%MODEL_SERVING%"]
PHOTON_SKU_PATTERN = "%PHOTON%"

# Alert severity by tier.
SEVERITY_CRITICAL_PCT = 100
SEVERITY_HIGH_PCT = 90


def dec(x: str | int) -> Column:
    """Exact decimal literal (e.g. dec('3600.0') is DECIMAL(5,1), as in SQL text)."""
    return F.lit(Decimal(str(x)))


def active_price(pricing: str = "pricing") -> Column:
    """Price precedence: effective list price, else list price, else 0."""
    return F.coalesce(F.col(f"{pricing}.effective_list.default"), F.col(f"{pricing}.default"), F.lit(0))


def product_category(product: str = "billing_origin_product") -> Column:
    c = F.col(product)
    out = None
    for label, products in PRODUCT_CATEGORIES:
        out = F.when(c.isin(products), label) if out is None else out.when(c.isin(products), label)
    return out.otherwise(OTHER_CATEGORY)


def is_photon(sku: str = "sku_name") -> Column:
    return F.when(F.upper(F.col(sku)).like(PHOTON_SKU_PATTERN), True).otherwise(False)


def is_bundled(sku: str = "sku_name") -> Column:
    up = F.upper(F.col(sku))
    cond = None
    for p in BUNDLED_SKU_PATTERNS:
        cond = up.like(p) if cond is None else cond | up.like(p)
    return cond


def hours_between(start: str, end: str) -> Column:
    """Whole seconds between two timestamps / 3600.0 — DECIMAL(27,6), rounded per interval."""
    return F.timestamp_diff("SECOND", F.col(start), F.col(end)) / dec("3600.0")


def money(units: Column, nanos: Column) -> Column:
    """Catalogue money: integer units + nanos / 1e9, as a double."""
    return F.coalesce(units, F.lit("0")).cast("long") + F.coalesce(nanos, F.lit(0)).cast("double") / F.lit(1e9)


def severity(pct: str = "threshold_pct") -> Column:
    c = F.col(pct)
    return (
        F.when(c >= SEVERITY_CRITICAL_PCT, "CRITICAL").when(c >= SEVERITY_HIGH_PCT, "HIGH").otherwise("WARNING")
    )


def display_time(ts: Column, tz: str) -> Column:
    """UTC timestamp shown in ``tz`` as 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(F.from_utc_timestamp(ts, tz), "yyyy-MM-dd HH:mm:ss")


def month_start(label: str | None, as_of) -> Column:
    """``COALESCE(try_to_date(label, 'MMM yyyy'), date_trunc('MONTH', as_of))``.

    Both operands are literals, so Catalyst folds the expression to a constant and the
    month filter reaches the scan as a partition / pushed filter.
    """
    fallback = F.lit(as_of.replace(day=1))
    if label is None:
        return fallback
    return F.coalesce(F.try_to_date(F.lit(label), "MMM yyyy"), fallback)


def in_month(date_col: str, label: str | None, as_of, offset: int = 0) -> Column:
    """Half-open month range ``[mstart + offset, mstart + offset + 1 month)``."""
    ms = month_start(label, as_of)
    lo = F.add_months(ms, offset) if offset else ms
    return (F.col(date_col) >= lo) & (F.col(date_col) < F.add_months(ms, offset + 1))


PARTITION_COL = "usage_month"


def on_or_after(df, date_col: str, start) -> "DataFrame":
    """``date_col >= start``; on a table stored by ``usage_month`` also the implied
    ``usage_month >= month(start)``, so whole partitions are skipped."""
    out = df.where(F.col(date_col) >= start)
    if PARTITION_COL in df.columns and date_col == "usage_date":
        out = out.where(F.col(PARTITION_COL) >= F.trunc(start, "month"))
    return out


def on_date(df, date_col: str, day) -> "DataFrame":
    """``date_col = day``; on a table stored by ``usage_month`` also ``usage_month = month(day)``."""
    out = df.where(F.col(date_col) == F.lit(day))
    if PARTITION_COL in df.columns and date_col == "usage_date":
        out = out.where(F.col(PARTITION_COL) == F.trunc(F.lit(day), "month"))
    return out


def csv_ints(s: Column) -> Column:
    """'25, 50,75' -> [25, 50, 75] (a bad token raises under ANSI, like int() in Python)."""
    return F.transform(F.split(s, ","), lambda x: F.trim(x).cast("int"))
