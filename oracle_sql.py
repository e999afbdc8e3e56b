"""DuckDB SQL twins of the registered Spark queries (the correctness oracle).

Only the 14 base tables exist on the DuckDB side, so every statement starts with the
derived billing views of FIXTURES.md as CTEs.  Where Spark's DECIMAL arithmetic rounds
between steps (a product beyond 38 digits keeps 6 places, averages keep 10), the SQL
reproduces it with exact integer arithmetic on scaled values and half-up division
(``hu``), because DuckDB turns decimal division into DOUBLE.

Fixed values: the category lists, LIKE patterns, labels, severity limits and component
prices in the statements must equal those of ``functions/expressions.py`` and
``sources/seed.py``.
"""

from __future__ import annotations

from ledger.sources.seed import REGION_MARKUP, SEED_VM_PRICES

AS_OF = "DATE '2000-06-30'"
WINDOW90 = "DATE '2000-04-01'"          # as_of - 90 days
MONTH_START, MONTH_END, PREV_START = "DATE '2000-06-01'", "DATE '2000-07-01'", "DATE '2000-05-01'"
LOADED_AT = "TIMESTAMP '2000-07-01 00:30:00'"
SENT_AT = "TIMESTAMP '2000-06-30 23:00:00'"
REGION = "us-central1"


def hu(a: str, b: str) -> str:
    """Integer a / b rounded half away from zero (Java HALF_UP)."""
    return (
        f"(CASE WHEN ({a}) < 0 THEN -1 ELSE 1 END * CASE WHEN ({b}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs(CAST({a} AS HUGEINT)) + abs(CAST({b} AS HUGEINT))) // (2 * abs(CAST({b} AS HUGEINT)))))"
    )


def I(x: str, s: int) -> str:  # noqa: E743 - decimal with scale <= s -> scaled integer
    return f"CAST(({x}) * {10 ** s} AS HUGEINT)"


def D(x: str, s: int) -> str:
    """Scaled integer -> DECIMAL(38, s)."""
    return f"(CAST({x} AS DECIMAL(38,0)) * CAST({'0.' + '0' * (s - 1) + '1'} AS DECIMAL(18,{s})))"


def ist(ts: str) -> str:
    return f"strftime({ts} + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S')"


BUNDLED = "(upper(sku_name) LIKE '%SERVERLESS%' OR upper(sku_name) LIKE '%REAL_TIME_INFERENCE%' " \
          "OR upper(sku_name) LIKE '%SQL_PRO%' OR upper(sku_name) LIKE '%MODEL_SERVING%')"

SEED_VALUES = ",\n    ".join(f"('{n}', {v}, {m!r}, {p!r})" for n, v, m, p in SEED_VM_PRICES)
MARKUP_VALUES = ", ".join(f"('{r}', {m!r}, '{m!r}')" for r, m in REGION_MARKUP.items())

# --------------------------------------------------------------------------- CTEs
# name -> (sql, dependencies)
CTE: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTE[name] = (sql, deps)


cte("usage", [], """
SELECT CAST(l_shipdate AS DATE) AS usage_date,
  l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR AS usage_start_time,
  l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR + CAST(l_quantity AS INTEGER) * INTERVAL '1' MINUTE AS usage_end_time,
  CASE l_linenumber WHEN 1 THEN 'PREMIUM_JOBS_COMPUTE' WHEN 2 THEN 'PREMIUM_JOBS_COMPUTE_(PHOTON)'
    WHEN 3 THEN 'PREMIUM_ALL_PURPOSE_COMPUTE' WHEN 4 THEN 'PREMIUM_SQL_PRO_COMPUTE'
    WHEN 5 THEN 'PREMIUM_SERVERLESS_SQL_COMPUTE' WHEN 6 THEN 'PREMIUM_DLT_CORE_COMPUTE'
    ELSE 'PREMIUM_SERVERLESS_REAL_TIME_INFERENCE' END AS sku_name,
  CASE WHEN l_suppkey % 10 = 0 THEN 'VECTOR_SEARCH' WHEN l_suppkey % 10 = 1 THEN 'INTERACTIVE'
    WHEN l_suppkey % 10 = 2 THEN 'STORAGE' WHEN l_linenumber <= 2 THEN 'JOBS'
    WHEN l_linenumber = 3 THEN 'ALL_PURPOSE_COMPUTE' WHEN l_linenumber <= 5 THEN 'SQL'
    WHEN l_linenumber = 6 THEN 'DLT' ELSE 'MODEL_SERVING' END AS billing_origin_product,
  CASE WHEN l_returnflag = 'R' THEN 'AWS' ELSE 'GCP' END AS cloud,
  l_suppkey % 3 AS workspace_id,
  CASE WHEN l_linenumber IN (5,7) THEN true WHEN l_linestatus = 'F' THEN false END AS is_serverless,
  CASE WHEN l_linenumber <> 5 THEN concat('c-', CAST(l_suppkey % 12 AS VARCHAR)) END AS cluster_id,
  CAST(l_quantity AS DECIMAL(18,6)) AS usage_quantity
FROM lineitem""")

cte("list_prices", ["usage"], """
SELECT sku_name, cloud,
  CASE gen WHEN 1 THEN TIMESTAMP '1990-01-01 00:00:00' WHEN 2 THEN TIMESTAMP '2000-04-20 12:00:00'
    WHEN 3 THEN TIMESTAMP '2000-05-10 12:00:00' ELSE TIMESTAMP '2000-06-10 12:00:00' END AS price_start_time,
  CASE gen WHEN 1 THEN TIMESTAMP '2000-04-20 12:00:00' WHEN 2 THEN TIMESTAMP '2000-05-10 12:00:00'
    WHEN 3 THEN TIMESTAMP '2000-06-10 12:00:00' END AS price_end_time,
  CAST(0.10 + 0.01 * length(sku_name) + 0.05 * gen AS DECIMAL(18,6)) AS price_default,
  CASE WHEN sku_name LIKE '%SQL%' THEN CAST(0.07 * gen + 0.20 AS DECIMAL(18,6)) END AS price_effective
FROM (SELECT DISTINCT sku_name, cloud FROM usage WHERE sku_name NOT LIKE '%DLT%') s
CROSS JOIN (SELECT 1 AS gen UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) g""")

cte("node_timeline", [], """
SELECT concat('c-', CAST(o_custkey % 10 AS VARCHAR)) AS cluster_id,
  o_orderpriority = '1-URGENT' AS driver,
  CASE o_orderkey % 4 WHEN 0 THEN 'n2-standard-8' WHEN 1 THEN 'n1-highmem-16'
    WHEN 2 THEN 'e2-standard-4' ELSE 'n1-standard-7' END AS node_type,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS start_time,
  CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR
    + (o_orderkey % 7 + 1) * INTERVAL '1000' SECOND END AS end_time
FROM orders""")

cte("clusters", [], """
SELECT concat('c-', CAST(c_custkey % 11 AS VARCHAR)) AS cluster_id,
  concat('cluster-', CAST(c_custkey % 11 AS VARCHAR)) AS cluster_name,
  TIMESTAMP '1995-01-01 00:00:00' + c_custkey * INTERVAL '1' HOUR AS change_time,
  CASE c_nationkey % 3 WHEN 0 THEN 'n1-standard-4' WHEN 1 THEN 'n2-highmem-8' ELSE 'n1-standard-9' END AS driver_node_type,
  CASE c_nationkey % 4 WHEN 0 THEN 'n1-standard-16' WHEN 1 THEN 'c2-standard-8' WHEN 2 THEN 'e2-standard-8' END AS worker_node_type,
  CAST(CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey % 5 END AS INTEGER) AS worker_count,
  CAST(CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey % 8 + 1 END AS INTEGER) AS max_autoscale_workers
FROM customer""")

cte("node_types", [], """
SELECT DISTINCT concat('n1-standard-', CAST(p_size AS VARCHAR)) AS node_type,
  CAST(p_size AS DOUBLE) AS core_count, CAST(p_size * 3840 AS BIGINT) AS memory_mb
FROM part""")

cte("catalog_flat", [], """
SELECT concat('services/S/skus/SKU-', CAST(p_partkey AS VARCHAR)) AS name,
  CASE WHEN p_size % 5 = 0 THEN 'Storage' ELSE 'Compute' END AS resource_family,
  CASE p_type WHEN 'PROMO' THEN 'Preemptible' WHEN 'SMALL' THEN NULL ELSE 'OnDemand' END AS usage_type,
  CASE p_partkey % 4 WHEN 0 THEN 'us-central1,us-east1' WHEN 1 THEN 'us-central1' WHEN 2 THEN 'asia-south1' END AS regions_csv,
  p_name AS description, CAST(p_partkey % 3 AS VARCHAR) AS units,
  CAST(p_partkey % 7 * 100000000 AS BIGINT) AS nanos, p_partkey % 11 <> 0 AS has_tier
FROM part""")

cte("alert_config", [], """
SELECT CAST(c_custkey AS INTEGER) AS config_id,
  CAST(100 * (c_custkey % 5 + 2) AS DECIMAL(20,2)) AS daily_threshold_dollars,
  CASE WHEN c_custkey % 2 = 1 THEN lower(c_mktsegment) || '@example.com,finance@example.com'
    ELSE lower(c_mktsegment) || '@example.com' END AS recipient_emails,
  c_custkey % 3 <> 0 AS is_active,
  CASE c_custkey % 4 WHEN 1 THEN '25,50,75,90,100' WHEN 2 THEN '50, 100' WHEN 3 THEN '90' ELSE '100' END
    AS threshold_percentages,
  TIMESTAMP '2000-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS created_at,
  TIMESTAMP '2000-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE + c_nationkey * INTERVAL '1' DAY AS updated_at
FROM customer""")

cte("alert_history", [], """
SELECT o_orderkey AS alert_id, CAST(o_orderdate AS DATE) AS alert_date,
  CAST(CASE o_orderkey % 5 WHEN 0 THEN 25 WHEN 1 THEN 50 WHEN 2 THEN 75 WHEN 3 THEN 90 ELSE 100 END AS INTEGER) AS threshold_pct,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DECIMAL(20,2)) AS amount_at_alert,
  CAST(3 * CASE o_orderkey % 5 WHEN 0 THEN 25 WHEN 1 THEN 50 WHEN 2 THEN 75 WHEN 3 THEN 90 ELSE 100 END
    AS DECIMAL(20,2)) AS threshold_amount,
  CAST(300 AS DECIMAL(20,2)) AS daily_threshold, 'ops@example.com' AS recipients,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS sent_at,
  CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SENT' END AS status
FROM orders""")

cte("seed", [], f"""
SELECT * FROM (VALUES
    {SEED_VALUES}
) v(node_type_id, vcpus, memory_gb, base_price)""")

cte("markup", [], f"SELECT * FROM (VALUES {MARKUP_VALUES}) m(region, markup, markup_txt)")


def priced_sql(prices: str = "list_prices", window: str | None = None) -> str:
    w = f" AND u.usage_date >= {window} AND u.usage_date <= {AS_OF}" if window else ""
    return f"""
SELECT u.usage_date, u.usage_start_time, u.usage_end_time, u.sku_name, u.billing_origin_product, u.cloud,
  u.workspace_id, u.is_serverless, u.cluster_id, u.usage_quantity, p.price_start_time,
  COALESCE(p.price_effective, p.price_default, 0) AS unit_price,
  u.usage_quantity * COALESCE(p.price_effective, p.price_default, 0) AS exact_cost
FROM usage u LEFT JOIN {prices} p
  ON u.sku_name = p.sku_name AND u.cloud = p.cloud AND u.usage_start_time >= p.price_start_time
  AND (p.price_end_time IS NULL OR u.usage_start_time < p.price_end_time)
WHERE u.cloud = 'GCP'{w}"""


def summary_sql(priced: str) -> str:
    return f"""
SELECT usage_date, sku_name, billing_origin_product, cloud, CAST(workspace_id AS VARCHAR) AS workspace_id,
  COALESCE(is_serverless, false) AS is_serverless,
  CAST(SUM(usage_quantity) AS DECIMAL(38,6)) AS total_dbus,
  CAST(MAX(unit_price) AS DECIMAL(38,6)) AS list_price_per_dbu,
  CAST(SUM(usage_quantity) * MAX(unit_price) AS DECIMAL(38,6)) AS total_cost_usd
FROM {priced}
GROUP BY usage_date, sku_name, billing_origin_product, cloud, CAST(workspace_id AS VARCHAR), COALESCE(is_serverless, false)"""


cte("priced", ["usage", "list_prices"], priced_sql())
cte("summary", ["priced"], summary_sql("priced"))

# sku_daily_details: AVG keeps 10 places; (c - a) and (c - a) / a keep 6; pct rounds to 2.
_W = "PARTITION BY sku_name ORDER BY usage_date NULLS FIRST, billing_origin_product NULLS FIRST, is_serverless NULLS FIRST"
cte("details_base", ["summary"], """
SELECT usage_date, sku_name, billing_origin_product, is_serverless,
  SUM(total_dbus) AS total_dbus, SUM(total_cost_usd) AS total_cost_usd
FROM summary GROUP BY usage_date, sku_name, billing_origin_product, is_serverless""")
cte("details_w", ["details_base"], f"""
SELECT *, {I('total_cost_usd', 6)} AS c6,
  SUM({I('total_cost_usd', 6)}) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7,
  COUNT(*) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7,
  SUM({I('total_cost_usd', 6)}) OVER ({_W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS s30,
  COUNT(*) OVER ({_W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS n30
FROM details_base""")
cte("details_a", ["details_w"], f"""
SELECT *, {hu('s7 * 10000', 'n7')} AS a7_10, {hu('s30 * 10000', 'n30')} AS a30_10 FROM details_w""")
cte("details_r", ["details_a"], f"""
SELECT *, CASE WHEN a7_10 > 0 THEN {hu(hu('c6 * 10000 - a7_10', '10000') + ' * 10000000000', 'a7_10')} END AS r6
FROM details_a""")
cte("details", ["details_r"], f"""
SELECT usage_date, sku_name, billing_origin_product,
  CASE WHEN billing_origin_product IN ('JOBS', 'ALL_PURPOSE_COMPUTE', 'JOBS_COMPUTE') THEN 'Compute'
    WHEN billing_origin_product IN ('SQL', 'SQL_WAREHOUSE', 'SERVERLESS_SQL') THEN 'SQL Warehouse'
    WHEN billing_origin_product IN ('DLT', 'DELTA_LIVE_TABLES') THEN 'Delta Live Tables'
    WHEN billing_origin_product IN ('MODEL_SERVING', 'FOUNDATION_MODEL_APIS') THEN 'Model Serving'
    WHEN billing_origin_product IN ('VECTOR_SEARCH') THEN 'Vector Search'
    WHEN billing_origin_product IN ('INTERACTIVE', 'NOTEBOOKS') THEN 'Interactive'
    ELSE 'Other' END AS product_category,
  is_serverless,
  upper(sku_name) LIKE '%PHOTON%' AS is_photon,
  CAST(total_dbus AS DECIMAL(38,6)) AS total_dbus,
  CAST(total_cost_usd AS DECIMAL(38,6)) AS total_cost_usd,
  {D(hu('a7_10', '10000'), 6)} AS cost_7d_avg,
  {D(hu('a30_10', '10000'), 6)} AS cost_30d_avg,
  CAST(CASE WHEN a7_10 > 0 THEN {D(hu('r6 * 100', '10000'), 2)} ELSE 0 END AS DECIMAL(10,2)) AS cost_pct_change_7d
FROM details_r""")

# ---- VM price table
cte("seed_uc1", ["seed", "markup"], f"""
SELECT s.node_type_id, s.node_type_id AS gcp_machine_type, CAST(s.vcpus AS INTEGER) AS vcpus,
  CAST(s.memory_gb AS DOUBLE) AS memory_gb,
  CAST(ROUND(CAST(s.base_price AS DOUBLE) * COALESCE(m.markup, 1.0), 6) AS DECIMAL(10,6)) AS hourly_price_usd,
  r.region,
  CASE WHEN COALESCE(m.markup, 1.0) = 1.0 THEN 'GCP list price (seeded, ' || r.region || ')'
    ELSE 'GCP list price (seeded us-central1, ~' || m.markup_txt || 'x markup for ' || r.region || ')' END AS price_source
FROM (SELECT '{REGION}' AS region) r CROSS JOIN seed s LEFT JOIN markup m ON m.region = r.region""")
cte("catalog_regions", ["catalog_flat"], """
SELECT DISTINCT unnest(string_split(regions_csv, ',')) AS region FROM catalog_flat WHERE regions_csv IS NOT NULL""")
cte("seed_all", ["seed", "markup", "catalog_regions"], """
SELECT s.node_type_id, s.node_type_id AS gcp_machine_type, CAST(s.vcpus AS INTEGER) AS vcpus,
  CAST(s.memory_gb AS DOUBLE) AS memory_gb,
  CAST(ROUND(CAST(s.base_price AS DOUBLE) * COALESCE(m.markup, 1.0), 6) AS DECIMAL(10,6)) AS hourly_price_usd,
  r.region,
  CASE WHEN COALESCE(m.markup, 1.0) = 1.0 THEN 'GCP list price (seeded, ' || r.region || ')'
    ELSE 'GCP list price (seeded us-central1, ~' || m.markup_txt || 'x markup for ' || r.region || ')' END AS price_source
FROM catalog_regions r CROSS JOIN seed s LEFT JOIN markup m ON m.region = r.region""")
cte("catalog_extract", ["catalog_flat"], f"""
SELECT string_split(name, '/')[-1] AS node_type_id, lower(COALESCE(description, '')) AS gcp_machine_type,
  0 AS vcpus, CAST(0.0 AS DOUBLE) AS memory_gb,
  CAST(CAST(units AS BIGINT) + nanos / 1e9 AS DECIMAL(10,6)) AS hourly_price_usd,
  '{REGION}' AS region, 'GCP Cloud Billing Catalog API ({REGION})' AS price_source
FROM catalog_flat
WHERE resource_family = 'Compute' AND usage_type = 'OnDemand'
  AND COALESCE(list_contains(string_split(regions_csv, ','), '{REGION}'), false) AND has_tier
  AND CAST(units AS BIGINT) + nanos / 1e9 > 0""")
cte("estimates", ["node_types", "seed_uc1"], f"""
SELECT DISTINCT nt.node_type AS node_type_id, nt.node_type AS gcp_machine_type,
  CAST(nt.core_count AS INTEGER) AS vcpus,
  CAST(ROUND(CAST(nt.memory_mb AS DECIMAL(38,10)) * 0.0009765625, 1) AS DOUBLE) AS memory_gb,
  CAST(ROUND(nt.core_count * CAST(0.04749 AS DOUBLE)
    + CAST(CAST(nt.memory_mb AS DECIMAL(38,10)) * 0.0009765625 * 0.006383 AS DOUBLE), 6) AS DECIMAL(10,6))
    AS hourly_price_usd,
  '{REGION}' AS region, 'Estimated from GCP N1 component pricing' AS price_source
FROM node_types nt
WHERE nt.node_type NOT IN (SELECT node_type_id FROM seed_uc1 WHERE region = '{REGION}')""")
cte("vm_prices", ["seed_uc1", "estimates"], "SELECT * FROM seed_uc1 UNION ALL SELECT * FROM estimates")

# ---- VM cost: hours and costs as scaled integers, Spark's 6-place products reproduced
_SECS = "date_sub('second', {a}, {b})"
cte("cu", ["priced"], f"""
SELECT usage_date, cluster_id, sku_name, SUM(usage_quantity) AS total_dbus,
  SUM({hu(_SECS.format(a='usage_start_time', b='usage_end_time') + ' * 1000000', '3600')}) AS bh6,
  SUM(usage_quantity * unit_price) AS dbu_exact
FROM priced WHERE cluster_id IS NOT NULL GROUP BY usage_date, cluster_id, sku_name""")
_H6 = hu(_SECS.format(a="start_time", b="end_time") + " * 1000000", "3600")
cte("nh", ["node_timeline"], f"""
SELECT CAST(start_time AS DATE) AS usage_date, cluster_id,
  SUM(CASE WHEN driver THEN {_H6} ELSE 0 END) AS dh6,
  SUM(CASE WHEN NOT driver THEN {_H6} ELSE 0 END) AS wh6,
  MAX(CASE WHEN driver THEN node_type END) AS nt_driver_type,
  MAX(CASE WHEN NOT driver THEN node_type END) AS nt_worker_type
FROM node_timeline GROUP BY CAST(start_time AS DATE), cluster_id""")
cte("cfg", ["clusters"], """
SELECT cluster_id, cluster_name, cc_driver_type, cc_worker_type, cc_num_workers FROM (
  SELECT cluster_id, cluster_name, driver_node_type AS cc_driver_type, worker_node_type AS cc_worker_type,
    COALESCE(worker_count, max_autoscale_workers, 1) AS cc_num_workers,
    ROW_NUMBER() OVER (PARTITION BY cluster_id ORDER BY change_time DESC NULLS LAST, cluster_name DESC NULLS LAST,
      driver_node_type DESC NULLS LAST, worker_node_type DESC NULLS LAST, worker_count DESC NULLS LAST,
      max_autoscale_workers DESC NULLS LAST) AS rn
  FROM clusters) WHERE rn = 1""")
cte("vm_j", ["cu", "nh", "cfg", "vm_prices"], f"""
SELECT cu.*, nh.dh6, nh.wh6, cfg.cluster_name, cfg.cc_driver_type, cfg.cc_num_workers,
  COALESCE(nh.nt_driver_type, cfg.cc_driver_type) AS driver_node_type,
  COALESCE(nh.nt_worker_type, cfg.cc_worker_type) AS worker_node_type,
  COALESCE({I('dvm.hourly_price_usd', 6)}, 0) AS dp6, COALESCE({I('wvm.hourly_price_usd', 6)}, 0) AS wp6,
  dvm.gcp_machine_type AS driver_vm_type, wvm.gcp_machine_type AS worker_vm_type,
  {BUNDLED} AS bundled
FROM cu
LEFT JOIN nh ON cu.usage_date = nh.usage_date AND cu.cluster_id = nh.cluster_id
LEFT JOIN cfg ON cu.cluster_id = cfg.cluster_id
LEFT JOIN vm_prices dvm ON COALESCE(nh.nt_driver_type, cfg.cc_driver_type) = dvm.node_type_id AND dvm.region = '{REGION}'
LEFT JOIN vm_prices wvm ON COALESCE(nh.nt_worker_type, cfg.cc_worker_type) = wvm.node_type_id AND wvm.region = '{REGION}'""")
cte("vm_c", ["vm_j"], f"""
SELECT *, CASE WHEN bundled THEN 0
    WHEN dh6 IS NOT NULL THEN {hu('dh6 * dp6', '1000000')} + {hu('wh6 * wp6', '1000000')}
    WHEN cc_driver_type IS NOT NULL THEN {hu('bh6 * (dp6 + COALESCE(cc_num_workers, 1) * wp6)', '1000000')}
    ELSE 0 END AS vm6
FROM vm_j""")
cte("vm", ["vm_c"], f"""
SELECT usage_date, cluster_id, cluster_name, sku_name, driver_node_type, worker_node_type,
  CAST(COALESCE(cc_num_workers, 1) AS BIGINT) AS num_workers,
  CAST({D(hu('COALESCE(dh6 + wh6, bh6)', '100'), 4)} AS DECIMAL(20,4)) AS cluster_uptime_hours,
  CAST(ROUND(dbu_exact, 6) AS DECIMAL(38,6)) AS dbu_cost_usd,
  {D('vm6', 6)} AS estimated_vm_cost_usd,
  CAST(ROUND(dbu_exact, 6) AS DECIMAL(38,6)) + {D('vm6', 6)} AS total_estimated_cost,
  driver_vm_type, worker_vm_type,
  CASE WHEN bundled THEN 'BUNDLED_IN_DBU' WHEN dh6 IS NOT NULL THEN 'node_timeline'
    WHEN cc_driver_type IS NOT NULL THEN 'cluster_config' ELSE 'unknown' END AS vm_cost_source
FROM vm_c""")

# ---- alerts
cte("active", ["alert_config"], """
SELECT * FROM alert_config WHERE is_active = true ORDER BY config_id LIMIT 1""")
cte("today", ["summary", "active"], f"""
SELECT a.*, {AS_OF} AS usage_date, c.today_cost,
  CASE WHEN CAST(a.daily_threshold_dollars AS DOUBLE) > 0
    THEN CAST(c.today_cost AS DOUBLE) / CAST(a.daily_threshold_dollars AS DOUBLE) * 100 ELSE 0.0 END AS pct_consumed
FROM active a CROSS JOIN (SELECT COALESCE(SUM(total_cost_usd), 0) AS today_cost FROM summary WHERE usage_date = {AS_OF}) c""")
cte("tiers_of_today", ["today"], """
SELECT t.*, CAST(trim(x.tier) AS INTEGER) AS threshold_pct
FROM today t, unnest(string_split(t.threshold_percentages, ',')) AS x(tier)""")
cte("crossed", ["tiers_of_today"], """
SELECT *, CAST(daily_threshold_dollars AS DOUBLE) * (threshold_pct / 100.0) AS threshold_amount
FROM tiers_of_today
WHERE CAST(daily_threshold_dollars AS DOUBLE) > 0
  AND CAST(today_cost AS DOUBLE) >= CAST(daily_threshold_dollars AS DOUBLE) * (threshold_pct / 100.0)""")
_SEV = "CASE WHEN threshold_pct >= 100 THEN 'CRITICAL' WHEN threshold_pct >= 90 THEN 'HIGH' ELSE 'WARNING' END"
cte("new_alerts", ["crossed", "alert_history"], f"""
SELECT usage_date AS alert_date, threshold_pct, CAST(today_cost AS DECIMAL(20,2)) AS amount_at_alert,
  CAST(threshold_amount AS DECIMAL(20,2)) AS threshold_amount,
  CAST(daily_threshold_dollars AS DECIMAL(20,2)) AS daily_threshold, recipient_emails AS recipients,
  {_SEV} AS severity,
  '[' || {_SEV} || '] GCP cost alert: ' || CAST(threshold_pct AS VARCHAR) || '% of daily threshold reached ($'
    || CAST(CAST(today_cost AS DECIMAL(20,2)) AS VARCHAR) || ' / $'
    || CAST(CAST(daily_threshold_dollars AS DECIMAL(20,2)) AS VARCHAR) || ')' AS subject
FROM crossed c
WHERE NOT EXISTS (SELECT 1 FROM alert_history h WHERE h.status = 'SENT' AND h.alert_date = c.usage_date
  AND h.threshold_pct = c.threshold_pct)""")
cte("history_after", ["alert_history", "new_alerts"], f"""
SELECT * FROM alert_history
UNION ALL
SELECT (SELECT COALESCE(MAX(alert_id), 0) FROM alert_history)
    + ROW_NUMBER() OVER (ORDER BY alert_date, threshold_pct) AS alert_id,
  alert_date, threshold_pct, amount_at_alert, threshold_amount, daily_threshold, recipients,
  {SENT_AT} AS sent_at, 'SENT' AS status
FROM new_alerts""")

# ---- month summary for reports
cte("month_picker", ["summary"], f"""
SELECT DISTINCT strftime(usage_date, '%b %Y') AS month_label, CAST(date_trunc('month', usage_date) AS DATE) AS month_start
FROM summary WHERE usage_date >= {AS_OF} - INTERVAL 365 DAY AND usage_date <= {AS_OF}""")


def _with(names: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][0]})" for n in order) + "\n"


def q(deps: list[str], body: str) -> str:
    return _with(deps) + body


IN_MONTH = f"usage_date >= {MONTH_START} AND usage_date < {MONTH_END}"

ORACLE: dict[str, str] = {
    "usage_window": q(["usage"], f"SELECT * FROM usage WHERE cloud = 'GCP' AND usage_date >= {WINDOW90} AND usage_date <= {AS_OF}"),
    "priced_usage": q(["priced"], "SELECT * FROM priced"),
    "daily_cost_summary": q(["summary"], "SELECT * FROM summary"),
    "upsert_daily_cost": _with(["usage", "list_prices"])[:-1] + f""",
early_prices AS (SELECT * FROM list_prices WHERE price_start_time < TIMESTAMP '2000-06-10 12:00:00'),
old AS ({summary_sql('(' + priced_sql('early_prices') + ')')}),
batch AS ({summary_sql('(' + priced_sql('list_prices', WINDOW90) + ')')})
SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.usage_date = o.usage_date
  AND b.sku_name = o.sku_name AND b.workspace_id = o.workspace_id
  AND b.billing_origin_product = o.billing_origin_product AND b.is_serverless = o.is_serverless)
UNION ALL SELECT * FROM batch""",
    "sku_daily_details": q(["details"], "SELECT * FROM details"),
    "load_stats": q(["summary", "details"], """
SELECT 'daily_cost_summary' AS table_name, COUNT(*) AS "rows", MIN(usage_date) AS min_date, MAX(usage_date) AS max_date,
  CAST(SUM(total_cost_usd) AS DECIMAL(38,6)) AS total_cost FROM summary
UNION ALL
SELECT 'sku_daily_details', COUNT(*), MIN(usage_date), MAX(usage_date), CAST(SUM(total_cost_usd) AS DECIMAL(38,6))
FROM details"""),
    "catalog_price_extract": q(["catalog_extract"], "SELECT * FROM catalog_extract"),
    "seed_prices": q(["seed_all"], "SELECT * FROM seed_all"),
    "price_upsert": q(["seed_all", "catalog_extract"], """
SELECT * FROM seed_all s WHERE NOT EXISTS (SELECT 1 FROM catalog_extract c
  WHERE c.node_type_id = s.node_type_id AND c.region = s.region)
UNION ALL SELECT * FROM catalog_extract"""),
    "estimate_missing_prices": q(["estimates"], "SELECT * FROM estimates"),
    "price_source_counts": q(["vm_prices"], f"""
SELECT price_source, COUNT(*) AS cnt, price_source LIKE 'Estimated%' AS is_estimate
FROM vm_prices WHERE region = '{REGION}' GROUP BY price_source"""),
    "price_coverage": q(["vm_prices", "node_types"], f"""
SELECT CASE WHEN n.node_type IS NULL THEN 'price without node type' WHEN p.node_type_id IS NULL THEN 'no price'
    WHEN p.estimated THEN 'estimated price' ELSE 'listed price' END AS coverage, COUNT(*) AS node_types
FROM (SELECT DISTINCT node_type FROM node_types) n FULL OUTER JOIN
  (SELECT node_type_id, MIN(price_source LIKE 'Estimated%') AS estimated FROM vm_prices WHERE region = '{REGION}' GROUP BY 1) p
  ON n.node_type = p.node_type_id GROUP BY 1"""),
    "price_overlap_check": q(["usage", "list_prices"], """
SELECT u.sku_name, u.cloud, u.usage_start_time, COUNT(DISTINCT (p.price_start_time, p.price_end_time)) AS active_prices
FROM usage u JOIN (SELECT sku_name, cloud, price_end_time,
    CASE WHEN price_start_time >= TIMESTAMP '2000-06-10 12:00:00' THEN price_start_time - INTERVAL 1 DAY ELSE price_start_time END AS price_start_time
  FROM list_prices) p
  ON u.sku_name = p.sku_name AND u.cloud = p.cloud AND u.usage_start_time >= p.price_start_time
  AND (p.price_end_time IS NULL OR u.usage_start_time < p.price_end_time)
WHERE u.cloud = 'GCP' GROUP BY ALL HAVING COUNT(DISTINCT (p.price_start_time, p.price_end_time)) > 1"""),
    "cluster_usage": q(["cu"], f"""
SELECT usage_date, cluster_id, sku_name, total_dbus, {D('bh6', 6)} AS billing_hours, dbu_exact AS dbu_cost_usd FROM cu"""),
    "node_hours": q(["nh"], f"""
SELECT usage_date, cluster_id, {D('dh6', 6)} AS driver_hours, {D('wh6', 6)} AS worker_hours,
  nt_driver_type, nt_worker_type FROM nh"""),
    "latest_cluster_config": q(["cfg"], "SELECT * FROM cfg"),
    "cluster_config_as_of": q(["clusters", "cu"], """
SELECT days.usage_date, days.cluster_id, changes.cluster_name, changes.driver_node_type AS cc_driver_type,
  changes.worker_node_type AS cc_worker_type, COALESCE(changes.worker_count, changes.max_autoscale_workers, 1) AS cc_num_workers
FROM (SELECT DISTINCT usage_date, cluster_id FROM cu) days
ASOF JOIN (
  SELECT *, CAST(change_time AS DATE) AS day FROM clusters WHERE change_time IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY cluster_id, CAST(change_time AS DATE) ORDER BY change_time DESC, cluster_name DESC NULLS LAST,
    driver_node_type DESC NULLS LAST, worker_node_type DESC NULLS LAST, worker_count DESC NULLS LAST,
    max_autoscale_workers DESC NULLS LAST) = 1) changes
ON days.cluster_id = changes.cluster_id AND days.usage_date >= changes.day"""),
    "vm_cost_estimate": q(["vm"], "SELECT * FROM vm"),
    "trailing_clusters": q(["cu"], """
SELECT m.usage_month, COUNT(DISTINCT CASE WHEN date_trunc('month', u.usage_date) = m.usage_month THEN u.cluster_id END) AS clusters,
  COUNT(DISTINCT u.cluster_id) AS trailing_clusters
FROM (SELECT DISTINCT CAST(date_trunc('month', usage_date) AS DATE) AS usage_month FROM cu WHERE usage_date IS NOT NULL) m
JOIN cu u ON u.usage_date >= m.usage_month - INTERVAL 11 MONTH AND u.usage_date < m.usage_month + INTERVAL 1 MONTH
GROUP BY m.usage_month"""),
    "vm_cost_by_source": q(["vm"], """
SELECT vm_cost_source, COUNT(*) AS "rows", ROUND(SUM(dbu_cost_usd), 2) AS dbu_cost,
  ROUND(SUM(estimated_vm_cost_usd), 2) AS vm_cost FROM vm GROUP BY vm_cost_source"""),
    "schema_conform": q(["vm"], "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS vm_cost_source) FROM vm"),
    "alert_config_upsert": q(["alert_config"], f"""
SELECT COALESCE(t.config_id, s.config_id) AS config_id,
  CASE WHEN t.config_id IS NOT NULL AND s.config_id IS NOT NULL THEN s.daily_threshold_dollars
    WHEN t.config_id IS NOT NULL THEN t.daily_threshold_dollars ELSE s.daily_threshold_dollars END AS daily_threshold_dollars,
  CASE WHEN t.config_id IS NOT NULL AND s.config_id IS NOT NULL THEN s.recipient_emails
    WHEN t.config_id IS NOT NULL THEN t.recipient_emails ELSE s.recipient_emails END AS recipient_emails,
  CASE WHEN t.config_id IS NOT NULL AND s.config_id IS NOT NULL THEN true
    WHEN t.config_id IS NOT NULL THEN t.is_active ELSE s.is_active END AS is_active,
  CASE WHEN t.config_id IS NOT NULL AND s.config_id IS NOT NULL THEN s.threshold_percentages
    WHEN t.config_id IS NOT NULL THEN t.threshold_percentages ELSE s.threshold_percentages END AS threshold_percentages,
  CASE WHEN t.config_id IS NOT NULL THEN t.created_at ELSE s.created_at END AS created_at,
  CASE WHEN t.config_id IS NOT NULL AND s.config_id IS NOT NULL THEN {LOADED_AT}
    WHEN t.config_id IS NOT NULL THEN t.updated_at ELSE s.updated_at END AS updated_at
FROM alert_config t FULL OUTER JOIN (
  SELECT 1 AS config_id, CAST(1000 AS DECIMAL(20,2)) AS daily_threshold_dollars,
    'ops@example.com,finance@example.com' AS recipient_emails, true AS is_active,
    '25,50,75,90,100' AS threshold_percentages, {LOADED_AT} AS created_at, {LOADED_AT} AS updated_at) s
ON t.config_id = s.config_id"""),
    "alert_config_update": q(["alert_config"], f"""
SELECT config_id,
  CASE WHEN config_id = 1 THEN CAST(0.01 AS DECIMAL(20,2)) ELSE daily_threshold_dollars END AS daily_threshold_dollars,
  recipient_emails, is_active, threshold_percentages, created_at,
  CASE WHEN config_id = 1 THEN {LOADED_AT} ELSE updated_at END AS updated_at
FROM alert_config"""),
    "active_alert_config": q(["active"], "SELECT * FROM active"),
    "alert_tiers": q(["alert_config"], """
SELECT config_id, CAST(trim(x.tier) AS INTEGER) AS threshold_pct
FROM alert_config, unnest(string_split(threshold_percentages, ',')) AS x(tier)"""),
    "today_cost": q(["today"], "SELECT config_id, usage_date, today_cost, daily_threshold_dollars, pct_consumed FROM today"),
    "crossed_tiers": q(["crossed"], "SELECT config_id, usage_date, threshold_pct, threshold_amount, today_cost FROM crossed"),
    "new_alerts": q(["new_alerts"], "SELECT * FROM new_alerts"),
    "alert_history_append": q(["history_after"], "SELECT * FROM history_after"),
    "alert_gate": q(["new_alerts", "today", "alert_history"], f"""
SELECT ROUND(CAST(t.today_cost AS DOUBLE), 2) AS today_cost, ROUND(CAST(t.daily_threshold_dollars AS DOUBLE), 2) AS daily_threshold,
  n.alerts_sent, n.max_pct,
  n.alerts_sent + (SELECT COUNT(*) FROM alert_history WHERE alert_date = {AS_OF} AND status = 'SENT') AS total_sent_today
FROM today t CROSS JOIN (SELECT COUNT(*) AS alerts_sent, COALESCE(MAX(threshold_pct), 0) AS max_pct FROM new_alerts) n"""),
    "recent_alerts": q(["history_after"], f"""
SELECT alert_id, alert_date, threshold_pct, amount_at_alert, threshold_amount, daily_threshold, recipients,
  {ist('sent_at')} AS sent_at_ist, status
FROM history_after ORDER BY sent_at DESC NULLS LAST, alert_id DESC NULLS LAST LIMIT 5"""),
    "month_picker": q(["month_picker"], "SELECT * FROM month_picker"),
    "month_bounds": q(["month_picker"], f"""
SELECT month_label, ms AS month_start, CAST(ms + INTERVAL 1 MONTH AS DATE) AS month_end,
  CAST(ms - INTERVAL 1 MONTH AS DATE) AS prev_month_start
FROM (SELECT month_label, COALESCE(CAST(try_strptime(month_label, '%b %Y') AS DATE), DATE '2000-06-01') AS ms
  FROM (SELECT month_label FROM month_picker UNION ALL SELECT 'junk' UNION ALL SELECT NULL UNION ALL SELECT 'Feb 2000'))"""),
    "cost_counters": q(["summary"], f"""
SELECT ROUND(month_total, 2) AS month_total,
  CASE WHEN days_with_usage <> 0 THEN {D(hu(hu(I('month_total', 6), 'days_with_usage'), '10000'), 2)} END AS avg_daily,
  ROUND(peak_day_cost, 2) AS peak_day,
  CASE WHEN prev_total <> 0 THEN {D(hu(hu('(' + I('month_total', 6) + ' - ' + I('prev_total', 6) + ') * 1000000', I('prev_total', 6)) + ' * 100', '100000'), 1)} END AS pct_vs_prev_month
FROM (SELECT SUM(daily_cost) AS month_total, COUNT(DISTINCT usage_date) AS days_with_usage, MAX(daily_cost) AS peak_day_cost
      FROM (SELECT usage_date, SUM(total_cost_usd) AS daily_cost FROM summary WHERE {IN_MONTH} GROUP BY usage_date)) agg
CROSS JOIN (SELECT SUM(total_cost_usd) AS prev_total FROM summary
      WHERE usage_date >= {PREV_START} AND usage_date < {MONTH_START}) prev"""),
    "daily_cost_trend": q(["summary"], f"""
SELECT usage_date, billing_origin_product, SUM(total_cost_usd) AS daily_cost, SUM(total_dbus) AS daily_dbus
FROM summary WHERE {IN_MONTH} GROUP BY usage_date, billing_origin_product"""),
    "top_skus": q(["summary"], f"""
SELECT sku_name, billing_origin_product, SUM(total_cost_usd) AS total_cost, SUM(total_dbus) AS total_dbus
FROM summary WHERE {IN_MONTH} GROUP BY sku_name, billing_origin_product
ORDER BY total_cost DESC NULLS LAST, sku_name ASC NULLS FIRST, billing_origin_product ASC NULLS FIRST LIMIT 20"""),
    "sku_details_month": q(["details"], f"""
SELECT usage_date, sku_name, billing_origin_product, product_category, is_serverless, total_dbus, total_cost_usd,
  cost_7d_avg, cost_30d_avg, cost_pct_change_7d FROM details WHERE {IN_MONTH}"""),
    "sku_details_filtered": q(["details"], f"""
SELECT usage_date, sku_name, billing_origin_product, product_category, is_serverless, total_dbus, total_cost_usd,
  cost_7d_avg, cost_30d_avg, cost_pct_change_7d FROM details WHERE {IN_MONTH}
  AND sku_name IN ('PREMIUM_JOBS_COMPUTE', 'PREMIUM_SQL_PRO_COMPUTE', 'PREMIUM_JOBS_COMPUTE_(PHOTON)')
  AND product_category IN ('Compute', 'SQL Warehouse')"""),
    "vm_estimates_month": q(["vm"], f"""
SELECT usage_date, cluster_id, cluster_name, sku_name, driver_node_type, worker_node_type, num_workers,
  ROUND(cluster_uptime_hours, 2) AS cluster_uptime_hours, ROUND(dbu_cost_usd, 2) AS dbu_cost_usd,
  ROUND(estimated_vm_cost_usd, 2) AS estimated_vm_cost_usd, ROUND(total_estimated_cost, 2) AS total_estimated_cost,
  driver_vm_type, worker_vm_type
FROM vm WHERE {IN_MONTH}"""),
    "vm_cost_counters": q(["vm"], f"""
SELECT ROUND(SUM(estimated_vm_cost_usd), 2) AS month_vm_cost, ROUND(SUM(dbu_cost_usd), 2) AS month_dbu_cost,
  ROUND(SUM(total_estimated_cost), 2) AS month_total_cost,
  CASE WHEN COUNT(DISTINCT usage_date) <> 0
    THEN {D(hu(hu(I('SUM(estimated_vm_cost_usd)', 6), 'COUNT(DISTINCT usage_date)'), '10000'), 2)} END AS avg_daily_vm_cost
FROM vm WHERE {IN_MONTH}"""),
    "vm_daily_trend": q(["vm"], f"""
SELECT usage_date, ROUND(SUM(dbu_cost_usd), 2) AS dbu_cost, ROUND(SUM(estimated_vm_cost_usd), 2) AS vm_cost,
  ROUND(SUM(total_estimated_cost), 2) AS total_cost
FROM vm WHERE {IN_MONTH} GROUP BY usage_date"""),
    "vm_by_node_type": q(["vm"], f"""
SELECT node_type, ROUND(SUM(estimated_vm_cost_usd), 2) AS total_vm_cost FROM (
  SELECT worker_node_type AS node_type, estimated_vm_cost_usd FROM vm WHERE {IN_MONTH} AND worker_node_type IS NOT NULL
  UNION ALL
  SELECT driver_node_type AS node_type, estimated_vm_cost_usd FROM vm WHERE {IN_MONTH} AND driver_node_type IS NOT NULL)
GROUP BY node_type ORDER BY total_vm_cost DESC NULLS LAST, node_type LIMIT 20"""),
    "vm_reference_prices": q(["vm_prices"], f"""
SELECT node_type_id, gcp_machine_type, vcpus, memory_gb, ROUND(hourly_price_usd, 6) AS hourly_price_usd, region,
  price_source, {ist(LOADED_AT)} AS last_updated_ist FROM vm_prices"""),
    "alert_config_view": q(["alert_config"], f"""
SELECT config_id, daily_threshold_dollars, recipient_emails, is_active, threshold_percentages,
  {ist('updated_at')} AS updated_at_ist FROM alert_config"""),
    "alert_history_month": q(["history_after"], f"""
SELECT alert_date, threshold_pct, ROUND(amount_at_alert, 2) AS amount_at_alert, ROUND(threshold_amount, 2) AS threshold_amount,
  ROUND(daily_threshold, 2) AS daily_threshold, recipients, {ist('sent_at')} AS sent_at_ist, status
FROM history_after WHERE alert_date >= {MONTH_START} AND alert_date < {MONTH_END}
ORDER BY sent_at DESC NULLS LAST, alert_id DESC NULLS LAST LIMIT 100"""),
    "threshold_gauge": q(["summary", "alert_config"], f"""
SELECT ROUND(month_spend, 2) AS month_spend, ROUND(threshold, 2) AS daily_threshold,
  CASE WHEN days_in_month <> 0 AND threshold <> 0 THEN
    {D(hu(hu(hu(I('month_spend', 6), 'days_in_month') + ' * 100', I('threshold', 2)) + ' * 100', '100000'), 1)} END
    AS pct_avg_vs_threshold
FROM (SELECT COALESCE(SUM(total_cost_usd), 0) AS month_spend, COUNT(DISTINCT usage_date) AS days_in_month
      FROM summary WHERE {IN_MONTH}) spend
CROSS JOIN (SELECT daily_threshold_dollars AS threshold FROM alert_config WHERE is_active = true
      ORDER BY config_id LIMIT 1) cfg1"""),
}

# DECIMAL result columns of each statement (fixed by the SQL text, listed from DuckDB's
# DESCRIBE); they are cast to DOUBLE like the Spark side's boundary cast.
DECIMAL_COLUMNS: dict[str, list[str]] = {
    'active_alert_config': ['daily_threshold_dollars'],
    'alert_config_update': ['daily_threshold_dollars'],
    'alert_config_upsert': ['daily_threshold_dollars'],
    'alert_config_view': ['daily_threshold_dollars'],
    'alert_history_append': ['amount_at_alert', 'threshold_amount', 'daily_threshold'],
    'alert_history_month': ['amount_at_alert', 'threshold_amount', 'daily_threshold'],
    'catalog_price_extract': ['hourly_price_usd'],
    'cluster_usage': ['total_dbus', 'billing_hours', 'dbu_cost_usd'],
    'cost_counters': ['month_total', 'avg_daily', 'peak_day', 'pct_vs_prev_month'],
    'crossed_tiers': ['today_cost'],
    'daily_cost_summary': ['total_dbus', 'list_price_per_dbu', 'total_cost_usd'],
    'daily_cost_trend': ['daily_cost', 'daily_dbus'],
    'estimate_missing_prices': ['hourly_price_usd'],
    'load_stats': ['total_cost'],
    'new_alerts': ['amount_at_alert', 'threshold_amount', 'daily_threshold'],
    'node_hours': ['driver_hours', 'worker_hours'],
    'price_upsert': ['hourly_price_usd'],
    'priced_usage': ['usage_quantity', 'unit_price', 'exact_cost'],
    'recent_alerts': ['amount_at_alert', 'threshold_amount', 'daily_threshold'],
    'schema_conform': ['cluster_uptime_hours', 'dbu_cost_usd', 'estimated_vm_cost_usd', 'total_estimated_cost'],
    'seed_prices': ['hourly_price_usd'],
    'sku_daily_details': ['total_dbus', 'total_cost_usd', 'cost_7d_avg', 'cost_30d_avg', 'cost_pct_change_7d'],
    'sku_details_filtered': ['total_dbus', 'total_cost_usd', 'cost_7d_avg', 'cost_30d_avg', 'cost_pct_change_7d'],
    'sku_details_month': ['total_dbus', 'total_cost_usd', 'cost_7d_avg', 'cost_30d_avg', 'cost_pct_change_7d'],
    'threshold_gauge': ['month_spend', 'daily_threshold', 'pct_avg_vs_threshold'],
    'today_cost': ['today_cost', 'daily_threshold_dollars'],
    'top_skus': ['total_cost', 'total_dbus'],
    'upsert_daily_cost': ['total_dbus', 'list_price_per_dbu', 'total_cost_usd'],
    'usage_window': ['usage_quantity'],
    'vm_by_node_type': ['total_vm_cost'],
    'vm_cost_by_source': ['dbu_cost', 'vm_cost'],
    'vm_cost_counters': ['month_vm_cost', 'month_dbu_cost', 'month_total_cost', 'avg_daily_vm_cost'],
    'vm_cost_estimate': ['cluster_uptime_hours', 'dbu_cost_usd', 'estimated_vm_cost_usd', 'total_estimated_cost'],
    'vm_daily_trend': ['dbu_cost', 'vm_cost', 'total_cost'],
    'vm_estimates_month': ['cluster_uptime_hours', 'dbu_cost_usd', 'estimated_vm_cost_usd', 'total_estimated_cost'],
    'vm_reference_prices': ['hourly_price_usd'],
}


def _as_double(sql: str, cols: list[str]) -> str:
    if not cols:
        return sql
    casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS boundary"


ORACLE = {k: _as_double(v, DECIMAL_COLUMNS.get(k, [])) for k, v in ORACLE.items()}
