"""Billing source tables derived from the TPC-H-style test data.

The test data has no billing tables, so each source is a deterministic projection of a
base table (see FIXTURES.md for the same rules as SQL).  Every view is a lazy DataFrame
over the parquet files: it scales with the base table and keeps scan pushdown.

    usage          <- lineitem     (one usage record per line item)
    list_prices    <- distinct (sku, cloud) of usage x 4 price generations
    node_timeline  <- orders       (one node interval per order)
    clusters       <- customer     (one config change per customer)
    node_types     <- part         (distinct sizes)
    catalog pages  <- part         (one catalogue SKU per part)
    alert_config   <- customer     (one config row per customer)
    alert_history  <- orders       (one logged alert per order)
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.sources.catalog import pages_from_flat
from ledger.sources.schemas import CLUSTERS, LIST_PRICES, NODE_TIMELINE, NODE_TYPES, USAGE, conform


def _ntz(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _ltz(s: str) -> Column:
    return F.lit(s).cast("timestamp")


def _case(col: Column, mapping: list[tuple], default=None) -> Column:
    out = None
    for k, v in mapping:
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out.otherwise(default) if default is not None else out


def _dec(x: str) -> Column:
    from decimal import Decimal

    return F.lit(Decimal(x))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    ln, sk = F.col("l_linenumber"), F.col("l_suppkey")
    start = F.timestamp_add("HOUR", F.col("l_orderkey") % 24, F.col("l_shipdate"))
    sku = _case(
        ln,
        [
            (1, "PREMIUM_JOBS_COMPUTE"),
            (2, "PREMIUM_JOBS_COMPUTE_(PHOTON)"),
            (3, "PREMIUM_ALL_PURPOSE_COMPUTE"),
            (4, "PREMIUM_SQL_PRO_COMPUTE"),
            (5, "PREMIUM_SERVERLESS_SQL_COMPUTE"),
            (6, "PREMIUM_DLT_CORE_COMPUTE"),
        ],
        F.lit("PREMIUM_SERVERLESS_REAL_TIME_INFERENCE"),
    )
    product = (
        F.when(sk % 10 == 0, "VECTOR_SEARCH")
        .when(sk % 10 == 1, "INTERACTIVE")
        .when(sk % 10 == 2, "STORAGE")
        .when(ln <= 2, "JOBS")
        .when(ln == 3, "ALL_PURPOSE_COMPUTE")
        .when(ln <= 5, "SQL")
        .when(ln == 6, "DLT")
        .otherwise("MODEL_SERVING")
    )
    serverless = F.when(ln.isin(5, 7), F.lit(True)).when(F.col("l_linestatus") == "F", F.lit(False))
    cluster = F.when(ln != 5, F.concat(F.lit("c-"), (sk % 12).cast("string")))
    return li.select(
        F.to_date("l_shipdate").alias("usage_date"),
        start.alias("usage_start_time"),
        F.timestamp_add("MINUTE", F.col("l_quantity").cast("int"), start).alias("usage_end_time"),
        sku.alias("sku_name"),
        product.alias("billing_origin_product"),
        F.when(F.col("l_returnflag") == "R", "AWS").otherwise("GCP").alias("cloud"),
        (sk % 3).alias("workspace_id"),
        F.struct(serverless.alias("is_serverless")).alias("product_features"),
        F.struct(cluster.alias("cluster_id")).alias("usage_metadata"),
        F.col("l_quantity").cast("decimal(18,6)").alias("usage_quantity"),
    )


def list_prices(spark: SparkSession, sf_dir: str, usage_df: DataFrame | None = None) -> DataFrame:
    """Four SCD2 price generations per (sku, cloud); DLT SKUs have no price on purpose."""
    u = usage_df if usage_df is not None else usage(spark, sf_dir)
    skus = u.select("sku_name", "cloud").where(~F.col("sku_name").like("%DLT%")).distinct()
    g = F.col("gen")
    start = _case(
        g,
        [(1, _ntz("1990-01-01 00:00:00")), (2, _ntz("2000-04-20 12:00:00")), (3, _ntz("2000-05-10 12:00:00"))],
        _ntz("2000-06-10 12:00:00"),
    )
    end = _case(
        g,
        [(1, _ntz("2000-04-20 12:00:00")), (2, _ntz("2000-05-10 12:00:00")), (3, _ntz("2000-06-10 12:00:00"))],
    )
    default = (_dec("0.10") + _dec("0.01") * F.length("sku_name") + _dec("0.05") * g).cast("decimal(18,6)")
    effective = F.when(F.col("sku_name").like("%SQL%"), (_dec("0.07") * g + _dec("0.20")).cast("decimal(18,6)"))
    # four generations per (sku, cloud): a generator, no join
    gens = skus.select("*", F.explode(F.array(*[F.lit(i) for i in range(1, 5)])).alias("gen"))
    return gens.select(
        "sku_name",
        "cloud",
        start.alias("price_start_time"),
        end.alias("price_end_time"),
        F.struct(default.alias("default"), F.struct(effective.alias("default")).alias("effective_list")).alias(
            "pricing"
        ),
    )


def node_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = F.timestamp_add("HOUR", k % 24, F.col("o_orderdate"))
    node_type = _case(k % 4, [(0, "n2-standard-8"), (1, "n1-highmem-16"), (2, "e2-standard-4")], F.lit("n1-standard-7"))
    return o.select(
        F.concat(F.lit("c-"), (F.col("o_custkey") % 10).cast("string")).alias("cluster_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("driver"),
        node_type.alias("node_type"),
        start.alias("start_time"),
        F.when(k % 50 != 0, F.timestamp_add("SECOND", (k % 7 + 1) * 1000, start)).alias("end_time"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    return c.select(
        F.concat(F.lit("c-"), (key % 11).cast("string")).alias("cluster_id"),
        F.concat(F.lit("cluster-"), (key % 11).cast("string")).alias("cluster_name"),
        F.timestamp_add("HOUR", key, _ntz("1995-01-01 00:00:00")).alias("change_time"),
        _case(nat % 3, [(0, "n1-standard-4"), (1, "n2-highmem-8")], F.lit("n1-standard-9")).alias("driver_node_type"),
        _case(nat % 4, [(0, "n1-standard-16"), (1, "c2-standard-8"), (2, "e2-standard-8")]).alias("worker_node_type"),
        F.when(key % 3 != 0, nat % 5).cast("int").alias("worker_count"),
        F.when(key % 6 != 0, nat % 8 + 1).cast("int").alias("max_autoscale_workers"),
    )


def node_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("n1-standard-"), F.col("p_size").cast("string")).alias("node_type"),
        F.col("p_size").cast("double").alias("core_count"),
        (F.col("p_size") * 3840).cast("bigint").alias("memory_mb"),
    ).distinct()


def catalog_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("services/S/skus/SKU-"), key.cast("string")).alias("name"),
        F.when(F.col("p_size") % 5 == 0, "Storage").otherwise("Compute").alias("resource_family"),
        F.when(F.col("p_type") == "PROMO", "Preemptible")
        .when(F.col("p_type") == "SMALL", F.lit(None))
        .otherwise("OnDemand")
        .alias("usage_type"),
        _case(key % 4, [(0, "us-central1,us-east1"), (1, "us-central1"), (2, "asia-south1")]).alias("regions_csv"),
        F.col("p_name").alias("description"),
        (key % 3).cast("string").alias("units"),
        (key % 7 * 100000000).cast("bigint").alias("nanos"),
        (key % 11 != 0).alias("has_tier"),
    )


def catalog_pages(spark: SparkSession, sf_dir: str, page_size: int = 5000) -> DataFrame:
    """The catalogue in the shape of paged JSON responses (``skus`` array per page)."""
    return pages_from_flat(catalog_flat(spark, sf_dir), page_size)


def alert_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert configuration per customer; config 1 is the first active one."""
    c = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    tiers = _case(key % 4, [(1, "25,50,75,90,100"), (2, "50, 100"), (3, "90")], F.lit("100"))
    created = F.timestamp_add("MINUTE", key, _ltz("2000-01-01 00:00:00"))
    return c.select(
        key.cast("int").alias("config_id"),
        (F.lit(100) * (key % 5 + 2)).cast("decimal(20,2)").alias("daily_threshold_dollars"),
        F.when(key % 2 == 1, F.concat(F.lower("c_mktsegment"), F.lit("@example.com,finance@example.com")))
        .otherwise(F.concat(F.lower("c_mktsegment"), F.lit("@example.com")))
        .alias("recipient_emails"),
        (key % 3 != 0).alias("is_active"),
        tiers.alias("threshold_percentages"),
        created.alias("created_at"),
        F.timestamp_add("DAY", F.col("c_nationkey"), created).alias("updated_at"),
    )


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One previously logged alert per order (FAILED for status 'F')."""
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    pct = _case(k % 5, [(0, 25), (1, 50), (2, 75), (3, 90)], F.lit(100))
    return o.select(
        k.alias("alert_id"),
        F.to_date("o_orderdate").alias("alert_date"),
        pct.cast("int").alias("threshold_pct"),
        (F.floor("o_totalprice").cast("bigint") % 1000).cast("decimal(20,2)").alias("amount_at_alert"),
        (pct * 3).cast("decimal(20,2)").alias("threshold_amount"),
        F.lit(300).cast("decimal(20,2)").alias("daily_threshold"),
        F.lit("ops@example.com").alias("recipients"),
        F.timestamp_add("HOUR", k % 24, F.col("o_orderdate")).cast("timestamp").alias("sent_at"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SENT").alias("status"),
    )


def wrap_usage_flat(flat: DataFrame) -> DataFrame:
    """Nest flattened micro-fixture rows (is_serverless, cluster_id) into the source structs."""
    rest = [c for c in flat.columns if c not in ("is_serverless", "cluster_id")]
    return flat.select(
        *rest,
        F.struct(F.col("is_serverless").cast("boolean").alias("is_serverless")).alias("product_features"),
        F.struct(F.col("cluster_id").cast("string").alias("cluster_id")).alias("usage_metadata"),
    )


def wrap_prices_flat(flat: DataFrame) -> DataFrame:
    """Nest flattened price rows (price_default, price_effective) into the ``pricing`` struct."""
    rest = [c for c in flat.columns if c not in ("price_default", "price_effective")]
    return flat.select(
        *rest,
        F.struct(
            F.col("price_default").cast("decimal(18,6)").alias("default"),
            F.struct(F.col("price_effective").cast("decimal(18,6)").alias("default")).alias("effective_list"),
        ).alias("pricing"),
    )


@dataclass
class Sources:
    """All billing sources of one run (lazy frames)."""

    usage: DataFrame
    list_prices: DataFrame
    node_timeline: DataFrame
    clusters: DataFrame
    node_types: DataFrame
    catalog_pages: DataFrame
    alert_config: DataFrame
    alert_history: DataFrame

    def conformed(self) -> Sources:
        """The five read-only sources in their declared types (sums are exact on decimals,
        day bounds compare wall-clock times)."""
        return replace(
            self, usage=conform(self.usage, USAGE), list_prices=conform(self.list_prices, LIST_PRICES),
            node_timeline=conform(self.node_timeline, NODE_TIMELINE), clusters=conform(self.clusters, CLUSTERS),
            node_types=conform(self.node_types, NODE_TYPES))


def load(spark: SparkSession, sf_dir: str) -> Sources:
    u = usage(spark, sf_dir)
    return Sources(
        usage=u,
        list_prices=list_prices(spark, sf_dir, u),
        node_timeline=node_timeline(spark, sf_dir),
        clusters=clusters(spark, sf_dir),
        node_types=node_types(spark, sf_dir),
        catalog_pages=catalog_pages(spark, sf_dir),
        alert_config=alert_config(spark, sf_dir),
        alert_history=alert_history(spark, sf_dir),
    )
