"""Invariants of the survey's test plan (§5.3), checked on derived test data and random frames."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL
from ledger.operators.upsert import upsert
from ledger.params import RunParams
from ledger.plans import alerts, pricing, vm
from ledger.registry import Chain

P = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=None)


def test_exact_cost_is_split_between_clustered_and_unclustered(spark):
    c = Chain(spark, SMALL)
    total = c.priced.agg(F.sum("exact_cost")).first()[0]
    clustered = vm.cluster_usage(c.priced).agg(F.sum("dbu_cost_usd")).first()[0]
    unclustered = c.priced.where(F.col("cluster_id").isNull()).agg(F.sum("exact_cost")).first()[0]
    assert total == clustered + unclustered


def test_summary_cost_at_least_exact_cost_without_overlaps(spark):
    c = Chain(spark, SMALL)
    assert pricing.price_overlap_check(c.src.usage, c.src.list_prices, P).count() == 0
    keys = ["usage_date", "sku_name", "billing_origin_product", "cloud", "workspace_id", "is_serverless"]
    exact = c.priced.groupBy(
        "usage_date", "sku_name", "billing_origin_product", "cloud",
        F.col("workspace_id").cast("string").alias("workspace_id"),
        F.coalesce("is_serverless", F.lit(False)).alias("is_serverless"),
    ).agg(F.sum("exact_cost").alias("exact"))
    j = c.summary.join(exact, keys)
    assert j.count() == c.summary.count()
    assert j.where(F.col("total_cost_usd") < F.col("exact")).count() == 0


def test_every_vm_row_has_one_lineage_and_bundled_rows_cost_nothing(spark):
    c = Chain(spark, SMALL)
    v = c.vm
    allowed = ["BUNDLED_IN_DBU", "node_timeline", "cluster_config", "unknown"]
    assert v.where(~F.col("vm_cost_source").isin(allowed) | F.col("vm_cost_source").isNull()).count() == 0
    assert v.where((F.col("vm_cost_source") == "BUNDLED_IN_DBU") & (F.col("estimated_vm_cost_usd") != 0)).count() == 0


def test_new_alerts_never_repeat_a_sent_tier(spark):
    c = Chain(spark, "/root/testdata/sf0.01")
    sent = c.src.alert_history.where(F.col("status") == "SENT").select("alert_date", "threshold_pct")
    assert c.new_alerts.join(sent, ["alert_date", "threshold_pct"]).count() == 0


def test_crossed_tiers_are_monotone_in_cost(spark):
    from decimal import Decimal

    cfg = spark.createDataFrame([(1, Decimal("100"), "x", True, "10,30,50,70,90,100", None, None)],
                                "config_id int, daily_threshold_dollars decimal(20,2), recipient_emails string, "
                                "is_active boolean, threshold_percentages string, created_at timestamp, updated_at timestamp")
    prev = set()
    for amount in [0, 15, 45, 45, 95, 120]:
        s = spark.createDataFrame([(P.as_of, Decimal(amount))], "usage_date date, total_cost_usd decimal(38,6)")
        tiers = {r.threshold_pct for r in alerts.crossed_tiers(alerts.today_cost(s, P.as_of, cfg)).collect()}
        assert prev <= tiers
        prev = tiers


rows = st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xy"), st.integers(0, 9)), max_size=6)


@settings(max_examples=8, deadline=None)
@given(target=rows, source=rows)
def test_upsert_twice_equals_once(spark, target, source):
    src = {(k, p): v for k, p, v in source}                       # unique source keys
    t = spark.createDataFrame(target, "k string, p string, v int")
    s = spark.createDataFrame([(k, p, v) for (k, p), v in src.items()], "k string, p string, v int")
    once = upsert(t, s, ["k", "p"])
    twice = upsert(once, s, ["k", "p"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    got = {(r.k, r.p): r.v for r in once.collect() if (r.k, r.p) in src}
    assert got == src
