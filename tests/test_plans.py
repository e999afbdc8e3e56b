"""Physical-plan checks: broadcast only where bounded, pushdown, pruning, no Cartesian product."""

import datetime as dt

from helpers import SMALL
from ledger.params import RunParams
from ledger.plans import cost, pricing, reports
from ledger.registry import QUERIES, Chain

P = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=None)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_join_broadcasts_the_price_list(spark):
    c = Chain(spark, SMALL)
    p = plan(c.priced)
    assert "BroadcastHashJoin" in p and "CartesianProduct" not in p


def test_vm_estimate_has_no_cartesian_product(spark):
    c = Chain(spark, SMALL)
    p = plan(c.vm)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_latest_config_uses_group_limit(spark):
    c = Chain(spark, SMALL)
    assert "WindowGroupLimit" in plan(c.latest_config)


def test_month_report_prunes_partitions(spark, tmp_path):
    c = Chain(spark, SMALL)
    from ledger.plans.jobs import with_month
    path = str(tmp_path / "summary")
    with_month(c.summary).write.partitionBy("usage_month").parquet(path)
    stored = spark.read.parquet(path)
    p = plan(reports.top_skus(stored, "Jun 2000", P.as_of))
    assert "PartitionFilters: [isnotnull(usage_month" in p and "2000-06-01" in p


def test_daily_steps_prune_stored_partitions(spark, tmp_path):
    from ledger.functions.expressions import on_date
    from ledger.plans import cost
    from ledger.plans.jobs import with_month

    c = Chain(spark, SMALL)
    path = str(tmp_path / "summary")
    with_month(c.summary).write.partitionBy("usage_month").parquet(path)
    stored = spark.read.parquet(path)
    p90 = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=90)
    assert "usage_month#" in plan(cost.sku_daily_details(stored, p90)).split("PartitionFilters: [")[1].split("]")[0]
    assert "usage_month" in plan(on_date(stored, "usage_date", P.as_of)).split("PartitionFilters: [")[1].split("]")[0]


def test_raw_volume_aggregations_combine_map_side(spark):
    # a hot key (a third of all rows) then crosses the shuffle once per map task
    c = Chain(spark, SMALL)
    for df in (c.summary, c.cluster_usage, c.node_hours):
        p = plan(df)
        assert "partial_sum" in p and p.index("partial_sum") > p.index("Exchange hashpartitioning")


def test_node_hours_hash_aggregates_raw_rows_first(spark):
    c = Chain(spark, SMALL)
    p = plan(c.node_hours)
    # the plan string lists operators top-down: the sort-based MAX sits above the hash stage
    assert "SortAggregate" in p and p.index("SortAggregate") < p.rindex("HashAggregate")
    assert "partial_sum" in p


def test_active_config_does_not_sort_the_config_table(spark):
    from ledger.plans.alerts import active_config

    c = Chain(spark, SMALL)
    p = plan(active_config(c.src.alert_config))
    assert "Sort" not in p and "Subquery" in p


def test_building_a_read_query_starts_no_job(spark):
    """Plans are chosen by the planner's sizes, not by counting rows while building: the
    only jobs are those that read the schemas of the test tables."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs_of(group, build):
        context.setJobGroup(group, "")
        build()
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    schemas = jobs_of("schemas", lambda: Chain(spark, SMALL))
    for name in ("vm_cost_estimate", "daily_cost_summary", "upsert_daily_cost", "price_upsert", "new_alerts", "alert_gate"):
        assert jobs_of(name, lambda n=name: QUERIES[n](spark, SMALL)) == schemas


def no_broadcast(spark):
    return {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_hot_sku_is_dealt_over_all_partitions_when_the_price_list_is_not_broadcast(spark):
    """Without a broadcast the join shuffles on the keys and the time bucket, and the group keys
    get an exchange of their own after the map-side combine; the result is the same."""
    c = Chain(spark, SMALL)
    want = cost.usage_rollup(pricing.price_usage(c.src.usage, c.src.list_prices, P)).collect()
    for k, v in no_broadcast(spark).items():
        spark.conf.set(k, v)
    try:
        priced = pricing.price_usage(c.src.usage, c.src.list_prices, P)
        got = cost.usage_rollup(priced)
        text = plan(got)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        above = text[:text.index("SortMergeJoin")]
        assert above.count("HashAggregate") == 2 and "Exchange hashpartitioning(usage_date" in above
        assert "__part" in text[text.index("SortMergeJoin"):]
        assert sorted(map(str, got.collect())) == sorted(map(str, want))
    finally:
        for k in no_broadcast(spark):
            spark.conf.unset(k)


def test_broadcast_versions_are_not_repeated(spark):
    assert "Generate explode" not in plan(Chain(spark, SMALL).priced).split("BroadcastHashJoin")[1].split("Exchange")[0]
    assert "__v_part" not in plan(Chain(spark, SMALL).priced)


def test_time_buckets_join_equals_brute_force(spark):
    """One hot key over many buckets; open, empty and reversed intervals, overlaps, times out of the span, NULLs."""
    import random

    from pyspark.sql import functions as F

    from ledger.operators.temporal_join import scd2_left_join

    rng = random.Random(7)
    day = lambda n: None if n is None else dt.datetime(2000, 1, 1) + dt.timedelta(hours=n)
    facts = [(k, "hot" if k % 3 else f"k{k % 5}", rng.choice([None, *range(-50, 300)])) for k in range(400)]
    versions = [(rng.choice(["hot", "k0", "k1", "k9"]), s, rng.choice([None, s, s - 5, s + 1, s + 40, s + 500]), v) for v, s in enumerate(rng.choices(range(-100, 320), k=60))]
    versions.append(("hot", None, None, 99))
    want = sorted((i, v) for i, k, t in facts for v in ([n for key, s, e, n in versions if key == k and t is not None and s is not None and s <= t and (e is None or t < e)] or [-1]))
    f = spark.createDataFrame([(i, k, day(t)) for i, k, t in facts], "id int, key string, at timestamp_ntz")
    v = spark.createDataFrame([(k, day(s), day(e), n) for k, s, e, n in versions], "key string, a timestamp_ntz, b timestamp_ntz, n int")
    spans = [None, (F.lit("2000-01-02").cast("timestamp"), F.lit("2000-01-05").cast("timestamp")), (F.lit("2000-01-02").cast("timestamp"),) * 2]
    for conf in ({}, no_broadcast(spark)):
        for name, value in conf.items():
            spark.conf.set(name, value)
        try:
            for span in spans:
                joined = scd2_left_join(f, v, ["key"], "at", "a", "b", span)
                assert joined.columns == ["id", "key", "at", "a", "b", "n"]
                assert sorted((r.id, -1 if r.n is None else r.n) for r in joined.collect()) == want
                if conf and span is None:
                    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
                    assert joined.where("key = 'hot'").select(F.spark_partition_id()).distinct().count() >= 5  # of 8, by hash of the bucket
                    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        finally:
            for name in conf:
                spark.conf.unset(name)


def test_a_clean_price_list_is_checked_without_reading_usage(spark):
    c = Chain(spark, SMALL)
    got = pricing.price_overlap_check(c.src.usage, c.src.list_prices, P)
    assert "parquet" not in plan(got).lower() and got.count() == 0
    assert [f.name for f in got.schema] == ["sku_name", "cloud", "usage_start_time", "active_prices"]


def test_alert_chain_reads_each_source_once(spark):
    c = Chain(spark, SMALL)
    assert plan(c.crossed).count("Join") <= plan(c.today).count("Join")
