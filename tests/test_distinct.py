"""Distinct days and clusters of month ranges: bitmaps in store equal COUNT(DISTINCT)."""

import datetime as dt

from pyspark.sql import functions as F

from ledger.params import RunParams
from ledger.plans import distinct, jobs

FACTS = "usage_date date, cluster_id string, sku_name string"


def _facts(spark, n, seed=0):
    draw = lambda k, m: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(m)).cast("int")
    day = F.when(draw(1, 50) > 0, F.date_add(F.lit(dt.date(2023, 1, 1)), draw(2, 500)))
    busy = F.when(draw(3, 3) == 0, F.lit("busy")).when(draw(3, 40) > 1, F.concat(F.lit("c"), draw(4, 70_000).cast("string")))
    return spark.range(n).select(day.alias("usage_date"), busy.alias("cluster_id"), F.lit("S").alias("sku_name"))


def _want(facts, first, last):
    end = (last.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    r = facts.where((F.col("usage_date") >= F.lit(first.replace(day=1))) & (F.col("usage_date") < F.lit(end))).agg(
        F.count_distinct("usage_date"), F.count_distinct("cluster_id")).first()
    return (r[0], r[1])


def test_any_range_equals_count_distinct(spark, tmp_path):
    root = str(tmp_path / "states")
    facts = _facts(spark, 120_000).checkpoint()
    distinct.refresh_months(spark, facts, root)
    assert spark.read.parquet(f"{root}/numbers").where("number > 32768").count() > 0     # more than one bucket
    for first, last in [((2023, 1, 1), (2023, 12, 31)), ((2023, 3, 9), (2023, 3, 1)), ((2023, 11, 1), (2024, 2, 2)), ((1999, 1, 1), (1999, 9, 1))]:
        got = distinct.range_counts(spark, root, dt.date(*first), dt.date(*last)).first()
        assert (got.days, got.clusters) == _want(facts, dt.date(*first), dt.date(*last))

    # later usage in the window: known clusters keep their numbers, other months stay unread
    numbers = {r.cluster_id: r.number for r in spark.read.parquet(f"{root}/numbers").collect()}
    late = facts.unionAll(spark.createDataFrame([(dt.date(2024, 5, 20), "new", "S"), (dt.date(2024, 5, 21), "busy", "S"), (dt.date(2023, 1, 1), "unseen", "S")], FACTS))
    distinct.refresh_months(spark, late, root, dt.date(2024, 3, 17))
    now = {r.cluster_id: r.number for r in spark.read.parquet(f"{root}/numbers").collect()}
    assert numbers.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1)) and "unseen" not in now
    whole = (dt.date(2023, 6, 1), dt.date(2024, 5, 31))
    got = distinct.range_counts(spark, root, *whole).first()
    assert (got.days, got.clusters) == _want(late, *whole)


def test_no_facts_and_only_nulls(spark, tmp_path):
    for i, rows in enumerate(([], [(None, "a", "S"), (dt.date(2024, 1, 31), None, "S")])):
        root = str(tmp_path / str(i))
        distinct.refresh_months(spark, spark.createDataFrame(rows, FACTS), root)
        got = distinct.range_counts(spark, root, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).first()
        assert (got.days, got.clusters) == (len(rows) // 2, 0)


def test_states_of_a_warehouse(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.setup(spark, wh)
    facts = spark.createDataFrame([(dt.date(2024, 1, 2), "a", "S"), (dt.date(2024, 2, 2), "a", "S"), (dt.date(2024, 2, 3), "b", "T")], FACTS)
    jobs.with_month(facts).write.mode("append").partitionBy("usage_month").parquet(wh.path("daily_cost_with_vm_estimate"))
    jobs.refresh_month_states(spark, wh, RunParams(as_of=dt.date(2024, 2, 28), lookback_days=None))
    got = jobs.range_counts(spark, wh, dt.date(2024, 1, 1), dt.date(2024, 2, 29)).first()
    assert (got.days, got.clusters) == (3, 2)
