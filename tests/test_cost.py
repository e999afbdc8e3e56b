"""Daily summary and details (traps T3, T10-T15)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import price_rows, usage_rows
from ledger.params import RunParams
from ledger.plans import cost, pricing

P = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=None)


def test_t3_summary_uses_max_price_for_the_day(spark):
    prices = price_rows(spark, [
        ("S", "GCP", "2000-01-01 00:00:00", "2000-02-01 12:00:00", 1, None),
        ("S", "GCP", "2000-02-01 12:00:00", None, 2, None),
    ])
    usage = usage_rows(spark, [
        ("2000-02-01", "2000-02-01 01:00:00", "2000-02-01 02:00:00", "S", "JOBS", "GCP", 1, False, "c", 10),
        ("2000-02-01", "2000-02-01 13:00:00", "2000-02-01 14:00:00", "S", "JOBS", "GCP", 1, False, "c", 10),
    ])
    priced = pricing.price_usage(usage, prices, P)
    s = cost.daily_cost_summary(priced).collect()
    assert len(s) == 1 and float(s[0].total_cost_usd) == 40.0
    assert float(priced.agg(F.sum("exact_cost")).first()[0]) == 30.0


def _summary(spark, rows):
    """rows: (date, sku, product, serverless, cost, cloud, workspace)"""
    from decimal import Decimal
    data = [(dt.date.fromisoformat(r[0]), r[1], r[2], r[5] if len(r) > 5 else "GCP",
             r[6] if len(r) > 6 else "1", r[3], Decimal("1"), Decimal("1"), Decimal(str(r[4]))) for r in rows]
    return spark.createDataFrame(data, "usage_date date, sku_name string, billing_origin_product string, "
                                       "cloud string, workspace_id string, is_serverless boolean, "
                                       "total_dbus decimal(38,6), list_price_per_dbu decimal(38,6), "
                                       "total_cost_usd decimal(38,6)")


def test_t10_details_sum_over_clouds_and_workspaces(spark):
    s = _summary(spark, [("2000-01-01", "S", "JOBS", False, 1, "GCP", "1"), ("2000-01-01", "S", "JOBS", False, 2, "AWS", "2")])
    rows = cost.sku_daily_details(s, P).collect()
    assert len(rows) == 1 and float(rows[0].total_cost_usd) == 3.0


def test_t11_rolling_mean_counts_rows_not_days(spark):
    days = [f"2000-01-0{i}" for i in range(1, 10)]
    rows = [(d, "S", "JOBS", False, i + 1) for i, d in enumerate(days)]
    rows += [("2000-01-01", "G", "JOBS", False, 10), ("2000-01-20", "G", "JOBS", False, 20)]   # 19-day gap
    out = {(r.sku_name, str(r.usage_date)): r for r in cost.sku_daily_details(_summary(spark, rows), P).collect()}
    assert float(out[("S", "2000-01-09")].cost_7d_avg) == sum(range(3, 10)) / 7
    assert float(out[("G", "2000-01-20")].cost_7d_avg) == 15.0          # the gap does not shrink the frame


def test_t11_ties_on_date_are_ordered_by_product(spark):
    rows = [("2000-01-01", "S", "B_PROD", False, 4), ("2000-01-01", "S", "A_PROD", False, 2)]
    out = {r.billing_origin_product: float(r.cost_7d_avg) for r in cost.sku_daily_details(_summary(spark, rows), P).collect()}
    assert out == {"A_PROD": 2.0, "B_PROD": 3.0}


def test_t12_warmup_reads_further_back(spark):
    base = dt.date(2000, 1, 1)
    rows = [((base + dt.timedelta(days=i)).isoformat(), "S", "JOBS", False, i + 1) for i in range(40)]
    p = RunParams(as_of=base + dt.timedelta(days=39), lookback_days=34)    # window starts at day 5
    plain = cost.sku_daily_details(_summary(spark, rows), p).orderBy("usage_date").first()
    assert float(plain.cost_7d_avg) == float(plain.total_cost_usd)         # oldest row averages itself
    warm = cost.sku_daily_details(_summary(spark, rows), p, warmup_days=29).orderBy("usage_date").first()
    assert warm.usage_date == plain.usage_date
    assert float(warm.cost_7d_avg) == (1 + 2 + 3 + 4 + 5 + 6) / 6      # days 0..5 fill the frame


def test_t13_pct_change_zero_when_average_not_positive(spark):
    rows = [("2000-01-01", "Z", "JOBS", False, 0), ("2000-01-01", "N", "JOBS", False, -5)]
    out = {r.sku_name: float(r.cost_pct_change_7d) for r in cost.sku_daily_details(_summary(spark, rows), P).collect()}
    assert out == {"Z": 0.0, "N": 0.0}


def test_t14_categories(spark):
    prods = ["JOBS", "SQL", "DLT", "MODEL_SERVING", "VECTOR_SEARCH", "NOTEBOOKS", "sql", None, "STORAGE"]
    rows = [("2000-01-01", f"S{i}", p, False, 1) for i, p in enumerate(prods)]
    got = [r.product_category for r in cost.sku_daily_details(_summary(spark, rows), P).orderBy("sku_name").collect()]
    assert got == ["Compute", "SQL Warehouse", "Delta Live Tables", "Model Serving", "Vector Search",
                   "Interactive", "Other", "Other", "Other"]


def test_t15_like_patterns_treat_underscore_as_wildcard(spark):
    from ledger.functions.expressions import is_bundled, is_photon

    df = spark.createDataFrame([("SQLXPRO",), ("premium_photon",), ("X_MODEL_SERVING_Y",), ("SQL_PRO",), ("JOBS",)],
                               "sku_name string")
    got = {r.sku_name: (r.b, r.p) for r in df.select("sku_name", is_bundled().alias("b"), is_photon().alias("p")).collect()}
    assert got == {"SQLXPRO": (True, False), "premium_photon": (False, True), "X_MODEL_SERVING_Y": (True, False),
                   "SQL_PRO": (True, False), "JOBS": (False, False)}


def test_rollup_gives_the_same_summary(spark):
    from ledger.sources import fixtures

    src = fixtures.load(spark, "/root/testdata/sf0.001")
    priced = pricing.price_usage(src.usage, src.list_prices, P)
    direct = cost.daily_cost_summary(priced, F.lit(None)).drop("_etl_updated_at")
    rolled = cost.daily_cost_summary(cost.usage_rollup(priced), F.lit(None)).drop("_etl_updated_at")
    assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0


def test_range_frame_uses_calendar_days(spark):
    rows = [("2000-01-01", "S", "JOBS", False, 10), ("2000-01-02", "S", "JOBS", False, 20),
            ("2000-01-10", "S", "JOBS", False, 30)]
    out = {str(r.usage_date): float(r.cost_7d_avg)
           for r in cost.sku_daily_details(_summary(spark, rows), P, frame="range").collect()}
    assert out == {"2000-01-01": 10.0, "2000-01-02": 15.0, "2000-01-10": 30.0}   # rows frame would give 20.0
