"""Month-scoped reports: label handling, empty months, top-k."""

import datetime as dt
from decimal import Decimal

from ledger.plans import reports

AS_OF = dt.date(2000, 6, 30)
SCH = "usage_date date, sku_name string, billing_origin_product string, total_cost_usd decimal(38,6), total_dbus decimal(38,6)"


def _s(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(a), b, c, Decimal(str(x)), Decimal("1")) for a, b, c, x in rows], SCH)


def test_month_bounds_frame(spark):
    labels = spark.createDataFrame([("Feb 2000",), ("junk",), (None,)], "month_label string")
    got = {r.month_label: (r.month_start, r.month_end, r.prev_month_start)
           for r in reports.month_bounds_frame(labels, AS_OF).collect()}
    assert got["Feb 2000"] == (dt.date(2000, 2, 1), dt.date(2000, 3, 1), dt.date(2000, 1, 1))
    assert got["junk"][0] == dt.date(2000, 6, 1) and got[None][0] == dt.date(2000, 6, 1)


def test_cost_counters(spark):
    s = _s(spark, [("2000-06-01", "a", "P", 10), ("2000-06-01", "b", "P", 5), ("2000-06-03", "a", "P", 5),
                   ("2000-05-10", "a", "P", 10)])
    r = reports.cost_counters(s, "Jun 2000", AS_OF).collect()[0]
    assert (float(r.month_total), float(r.avg_daily), float(r.peak_day), float(r.pct_vs_prev_month)) == (20, 10, 15, 100)
    junk = reports.cost_counters(s, "junk", AS_OF).collect()[0]
    assert float(junk.month_total) == 20                      # falls back to the as_of month


def test_empty_month_and_zero_previous(spark):
    s = _s(spark, [("2000-06-01", "a", "P", 10)])
    r = reports.cost_counters(s, "Jan 1999", AS_OF).collect()[0]
    assert r.month_total is None and r.avg_daily is None and r.pct_vs_prev_month is None
    r = reports.cost_counters(s, "Jun 2000", AS_OF).collect()[0]
    assert r.pct_vs_prev_month is None                         # previous month has no cost


def test_top_k_limit_and_tie_order(spark):
    s = _s(spark, [("2000-06-01", f"sku{i:02d}", "P", 1) for i in range(25)])
    got = [r.sku_name for r in reports.top_skus(s, "Jun 2000", AS_OF).collect()]
    assert got == [f"sku{i:02d}" for i in range(20)]


def test_threshold_gauge(spark):
    s = _s(spark, [("2000-06-01", "a", "P", 10), ("2000-06-02", "a", "P", 30)])
    cfg = spark.createDataFrame([(2, Decimal("40"), True), (1, Decimal("80"), False)],
                                "config_id int, daily_threshold_dollars decimal(20,2), is_active boolean")
    r = reports.threshold_gauge(s, cfg, "Jun 2000", AS_OF).collect()[0]
    assert (float(r.month_spend), float(r.daily_threshold), float(r.pct_avg_vs_threshold)) == (40, 40, 50)
