"""VM cost estimation (traps T16-T24)."""

import datetime as dt
from decimal import Decimal


from helpers import ts
from ledger.params import RunParams
from ledger.plans import reports, vm

P = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=None)
NT = "cluster_id string, driver boolean, node_type string, start_time timestamp_ntz, end_time timestamp_ntz"
CL = ("cluster_id string, cluster_name string, change_time timestamp_ntz, driver_node_type string, "
      "worker_node_type string, worker_count int, max_autoscale_workers int")
PR = "node_type_id string, hourly_price_usd decimal(10,6), gcp_machine_type string, region string"
CU = "usage_date date, cluster_id string, sku_name string, total_dbus decimal(38,6), billing_hours decimal(38,6), dbu_cost_usd decimal(38,12)"


def _nt(spark, rows):
    return spark.createDataFrame([(c, dr, t, ts(s), ts(e) if e else None) for c, dr, t, s, e in rows], NT)


def test_t16_interval_charged_to_start_day_open_adds_nothing(spark):
    nh = vm.node_hours(_nt(spark, [("c", True, "a", "2000-01-01 23:30:00", "2000-01-02 00:30:00"),
                                   ("c", True, "a", "2000-01-01 10:00:00", None)]), P).collect()
    assert len(nh) == 1 and str(nh[0].usage_date) == "2000-01-01" and float(nh[0].driver_hours) == 1.0


def test_split_days_charges_each_day_its_own_seconds(spark):
    """Hours per day add up to the interval's; fractions of a second, open ends and the window's edges."""
    rows = [("a", True, "x", "2000-01-01 22:00:00", "2000-01-04 03:30:00"), ("b", False, "y", "2000-01-01 23:59:59.5", "2000-01-02 00:00:00.5"),
            ("c", True, "x", "2000-01-02 00:00:00", "2000-01-03 00:00:00"), ("d", True, "x", "2000-01-03 18:00:00", None),
            ("e", False, "y", "2000-01-02 05:00:00", "2000-01-02 05:00:00"), ("f", None, "z", "2000-01-01 12:00:00", "2000-01-02 12:00:00")]
    nt = _nt(spark, rows)
    seconds = {}
    for r in vm.split_at_midnight(nt, RunParams(as_of=dt.date(2000, 1, 31), lookback_days=None)).collect():
        seconds.setdefault(r.cluster_id, {})[r.usage_date.day] = r.seconds
    assert seconds["a"] == {1: 7200, 2: 86400, 3: 86400, 4: 12600} and seconds["c"] == {2: 86400} and seconds["e"] == {2: 0}
    assert sum(seconds["b"].values()) == 1 and set(seconds["b"]) == {1, 2} and seconds["f"] == {1: 43200, 2: 43200}
    assert len(seconds["d"]) == 29 and sum(seconds["d"].values()) == 29 * 86400 - 18 * 3600  # open: until the run's day ends
    short = RunParams(as_of=dt.date(2000, 1, 3), lookback_days=1)
    got = {(r.cluster_id, r.usage_date.day): (r.driver_hours, r.worker_hours) for r in vm.node_hours(nt, short, split_days=True).collect()}
    assert got["a", 2] == (24, 0) and got["a", 3] == (24, 0) and got["d", 3] == (6, 0) and ("a", 1) not in got and ("a", 4) not in got
    unbounded = RunParams(as_of=dt.date(2000, 1, 3), lookback_days=None, bounded=False)
    assert [r.seconds for r in vm.split_at_midnight(nt.where("cluster_id = 'd'"), unbounded).collect()] == [None]


def test_config_as_of_the_day_takes_no_later_change(spark):
    cl = spark.createDataFrame([("a", "old", ts("2000-01-02 08:00:00"), "d1", "w1", 2, None), ("a", "noon", ts("2000-01-05 12:00:00"), "d2", "w2", None, 4),
                                ("a", "night", ts("2000-01-05 23:59:59"), "d3", "w3", None, None), ("a", "tie", ts("2000-01-05 23:59:59"), "d3", "w3", None, None),
                                ("b", "b", None, "d", "w", 1, None), (None, "n", ts("2000-01-01 00:00:00"), "d", "w", 1, None)], CL)
    days = [("a", day) for day in (1, 2, 3, 4, 5, 6, 6)] + [("b", 2), (None, 3), ("c", 3)]
    used = spark.createDataFrame([(dt.date(2000, 1, x), c) for c, x in days], "usage_date date, cluster_id string")
    got = {(r.cluster_id, r.usage_date.day): (r.cluster_name, r.cc_driver_type, r.cc_num_workers) for r in vm.cluster_config_as_of(cl, used).collect()}
    assert got == {("a", 2): ("old", "d1", 2), ("a", 3): ("old", "d1", 2), ("a", 4): ("old", "d1", 2), ("a", 5): ("tie", "d3", 1), ("a", 6): ("tie", "d3", 1)}
    assert vm.cluster_config_as_of(cl.limit(0), used).count() == 0 and vm.cluster_config_as_of(cl, used.limit(0)).count() == 0


def test_estimate_by_the_config_of_the_day(spark):
    cl = spark.createDataFrame([("a", "then", ts("2000-01-02 08:00:00"), "d1", "w1", 2, None), ("a", "now", ts("2000-03-01 00:00:00"), "d2", "w1", 3, None)], CL)
    cu = spark.createDataFrame([(dt.date(2000, 1, x), "a", "S", Decimal(1), Decimal(2), Decimal(1)) for x in (1, 5)], CU)
    prices = spark.createDataFrame([("d1", Decimal(1), "m1", P.region), ("d2", Decimal(5), "m2", P.region), ("w1", Decimal(2), "m3", P.region)], PR)
    nh = vm.node_hours(_nt(spark, []), P)
    got = {r.usage_date.day: r for r in vm.vm_cost_estimate(cu, nh, vm.cluster_config_as_of(cl, cu), prices, P).collect()}
    assert (got[5].cluster_name, float(got[5].estimated_vm_cost_usd), got[5].vm_cost_source) == ("then", 10.0, "cluster_config")
    assert got[1].cluster_name is None and got[1].vm_cost_source == "unknown"     # before the first change
    latest = {r.usage_date.day: float(r.estimated_vm_cost_usd) for r in vm.vm_cost_estimate(cu, nh, vm.latest_cluster_config(cl), prices, P).collect()}
    assert latest == {1: 22.0, 5: 22.0}


def test_t17_driver_null_counts_for_no_role(spark):
    rows = vm.node_hours(_nt(spark, [("c", None, "a", "2000-01-01 01:00:00", "2000-01-01 02:00:00")]), P).collect()
    assert float(rows[0].driver_hours) == 0 and float(rows[0].worker_hours) == 0
    only_open = vm.node_hours(_nt(spark, [("d", True, "a", "2000-01-01 01:00:00", None)]), P).collect()
    assert only_open[0].driver_hours is None          # -> falls back to cluster_config


def test_t18_mixed_types_take_max(spark):
    rows = vm.node_hours(_nt(spark, [("c", False, "a", "2000-01-01 01:00:00", "2000-01-01 02:00:00"),
                                     ("c", False, "b", "2000-01-01 03:00:00", "2000-01-01 04:00:00")]), P).collect()
    assert rows[0].nt_worker_type == "b"


def test_t19_latest_config_and_worker_count(spark):
    cl = spark.createDataFrame([
        ("a", "old", ts("2000-01-01 00:00:00"), "d", "w", 5, None),
        ("a", "new", ts("2000-02-01 00:00:00"), "d", "w", 0, None),
        ("b", "b", ts("2000-01-01 00:00:00"), "d", "w", None, 8),
        ("c", "c", ts("2000-01-01 00:00:00"), "d", "w", None, None),
    ], CL)
    got = {r.cluster_id: (r.cluster_name, r.cc_num_workers) for r in vm.latest_cluster_config(cl).collect()}
    assert got == {"a": ("new", 0), "b": ("b", 8), "c": ("c", 1)}


def _estimate(spark, cu_rows, nt_rows, cl_rows, price_rows, allocate="per_sku"):
    cu = spark.createDataFrame([(dt.date.fromisoformat(a), b, c, Decimal(d), Decimal(e), Decimal(f))
                                for a, b, c, d, e, f in cu_rows], CU)
    nh = vm.node_hours(_nt(spark, nt_rows), P)
    cfg = vm.latest_cluster_config(spark.createDataFrame(
        [(a, b, ts(c), d, e, f, g) for a, b, c, d, e, f, g in cl_rows], CL))
    prices = spark.createDataFrame([(a, Decimal(b), c, "us-central1") for a, b, c in price_rows], PR)
    return {(r.cluster_id, r.sku_name): r for r in vm.vm_cost_estimate(cu, nh, cfg, prices, P, allocate=allocate).collect()}


def test_lineage_values_and_t21_t23(spark):
    out = _estimate(
        spark,
        [("2000-01-01", "tl", "JOBS", "1", "2", "1"), ("2000-01-01", "cc", "JOBS", "1", "2", "1"),
         ("2000-01-01", "un", "JOBS", "1", "2", "1"), ("2000-01-01", "tl", "SERVERLESS_X", "1", "2", "1"),
         ("2000-01-01", "miss", "JOBS", "1", "2", "1")],
        [("tl", True, "drv", "2000-01-01 00:00:00", "2000-01-01 02:00:00")]
        + [("tl", False, "wrk", "2000-01-01 00:00:00", "2000-01-01 02:00:00")] * 3,
        [("cc", "cc", "2000-01-01 00:00:00", "drv", "wrk", 3, None), ("tl", "tl", "2000-01-01 00:00:00", "drv", "wrk", 7, None),
         ("miss", "miss", "2000-01-01 00:00:00", "nope", "nope", 1, None)],
        [("drv", "1", "drv-vm"), ("wrk", "0.5", "wrk-vm")],
    )
    tl = out[("tl", "JOBS")]
    assert tl.vm_cost_source == "node_timeline"
    assert float(tl.estimated_vm_cost_usd) == 2 * 1 + 6 * 0.5                     # driver 2h + 3 workers x 2h
    assert float(tl.cluster_uptime_hours) == 8 and tl.num_workers == 7            # T23: workers from config
    cc = out[("cc", "JOBS")]
    assert cc.vm_cost_source == "cluster_config" and float(cc.estimated_vm_cost_usd) == 2 * (1 + 3 * 0.5)
    assert out[("un", "JOBS")].vm_cost_source == "unknown"
    assert float(out[("un", "JOBS")].estimated_vm_cost_usd) == 0
    b = out[("tl", "SERVERLESS_X")]
    assert b.vm_cost_source == "BUNDLED_IN_DBU" and float(b.estimated_vm_cost_usd) == 0
    miss = out[("miss", "JOBS")]                                                    # T21
    assert miss.vm_cost_source == "cluster_config" and float(miss.estimated_vm_cost_usd) == 0
    assert miss.driver_vm_type is None


def test_t20_per_sku_duplicates_and_dbu_share_splits(spark):
    args = (
        [("2000-01-01", "c", "A", "1", "1", "3"), ("2000-01-01", "c", "B", "1", "1", "1")],
        [("c", True, "drv", "2000-01-01 00:00:00", "2000-01-01 01:00:00")],
        [],
        [("drv", "4", "drv-vm")],
    )
    per = _estimate(spark, *args)
    assert float(per[("c", "A")].estimated_vm_cost_usd) == 4 and float(per[("c", "B")].estimated_vm_cost_usd) == 4
    share = _estimate(spark, *args, allocate="dbu_share")
    assert float(share[("c", "A")].estimated_vm_cost_usd) == 3 and float(share[("c", "B")].estimated_vm_cost_usd) == 1


def test_t22_total_rounds_exact_dbu_cost_plus_vm_once(spark):
    # DECIMAL inputs: the VM product is already kept to 6 places by Spark's decimal rules
    # (as in the reference's SQL); the total rounds the exact 12-place DBU cost plus it.
    out = _estimate(
        spark, [("2000-01-01", "c", "A", "1", "1", "0.0000005")],
        [("c", True, "drv", "2000-01-01 00:00:00", "2000-01-01 00:00:01")], [], [("drv", "0.001440", "x")],
    )
    r = out[("c", "A")]
    assert float(r.estimated_vm_cost_usd) == 0.0            # 1/3600 h x 0.00144 = 0.0000004 -> 0
    assert float(r.total_estimated_cost) == 0.000001         # round(0.0000005 + 0, 6), half up
    assert float(r.dbu_cost_usd) == 0.000001


def test_t24_node_type_report_counts_driver_and_worker(spark):
    rows = [(dt.date(2000, 6, 1), "a", "b", Decimal("10"))]
    t = spark.createDataFrame(rows, "usage_date date, driver_node_type string, worker_node_type string, "
                                    "estimated_vm_cost_usd decimal(38,6)")
    got = {r.node_type: float(r.total_vm_cost) for r in reports.vm_by_node_type(t, "Jun 2000", P.as_of).collect()}
    assert got == {"a": 10.0, "b": 10.0}
