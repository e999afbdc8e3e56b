"""Usage pricing and VM price table (traps T1, T2, T4, T5, T25; markup; estimates)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import price_rows, usage_rows
from ledger.params import RunParams
from ledger.plans import pricing
from ledger.sources.catalog import PAGE_SCHEMA, IncompleteCatalogError, page_chain, read_catalog_pages, require_whole_catalog

P = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=None)


def _u(day, start, sku="S", qty=1, cloud="GCP"):
    return (day, start, start, sku, "JOBS", cloud, 1, False, "c-1", qty)


def test_t1_half_open_interval_on_usage_start(spark):
    prices = price_rows(spark, [
        ("S", "GCP", "2000-01-01 00:00:00", "2000-01-10 00:00:00", 1, None),
        ("S", "GCP", "2000-01-10 00:00:00", None, 2, None),
    ])
    usage = usage_rows(spark, [
        _u("2000-01-01", "2000-01-01 00:00:00"),   # exactly at start -> first price
        _u("2000-01-10", "2000-01-10 00:00:00"),   # exactly at end -> next price
        _u("2000-01-09", "2000-01-09 23:59:59"),   # 1 s before end -> old price
        _u("1999-12-31", "1999-12-31 23:00:00"),   # before the first price -> 0
    ])
    got = {r.usage_start_time.isoformat(): float(r.unit_price)
           for r in pricing.price_usage(usage, prices, P).collect()}
    assert got == {"2000-01-01T00:00:00": 1.0, "2000-01-10T00:00:00": 2.0,
                   "2000-01-09T23:59:59": 1.0, "1999-12-31T23:00:00": 0.0}


def test_t2_price_precedence(spark):
    prices = price_rows(spark, [
        ("A", "GCP", "2000-01-01 00:00:00", None, 5, 2),
        ("B", "GCP", "2000-01-01 00:00:00", None, 5, None),
        ("C", "GCP", "2000-01-01 00:00:00", None, None, None),
    ])
    usage = usage_rows(spark, [_u("2000-02-01", "2000-02-01 00:00:00", s) for s in "ABCD"])
    got = {r.sku_name: float(r.unit_price) for r in pricing.price_usage(usage, prices, P).collect()}
    assert got == {"A": 2.0, "B": 5.0, "C": 0.0, "D": 0.0}


def test_t4_overlapping_prices_fan_out_and_are_reported(spark):
    prices = price_rows(spark, [
        ("S", "GCP", "2000-01-01 00:00:00", None, 1, None),
        ("S", "GCP", "2000-01-05 00:00:00", None, 1, None),
    ])
    usage = usage_rows(spark, [_u("2000-02-01", "2000-02-01 00:00:00", qty=10)])
    priced = pricing.price_usage(usage, prices, P)
    assert priced.count() == 2
    assert pricing.price_overlap_check(usage, prices, P).count() == 1


def test_t5_window_is_inclusive_on_both_sides_and_can_be_unbounded(spark):
    usage = usage_rows(spark, [_u(day, f"{day} 01:00:00") for day in
                               ["2000-03-31", "2000-04-01", "2000-06-30", "2000-07-01"]])
    p = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=90)
    kept = sorted(str(r.usage_date) for r in pricing.usage_window(usage, p).collect())
    assert kept == ["2000-04-01", "2000-06-30"]
    p = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=90, bounded=False)
    kept = sorted(str(r.usage_date) for r in pricing.usage_window(usage, p).collect())
    assert kept == ["2000-04-01", "2000-06-30", "2000-07-01"]


def test_window_filters_reach_the_parquet_scan(spark):
    from ledger.sources import fixtures

    u = fixtures.usage(spark, "/root/testdata/sf0.001")
    p = RunParams(as_of=dt.date(2000, 6, 30), lookback_days=90)
    plan = pricing.usage_window(u, p)._jdf.queryExecution().executedPlan().toString()
    # the date bound reaches Parquet even through the DATE(ts) derivation
    assert "GreaterThanOrEqual(l_shipdate,2000-04-01T00:00)" in plan
    # only the columns the usage view needs are read
    assert "l_extendedprice" not in plan and "l_discount" not in plan


def test_seed_markup_by_region(spark):
    regions = spark.createDataFrame([("us-central1",), ("asia-south1",), ("mars-1",)], "region string")
    rows = pricing.seed_prices(regions).where(F.col("node_type_id") == "n1-standard-4").collect()
    got = {r.region: (float(r.hourly_price_usd), r.price_source) for r in rows}
    assert got["us-central1"] == (0.19, "GCP list price (seeded, us-central1)")
    assert got["asia-south1"][0] == 0.2204
    assert "1.16x markup" in got["asia-south1"][1]
    assert got["mars-1"][0] == 0.19
    assert pricing.seed_prices(regions).count() == 108


def test_t25_catalog_extract_from_json_pages(spark, tmp_path):
    def sku(name, family="Compute", usage="OnDemand", regions=("us-central1",), tiers=(("1", 500000000),)):
        return {
            "name": f"services/X/skus/{name}",
            "category": None if family is None else {"resourceFamily": family, "usageType": usage},
            "serviceRegions": list(regions),
            "description": f"{name} Instance Core",
            "pricingInfo": [{"pricingExpression": {"tieredRates": [
                {"unitPrice": {"units": u, "nanos": n}} for u, n in tiers]}}],
        }

    page = {"skus": [
        sku("OK"), sku("FAM", family="Storage"), sku("USE", usage="Preemptible"),
        sku("REG", regions=("europe-west1",)), sku("NOTIER", tiers=()), sku("ZERO", tiers=(("0", 0),)),
        sku("NOCAT", family=None),
    ], "nextPageToken": ""}
    (tmp_path / "page-0.json").write_text(json.dumps(page))
    pages = read_catalog_pages(spark, str(tmp_path))
    rows = pricing.catalog_price_extract(pages, "us-central1").collect()
    assert [(r.node_type_id, float(r.hourly_price_usd), r.vcpus) for r in rows] == [("OK", 1.5, 0)]
    assert rows[0].gcp_machine_type == "ok instance core"


def test_estimates_only_for_unpriced_node_types(spark):
    nt = spark.createDataFrame([("n1-standard-4", 4.0, 15360), ("x-9", 9.0, 34560)],
                               "node_type string, core_count double, memory_mb bigint")
    regions = spark.createDataFrame([("us-central1",)], "region string")
    seeds = pricing.seed_prices(regions)
    est = pricing.estimate_missing_prices(nt, seeds, "us-central1").collect()
    assert len(est) == 1 and est[0].node_type_id == "x-9"
    assert est[0].memory_gb == 33.8   # 34560 / 1024 = 33.75 -> half up
    assert float(est[0].hourly_price_usd) == round(9 * 0.04749 + 33.75 * 0.006383, 6)


def _pages(spark, links):
    return spark.createDataFrame(links, "pageToken string, nextPageToken string").withColumn("skus", F.lit(None).cast(PAGE_SCHEMA["skus"].dataType))


@pytest.mark.parametrize("links, problems", [
    ([(None, None)], []),
    ([("", "t1"), ("t1", "t2"), ("t2", "")], []),
    ([(None if i == 0 else f"t{i}", f"t{i + 1}" if i < 36 else None) for i in range(37)], []),
    ([], [("missing", "", 0)]),
    ([(None, "t1"), ("t1", "t2"), ("t3", None)], [("missing", "t2", 0), ("not reached", "t3", 1)]),
    ([(None, "t1"), ("t1", None), ("t1", None)], [("repeated", "t1", 2)]),
    ([(None, "t1"), ("t1", "t2"), ("t2", "t1")], [("no end", "", 0)]),
    ([(None, None), ("t1", "t2"), ("t2", "t1")], [("not reached", "t1", 1), ("not reached", "t2", 1)]),
    ([("t1", None)], [("missing", "", 0), ("not reached", "t1", 1)]),
    ([(None, None), (None, None)], [("repeated", "", 2)]),
    ([(None, "t1"), (None, "t2"), ("t1", None), ("t2", None)], [("repeated", "", 2)]),
])
def test_page_chain_finds_what_breaks_it(spark, links, problems):
    pages = _pages(spark, links)
    assert sorted((r.problem, r.token, r.pages) for r in page_chain(pages).collect()) == problems
    if problems:
        with pytest.raises(IncompleteCatalogError, match=problems[0][0]):
            require_whole_catalog(pages)
    else:
        require_whole_catalog(pages)
