"""Values and row builders that the test modules share."""

import datetime as dt
from decimal import Decimal

SMALL = "/root/testdata/sf0.001"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def dec(x) -> Decimal:
    return Decimal(str(x))


USAGE_FLAT = ("usage_date date, usage_start_time timestamp_ntz, usage_end_time timestamp_ntz, sku_name string, "
              "billing_origin_product string, cloud string, workspace_id bigint, is_serverless boolean, "
              "cluster_id string, usage_quantity decimal(18,6)")
PRICES_FLAT = ("sku_name string, cloud string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, "
               "price_default decimal(18,6), price_effective decimal(18,6)")


def usage_rows(spark, rows):
    """rows: (date, start, end, sku, product, cloud, ws, serverless, cluster, qty)"""
    from ledger.sources.fixtures import wrap_usage_flat

    conv = [(d(r[0]), ts(r[1]), ts(r[2]), r[3], r[4], r[5], r[6], r[7], r[8], dec(r[9])) for r in rows]
    return wrap_usage_flat(spark.createDataFrame(conv, USAGE_FLAT))


def price_rows(spark, rows):
    """rows: (sku, cloud, start, end|None, default|None, effective|None)"""
    from ledger.sources.fixtures import wrap_prices_flat

    conv = [(r[0], r[1], ts(r[2]), ts(r[3]) if r[3] else None,
             dec(r[4]) if r[4] is not None else None, dec(r[5]) if r[5] is not None else None) for r in rows]
    return wrap_prices_flat(spark.createDataFrame(conv, PRICES_FLAT))
