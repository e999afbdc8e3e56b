"""Command line: the two scheduled jobs and the month reports.

    python -m ledger setup  --warehouse W [--threshold 1000 --recipients a@x,b@y --tiers 25,50,75,90,100]
    python -m ledger daily  --warehouse W --usage U --list-prices L --node-timeline N \\
                            --clusters C --node-types T [--catalog-pages DIR] [--as-of D] [--lookback-days 90]
    python -m ledger alerts --warehouse W [--alert-config A] [--as-of D]
    python -m ledger config --warehouse W --id 1 --set daily_threshold_dollars=500 [--set is_active=false ...]
    python -m ledger report NAME --warehouse W [--month 'Jun 2000'] [--alert-config A] [--out PATH]

``--alert-config`` defaults to the warehouse's own ``alert_config`` table (written by setup).

A source is a Parquet path (contains '/') or a catalog table name.  The session comes
from the environment (spark-submit); ``spark.checkpoint.dir`` must name shared storage.
Dates default to today (UTC), like the reference's ``current_date()``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.params import RunParams
from ledger.plans import alerts, jobs, pricing, reports, vm
from ledger.session import apply_job_conf
from ledger.sources.catalog import read_catalog_pages
from ledger.sources.fixtures import Sources

REPORTS = {
    "month_picker": lambda t, a: reports.month_picker(t("daily_cost_summary"), a.as_of),
    "cost_counters": lambda t, a: reports.cost_counters(t("daily_cost_summary"), a.month, a.as_of),
    "daily_cost_trend": lambda t, a: reports.daily_cost_trend(t("daily_cost_summary"), a.month, a.as_of),
    "top_skus": lambda t, a: reports.top_skus(t("daily_cost_summary"), a.month, a.as_of),
    "sku_details": lambda t, a: reports.sku_details(t("sku_daily_details"), a.month, a.as_of, a.sku, a.category),
    "vm_estimates": lambda t, a: reports.vm_estimates(t("daily_cost_with_vm_estimate"), a.month, a.as_of),
    "vm_cost_counters": lambda t, a: reports.vm_cost_counters(t("daily_cost_with_vm_estimate"), a.month, a.as_of),
    "vm_daily_trend": lambda t, a: reports.vm_daily_trend(t("daily_cost_with_vm_estimate"), a.month, a.as_of),
    "vm_by_node_type": lambda t, a: reports.vm_by_node_type(t("daily_cost_with_vm_estimate"), a.month, a.as_of),
    "vm_reference_prices": lambda t, a: reports.vm_reference_prices(t("gcp_vm_reference_prices"), a.tz),
    "alert_config": lambda t, a: reports.alert_config_view(t("alert_config"), a.tz),
    "alert_history": lambda t, a: reports.alert_history_month(t("alert_history"), a.month, a.as_of, 100, a.tz),
    "threshold_gauge": lambda t, a: reports.threshold_gauge(t("daily_cost_summary"), t("alert_config"), a.month,
                                                            a.as_of),
    "vm_cost_by_source": lambda t, a: vm.vm_cost_by_source(t("daily_cost_with_vm_estimate")),
    "price_source_counts": lambda t, a: pricing.price_source_counts(t("gcp_vm_reference_prices"), a.region),
    "recent_alerts": lambda t, a: alerts.recent_alerts(t("alert_history"), 5, a.tz),
}

# Settings of alert_config that ``config --set`` takes, with their types.
SETTINGS = {"daily_threshold_dollars": "decimal(20,2)", "recipient_emails": "string", "is_active": "boolean",
            "threshold_percentages": "string"}


def _read(spark: SparkSession, ref: str | None) -> DataFrame | None:
    if ref is None:
        return None
    return spark.read.parquet(ref) if "/" in ref else spark.table(ref)


def _setting(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not found or name not in SETTINGS:
        raise argparse.ArgumentTypeError(f"expected one of {', '.join(SETTINGS)} as NAME=VALUE")
    return name, value


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--warehouse", required=True)
    common.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.datetime.now(dt.timezone.utc).date())
    common.add_argument("--cloud", default="GCP")
    common.add_argument("--region", default="us-central1")
    common.add_argument("--tz", default="Asia/Kolkata")
    d = sub.add_parser("daily", parents=[common])
    for name in ("usage", "list-prices", "node-timeline", "clusters", "node-types"):
        d.add_argument(f"--{name}", required=True)
    d.add_argument("--catalog-pages")
    d.add_argument("--lookback-days", type=int, default=90, help="negative = whole history")
    d.add_argument("--carry-rows", action="store_true", help="rolling means of the window's first rows use the rows stored before it")
    d.add_argument("--split-days", action="store_true", help="node hours count on the days they fall on, not on the day they start")
    d.add_argument("--touched-days", action="store_true", help="read only usage of days whose files or prices changed (usage is a path of files)")
    d.add_argument("--whole-catalog", action="store_true", help="refuse price pages that are no unbroken chain from the first to the last")
    d.add_argument("--config-as-of", action="store_true", help="a day's cluster configuration is that of the day, not the newest one")
    s = sub.add_parser("setup", parents=[common])
    s.add_argument("--threshold", help="daily threshold in dollars; omit to only create tables")
    s.add_argument("--recipients", default="")
    s.add_argument("--tiers", default="25,50,75,90,100")
    s.add_argument("--database", help="also enter the tables, with their comments, in this database of the session's catalog")
    c = sub.add_parser("config", parents=[common])
    c.add_argument("--id", type=int, default=1)
    c.add_argument("--set", action="append", required=True, metavar="NAME=VALUE", type=_setting)
    a = sub.add_parser("alerts", parents=[common])
    a.add_argument("--alert-config")
    r = sub.add_parser("report", parents=[common])
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--month")
    r.add_argument("--alert-config")
    r.add_argument("--sku", action="append")
    r.add_argument("--category", action="append")
    r.add_argument("--out", help="write the result as Parquet here instead of showing it")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"ledger-{args.cmd}").getOrCreate()
    apply_job_conf(spark)
    wh = jobs.Warehouse(args.warehouse)

    def config() -> DataFrame:
        ref = getattr(args, "alert_config", None)
        return _read(spark, ref) if ref else jobs.read_table(spark, wh, "alert_config")

    if args.cmd == "setup":
        row = None
        if args.threshold is not None:
            row = spark.range(1).select(
                F.lit(1).alias("config_id"),
                F.lit(args.threshold).cast("decimal(20,2)").alias("daily_threshold_dollars"),
                F.lit(args.recipients).alias("recipient_emails"),
                F.lit(True).alias("is_active"),
                F.lit(args.tiers).alias("threshold_percentages"),
                F.current_timestamp().alias("created_at"),
                F.current_timestamp().alias("updated_at"),
            )
        jobs.setup(spark, wh, row)
        if args.database:
            jobs.register_tables(spark, wh, args.database)
        out = jobs.read_table(spark, wh, "alert_config")
    elif args.cmd == "daily":
        lookback = None if args.lookback_days < 0 else args.lookback_days
        p = RunParams(as_of=args.as_of, cloud=args.cloud, region=args.region, lookback_days=lookback, tz=args.tz)
        src = Sources(
            usage=_read(spark, args.usage), list_prices=_read(spark, args.list_prices),
            node_timeline=_read(spark, args.node_timeline), clusters=_read(spark, args.clusters),
            node_types=_read(spark, args.node_types), catalog_pages=None, alert_config=None, alert_history=None,
        )
        pages = read_catalog_pages(spark, args.catalog_pages) if args.catalog_pages else None
        out = jobs.run_daily(spark, src, wh, p, live_pages=pages, carry_rows=args.carry_rows, split_days=args.split_days,
                             touched_days=args.touched_days, whole_catalog=args.whole_catalog, config_as_of=args.config_as_of)
    elif args.cmd == "config":
        out = jobs.update_config(spark, wh, args.id, **{n: F.lit(v).cast(SETTINGS[n]) for n, v in args.set})
    elif args.cmd == "alerts":
        p = RunParams(as_of=args.as_of, cloud=args.cloud, region=args.region, tz=args.tz)
        out = jobs.run_alerts(spark, config(), wh, p)
    else:
        def table(name: str) -> DataFrame:
            return config() if name == "alert_config" else jobs.read_table(spark, wh, name)

        out = REPORTS[args.name](table, args)
        if args.out:
            out.write.mode("overwrite").parquet(args.out)
            return out
    out.show(truncate=False)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
