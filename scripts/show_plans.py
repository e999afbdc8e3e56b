"""Print the formatted physical plans of the main operators.

    python scripts/show_plans.py [sf_dir] [name ...]

Names: summary, details, vm, today, top_skus_stored, upsert_stored.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledger.params import RunParams  # noqa: E402
from ledger.plans import reports  # noqa: E402
from ledger.plans.jobs import with_month  # noqa: E402
from ledger.registry import Chain  # noqa: E402
from ledger.session import local_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="ledger-plans-")
    spark = local_session(8, 16, checkpoint=f"{scratch}/ck")
    c = Chain(spark, sf)
    path = f"{scratch}/summary"
    with_month(c.summary).write.partitionBy("usage_month").parquet(path)
    stored = spark.read.parquet(path)
    frames = {
        "summary": lambda: c.summary,
        "details": lambda: c.details,
        "vm": lambda: c.vm,
        "today": lambda: c.today,
        "top_skus_stored": lambda: reports.top_skus(stored, "Jun 2000", dt.date(2000, 6, 30)),
        "details_stored": lambda: __import__("ledger.plans.cost", fromlist=["x"]).sku_daily_details(
            stored, RunParams(as_of=dt.date(2000, 6, 30), lookback_days=90)),
    }
    for name in args or list(frames):
        print(f"==================== {name}")
        frames[name]().explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
