"""The command line runs the jobs and reports against Parquet source tables."""

from helpers import SMALL
from ledger.__main__ import main
from ledger.registry import QUERIES, boundary
from ledger.sources import fixtures


def test_cli_daily_alerts_report(spark, tmp_path):
    src = fixtures.load(spark, SMALL)
    paths = {}
    for name in ("usage", "list_prices", "node_timeline", "clusters", "node_types", "alert_config"):
        paths[name] = str(tmp_path / "src" / name)
        getattr(src, name).write.parquet(paths[name])
    wh = str(tmp_path / "wh")
    common = ["--warehouse", wh, "--as-of", "2000-06-30"]
    cfg = main(["setup", *common, "--threshold", "300", "--recipients", "ops@example.com"], spark).collect()
    assert [(r.config_id, float(r.daily_threshold_dollars)) for r in cfg] == [(1, 300.0)]
    main(["daily", *common, "--usage", paths["usage"], "--list-prices", paths["list_prices"],
          "--node-timeline", paths["node_timeline"], "--clusters", paths["clusters"],
          "--node-types", paths["node_types"], "--lookback-days", "-1"], spark)
    before = spark.read.parquet(f"{wh}/daily_cost_summary").collect()
    main(["daily", *common, "--usage", paths["usage"], "--list-prices", paths["list_prices"],
          "--node-timeline", paths["node_timeline"], "--clusters", paths["clusters"],
          "--node-types", paths["node_types"], "--touched-days", "--config-as-of"], spark)
    assert sorted(map(str, spark.read.parquet(f"{wh}/daily_cost_summary").collect())) == sorted(map(str, before))
    gate = main(["alerts", *common, "--alert-config", paths["alert_config"]], spark).collect()[0]
    assert gate.alerts_sent == 0                                   # sf0.001 stays below the first tier
    own = main(["alerts", *common], spark).collect()[0]            # the warehouse's own config (setup)
    assert own.daily_threshold == 300.0
    out = str(tmp_path / "top")
    main(["report", "top_skus", *common, "--month", "Jun 2000", "--out", out], spark)
    got = boundary(spark.read.parquet(out))
    want = QUERIES["top_skus"](spark, SMALL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    changed = main(["config", *common, "--set", "daily_threshold_dollars=42", "--set", "is_active=false"], spark).collect()
    assert [(float(r.daily_threshold_dollars), r.is_active, r.recipient_emails) for r in changed] == [(42.0, False, "ops@example.com")]
    for name in ("vm_cost_by_source", "price_source_counts", "recent_alerts"):
        main(["report", name, *common, "--out", str(tmp_path / name)], spark)
    assert spark.read.parquet(str(tmp_path / "vm_cost_by_source")).count() > 0
    assert spark.read.parquet(str(tmp_path / "price_source_counts")).count() > 0
