"""The stored usage rollup, brought up to date by touched days, equals a full recompute."""

import datetime as dt
import pathlib

import pytest

from helpers import price_rows, usage_rows
from ledger.params import RunParams
from ledger.plans import cost, late, pricing

P = RunParams(as_of=dt.date(2024, 3, 31), lookback_days=90)
PRICES = [("A", "GCP", "2024-01-01 00:00:00", "2024-03-01 00:00:00", 0.5, None),
          ("A", "GCP", "2024-03-01 00:00:00", None, 0.7, 0.6),
          ("B", "GCP", "2024-01-01 00:00:00", None, 2, None)]


def _use(day, sku="A", qty=1, cluster="c1", cloud="GCP"):
    return (day, f"{day} 10:00:00", f"{day} 11:30:00", sku, "JOBS", cloud, 7, None, cluster, qty)


@pytest.fixture()
def world(spark, tmp_path):
    raw, root = str(tmp_path / "usage"), str(tmp_path / "state")

    class World:
        prices = PRICES

        def add(self, *rows):
            before = self.files()
            usage_rows(spark, rows).coalesce(1).write.mode("append").parquet(raw)
            return (self.files() - before).pop()

        def files(self):
            return set(pathlib.Path(raw).glob("*.parquet"))

        def run(self, p=P):
            spark.catalog.refreshByPath(raw)
            got, days = late.refresh_rollup(spark, spark.read.parquet(raw), price_rows(spark, self.prices), p, root)
            want = cost.usage_rollup(pricing.price_usage(spark.read.parquet(raw), price_rows(spark, self.prices), p))
            assert got.schema.simpleString() == want.schema.simpleString()
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            assert not pathlib.Path(root, p.cloud, "open").exists()
            return days

    return World()


def _gone(path):
    path.unlink()
    crc = path.with_name(f".{path.name}.crc")
    if crc.exists():
        crc.unlink()


def test_late_usage_is_merged_and_nothing_else_is_touched(world):
    world.add(_use("2024-01-10"), _use("2024-02-10", "B", 3), _use("2024-03-10"), _use("2024-03-10", cluster=None))
    assert world.run() == {"merged": 0, "anew": 3, "kept": 0}
    assert world.run() == {"merged": 0, "anew": 0, "kept": 3}
    world.add(_use("2024-02-10", "B", 4), _use("2024-02-10", "A", "0.000001"), _use("2024-03-11"))
    assert world.run() == {"merged": 1, "anew": 1, "kept": 2}   # 02-10 merged, 03-11 is a new day
    assert world.run() == {"merged": 0, "anew": 0, "kept": 4}


def test_repeated_and_deleted_files(world):
    world.add(_use("2024-02-01"), _use("2024-03-01"))
    late_file = world.add(_use("2024-02-01", qty=5), _use("2024-02-02", qty=5))
    world.run()
    again = world.add(_use("2024-02-01", qty=5), _use("2024-02-02", qty=5))   # the same rows delivered twice count twice
    assert world.run() == {"merged": 2, "anew": 0, "kept": 1}
    _gone(again)
    assert world.run() == {"merged": 0, "anew": 2, "kept": 1}
    _gone(late_file)                                                          # 02-02 has no file any more
    assert world.run()["anew"] == 2
    world.add(_use("2024-02-02", qty=9))
    assert world.run() == {"merged": 0, "anew": 1, "kept": 2}


def test_a_month_without_any_file_left_is_gone(world):
    world.add(_use("2024-03-01"))
    lone = world.add(_use("2024-01-20"))
    world.run()
    _gone(lone)
    world.run()


def test_changed_prices_touch_the_days_they_price(world):
    world.add(_use("2024-01-10"), _use("2024-02-10", "B"), _use("2024-03-10"))
    world.run()
    world.prices = PRICES[:1] + [("A", "GCP", "2024-03-01 00:00:00", None, 0.9, None)] + PRICES[2:]
    assert world.run() == {"merged": 0, "anew": 1, "kept": 2}
    world.prices = world.prices + [("C", "AWS", "2024-01-01 00:00:00", None, 1, None)]   # another cloud's list
    assert world.run() == {"merged": 0, "anew": 0, "kept": 3}


def test_window_and_cloud(world):
    world.add(_use("2023-06-01"), _use("2024-03-10"), _use("2024-04-02"), _use("2024-03-10", cloud="AWS"))
    assert world.run()["anew"] == 1
    later = RunParams(as_of=dt.date(2024, 4, 2), lookback_days=90)
    assert world.run(later) == {"merged": 0, "anew": 1, "kept": 1}
    assert world.run(RunParams(as_of=dt.date(2024, 4, 2), lookback_days=None, bounded=False))["anew"] == 1
    assert world.run(RunParams(as_of=dt.date(2024, 3, 31), cloud="AWS"))["anew"] == 1
    assert world.run(P) == {"merged": 0, "anew": 0, "kept": 1}
    world.add(_use("2024-04-02"), _use("2024-03-10"))
    assert world.run(later) == {"merged": 1, "anew": 1, "kept": 0}   # the last run did not list 04-02


@pytest.mark.parametrize("table", ["prices", "files"])
def test_an_interrupted_run_is_mended(world, monkeypatch, table):
    world.add(_use("2024-02-10"), _use("2024-03-10"))
    world.run()
    world.add(_use("2024-02-10", qty=4))
    real = late.replace_table

    def broken(df, path):
        if path.endswith(table):
            raise OSError("lost")
        real(df, path)

    monkeypatch.setattr(late, "replace_table", broken)
    with pytest.raises(OSError):
        world.run()
    monkeypatch.setattr(late, "replace_table", real)
    assert world.run() == {"merged": 0, "anew": 1, "kept": 1}   # merged already, so computed from its usage


def test_no_usage_at_all(world):
    world.add()
    assert world.run() == {"merged": 0, "anew": 0, "kept": 0}
    world.add(_use("2024-03-10"))
    assert world.run() == {"merged": 0, "anew": 1, "kept": 0}


def test_merging_opens_new_files_only(spark, world, tmp_path):
    world.add(_use("2024-02-10"), _use("2024-03-10"))
    usage = late.usage_with_files(spark.read.parquet(str(tmp_path / "usage")))
    plan = usage.where("modified >= timestamp'2999-01-01'")
    assert plan._jdf.queryExecution().toRdd().getNumPartitions() == 0   # the files' times prune the scan
    assert usage._jdf.queryExecution().toRdd().getNumPartitions() > 0
