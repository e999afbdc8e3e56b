"""Late usage by touched days: the usage rollup kept in store and brought up to date.

The daily job reads its whole window of raw usage again because usage arrives late.  Here the
window's rollup is kept as partial states (decimal sums, maxima: they merge exactly), with a
list of the files each day was computed from.  A run compares that list with the files there
are now and touches only

* days that gained files and lost none: the new files alone are read, priced and merged in;
* days that lost or changed a file, days that are new to the store, days whose prices changed
  and days that an interrupted run left open: computed again from all their usage.

Everything else is neither read nor written.  ``refresh_rollup`` returns the window's rollup,
equal to ``usage_rollup(price_usage(...))`` over the same files.

What is stored below ``root`` (one folder for each cloud): ``rollup`` by month, ``files`` (a
row for each file and day: size, time, rows, first and last usage time), ``prices`` (the list
the states were priced with) and, while a run is under way, ``open`` (the days it touches).
Merging a file twice would count it twice, so ``open`` is written before the states change and
removed after ``files`` is: a run that finds it computes those days from their usage.

Defined results: usage without a day makes up a day of its own (NULL) where the run has no
bounds; a file that was written again with the same size and time counts as unchanged; empty
usage gives an empty rollup; a window that moves back over days it had left computes them anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.functions.expressions import PARTITION_COL
from ledger.operators.upsert import remove, replace_table, table_exists, touched_rows
from ledger.params import RunParams
from ledger.plans.cost import ROLLUP_KEYS, usage_rollup
from ledger.plans.pricing import price_usage, usage_window
from ledger.sources.schemas import LIST_PRICES, USAGE, conform

SUMS = ("usage_quantity", "billed_hours", "exact_cost")
FILE = ("file", "size", "modified")


def _same_day(a: str, b: str) -> Column:
    return F.col(f"{a}.usage_date").eqNullSafe(F.col(f"{b}.usage_date"))


def _same_file(a: str, b: str) -> Column:
    cond = _same_day(a, b)
    for c in FILE:
        cond = cond & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}"))
    return cond


def _without(a: DataFrame, b: DataFrame, cond) -> DataFrame:
    return a.alias("a").join(b.alias("b"), cond("a", "b"), "left_anti")


def usage_with_files(usage: DataFrame) -> DataFrame:
    """Usage in its declared types with the file each row came from; ``usage`` reads files."""
    at = F.col("_metadata")
    named = usage.select("*", at["file_path"].alias("file"), at["file_size"].alias("size"),
                         at["file_modification_time"].alias("modified"))
    return conform(named, USAGE, drop_extra=False).select(*USAGE.fieldNames(), *FILE)


def file_days(usage: DataFrame, p: RunParams) -> DataFrame:
    """One row for each file and day of the window.  The scan reads the day, the cloud and the
    usage time only, and row groups outside the window not at all."""
    return usage_window(usage, p).groupBy(*FILE, "usage_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("usage_start_time").alias("first_use"), F.max("usage_start_time").alias("last_use"))


def repriced_days(days: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Days of ``days`` with usage in the span of time of the versions that came, went or
    changed; versions without a beginning price nothing."""
    changed = before.exceptAll(now).unionAll(now.exceptAll(before)).where(F.col("price_start_time").isNotNull())
    span = changed.agg(
        F.min("price_start_time").alias("begin"), F.max("price_end_time").alias("end"),
        F.coalesce(F.bool_or(F.col("price_end_time").isNull()), F.lit(False)).alias("open")).first()
    if span["begin"] is None:
        return days.select("usage_date").where(F.lit(False))
    hit = F.col("last_use") >= F.lit(span["begin"])
    if not span["open"]:
        hit = hit & (F.col("first_use") <= F.lit(span["end"]))
    return days.where(hit).select("usage_date")


def merged(states: DataFrame, like: DataFrame) -> DataFrame:
    """Partial states of the same keys as one, in the types of ``like``."""
    out = states.groupBy(*ROLLUP_KEYS).agg(*(F.sum(c).alias(c) for c in SUMS), F.max("unit_price").alias("unit_price"))
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def refresh_rollup(spark: SparkSession, usage: DataFrame, list_prices: DataFrame, p: RunParams,
                   root: str) -> tuple[DataFrame, dict[str, int]]:
    """The window's usage rollup, and how many days were ``merged``, computed anew (``anew``)
    and left alone (``kept``).  ``usage`` must read files; both sources as they come."""
    root = f"{root.rstrip('/')}/{p.cloud}"
    paths = {name: f"{root}/{name}" for name in ("rollup", "files", "prices", "open", "listing")}
    usage = usage_with_files(usage)
    now = conform(list_prices, LIST_PRICES).where(F.col("cloud") == p.cloud)

    # The listing is staged, so one look at the files decides everything that follows.
    file_days(usage, p).write.mode("overwrite").parquet(paths["listing"])
    listed = spark.read.parquet(paths["listing"])
    left_open = spark.read.parquet(paths["open"]) if table_exists(spark, paths["open"]) else None
    first = not (table_exists(spark, paths["files"]) and table_exists(spark, paths["rollup"]))
    if first:
        new, anew = listed, [listed.select("usage_date")]
    else:
        known = usage_window(spark.read.parquet(paths["files"]).withColumn("cloud", F.lit(p.cloud)), p).drop("cloud")
        new = _without(listed, known, _same_file)
        anew = [_without(known, listed, _same_file).select("usage_date"),
                _without(new, known, _same_day).select("usage_date"),
                repriced_days(listed, conform(spark.read.parquet(paths["prices"]), LIST_PRICES), now)]
    if left_open is not None:
        anew.append(left_open.select("usage_date"))
    days = new.select("usage_date", F.lit(False).alias("anew"))
    for part in anew:
        days = days.unionAll(part.select("usage_date", F.lit(True).alias("anew")))
    replace_table(days.groupBy("usage_date").agg(F.bool_or("anew").alias("anew")), paths["open"])

    days = spark.read.parquet(paths["open"])
    whole, partly = days.where("anew").select("usage_date"), days.where(~F.col("anew")).select("usage_date")
    n_listed = listed.agg(F.count_distinct(F.struct("usage_date"))).first()[0]
    n_anew, n_merged = days.agg(F.count_if("anew"), F.count_if(~F.col("anew"))).first()
    parts = []
    if n_anew:
        parts.append(touched_rows(usage, whole, "usage_date"))
    if n_merged:
        pairs = new.alias("a").join(partly.alias("b"), _same_day("a", "b"), "left_semi")
        since = pairs.agg(F.min("modified")).first()[0]  # older files are not opened
        parts.append(usage.where(F.col("modified") >= F.lit(since)).alias("a").join(pairs.alias("b"), _same_file("a", "b"), "left_semi"))
    if parts:
        rows = parts[0].unionAll(parts[1]) if len(parts) > 1 else parts[0]
        fresh = usage_rollup(price_usage(rows, now, p))
        if first:
            out = fresh.withColumn(PARTITION_COL, F.trunc("usage_date", "month"))
        else:
            stored = spark.read.schema(_stored_schema(fresh)).parquet(paths["rollup"])
            months = days.select(F.trunc("usage_date", "month").alias(PARTITION_COL)).distinct()
            near = touched_rows(stored, months, PARTITION_COL)
            old = near.alias("a").join(partly.alias("b"), _same_day("a", "b"), "left_semi").select(*fresh.columns)
            same = _without(near, days, _same_day).select(*fresh.columns)
            out = same.unionByName(merged(old.unionByName(fresh), fresh)).withColumn(PARTITION_COL, F.trunc("usage_date", "month"))
        (out.hint("rebalance", PARTITION_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PARTITION_COL).parquet(paths["rollup"]))
        spark.catalog.refreshByPath(paths["rollup"])
    replace_table(now, paths["prices"])
    replace_table(listed, paths["files"])
    remove(spark, paths["open"])
    remove(spark, paths["listing"])

    # A month whose last file went keeps its old folder: only days that have files count.
    plan = usage_rollup(price_usage(usage, now, p))
    have = spark.read.parquet(paths["files"]).select("usage_date").distinct()
    if not table_exists(spark, paths["rollup"]):
        return plan.where(F.lit(False)), {"merged": 0, "anew": 0, "kept": 0}
    rollup = touched_rows(spark.read.schema(_stored_schema(plan)).parquet(paths["rollup"]), have, "usage_date").select(*plan.columns)
    return rollup, {"merged": n_merged, "anew": n_anew, "kept": max(n_listed - n_merged - n_anew, 0)}


def _stored_schema(rollup: DataFrame):
    return rollup.withColumn(PARTITION_COL, F.trunc("usage_date", "month")).schema
