"""Distinct days and clusters of any range of months, from states that merge exactly.

COUNT(DISTINCT) over a year reads the year's rows.  Here a month keeps

* the days with rows, one bit a day of a 31-bit mask (months share no day, so counts add up);
* the clusters with rows, one bit a cluster in bitmaps of 32,768 clusters each.  Clusters
  are numbered densely from 1 and keep their number, so the bitmaps of months can be united.

A range of months is then a union of bitmaps and a count of bits: exact, and its cost grows
with months x clusters / 32,768, not with rows.  NULL days and clusters count for nothing, as
in COUNT(DISTINCT); a range without rows counts 0.

* ``day_masks``, ``cluster_bitmaps``   states of each month, one hash aggregate each
* ``trailing_clusters``                clusters of each month and of the 12 months up to it
* ``refresh_months``, ``range_counts`` the states in store and a range read from them
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.functions.expressions import PARTITION_COL, on_or_after
from ledger.operators.upsert import remove, table_exists, with_dense_ids
from ledger.session import checkpoint_dir

NUMBERS = "cluster_id string, number long"


def day_masks(facts: DataFrame) -> DataFrame:
    """``usage_month, days``: bit d - 1 is set where the month has rows on its day d."""
    day = F.call_function("shiftleft", F.lit(1), F.dayofmonth("usage_date") - 1)
    return facts.where(F.col("usage_date").isNotNull()).groupBy(F.trunc("usage_date", "month").alias(PARTITION_COL)).agg(F.bit_or(day).alias("days"))


def numbered_clusters(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Numbers for the clusters of ``facts`` that ``known`` (``NUMBERS``) lacks, on top of its own."""
    new = facts.select("cluster_id").where(F.col("cluster_id").isNotNull()).distinct().join(known, "cluster_id", "left_anti")
    return with_dense_ids(known, new, "number", ["cluster_id"])


def cluster_bitmaps(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """``usage_month, bucket, clusters``: a bitmap for each month and 32,768 numbers.

    A month's clusters are made distinct first, so a busy cluster sends one row a map task."""
    used = facts.where(F.col("usage_date").isNotNull()).select(F.trunc("usage_date", "month").alias(PARTITION_COL), "cluster_id").distinct()
    return (
        used.join(numbers, "cluster_id")
        .groupBy(PARTITION_COL, F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("clusters"))
    )


def trailing_clusters(bitmaps: DataFrame, months: int = 12) -> DataFrame:
    """``usage_month, clusters, trailing_clusters`` for each month that has a bitmap: its
    distinct clusters, and those of the ``months`` calendar months that end with it.

    A bitmap counts for the months it is within reach of; months without rows get none."""
    each = bitmaps.groupBy(PARTITION_COL).agg(F.sum(F.bitmap_count("clusters")).alias("clusters"))
    later = F.explode(F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: F.add_months(PARTITION_COL, k)))
    reach = bitmaps.select(later.alias("month"), "bucket", F.col("clusters").alias("some"))
    united = reach.groupBy("month", "bucket").agg(F.bitmap_or_agg("some").alias("all"))
    trailing = united.groupBy(F.col("month").alias(PARTITION_COL)).agg(F.sum(F.bitmap_count("all")).alias("trailing_clusters"))
    return each.join(trailing, PARTITION_COL)


def refresh_months(spark: SparkSession, facts: DataFrame, root: str, since: dt.date | None = None) -> None:
    """Bring the states below ``root`` up to date for the months from that of ``since`` on (None:
    all).  Other months are neither read nor written.  New clusters are numbered first; a run
    that fails after that finds them known.  Months whose rows all went keep their state (the
    fact tables never lose rows)."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in ("numbers", "days", "clusters")}
    if since is not None:
        facts = on_or_after(facts, "usage_date", F.lit(since.replace(day=1)))
    known = spark.read.schema(NUMBERS).parquet(paths["numbers"]) if table_exists(spark, paths["numbers"]) else spark.createDataFrame([], NUMBERS)
    stage = f"{checkpoint_dir(spark).rstrip('/')}/numbers-{uuid.uuid4().hex}"
    numbered_clusters(facts, known).write.parquet(stage)
    spark.read.schema(NUMBERS).parquet(stage).write.mode("append").parquet(paths["numbers"])
    remove(spark, stage)
    numbers = spark.read.schema(NUMBERS).parquet(paths["numbers"])
    for name, states in (("days", day_masks(facts)), ("clusters", cluster_bitmaps(facts, numbers))):
        (states.hint("rebalance", PARTITION_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PARTITION_COL).parquet(paths[name]))
        spark.catalog.refreshByPath(paths[name])


def range_counts(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    """One row, ``days, clusters``: distinct over the months from that of ``first`` to that of
    ``last``.  Only the states are read, and of them only the range's months."""
    def inside(name: str, schema: str) -> DataFrame:
        at = spark.read.schema(f"{schema}, {PARTITION_COL} date").parquet(f"{root.rstrip('/')}/{name}")
        return at.where(F.col(PARTITION_COL).between(F.lit(first.replace(day=1)), F.lit(last)))

    united = inside("clusters", "bucket long, clusters binary").groupBy("bucket").agg(F.bitmap_or_agg("clusters").alias("all"))
    clusters = united.agg(F.coalesce(F.sum(F.bitmap_count("all")), F.lit(0)).alias("n"))
    days = inside("days", "days int").agg(F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("long").alias("days"))
    return days.withColumn("clusters", clusters.scalar())
