"""Type-2 (validity interval) joins and sweeps: the version active at a fact's time, and the
stretches of time in which several versions are active."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def planned_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of ``df`` (files, staged tables) lets it be broadcast.  Asks
    the optimizer only; no job runs."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) if not text.startswith("-") else -1
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit >= 0 and int(str(size)) <= limit


def scd2_left_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    span: tuple[Column, Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``facts LEFT JOIN versions ON keys AND at >= start AND (end IS NULL OR at < end)``.

    The interval is half-open and an open ``end`` (NULL) means "still valid".  Facts with
    no active version keep NULL version columns; overlapping versions fan out (the
    reference's behaviour, see ``price_overlap_check``).

    Physical plan: the equi keys drive a hash join and the interval test is a residual
    predicate.  Versions whose planned size is small are broadcast as they are.  Others meet
    the facts in time buckets: the facts' span (``span``, else the smallest and largest
    ``at``, a scalar subquery) is cut into ``buckets`` (the session's shuffle partitions)
    equal stretches, and each version is repeated for exactly those that its interval
    covers.  Both sides shuffle on keys and bucket, so the facts of one hot key are dealt over
    all partitions, each with the versions of its own stretch of time only.  Times outside of
    the span belong to its first and last bucket on both sides, so the span decides about
    balance, never about the result.
    """
    renamed = [F.col(k).alias(f"__v_{k}") for k in keys]
    extra = [c for c in versions.columns if c not in keys]
    cond = [F.col(k) == F.col(f"__v_{k}") for k in keys]
    cond += [F.col(at) >= F.col(start), F.col(end).isNull() | (F.col(at) < F.col(end))]
    own = [f"__v_{k}" for k in keys]
    if planned_broadcast(versions):
        return facts.join(versions.select(*renamed, *extra), on=cond, how="left").drop(*own)

    n = buckets or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, high = span or (facts.agg(F.min(at)).scalar(), facts.agg(F.max(at)).scalar())

    def bucket(time: Column) -> Column:
        seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
        width = F.greatest(F.ceil((seconds(F.col("__high")) - seconds(F.col("__low")) + 1) / n), F.lit(1))
        return F.least(F.greatest(F.floor((seconds(time) - seconds(F.col("__low"))) / width), F.lit(0)), F.lit(n - 1)).cast("int")

    def bounded(df: DataFrame) -> DataFrame:
        return df.withColumn("__low", low).withColumn("__high", high)

    last = F.when(F.col(end).isNull(), F.lit(n - 1)).otherwise(bucket(F.col(end)))
    covered = F.when(F.col(end).isNull() | (F.col(start) < F.col(end)), F.sequence(bucket(F.col(start)), last))
    v = bounded(versions).select(*renamed, *extra, F.explode(covered).alias("__v_part"))
    f = bounded(facts).withColumn("__part", bucket(F.col(at))).drop("__low", "__high")
    return f.join(v, on=[*cond, F.col("__part") == F.col("__v_part")], how="left").drop(*own, "__v_part", "__part")


def overlapping_stretches(versions: DataFrame, keys: Sequence[str], start: str, end: str, name: str = "active") -> DataFrame:
    """``keys, start, end, name``: the stretches of time in which two or more distinct versions
    of a key are active, and how many.

    A sweep over the versions alone: each begins (+1) and ends (-1); the running sum over a
    key's times is the number active until the next time.  The stretches of a key do not
    overlap each other; an open one has a NULL end."""
    own = versions.select(*keys, start, end).where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end)))).distinct()
    events = own.select(*keys, F.inline(F.array(F.struct(F.col(start).alias("__at"), F.lit(1).alias("__step")),
                                                F.struct(F.col(end).alias("__at"), F.lit(-1).alias("__step"))))).where(F.col("__at").isNotNull())
    steps = events.groupBy(*keys, "__at").agg(F.sum("__step").alias("__step"))
    by_time = Window.partitionBy(*keys).orderBy("__at")
    swept = steps.select(*keys, F.col("__at").alias(start), F.lead("__at").over(by_time).alias(end),
                         F.sum("__step").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias(name))
    return swept.where(F.col(name) > 1)
