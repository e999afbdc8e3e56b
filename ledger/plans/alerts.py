"""Budget-tier alerts as one lazy plan.

The reference collects the config, today's cost and the sent set to the driver and loops
over tiers in Python.  Here they stay DataFrames: config (1 row) x tiers (explode) x
cost (1 row) -> filter -> anti join with the history -> append with ids.

* ``alert_config_upsert`` / ``alert_config_update``   deploy-time MERGE and manual UPDATE (P16, B8)
* ``active_config``       first active config by id (P17)
* ``alert_tiers``         CSV tiers -> one row per tier
* ``today_cost``          one day's cost and % of threshold (P18)
* ``crossed_tiers``       tiers whose amount the cost reaches (P19)
* ``new_alerts``          crossed minus already SENT today, severity, subject (P20)
* ``alert_history_append`` history plus the new rows with surrogate ids (P21)
* ``alert_gate``          one row: cost, threshold, count, max tier, all sent that day (P22)
* ``recent_alerts``       newest history rows with display time (P23)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.functions.expressions import csv_ints, display_time, on_date, severity
from ledger.operators.upsert import update_where, upsert_columns, with_new_ids
from ledger.sources.schemas import ALERT_CONFIG, ALERT_CONFIG_KEYS, ALERT_HISTORY, conform


def alert_config_upsert(config: DataFrame, new_rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Deploy-time MERGE on ``config_id``: a match takes the new threshold, recipients and
    tiers, is re-activated and gets a new ``updated_at``; ``created_at`` is kept.  New ids
    are inserted as given."""
    now = now if now is not None else F.current_timestamp()
    new_rows = conform(new_rows, ALERT_CONFIG)
    return upsert_columns(
        conform(config, ALERT_CONFIG),
        new_rows,
        ALERT_CONFIG_KEYS,
        {
            "daily_threshold_dollars": "daily_threshold_dollars",
            "recipient_emails": "recipient_emails",
            "is_active": F.lit(True),
            "threshold_percentages": "threshold_percentages",
            "updated_at": now,
        },
    )


def alert_config_update(config: DataFrame, config_id: int, **values) -> DataFrame:
    """``UPDATE alert_config SET <values>, updated_at = now WHERE config_id = :id``."""
    now = values.pop("updated_at", F.current_timestamp())
    assignments = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()}
    assignments["updated_at"] = now if isinstance(now, Column) else F.lit(now)
    return update_where(config, F.col("config_id") == config_id, assignments)


def active_config(config: DataFrame) -> DataFrame:
    """First active config by id (``ORDER BY config_id LIMIT 1``) — at most one row.

    Written as ``config_id = (SELECT MIN(config_id) ...)``: a scalar aggregate instead of
    a sort of the config table; ``limit(1)`` keeps the single-row guarantee.
    """
    active = config.where(F.col("is_active") == True)  # noqa: E712
    first = active.agg(F.min("config_id")).scalar()
    return active.where(F.col("config_id") == first).limit(1)


def alert_tiers(config: DataFrame) -> DataFrame:
    """One row per listed tier of each config row (a repeated tier is listed twice)."""
    return config.select("config_id", F.explode(csv_ints(F.col("threshold_percentages"))).alias("threshold_pct"))


def today_cost(summary: DataFrame, as_of: dt.date, config: DataFrame) -> DataFrame:
    """``COALESCE(SUM(total_cost_usd), 0)`` for ``as_of`` joined to the active config.

    The day's total is a global aggregate used as a scalar subquery: computed once,
    attached to each config row without a join.
    """
    cost = on_date(summary, "usage_date", as_of).agg(
        F.coalesce(F.sum("total_cost_usd"), F.lit(0)).alias("today_cost")
    )
    thr = F.col("daily_threshold_dollars").cast("double")
    return (
        config.withColumn("today_cost", cost.scalar())
        .withColumn("usage_date", F.lit(as_of))
        .withColumn(
            "pct_consumed",
            F.when(thr > 0, F.col("today_cost").cast("double") / thr * 100).otherwise(F.lit(0.0)),
        )
    )


def crossed_tiers(cost: DataFrame) -> DataFrame:
    """Tiers with ``today_cost >= threshold * pct / 100`` (floating point, like the
    reference).  A non-positive threshold yields nothing (T26)."""
    thr = F.col("daily_threshold_dollars").cast("double")
    return (
        cost.select("*", F.explode(csv_ints(F.col("threshold_percentages"))).alias("threshold_pct"))
        .withColumn("threshold_amount", thr * (F.col("threshold_pct") / F.lit(100.0)))
        .where((thr > 0) & (F.col("today_cost").cast("double") >= F.col("threshold_amount")))
    )


def new_alerts(crossed: DataFrame, history: DataFrame, cloud: str = "GCP", as_of: dt.date | None = None) -> DataFrame:
    """Crossed tiers not yet logged as SENT for that day (FAILED ones fire again).

    With ``as_of`` (the checked day) only that day's history is read — a filter that
    reaches the scan — instead of a distinct over the whole history.
    """
    hist = history if as_of is None else history.where(F.col("alert_date") == F.lit(as_of))
    sent = (
        hist.where(F.col("status") == "SENT")
        .select(F.col("alert_date").alias("usage_date"), "threshold_pct")
        .distinct()
    )
    fresh = crossed.join(sent, ["usage_date", "threshold_pct"], "left_anti")
    cost2 = F.col("today_cost").cast("decimal(20,2)")
    thr2 = F.col("daily_threshold_dollars").cast("decimal(20,2)")
    subject = F.concat(
        F.lit("["), severity(), F.lit(f"] {cloud} cost alert: "),
        F.col("threshold_pct").cast("string"), F.lit("% of daily threshold reached ($"),
        F.format_number(cost2, 2), F.lit(" / $"), F.format_number(thr2, 2), F.lit(")"),
    )
    return fresh.select(
        F.col("usage_date").alias("alert_date"),
        "threshold_pct",
        cost2.alias("amount_at_alert"),
        F.col("threshold_amount").cast("decimal(20,2)").alias("threshold_amount"),
        thr2.alias("daily_threshold"),
        F.col("recipient_emails").alias("recipients"),
        severity().alias("severity"),
        subject.alias("subject"),
    )


def numbered_alerts(history: DataFrame, new: DataFrame, sent_at: Column | None = None,
                    status: str = "SENT") -> DataFrame:
    """The new alerts as history rows, ids continuing after the history's largest id."""
    rows = new.withColumn("sent_at", sent_at if sent_at is not None else F.current_timestamp()).withColumn(
        "status", F.lit(status)
    )
    numbered = with_new_ids(history, conform(rows, ALERT_HISTORY).drop("alert_id"), "alert_id",
                            ["alert_date", "threshold_pct"])
    return conform(numbered, ALERT_HISTORY)


def alert_history_append(history: DataFrame, new: DataFrame, sent_at: Column | None = None,
                         status: str = "SENT") -> DataFrame:
    """The history with the new alerts appended (ids after the largest existing id)."""
    hist = conform(history, ALERT_HISTORY)
    return hist.unionByName(numbered_alerts(hist, new, sent_at, status))


def sent_on(history: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: the number of alerts logged as SENT for a day."""
    return history.where((F.col("alert_date") == F.lit(as_of)) & (F.col("status") == "SENT")).agg(F.count(F.lit(1)).alias("sent"))


def alert_gate(new: DataFrame, cost: DataFrame, sent_before: Column) -> DataFrame:
    """The job's gate values in one row: cost, threshold, alerts fired, highest tier and all
    alerts sent that day.  Without an active config the row holds zeros.

    ``new`` is aggregated once, to one struct; ``sent_before`` counts the day's alerts of
    earlier runs."""
    fired = new.agg(F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("threshold_pct"), F.lit(0)).alias("pct"))).scalar()
    money = lambda c: F.round(F.coalesce(F.max(F.col(c).cast("double")), F.lit(0.0)), 2).alias(c)
    row = cost.agg(money("today_cost"), money("daily_threshold_dollars")).withColumn("fired", fired)
    return row.select(
        "today_cost",
        F.col("daily_threshold_dollars").alias("daily_threshold"),
        F.col("fired.n").alias("alerts_sent"),
        F.col("fired.pct").alias("max_pct"),
        (sent_before + F.col("fired.n")).alias("total_sent_today"),
    )


def recent_alerts(history: DataFrame, n: int = 5, tz: str = "Asia/Kolkata") -> DataFrame:
    """Newest ``n`` history rows (ties on ``sent_at`` by id), times shown in ``tz``."""
    return (
        history.orderBy(F.col("sent_at").desc_nulls_last(), F.col("alert_id").desc_nulls_last())
        .limit(n)
        .select(
            "alert_id",
            "alert_date",
            "threshold_pct",
            "amount_at_alert",
            "threshold_amount",
            "daily_threshold",
            "recipients",
            display_time(F.col("sent_at"), tz).alias("sent_at_ist"),
            "status",
        )
    )
