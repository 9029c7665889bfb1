"""Day-over-day balance alerts on the latest snapshot day."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions.change import (
    FIRST_DAY_TEXT, MISSING_TEXT, THRESHOLD_PERCENT, exceeds, money_text, pct_change, pct_text,
)

MONTH = "snapshot_month"


def latest_snapshot_date(snapshot: DataFrame) -> DataFrame:
    """One row: the latest day, NULL for an empty snapshot.

    This reads the days of the whole snapshot. A refresh of stored marts knows its
    latest day and stores it beside them.
    """
    return snapshot.agg(F.max("snapshot_date").alias("latest_snapshot_date"))


def balance_day_pairs(snapshot: DataFrame, latest: Column | None = None) -> DataFrame:
    """Current and previous balance per organisation on the latest day.

    ``latest`` should be given where it is known, as a literal or the scalar of a
    stored row; a stored snapshot is then read in one or two months only. The
    two days are selected before the window, so only they are sorted. Series
    have no gaps, hence the previous row is the previous day; a series that
    starts on the latest day has a NULL previous balance.
    """
    if latest is None:
        latest = latest_snapshot_date(snapshot).scalar()
    two_days = snapshot.where(F.col("snapshot_date").between(F.date_sub(latest, 1), latest))
    if MONTH in snapshot.columns:
        two_days = two_days.where(
            F.col(MONTH).between(F.trunc(F.date_sub(latest, 1), "MM"), F.trunc(latest, "MM"))
        )
    by_day = Window.partitionBy("organization_id").orderBy("snapshot_date")
    balance = F.col("cumulative_net_financial_balance_usd")
    return two_days.select(
        "snapshot_date",
        "organization_id",
        balance.alias("current_balance"),
        F.lag(balance, 1).over(by_day).alias("previous_day_balance"),
    ).where(F.col("snapshot_date") == latest)


def balance_changes(segments: DataFrame) -> DataFrame:
    """Day pairs of the whole history, of the days on which a balance segment starts.

    On every other day the balance is that of the day before, which is no change and
    never an alert, so no day has to be generated. Segments follow each other without
    gaps: the previous one ends on the previous day. The lag runs in the partitions of
    the running sum that made the segments.
    """
    by_day = Window.partitionBy("organization_id").orderBy("valid_from")
    return segments.select(
        F.col("valid_from").alias("snapshot_date"),
        "organization_id",
        F.col("balance_usd").alias("current_balance"),
        F.lag("balance_usd", 1).over(by_day).alias("previous_day_balance"),
    )


def balance_pct_change(pairs: DataFrame) -> DataFrame:
    """Day pairs with their percentage change."""
    return pairs.withColumn("pct_change", _change(pct_change))


def balance_change_alerts(
    pairs: DataFrame, threshold: Decimal = THRESHOLD_PERCENT
) -> DataFrame:
    """Organisations whose balance moved by strictly more than ``threshold`` percent."""
    from_zero = (F.col("previous_day_balance") == 0) & (F.col("current_balance") != 0)
    return (
        balance_pct_change(pairs)
        .where(_change(exceeds, threshold))
        .withColumn("from_zero", from_zero)
        .select(
            "organization_id",
            "snapshot_date",
            "previous_day_balance",
            "current_balance",
            "pct_change",
            "from_zero",
            money_text(F.col("previous_day_balance"), FIRST_DAY_TEXT).alias("previous_display"),
            money_text(F.col("current_balance"), MISSING_TEXT).alias("current_display"),
            _change(pct_text).alias("change_display"),
        )
    )


def alert_summary(pairs: DataFrame, threshold: Decimal = THRESHOLD_PERCENT) -> DataFrame:
    """One row: the day checked, organisations processed, alerts raised."""
    return pairs.agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.count(F.lit(1)).alias("organizations_processed"),
        F.count_if(_change(exceeds, threshold)).alias("alerts_raised"),
    )


def _change(function, *args) -> Column:
    return function(F.col("previous_day_balance"), F.col("current_balance"), *args)
