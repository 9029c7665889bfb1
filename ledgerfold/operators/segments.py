"""Balances as segments: one row per stretch of days with the same balance.

Only days with activity are shuffled and sorted; days are generated last, on
the executors that hold the segments.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.operators.balances import (
    check_scope, days_between, last_day, shuffle_tasks, zero_usd,
)
from ledgerfold.schemas import USD, with_comments


def spine_start(as_of: date, spine_scope: str = "paid") -> Column:
    """Aggregate of the daily activity: the first day of the spine, ``as_of`` if there is none."""
    paid = F.col("has_paid")
    # For "all", every day opens the spine; has_paid is never NULL.
    opens = paid if check_scope(spine_scope) == "paid" else paid.isNotNull()
    in_time = F.col("transaction_date") < F.lit(as_of)
    return F.coalesce(F.min(F.when(opens & in_time, F.col("transaction_date"))), F.lit(as_of))


def _moves(start: Column) -> Column:
    """The change that enters the balance: none before the spine, nor for a missing organisation."""
    in_spine = F.col("has_paid") | (F.col("transaction_date") >= start)
    known = F.col("organization_id").isNotNull()
    return F.when(in_spine & known, F.col("daily_net_change_usd")).otherwise(zero_usd())


def balance_segments(
    days: DataFrame, as_of: date, spine_scope: str = "paid", start: Column | None = None
) -> DataFrame:
    """(organization_id, valid_from, valid_to, net_change_usd, balance_usd) rows.

    ``days`` is the daily activity, lazy or stored. Activity before the spine
    start is moved to the start with a change of 0: it opens the organisation's
    series but enters no balance. Where several days land on the start, all but
    the last give an empty stretch and go.

    The spine start is a scalar subquery over the same activity. A day with a
    payment is in the spine by definition; testing ``has_paid`` first says so
    and keeps the column in every plan, so that both uses of lazy activity have
    the same exchange, Spark runs it once, and the invoices are scanned once.
    From stored activity the subquery reads two columns. ``start`` gives the day where
    it is known, as it must be if ``days`` are those of some organisations only.
    """
    days = days.where(F.col("transaction_date") < F.lit(as_of))
    paid = F.col("has_paid")
    if start is None:
        start = days.agg(spine_start(as_of, spine_scope)).scalar()
    by_day = Window.partitionBy("organization_id").orderBy("transaction_date")
    history = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A row here becomes many days. A fixed partition count keeps adaptive
    # execution from merging these small partitions and generating in few tasks.
    tasks = shuffle_tasks(days)
    return (
        days.select(
            "organization_id",
            "transaction_date",
            F.when(paid, F.col("transaction_date"))
            .otherwise(F.greatest("transaction_date", start))
            .alias("valid_from"),
            _moves(start).alias("net_change_usd"),
        )
        .repartition(tasks, "organization_id")
        .select(
            "organization_id",
            "valid_from",
            F.coalesce(
                F.date_sub(F.lead("valid_from").over(by_day), 1), F.lit(last_day(as_of))
            ).alias("valid_to"),
            "net_change_usd",
            F.sum("net_change_usd").over(history).cast(USD).alias("balance_usd"),
        )
        .where(F.col("valid_from") <= F.col("valid_to"))
    )


def closing_balances(days: DataFrame, start: Column) -> DataFrame:
    """(organization_id, balance_usd) at the end of the activity, for a known start of the spine."""
    dated = days.where(F.col("transaction_date").isNotNull())
    return dated.groupBy("organization_id").agg(F.sum(_moves(start)).cast(USD).alias("balance_usd"))


def later_segments(balances: DataFrame, days: DataFrame, since: date, as_of: date) -> DataFrame:
    """Segments from ``since`` on, a day inside the spine, of the balances of the day before and what moved since.

    Each organisation with a balance goes on; one without starts on its first day.
    """
    first, last = F.lit(since), F.lit(as_of)
    going_on = balances.select(
        "organization_id", first.alias("valid_from"), zero_usd().alias("net_change_usd"), "balance_usd"
    )
    moved = days.where((F.col("transaction_date") >= first) & (F.col("transaction_date") < last)).select(
        "organization_id", F.col("transaction_date").alias("valid_from"), _moves(first).alias("net_change_usd"),
        _moves(first).alias("balance_usd"),
    )
    by_day = Window.partitionBy("organization_id").orderBy("valid_from")
    history = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = going_on.unionAll(moved).groupBy("organization_id", "valid_from").agg(
        F.sum("net_change_usd").cast(USD).alias("net_change_usd"), F.sum("balance_usd").cast(USD).alias("balance_usd"),
    )
    return daily.select(
        "organization_id",
        "valid_from",
        F.coalesce(F.date_sub(F.lead("valid_from").over(by_day), 1), F.lit(last_day(as_of))).alias("valid_to"),
        "net_change_usd",
        F.sum("balance_usd").over(history).cast(USD).alias("balance_usd"),
    )


def expand_days(
    segments: DataFrame, first: date | Column | None = None, keep: Sequence[str] = (), last: Column | None = None
) -> DataFrame:
    """Daily snapshot rows of the segments, optionally only from ``first`` on and up to ``last``."""
    lower, upper = F.col("valid_from"), F.col("valid_to")
    if first is not None:
        lower = F.greatest(lower, first if isinstance(first, Column) else F.lit(first))
    if last is not None:
        upper = F.least(upper, last)
    if first is not None or last is not None:
        segments = segments.where(lower <= upper)
    daily = segments.select("*", days_between(lower, upper).alias("snapshot_date")).select(
        "snapshot_date",
        "organization_id",
        F.when(F.col("snapshot_date") == F.col("valid_from"), F.col("net_change_usd"))
        .otherwise(zero_usd())
        .alias("daily_net_change_usd"),
        F.col("balance_usd").alias("cumulative_net_financial_balance_usd"),
        *keep,
    )
    return with_comments(daily, "fct_daily_financial_snapshot")


def split_by_month(segments: DataFrame) -> DataFrame:
    """Segments cut at month ends, with their month; only the first piece moves."""
    month = F.col("snapshot_month")
    first_month = F.trunc("valid_from", "MM")
    months = F.sequence(first_month, F.col("valid_to"), F.expr("INTERVAL 1 MONTH"))
    begins = month == first_month
    return segments.select("*", F.explode_outer(months).alias("snapshot_month")).select(
        "organization_id",
        F.greatest("valid_from", month).alias("valid_from"),
        F.least("valid_to", F.last_day(month)).alias("valid_to"),
        F.when(begins, F.col("net_change_usd")).otherwise(zero_usd()).alias("net_change_usd"),
        "balance_usd",
        "snapshot_month",
    )
