"""From raw tables to marts and alerts."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerfold.functions.change import THRESHOLD_PERCENT
from ledgerfold.operators import alerts, balances, quality, segments, staging
from ledgerfold.operators.balances import shuffle_tasks
from ledgerfold.sources.workspace import written


def daily_snapshot(
    stg: DataFrame,
    as_of: date,
    *,
    spine_scope: str = "paid",
    plan: str = "sparse",
    last_days: int | None = None,
) -> DataFrame:
    """Dense daily balance per organisation, up to the day before ``as_of``.

    To include a day, pass the day after it. ``last_days`` emits the newest days
    only (balances still carry the full history). ``plan="dense"`` follows the
    definition literally and gives the same rows.
    """
    first = None if last_days is None else as_of - timedelta(days=last_days)
    if plan == "sparse":
        days = balances.daily_activity(stg, as_of)
        return segments.expand_days(segments.balance_segments(days, as_of, spine_scope), first)
    if plan != "dense":
        raise ValueError(f"plan must be 'sparse' or 'dense', not {plan!r}")
    spans, daily_net = balances.organization_spans(stg), balances.daily_net_aggregates(stg)
    snapshot = balances.dense_balance(spans, daily_net, as_of, spine_scope)
    return snapshot if first is None else snapshot.where(F.col("snapshot_date") >= F.lit(first))


def latest_day(stg: DataFrame, as_of: date) -> DataFrame:
    """One row: the latest snapshot day, generating one day per organisation.

    Every series runs to the day before ``as_of``; without series it is NULL.
    """
    return alerts.latest_snapshot_date(daily_snapshot(stg, as_of, last_days=1))


def latest_pairs(stg: DataFrame, as_of: date) -> DataFrame:
    """Day pairs straight from invoices, generating two days per organisation.

    Every series runs to the day before ``as_of``, so the latest day is known.
    """
    snapshot = daily_snapshot(stg, as_of, last_days=2)
    return alerts.balance_day_pairs(snapshot, F.lit(balances.last_day(as_of)))


def alert_history(days: DataFrame, as_of: date, threshold: Decimal = THRESHOLD_PERCENT) -> DataFrame:
    """The alerts of every day before ``as_of``, from the daily activity, lazy or stored."""
    changes = alerts.balance_changes(segments.balance_segments(days, as_of))
    return alerts.balance_change_alerts(changes, threshold)


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Presentation order, NULLs last. Not for table writes: it sorts globally."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """The rows with their place (``row_number``, from 1) in the order of columns, NULLs last.

    Ranges of the order are numbered apart and offset by the sizes of those before, so
    no task sees more than its range. ``columns`` must tell all rows apart.
    """
    order = [F.asc_nulls_last(c) for c in columns]
    ranges = df.repartitionByRange(shuffle_tasks(df), *order).sortWithinPartitions(*order)
    # Written, as sizes and rows are two readings of the same ranges.
    ranges = written(ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row")))
    sizes = ranges.groupBy("_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", (F.coalesce(F.sum("_size").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_start"))
    place = (F.col("_row") + F.col("_start")).alias("row_number")
    return ranges.join(F.broadcast(starts), "_range").select(place, *df.columns)


def snapshot_report(snapshot: DataFrame) -> DataFrame:
    """The snapshot in reading order."""
    return ordered(snapshot, "organization_id", "snapshot_date")


def alert_report(pairs: DataFrame, threshold: Decimal = THRESHOLD_PERCENT) -> DataFrame:
    """The alerts in reading order."""
    return ordered(alerts.balance_change_alerts(pairs, threshold), "organization_id")


def build_tables(
    raw_invoices: DataFrame, raw_organizations: DataFrame, as_of: date, rejects: Observation | None = None
) -> dict[str, DataFrame]:
    """All tables by name, lazily.

    ``rejects`` observes what staging rejects while invoices are read; a refresh that
    gets it as well stores the counts. An observation counts for one reading.
    """
    if rejects is not None:
        raw_invoices = quality.observed(raw_invoices, rejects)
    stg = staging.stg_invoices(raw_invoices)
    orgs = staging.stg_organizations(raw_organizations)
    return {
        "stg_invoices": stg,
        "stg_organizations": orgs,
        "int_global_min_invoice_date": balances.global_min_invoice_date(stg, as_of),
        "dim_organizations": staging.dim_organizations(orgs),
        "fct_daily_financial_snapshot": daily_snapshot(stg, as_of),
    }
