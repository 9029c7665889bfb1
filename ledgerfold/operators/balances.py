"""Net movements per organisation and day, and the dense daily balance.

The dense form follows the definition step by step: a row per organisation and
day, joined to the movements, then a running sum. ``operators.segments`` gives
the same rows with far less shuffled data and is what production uses; the
dense form stays as its twin and supplies the intermediate tables.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions.money import negated
from ledgerfold.schemas import (
    BALANCE_STATUSES, INFLOW_STATUS, OUTFLOW_STATUSES, USD, with_comments,
)


def zero_usd() -> Column:
    return F.lit(0).cast(USD)


def signed_change() -> Column:
    """Inflow at the paid amount, outflow at minus the invoice amount, else NULL."""
    return (
        F.when(F.col("status") == INFLOW_STATUS, F.col("payment_amount_usd"))
        .when(F.col("status").isin(*OUTFLOW_STATUSES), negated(F.col("amount_usd")))
    )


def relevant_invoices(stg: DataFrame) -> DataFrame:
    """Invoices that move a balance: a counted status and a known USD value."""
    paid = F.col("status") == INFLOW_STATUS
    out = F.col("status").isin(*OUTFLOW_STATUSES)
    return stg.where(
        F.col("status").isin(*BALANCE_STATUSES)
        & (
            (paid & F.col("payment_amount_usd").isNotNull())
            | (out & F.col("amount_usd").isNotNull())
        )
    )


def signed_contributions(stg: DataFrame) -> DataFrame:
    """Each relevant invoice with its signed USD contribution."""
    return relevant_invoices(stg).select(
        "organization_id",
        "created_date",
        "status",
        signed_change().alias("daily_amount_change_usd"),
    )


def daily_activity(stg: DataFrame, as_of: date | None = None) -> DataFrame:
    """Net movement per (organisation, day) and whether the day had a valued payment.

    An invoice without a USD value adds NULL to the sum, and a group of nothing
    but such invoices is dropped by the NULL test on the sum: the result of
    filtering row by row, with every conversion evaluated once. Map-side
    partial sums bound what a hot organisation or day can send.
    """
    rows = stg.where(F.col("status").isin(*BALANCE_STATUSES))
    if as_of is not None:
        # On the timestamp, not the derived date, so that the scan can skip row groups.
        created = stg.schema["created_at_timestamp"].dataType
        rows = rows.where(F.col("created_at_timestamp") < F.lit(as_of).cast(created))
    return (
        rows.select(
            "organization_id",
            F.col("created_date").alias("transaction_date"),
            "status",
            signed_change().alias("change"),
        )
        .groupBy("organization_id", "transaction_date")
        .agg(
            F.sum("change").cast(USD).alias("daily_net_change_usd"),
            F.bool_or(
                F.col("change").isNotNull() & (F.col("status") == INFLOW_STATUS)
            ).alias("has_paid"),
        )
        .where(F.col("daily_net_change_usd").isNotNull())
    )


def daily_net_aggregates(stg: DataFrame) -> DataFrame:
    """Net USD movement per organisation and day with activity."""
    return daily_activity(stg).drop("has_paid")


def organization_spans(stg: DataFrame) -> DataFrame:
    """First day with activity, and with a valued payment, per organisation.

    Straight from the invoices: the minima are taken map-side, so a shuffle
    carries one row per organisation and task, however many invoices it has.
    """
    day = F.col("created_date")
    return (
        relevant_invoices(stg)
        .groupBy("organization_id")
        .agg(
            F.min(day).alias("first_transaction_date"),
            F.min(F.when(F.col("status") == INFLOW_STATUS, day)).alias("first_paid_date"),
        )
    )


def organization_first_transaction_date(stg: DataFrame) -> DataFrame:
    """Earliest day with activity per organisation."""
    return organization_spans(stg).drop("first_paid_date")


def global_min_invoice_date(stg: DataFrame, as_of: date, spine_scope: str = "paid") -> DataFrame:
    """One row: the day the date spine starts, ``as_of`` if nothing was paid.

    ``spine_scope="paid"`` looks at valued paid invoices only, so credits and
    refunds before the first payment enter no balance; ``"all"`` starts at the
    first relevant invoice of any kind.
    """
    rows = relevant_invoices(stg)
    if check_scope(spine_scope) == "paid":
        rows = rows.where(F.col("status") == INFLOW_STATUS)
    return rows.agg(
        F.coalesce(F.min("created_date"), F.lit(as_of)).alias("global_min_invoice_date")
    )


def check_scope(spine_scope: str) -> str:
    if spine_scope not in ("paid", "all"):
        raise ValueError(f"spine_scope must be 'paid' or 'all', not {spine_scope!r}")
    return spine_scope


def last_day(as_of: date) -> date:
    """The spine's end is exclusive: the last snapshot is the day before ``as_of``."""
    return as_of - timedelta(days=1)


def shuffle_tasks(df: DataFrame) -> int:
    """The session's shuffle partition count, for shuffles adaptive execution must not merge."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def days_between(first: Column, last: Column) -> Column:
    """Generator of the days first..last; callers filter to first <= last.

    The outer form is chosen because the plain one makes Catalyst add a
    ``size(sequence(..)) > 0`` filter, building every array twice.
    """
    return F.explode_outer(F.sequence(first, F.greatest(first, last)))


def date_spine(global_min: DataFrame, as_of: date) -> DataFrame:
    """Every day from the global minimum to the day before ``as_of``."""
    end = F.lit(last_day(as_of))
    start = F.col("global_min_invoice_date")
    return global_min.where(start <= end).select(days_between(start, end).alias("date_day"))


# Days that a task sorts in memory.
DAYS_PER_TASK = 1 << 21


def _scaffold_starts(spans: DataFrame, as_of: date, spine_scope: str) -> tuple[DataFrame, Column]:
    """(organization_id, _start): the first day of each series, and the start of the spine.

    The spine start is a scalar over the same spans. An organisation that began
    with a payment began in the spine; testing that first keeps both columns in
    both uses, and Spark aggregates the spans once.
    """
    first, first_paid = F.col("first_transaction_date"), F.col("first_paid_date")
    spans = spans.where(first.isNotNull())
    opens = first_paid if check_scope(spine_scope) == "paid" else first
    start = spans.agg(F.coalesce(F.min(opens), F.lit(as_of))).scalar()
    own_start = F.when(first_paid == first, first).otherwise(F.greatest(first, start))
    return spans.select("organization_id", own_start.alias("_start")), start


def organization_daily_scaffold(
    spans: DataFrame, as_of: date, spine_scope: str = "paid"
) -> DataFrame:
    """Every organisation on every spine day from its first activity on.

    Each organisation generates its own days, so nothing is paired and dropped.
    """
    end = F.lit(last_day(as_of))
    starts, _ = _scaffold_starts(spans, as_of, spine_scope)
    return (
        # A row becomes many days: keep these small partitions apart.
        starts.repartition(shuffle_tasks(spans), "organization_id")
        .where(F.col("_start") <= end)
        .select(days_between(F.col("_start"), end).alias("snapshot_date"), "organization_id")
    )


def dense_balance(
    spans: DataFrame, daily_net: DataFrame, as_of: date, spine_scope: str = "paid"
) -> DataFrame:
    """The scaffold with its movements, 0 on quiet days, and the running balance.

    Series and movements are shuffled by organisation before the days are generated.
    There each day of the scaffold meets the movement sorted right before it, if one is of
    its day, so no day is shuffled, and the join and the running sum share one sort. The
    days are counted first, for as many tasks as sort their days in memory. A NULL
    organisation is joined to nothing: its days stay 0.
    """
    end = F.lit(last_day(as_of))
    starts, start = _scaffold_starts(spans, as_of, spine_scope)
    series = starts.where(F.col("_start") <= end)
    days = series.agg(F.sum(F.datediff(end, "_start").cast("long") + 1)).first()[0] or 0
    tasks = max(shuffle_tasks(spans), -(-days // DAYS_PER_TASK))
    day = F.col("transaction_date")
    moves = daily_net.where(F.col("organization_id").isNotNull() & (day >= start) & (day <= end))
    rows = series.select(
        "organization_id", F.col("_start").alias("_first"), end.alias("_last"), zero_usd().alias("_change"),
        F.lit(True).alias("_scaffold"),
    ).unionAll(moves.select("organization_id", day, day, "daily_net_change_usd", F.lit(False)))
    daily = rows.repartition(tasks, "organization_id").select(
        "organization_id", days_between(F.col("_first"), F.col("_last")).alias("snapshot_date"), "_change", "_scaffold",
    )
    # The movement of a day comes before its place in the scaffold.
    by_day = Window.partitionBy("organization_id").orderBy("snapshot_date", "_scaffold")
    history = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moved = F.lag("snapshot_date").over(by_day) == F.col("snapshot_date")
    filled = daily.select(
        "snapshot_date",
        "organization_id",
        F.when(moved, F.lag("_change").over(by_day)).otherwise(zero_usd()).alias("daily_net_change_usd"),
        F.sum("_change").over(history).cast(USD).alias("cumulative_net_financial_balance_usd"),
        "_scaffold",
    )
    return with_comments(filled.where("_scaffold").drop("_scaffold"), "fct_daily_financial_snapshot")
