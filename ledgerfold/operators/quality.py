"""Data-quality checks, one function per kind of check.

Suite checks return (check_id, table_name, column_name, failures, passed), one
row per check; row checks return the offending rows. All group keys are counted
with map-side partial aggregates before any join, so a value that fills a third
of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.operators import boundaries
from ledgerfold.schemas import BASE_CURRENCY, INFLOW_STATUS, MONEY, OUTFLOW_STATUSES, RATE


def flagged_rows(
    df: DataFrame, table: str, checks: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Rows that meet a condition, for {check_id: (column, condition)}, in one pass."""
    counts = df.agg(*count_each(checks))
    return reported(counts, table, {i: c for i, (c, _) in checks.items()})


def count_each(checks: Mapping[str, tuple[str, Column]]) -> list[Column]:
    """Aggregates that count the rows of each condition, named by check id."""
    return [F.count_if(bad).alias(i) for i, (_, bad) in checks.items()]


def reported(counts: DataFrame, table: str, checks: Mapping[str, str]) -> DataFrame:
    """One row of failures, a column for each of {check_id: column}, as a row per check."""
    rows = [
        F.struct(
            F.lit(i).alias("check_id"),
            F.lit(c).alias("column_name"),
            F.coalesce(i, F.lit(0).cast("bigint")).alias("failures"),
        )
        for i, c in checks.items()
    ]
    flat = counts.select(F.inline(F.array(*rows)))
    return _report(flat.withColumn("table_name", F.lit(table)))


def is_null(checks: Mapping[str, str]) -> dict[str, tuple[str, Column]]:
    """Conditions of not-null checks, for {check_id: column}."""
    return {i: (c, F.col(c).isNull()) for i, c in checks.items()}


def not_null(df: DataFrame, table: str, checks: Mapping[str, str]) -> DataFrame:
    """NULLs per column, for {check_id: column}, in one pass over the table."""
    return flagged_rows(df, table, is_null(checks))


def unique(df: DataFrame, table: str, check_id: str, column: str) -> DataFrame:
    """Number of distinct non-NULL values that occur more than once."""
    repeated = _repeated(df.where(F.col(column).isNotNull()), [column])
    return _counted(repeated, table, check_id, column)


def unique_combination(
    df: DataFrame, table: str, check_id: str, columns: Iterable[str]
) -> DataFrame:
    """Number of distinct key tuples that occur more than once; NULLs compare equal."""
    columns = list(columns)
    return _counted(_repeated(df, columns), table, check_id, ", ".join(columns))


def accepted_values(
    df: DataFrame, table: str, check_id: str, column: str, values: Iterable[str]
) -> DataFrame:
    """Number of distinct non-NULL values outside the domain."""
    strange = df.where(~F.col(column).isin(*values)).select(column).distinct()
    return _counted(strange, table, check_id, column)


def relationships(
    df: DataFrame, table: str, check_id: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Number of rows whose non-NULL key is missing from the parent.

    Rows are counted per key first: the join sees each key once, and a key with
    very many rows cannot overload one task.
    """
    keys = df.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = keys.join(
        parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti"
    )
    # NULL keys are left out here and not by a filter, which would sink to the
    # scan and keep the snapshot's checks from sharing one aggregate.
    rows = F.sum(F.when(F.col("_key").isNotNull(), F.col("_rows")))
    failures = F.coalesce(rows, F.lit(0).cast("bigint"))
    return _single(orphans.agg(failures.alias("failures")), table, check_id, column)


def is_paid_missing_usd() -> Column:
    return (F.col("status") == INFLOW_STATUS) & F.col("payment_amount_usd").isNull()


def is_negative_missing_usd() -> Column:
    return F.col("status").isin(*OUTFLOW_STATUSES) & F.col("amount_usd").isNull()


def paid_missing_usd(stg: DataFrame) -> DataFrame:
    """Paid invoices without a USD payment amount."""
    return stg.where(is_paid_missing_usd()).select(
        "invoice_id", "organization_id", "status", "payment_amount_usd"
    )


def negative_missing_usd(stg: DataFrame) -> DataFrame:
    """Credits and refunds without a USD amount."""
    return stg.where(is_negative_missing_usd()).select(
        "invoice_id", "organization_id", "status", "amount_usd"
    )


def balance_consistency(snapshot: DataFrame) -> DataFrame:
    """Days on which the balance fell although the day's change was not negative.

    Organisations with such a day are found by summaries, so that only their rows are
    sorted. They are few in any snapshot worth reading, and so are broadcast; where there
    are none, Spark leaves out the second reading.
    """
    rows = boundaries.rows_of(snapshot, F.broadcast(boundaries.suspects(snapshot)))
    return (
        rows.select("*", previous_day_balance().alias("previous_day_balance"))
        .where(fell_without_outflow(F.col("previous_day_balance")))
        .select(
            "snapshot_date",
            "organization_id",
            "daily_net_change_usd",
            "previous_day_balance",
            "cumulative_net_financial_balance_usd",
        )
    )


_BY_DAY = ("organization_id", "snapshot_date")


def previous_day_balance() -> Column:
    by_day = Window.partitionBy(_BY_DAY[0]).orderBy(_BY_DAY[1])
    return F.lag("cumulative_net_financial_balance_usd", 1, Decimal(0)).over(by_day)


def fell_without_outflow(previous: Column) -> Column:
    balance = F.col("cumulative_net_financial_balance_usd")
    return (F.col("daily_net_change_usd") >= 0) & (balance < previous)


def second_of_its_day() -> Column:
    """True for one row of each (organisation, day) that repeats; NULLs compare equal.

    Days are compared as structs, so that a missing day differs from no row at all.
    """
    by_day = Window.partitionBy(_BY_DAY[0]).orderBy(_BY_DAY[1])
    day = F.struct(_BY_DAY[1])
    first, second = (F.lag(day, n).over(by_day) for n in (1, 2))
    return day.eqNullSafe(first) & ~day.eqNullSafe(second)


# The text columns that staging casts, with their types and the currency a rate belongs to.
_CAST = {
    "AMOUNT": (MONEY, None), "PAYMENT_AMOUNT": (MONEY, None),
    "FX_RATE": (RATE, "CURRENCY"), "FX_RATE_PAYMENT": (RATE, "PAYMENT_CURRENCY"),
}
REJECTED = "column_name string, reason string, rejected_rows long"


def reject_reasons() -> dict[tuple[str, str], Column]:
    """For {(raw column, reason)} the condition on which staging gives NULL for a reason.

    A value is malformed if it is no number, and out of range if it is one but does not
    fit. Rates matter for currencies but USD only: there they are rejected if zero or
    missing, and a missing currency rejects the amount.
    """
    reasons = {}
    for name, (kind, currency) in _CAST.items():
        text, lost = F.col(name), F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        number = text.try_cast("double").isNotNull()
        reasons[name.lower(), "malformed"] = lost & ~number
        reasons[name.lower(), "out_of_range"] = lost & number
        if currency:
            foreign = F.col(currency) != BASE_CURRENCY
            reasons[name.lower(), "zero_rate"] = foreign & (text.try_cast(kind) == 0)
            reasons[name.lower(), "missing_rate"] = foreign & text.isNull()
            reasons[currency.lower(), "missing_currency"] = F.col(currency).isNull()
    return reasons


def _metric(column: str, reason: str) -> str:
    return f"{column}.{reason}"


def observed(raw: DataFrame, observation: Observation) -> DataFrame:
    """The raw invoices, counting what staging rejects for whoever reads them to the end."""
    counts = [F.count_if(F.coalesce(bad, F.lit(False))).alias(_metric(*at)) for at, bad in reject_reasons().items()]
    return raw.observe(observation, *counts)


def rejected_values(observation: Observation, spark: SparkSession) -> DataFrame:
    """The counts of an observation, after its table was read: a row per column and reason."""
    counts = observation.get
    rows = [(*at, counts[_metric(*at)]) for at in reject_reasons()]
    return spark.createDataFrame(rows, REJECTED).coalesce(1)


def combine(reports: Iterable[DataFrame]) -> DataFrame:
    """All reports as one DataFrame."""
    return reduce(DataFrame.unionByName, reports)


def added(report: DataFrame, more: DataFrame) -> DataFrame:
    """A report with the failures of another one added to its checks."""
    key = ["check_id", "table_name", "column_name"]
    return _report(report.unionByName(more).groupBy(*key).agg(F.sum("failures").alias("failures")))


def _repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def _counted(rows: DataFrame, table: str, check_id: str, column: str) -> DataFrame:
    return _single(rows.agg(F.count(F.lit(1)).alias("failures")), table, check_id, column)


def _single(failures: DataFrame, table: str, check_id: str, column: str) -> DataFrame:
    return _report(
        failures.withColumns({
            "check_id": F.lit(check_id), "table_name": F.lit(table), "column_name": F.lit(column)
        })
    )


def _report(df: DataFrame) -> DataFrame:
    return df.select(
        "check_id", "table_name", "column_name", "failures", (F.col("failures") == 0).alias("passed")
    )
