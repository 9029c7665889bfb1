"""The data-quality suite over the built tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators import boundaries
from ledgerfold.operators import quality as q
from ledgerfold.schemas import INVOICE_STATUSES
from ledgerfold.sources.workspace import written

Tables = dict[str, DataFrame]

FACT = "fct_daily_financial_snapshot"

# Checks by table: {check id: column}.
NOT_NULL = {
    "stg_organizations": {
        "Q02": "organization_id",
        "Q03": "legal_entity_country_code",
        "Q04": "organization_created_date",
    },
    "stg_invoices": {
        "Q06": "invoice_id",
        "Q07": "organization_id",
        "Q08": "status",
        "Q10": "created_date",
    },
    "dim_organizations": {"Q12": "organization_id", "Q13": "organization_created_date"},
    FACT: {
        "Q14": "snapshot_date",
        "Q16": "organization_id",
        "Q17": "daily_net_change_usd",
        "Q18": "cumulative_net_financial_balance_usd",
    },
}
UNIQUE = {
    "stg_organizations": ("Q01", "organization_id"),
    "stg_invoices": ("Q05", "invoice_id"),
    "dim_organizations": ("Q11", "organization_id"),
}


def not_null(tables: Tables) -> DataFrame:
    return q.combine(q.not_null(tables[t], t, checks) for t, checks in NOT_NULL.items())


def unique(tables: Tables) -> DataFrame:
    return q.combine(q.unique(tables[t], t, *check) for t, check in UNIQUE.items())


def accepted_values(tables: Tables) -> DataFrame:
    return q.accepted_values(
        tables["stg_invoices"], "stg_invoices", "Q09", "status", INVOICE_STATUSES
    )


def unique_combination(tables: Tables) -> DataFrame:
    """Organisations with a repeated day are found by bits; only their days are counted one by one."""
    rows = boundaries.rows_of(tables[FACT], F.broadcast(boundaries.repeating(tables[FACT])))
    return q.unique_combination(rows, FACT, "Q15", ["snapshot_date", "organization_id"])


def relationships(tables: Tables) -> DataFrame:
    """Organisations missing from the dimension; off by default in the suite."""
    dim = tables["dim_organizations"]
    key = "organization_id"
    return q.combine([
        q.relationships(tables["stg_invoices"], "stg_invoices", "Q22", key, dim, key),
        q.relationships(tables[FACT], FACT, "Q23", key, dim, key),
    ])


def organization_checks(tables: Tables, table: str) -> DataFrame:
    """All checks of a table with one row per organisation, in one pass."""
    (unique_id, key), nulls = UNIQUE[table], NOT_NULL[table]
    per_key = tables[table].groupBy(key).agg(
        *q.count_each(q.is_null(nulls)), F.count(F.lit(1)).alias("_rows")
    )
    repeated = F.count_if((F.col("_rows") > 1) & F.col(key).isNotNull())
    counts = per_key.agg(*[F.sum(i).alias(i) for i in nulls], repeated.alias(unique_id))
    return q.reported(counts, table, {**nulls, unique_id: key})


def invoice_checks(tables: Tables, with_relationships: bool) -> DataFrame:
    """The invoices in two passes: one by id, and one by organisation and status for the rest.

    Everything but the ids is counted map-side per (organisation, status), which is
    small however many invoices there are.
    """
    table, key = "stg_invoices", "organization_id"
    conditions = {
        **q.is_null(NOT_NULL[table]),
        "Q19": ("payment_amount_usd", q.is_paid_missing_usd()),
        "Q20": ("amount_usd", q.is_negative_missing_usd()),
    }
    groups = tables[table].groupBy(key, "status").agg(
        *q.count_each(conditions), F.count(F.lit(1)).alias("_rows")
    )
    strange = F.when(~F.col("status").isin(*INVOICE_STATUSES), F.col("status"))
    failures = [F.sum(i).alias(i) for i in conditions] + [F.count_distinct(strange).alias("Q09")]
    checks = {**{i: c for i, (c, _) in conditions.items()}, "Q09": "status"}
    if with_relationships:
        groups = _with_parent(groups, tables, key)
        failures.append(_orphans(key).alias("Q22"))
        checks["Q22"] = key
    return q.combine([
        q.reported(groups.agg(*failures), table, checks),
        q.unique(tables[table], table, *UNIQUE[table]),
    ])


def snapshot_checks(tables: Tables, with_relationships: bool) -> DataFrame:
    """The snapshot in one pass: a window by organisation, then sums in the same partitions."""
    key, nulls = "organization_id", NOT_NULL[FACT]
    windows = tables[FACT].select(
        *nulls.values(),
        q.second_of_its_day().alias("_second"),
        q.previous_day_balance().alias("_previous"),
    )
    per_key = windows.groupBy(key).agg(
        *q.count_each(q.is_null(nulls)),
        F.count_if("_second").alias("Q15"),
        F.count_if(q.fell_without_outflow(F.col("_previous"))).alias("Q21"),
        F.count(F.lit(1)).alias("_rows"),
    )
    checks = {
        **nulls,
        "Q15": "snapshot_date, organization_id",
        "Q21": "cumulative_net_financial_balance_usd",
    }
    failures = [F.sum(i).alias(i) for i in checks]
    if with_relationships:
        per_key = _with_parent(per_key, tables, key)
        failures.append(_orphans(key).alias("Q23"))
        checks["Q23"] = key
    return q.reported(per_key.agg(*failures), FACT, checks)


def boundary_checks(tables: Tables, with_relationships: bool, folder: str | None = None) -> DataFrame:
    """The checks of a snapshot by boundary summaries; the result of ``snapshot_checks``.

    The summary of each organisation is written, to ``folder`` or a fresh one, and read again. Organisations whose runs
    are torn are checked row by row, if there are any; in a snapshot as it is built there
    are none. A snapshot grouped by organisation is not shuffled, of any other its runs.
    """
    key, nulls = "organization_id", NOT_NULL[FACT]
    per_key = written(boundaries.joined(boundaries.stretches(tables[FACT])), folder)
    torn = per_key.where("torn")
    exact = None
    if not torn.isEmpty():
        rows = boundaries.rows_of(tables[FACT], torn)
        exact = snapshot_checks({**tables, FACT: rows}, False)
    checks = {
        **nulls,
        "Q15": "snapshot_date, organization_id",
        "Q21": "cumulative_net_financial_balance_usd",
    }
    failures = [F.sum(f"no_{c}").alias(i) for i, c in nulls.items()]
    # Without a tear every day is there once.
    failures += [F.lit(0).cast("long").alias("Q15"), F.sum(F.when(~F.col("torn"), F.col("falls"))).alias("Q21")]
    if with_relationships:
        per_key = _with_parent(per_key.withColumnRenamed("rows", "_rows"), tables, key)
        failures.append(_orphans(key).alias("Q23"))
        checks["Q23"] = key
    report = q.reported(per_key.agg(*failures), FACT, checks)
    return report if exact is None else q.added(report, exact.where(F.col("check_id").isin("Q15", "Q21")))


def _with_parent(counts: DataFrame, tables: Tables, key: str) -> DataFrame:
    known = tables["dim_organizations"].select(key).distinct().withColumn("_known", F.lit(True))
    return counts.join(known, key, "left")


def _orphans(key: str) -> Column:
    return F.sum(F.when(F.col("_known").isNull() & F.col(key).isNotNull(), F.col("_rows")))


def run_suite(
    tables: Tables, with_relationships: bool = False, by_summaries: bool = False, folder: str | None = None
) -> DataFrame:
    """Every check, one row each.

    Works on lazy and on stored tables. The lazy snapshot is generated once and not
    shuffled, as it is already grouped by organisation; nor is a bucketed stored one.
    ``by_summaries`` is for a large snapshot, lazy or stored: it is checked at once, by
    boundary summaries, written to ``folder``, and its rows are not sorted.
    """
    if by_summaries:
        snapshot = boundary_checks(tables, with_relationships, folder)
    else:
        snapshot = snapshot_checks(tables, with_relationships)
    return q.combine([
        organization_checks(tables, "stg_organizations"),
        organization_checks(tables, "dim_organizations"),
        invoice_checks(tables, with_relationships),
        snapshot,
    ])
