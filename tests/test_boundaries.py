"""Checks by boundary summaries find what the checks row by row find."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import golden
import pytest

from ledgerfold.operators import boundaries, staging
from ledgerfold.operators.balances import daily_activity
from ledgerfold.plans import checks
from ledgerfold.sources import marts

SCHEMA = (
    "snapshot_date date, organization_id string, daily_net_change_usd decimal(38,8), "
    "cumulative_net_financial_balance_usd decimal(38,8)"
)
FIRST = date(2024, 1, 1)


def series(org, days, rng):
    balance, rows = Decimal(0), []
    for n in range(days):
        change = Decimal(rng.randint(-5, 5)) * Decimal("10000000000000000000.5")
        balance += change
        rows.append((FIRST + timedelta(days=n), org, change, balance))
    return rows


def damaged(rows, rng, times):
    rows = [list(r) for r in rows]
    for _ in range(times):
        row = rng.choice(rows)
        kind = rng.randrange(5)
        if kind == 0:
            rows.append(list(row))
        elif kind == 1:
            rows.remove(row)
        else:
            row[rng.choice([0, 1, 2, 3])] = None
        if kind == 4:
            rng.choice(rows)[3] = Decimal(rng.randint(-10**20, 10**20))
    return [tuple(r) for r in rows]


def reports(spark, rows, tasks):
    tables = {checks.FACT: spark.createDataFrame(rows, SCHEMA).repartition(tasks) if tasks else
              spark.createDataFrame(rows, SCHEMA).coalesce(1),
              "dim_organizations": spark.createDataFrame([("A",), ("B",)], "organization_id string")}
    return [sorted(map(str, check(tables, True).collect())) for check in (checks.boundary_checks, checks.snapshot_checks)]


@pytest.mark.parametrize("seed, times, tasks", [(1, 0, None), (2, 0, 3), (3, 6, None), (4, 12, 3)])
def test_same_report_as_row_by_row(spark, seed, times, tasks):
    rng = random.Random(seed)
    rows = [r for org in ("A", "B", "C", None) for r in series(org, 40, rng)]
    by_boundaries, by_rows = reports(spark, damaged(rows, rng, times), tasks)
    assert by_boundaries == by_rows


def test_a_fall_between_two_files_is_found(spark, tmp_path):
    rows = series("A", 10, random.Random(5))
    bad = (FIRST + timedelta(days=10), "A", Decimal(1), rows[-1][3] - 7)
    for part in (rows, [bad]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/fct")
    found = checks.boundary_checks({checks.FACT: spark.read.parquet(f"{tmp_path}/fct")}, False)
    assert {r.check_id: r.failures for r in found.collect()}["Q21"] == 1


def test_an_empty_snapshot(spark):
    by_boundaries, by_rows = reports(spark, [], None)
    assert by_boundaries == by_rows


def test_only_summaries_are_shuffled(spark, tmp_path):
    days = daily_activity(staging.stg_invoices(golden.raw_invoices(spark)))
    marts.write_snapshot(days, golden.AS_OF.replace(month=6), f"{tmp_path}/fct")
    stored = marts.read_snapshot(spark, f"{tmp_path}/fct")
    found = boundaries.runs(stored)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    # A run for each organisation and month.
    organizations = stored.select("organization_id").distinct().count()
    assert found.count() <= 6 * organizations < stored.count() / 20
    assert not boundaries.joined(found).where("torn").count()
