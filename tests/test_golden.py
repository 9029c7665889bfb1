"""Expected staging, balances, alerts and checks on the hand-written invoices."""

from __future__ import annotations

from datetime import date

import golden
import pytest
from golden import dec

from ledgerfold.operators import alerts, balances, quality, staging
from ledgerfold.plans import checks
from ledgerfold.plans.tables import alert_report, daily_snapshot, latest_pairs, snapshot_report

BALANCE = "cumulative_net_financial_balance_usd"


@pytest.fixture(scope="module")
def stg(spark):
    return staging.stg_invoices(golden.raw_invoices(spark)).cache()


@pytest.fixture(scope="module", params=["sparse", "dense"])
def snapshot(stg, request):
    return daily_snapshot(stg, golden.AS_OF, plan=request.param).cache()


def test_usd_amounts(stg):
    rows = {r.invoice_id: r for r in stg.collect()}
    for number, (amount, paid) in golden.USD.items():
        assert rows[number].amount_usd == dec(amount), number
        assert rows[number].payment_amount_usd == dec(paid), number
    assert rows[1].created_date == date(2024, 1, 3)
    assert rows[8].payment_amount == dec("1.01")


def test_staged_types(stg):
    types = dict(stg.dtypes)
    assert len(types) == 17
    assert types["amount"] == types["payment_amount"] == "decimal(38,2)"
    assert types["fx_rate"] == types["fx_rate_payment"] == "decimal(13,8)"
    assert types["amount_usd"] == types["payment_amount_usd"] == "decimal(38,8)"
    assert types["created_date"] == "date"


def test_snapshot(snapshot):
    series = {}
    for r in snapshot.collect():
        series.setdefault(r.organization_id, []).append(r)
    assert set(series) == set(golden.SNAPSHOT)
    for org, (count, first, change, balance) in golden.SNAPSHOT.items():
        rows = sorted(series[org], key=lambda r: r.snapshot_date)
        days = [r.snapshot_date for r in rows]
        assert days == [date(2024, 1, d) for d in range(first, 11)], org
        assert len(rows) == count
        assert rows[-1].daily_net_change_usd == dec(change)
        assert rows[-1][BALANCE] == dec(balance)


def test_series_of_one_organisation(snapshot):
    rows = snapshot.where("organization_id = 'A'").orderBy("snapshot_date").collect()
    assert [r.daily_net_change_usd for r in rows] == [
        dec(x) for x in ("100", "0", "-33.33333333", "0", "0", "0", "0", "0")
    ]
    assert [r[BALANCE] for r in rows] == [dec(x) for x in ["100"] * 2 + ["66.66666667"] * 6]


def test_snapshot_types(snapshot):
    assert snapshot.dtypes == [
        ("snapshot_date", "date"),
        ("organization_id", "string"),
        ("daily_net_change_usd", "decimal(38,8)"),
        (BALANCE, "decimal(38,8)"),
    ]


def test_report_order(snapshot):
    rows = snapshot_report(snapshot).collect()
    keys = [(r.organization_id is None, r.organization_id or "", r.snapshot_date) for r in rows]
    assert keys == sorted(keys)


def test_day_pairs_and_changes(snapshot):
    rows = alerts.balance_pct_change(alerts.balance_day_pairs(snapshot)).collect()
    got = {r.organization_id: (r.previous_day_balance, r.pct_change) for r in rows}
    assert got == {o: (dec(p), dec(c)) for o, (p, c) in golden.CHANGES.items()}


def test_alerts(snapshot):
    rows = alert_report(alerts.balance_day_pairs(snapshot)).collect()
    assert [r.organization_id for r in rows] == ["H", "I", "L"]
    got = {
        r.organization_id: (r.previous_display, r.current_display, r.change_display) for r in rows
    }
    assert got == golden.ALERTS
    assert [r.from_zero for r in rows] == [False, True, True]


def test_alert_threshold(snapshot):
    pairs = alerts.balance_day_pairs(snapshot)
    orgs = lambda limit: {
        r.organization_id for r in alerts.balance_change_alerts(pairs, dec(limit)).collect()
    }
    assert orgs("50.01") == {"I", "L"}
    assert orgs("49.99") == {"G", "H", "I", "L"}
    assert orgs("40") == {"G", "H", "I", "L"}
    assert orgs("39.99") == {"G", "H", "I", "K", "L"}
    assert orgs("999999.99") == set()


def test_alert_summary(snapshot):
    row = alerts.alert_summary(alerts.balance_day_pairs(snapshot)).first()
    assert tuple(row) == (date(2024, 1, 10), 9, 3)


def test_pairs_straight_from_invoices(stg, snapshot):
    direct = latest_pairs(stg, golden.AS_OF)
    assert sorted(map(str, direct.collect())) == sorted(
        map(str, alerts.balance_day_pairs(snapshot).collect())
    )


def test_intermediate_tables(stg):
    assert balances.global_min_invoice_date(stg, golden.AS_OF).first()[0] == date(2024, 1, 3)
    first = dict(
        tuple(r) for r in balances.organization_first_transaction_date(stg).collect()
    )
    assert first["B"] == date(2024, 1, 1) and first["E"] == date(2024, 2, 1)
    assert {r.invoice_id for r in balances.relevant_invoices(stg).collect()} == (
        set(range(1, 27)) - {3, 6, 7, 11, 12, 13}
    )
    spine = balances.date_spine(
        balances.global_min_invoice_date(stg, golden.AS_OF), golden.AS_OF
    )
    assert [r.date_day.day for r in spine.orderBy("date_day").collect()] == list(range(3, 11))


def test_spine_over_all_statuses_keeps_early_refunds(stg):
    for plan in ("sparse", "dense"):
        rows = daily_snapshot(stg, golden.AS_OF, spine_scope="all", plan=plan).where(
            "organization_id = 'B'"
        ).orderBy("snapshot_date").collect()
        assert rows[0].snapshot_date == date(2024, 1, 1)
        assert [rows[0][BALANCE], rows[-1][BALANCE]] == [dec("-40"), dec("60")]


def test_checks(stg, snapshot):
    orgs = snapshot.select("organization_id").distinct()
    tables = {
        "stg_invoices": stg,
        "fct_daily_financial_snapshot": snapshot,
        "stg_organizations": orgs.selectExpr(
            "organization_id", "1 legal_entity_country_code",
            "DATE '2020-01-01' organization_created_date",
        ),
        "dim_organizations": orgs.where("organization_id <> 'A'").selectExpr(
            "organization_id", "DATE '2020-01-01' organization_created_date"
        ),
    }
    rows = {r.check_id: r for r in checks.run_suite(tables, with_relationships=True).collect()}
    assert len(rows) == 23
    failing = {i: r.failures for i, r in rows.items() if not r.passed}
    assert failing == {
        "Q02": 1, "Q07": 1, "Q16": 7, "Q19": 4, "Q20": 1,
        # Invoices of A (3) and of C, D, E, F, which have no balance (7); A's days.
        "Q22": 3 + 7, "Q23": 8,
    }
    ids = lambda df: {r.invoice_id for r in df.collect()}
    assert ids(quality.paid_missing_usd(stg)) == {6, 11, 12, 13}
    assert ids(quality.negative_missing_usd(stg)) == {3}


def test_suite_without_relationships(stg, snapshot):
    orgs = snapshot.selectExpr(
        "organization_id", "1 legal_entity_country_code",
        "snapshot_date organization_created_date",
    )
    tables = {
        "stg_invoices": stg, "fct_daily_financial_snapshot": snapshot,
        "stg_organizations": orgs, "dim_organizations": orgs,
    }
    ids = {r.check_id for r in checks.run_suite(tables).collect()}
    assert ids == {f"Q{n:02d}" for n in range(1, 22)}
