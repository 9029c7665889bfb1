"""Stored segments, their days, and the alerts of every day."""

from __future__ import annotations

import glob
from datetime import date

import golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Observation

from ledgerfold.operators import alerts, staging
from ledgerfold.operators.balances import daily_activity
from ledgerfold.plans import tables as plans
from ledgerfold.sources import intervals, marts

AS_OF = golden.AS_OF.replace(month=6)


@pytest.fixture(scope="module")
def stg(spark):
    return staging.stg_invoices(golden.raw_invoices(spark))


@pytest.fixture(scope="module")
def stored(stg, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("segments") / "t")
    return intervals.write_segments(daily_activity(stg, AS_OF), AS_OF, path)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("first, last", [
    (date(2024, 1, 8), date(2024, 1, 10)), (date(2023, 1, 1), date(2025, 1, 1)), (date(2024, 6, 10), date(2024, 6, 10)),
    (date(2024, 2, 28), date(2024, 3, 1)), (date(2024, 3, 2), date(2024, 3, 1)),
])
def test_days_of_a_range(stg, stored, first, last):
    snapshot = plans.daily_snapshot(stg, AS_OF).where(F.col("snapshot_date").between(F.lit(first), F.lit(last)))
    assert rows(intervals.snapshot_days(stored, first, last)) == rows(snapshot)


def test_days_by_sql(spark, stg, stored):
    intervals.register_days(spark, stored, "test_segments", "test_days")
    found = spark.sql("SELECT * FROM test_days(DATE '2024-01-31', DATE '2024-02-02') WHERE organization_id <> 'A'")
    snapshot = plans.daily_snapshot(stg, AS_OF).where("snapshot_date BETWEEN '2024-01-31' AND '2024-02-02'")
    assert rows(found) == rows(snapshot.where("organization_id <> 'A'"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(closed_month#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "valid_from" in plan.split("DataFilters: ")[1].split("]")[0]


def test_only_overlapping_months_are_opened(stored):
    assert intervals.latest_day(stored).first()[0] == date(2024, 6, 10)
    two_days = intervals.overlapping(stored, F.lit(date(2024, 6, 9)), F.lit(date(2024, 6, 10)))
    assert {f.split("closed_month=")[1][:7] for f in stored.inputFiles()} == {"2024-01", "2024-06"}
    plan = two_days._jdf.queryExecution().executedPlan().toString()
    assert "closed_month" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_alerts_from_segments(stg, stored):
    latest = intervals.latest_day(stored).scalar()
    pairs = alerts.balance_day_pairs(intervals.snapshot_days(stored, F.date_sub(latest, 1), latest), latest)
    assert rows(pairs) == rows(plans.latest_pairs(stg, AS_OF))


def test_an_empty_store(spark, stg, tmp_path):
    none = intervals.write_segments(daily_activity(stg.limit(0), AS_OF), AS_OF, f"{tmp_path}/t")
    assert intervals.latest_day(none).first()[0] is None
    assert intervals.snapshot_days(none, date(2024, 1, 1), AS_OF).count() == 0


@pytest.mark.parametrize("threshold", ["0", "50.00", "150.00"])
def test_alerts_of_every_day(stg, threshold):
    """As by looking at each day in turn."""
    as_of = golden.AS_OF.replace(month=2, day=4)
    history = plans.alert_history(daily_activity(stg, as_of), as_of, golden.dec(threshold))
    expected = []
    for day in [date(2024, 1, d) for d in range(1, 32)] + [date(2024, 2, d) for d in range(1, 4)]:
        pairs = alerts.balance_day_pairs(plans.daily_snapshot(stg, as_of), F.lit(day))
        if day.day in (4, 5, 6, 8, 9, 10, 11, 31) or day.month == 2:
            expected += map(str, alerts.balance_change_alerts(pairs, golden.dec(threshold)).collect())
    assert rows(history) == sorted(expected)
    assert "Generate" not in history._jdf.queryExecution().executedPlan().toString()


def test_rejected_values(spark, tmp_path):
    rejects = Observation()
    orgs = spark.createDataFrame([], "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
                                 "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, "
                                 "CREATED_DATE timestamp_ntz")
    built = plans.build_tables(golden.raw_invoices(spark), orgs, golden.AS_OF, rejects)
    stored = marts.refresh(built, golden.AS_OF, str(tmp_path), rejects)
    counts = {(r.column_name, r.reason): r.rejected_rows for r in stored[marts.REJECTS].collect()}
    assert {at: n for at, n in counts.items() if n} == {
        ("amount", "malformed"): 1, ("payment_amount", "malformed"): 1, ("fx_rate", "out_of_range"): 1,
        ("fx_rate_payment", "out_of_range"): 1, ("fx_rate", "zero_rate"): 1, ("fx_rate", "missing_rate"): 1,
        ("fx_rate_payment", "missing_rate"): 2, ("payment_currency", "missing_currency"): 3,
    }
    assert len(counts) == 14
    assert stored[marts.FACT].count() == 39
    assert len(glob.glob(f"{tmp_path}/versions/*/{marts.REJECTS}")) == 1


def test_two_refreshes_at_once(spark, tmp_path, monkeypatch):
    orgs = spark.createDataFrame([], "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
                                 "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, "
                                 "CREATED_DATE timestamp_ntz")
    built = plans.build_tables(golden.raw_invoices(spark), orgs, golden.AS_OF)
    real, taken = marts.published, []

    def late(spark_, folder):
        # The second refresh takes its number before the first one is published.
        taken.append(folder)
        return [] if len(taken) == 4 else real(spark_, folder)

    monkeypatch.setattr(marts, "published", late)
    lost = 0
    marts.refresh(built, golden.AS_OF, str(tmp_path))
    first = real(spark, str(tmp_path))
    try:
        marts.refresh(built, golden.AS_OF, str(tmp_path))
    except marts.Conflict:
        lost = 1
    now = real(spark, str(tmp_path))
    assert [n for n, *_ in now] == [1] and lost == (now == first)
    assert marts.load(spark, str(tmp_path))[marts.FACT].count() == 39
