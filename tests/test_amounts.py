"""Stored days keep amounts in 64 bits where they fit, and give back every amount."""

from __future__ import annotations

import glob
from datetime import date, timedelta
from decimal import Decimal

import golden
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerfold.operators import boundaries, staging
from ledgerfold.operators.segments import expand_days
from ledgerfold.plans import tables as plans
from ledgerfold.sources import amounts, catalog, increments, marts

FACT, AS_OF = amounts.FACT, date(2024, 3, 10)
COLUMNS = ["snapshot_date", "organization_id", "daily_net_change_usd", "cumulative_net_financial_balance_usd"]
# The largest amount of 18 digits, the next one, and the largest of all.
EDGE, BEYOND, MOST = Decimal("9999999999.99999999"), Decimal("10000000000"), Decimal("9" * 30 + "." + "9" * 8)


def days(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def tables(spark):
    """Balances that come to need more than 18 digits, and go back."""
    def paid(number, org, day, amount, status="paid"):
        return golden.invoice(number, org, status, "USD", "USD", amount, amount, "1", "1", day.isoformat())

    rows = [paid(n, org, date(2024, 1, 5 + n), "10.25") for n, org in enumerate(["A", "B", None])] + [
        paid(10, "B", date(2024, 1, 20), "123456789012345678901.50"),
        paid(11, "B", date(2024, 2, 2), "123456789012345678901.50", "refunded"),
        paid(12, "C", date(2024, 2, 3), "9999999999.99"), paid(13, "C", date(2024, 2, 4), "0.01"),
        paid(14, "D", date(2024, 2, 3), "9999999999.99", "credited"), paid(15, "D", date(2024, 2, 4), "0.01", "credited"),
    ]
    dim = spark.createDataFrame([("A", None)], "organization_id string, organization_created_date date")
    return {"stg_invoices": staging.stg_invoices(golden.raw_invoices(spark, rows)), "dim_organizations": dim}


@pytest.mark.parametrize("store", ["increments", "folders", "catalog"])
def test_amounts_that_fit_are_64_bits(spark, tmp_path, store):
    """Every row comes back, and only amounts that need them are in 38 digits."""
    built = tables(spark)
    fresh = plans.daily_snapshot(built["stg_invoices"], AS_OF)
    if store == "catalog":
        stored = catalog.refresh(built, AS_OF, "amount_marts", buckets=2)
        files = spark.table(f"amount_marts.{FACT}_v1").inputFiles()
        by_sql = spark.sql(f"SELECT * FROM amount_marts.{FACT}")
        assert by_sql.dtypes == stored[FACT].dtypes and days(by_sql) == days(fresh)
    else:
        module = marts if store == "folders" else increments
        (marts.refresh if store == "folders" else increments.build)(built, AS_OF, str(tmp_path))
        stored = module.load(spark, str(tmp_path))
        files = stored[FACT].inputFiles()
    assert days(stored[FACT]) == days(fresh)
    assert [f.dataType for f in fresh.schema] == [stored[FACT].schema[c].dataType for c in COLUMNS]
    found = pa.concat_tables(pq.ParquetFile(f.removeprefix("file:")).read() for f in files)
    for amount in amounts.AMOUNTS:
        short, long = found[f"{amount}_18"], found[f"{amount}_38"]
        assert short.type == pa.decimal128(18, 8)
        assert short.null_count + long.null_count == len(found)
        wide = long.drop_null().to_pylist()
        assert wide and all(abs(value) >= BEYOND for value in wide)
    spark.sql("DROP DATABASE IF EXISTS amount_marts CASCADE")


@pytest.mark.parametrize("change, balance", [
    (EDGE, EDGE), (BEYOND, BEYOND), (-EDGE, -BEYOND), (MOST, MOST.copy_negate()), (None, EDGE), (EDGE, None), (None, None),
])
def test_no_amount_is_changed(spark, change, balance):
    rows = [(1, date(2024, 1, 30), date(2024, 2, 2), change, balance, date(2024, 1, 1))]
    segments = spark.createDataFrame(
        rows, "organization_id long, valid_from date, valid_to date, net_change_usd decimal(38,8), "
        "balance_usd decimal(38,8), snapshot_month date")
    stored = amounts.stored_days(segments, ["snapshot_month"])
    expected = expand_days(segments, keep=["snapshot_month"])
    seen = amounts.readable(stored)
    assert seen.columns == expected.columns and seen.collect() == expected.collect()
    assert [f.dataType for f in seen.schema] == [f.dataType for f in expected.schema]
    assert seen.schema["daily_net_change_usd"].metadata["comment"]


def test_folders_with_one_column_an_amount_are_read(spark, tmp_path, monkeypatch):
    """Days written before amounts had two columns, alone and beside newer ones."""
    built, folder = tables(spark), str(tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(increments, "stored_days", lambda pieces, keep: expand_days(pieces, keep=keep))
        patch.setattr(marts, "stored_days", lambda pieces, keep: expand_days(pieces, keep=keep))
        older = increments.build(built, AS_OF, f"{folder}/daily", buckets=2)
        stored = marts.refresh(built, AS_OF, f"{folder}/marts")
    fresh = days(plans.daily_snapshot(built["stg_invoices"], AS_OF))
    assert days(older[FACT]) == days(stored[FACT]) == fresh
    later = AS_OF + timedelta(days=40)
    newer = increments.append(built, later, f"{folder}/daily")
    assert len({p[2] for p in increments.published(spark, f"{folder}/daily")[-1].live}) == 2
    assert days(newer[FACT]) == days(plans.daily_snapshot(built["stg_invoices"], later))


def test_checks_group_days_by_64_bits(spark):
    """The key of a balance is a plain number if it fits; both kinds give the same runs."""
    values = [EDGE, EDGE, BEYOND, BEYOND, MOST, EDGE, None, Decimal(0), -BEYOND, -EDGE]
    rows = [(date(2024, 1, 1) + timedelta(days=n), 1, Decimal(1), v) for n, v in enumerate(values)]
    snapshot = spark.createDataFrame(rows, (
        "snapshot_date date, organization_id long, daily_net_change_usd decimal(38,8), "
        "cumulative_net_financial_balance_usd decimal(38,8)"))
    found = boundaries.stretches(snapshot)
    assert "decimal(18,8)" in found._jdf.queryExecution().optimizedPlan().toString()
    runs = sorted((r.first_day.day, r.last_day.day, r.first_balance) for r in found.collect() if r.first_day)
    assert runs == [(1, 2, EDGE), (3, 4, BEYOND), (5, 5, MOST), (6, 6, EDGE), (7, 7, None), (8, 8, Decimal(0)),
                    (9, 9, -BEYOND), (10, 10, -EDGE)]
    # From the largest to the edge, and to minus ten billion; a missing balance is not compared.
    assert boundaries.joined(found).first().falls == 2
