"""The batch jobs end to end: CSV in, marts, checks and alerts out."""

from __future__ import annotations

from datetime import timedelta

import golden
import pytest
from pyspark.sql import functions as F

from ledgerfold.__main__ import main
from ledgerfold.sources import marts
from ledgerfold.schemas import RAW_INVOICES

NUMBER = {org: n for n, org in enumerate("ABCDEFGHIJKL")}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    org = F.ascii("ORGANIZATION_ID") - F.ascii(F.lit("A"))
    rows = golden.raw_invoices(spark).withColumn("ORGANIZATION_ID", org.cast("long"))
    rows.to(RAW_INVOICES).write.option("header", True).csv(f"{folder}/csv")
    (folder / "orgs.csv").write_text(
        "ORGANIZATION_ID,FIRST_PAYMENT_DATE,LAST_PAYMENT_DATE,LEGAL_ENTITY_COUNTRY_CODE,"
        "COUNT_TOTAL_CONTRACTS_ACTIVE,CREATED_DATE\n"
        + "".join(f"{n},,,840,1,2023-01-01 00:00:00\n" for n in range(11))
    )
    return folder


def test_jobs(spark, folder):
    sources = ["--invoices", f"{folder}/inv", "--organizations", f"{folder}/orgs",
               "--as-of", golden.AS_OF.isoformat()]
    assert main(["ingest", "--csv", f"{folder}/csv/*.csv", "--out", f"{folder}/inv"]) == 0
    assert main(["ingest", "--table", "organizations", "--csv", f"{folder}/orgs.csv",
                 "--out", f"{folder}/orgs"]) == 0
    assert main(["build", *sources, "--out", f"{folder}/marts"]) == 0
    assert main(["check", *sources, "--marts", f"{folder}/marts", "--relationships",
                 "--out", f"{folder}/report"]) == 1
    assert main(["alerts", "--marts", f"{folder}/marts", "--out", f"{folder}/out"]) == 0

    stored = marts.load(spark, f"{folder}/marts")
    assert stored[marts.FACT].count() == 39
    assert stored[marts.DIMENSION].count() == 11
    summary = spark.read.parquet(f"{folder}/out/summary").collect()
    assert [tuple(r) for r in summary] == [(golden.AS_OF - timedelta(days=1), 9, len(golden.ALERTS))]
    failing = spark.read.parquet(f"{folder}/report").where("NOT passed").collect()
    assert {(r.check_id, r.failures) for r in failing} == {
        ("Q07", 1), ("Q16", 7), ("Q19", 4), ("Q20", 1), ("Q22", 3), ("Q23", 3)
    }
    rows = spark.read.parquet(f"{folder}/out/alerts").collect()
    assert {r.organization_id: r.change_display for r in rows} == {
        NUMBER[org]: shown for org, (_, _, shown) in golden.ALERTS.items()
    }


def test_jobs_on_tables_by_name(spark, folder):
    db = ["--database", "ledger_jobs"]
    assert main(["ingest", "--csv", f"{folder}/csv/*.csv", *db]) == 0
    assert main(["ingest", "--table", "organizations", "--csv", f"{folder}/orgs.csv", *db]) == 0
    sources = ["--invoices", "ledger_jobs.raw_invoices", "--organizations", "ledger_jobs.raw_organizations",
               "--as-of", golden.AS_OF.isoformat()]
    assert main(["build", *sources, *db]) == 0
    assert main(["check", *sources, *db, "--relationships", "--out", f"{folder}/db-report"]) == 1
    assert main(["alerts", *db, "--out", f"{folder}/db-out"]) == 0
    failing = spark.read.parquet(f"{folder}/db-report").where("NOT passed").collect()
    assert {(r.check_id, r.failures) for r in failing} == {
        ("Q07", 1), ("Q16", 7), ("Q19", 4), ("Q20", 1), ("Q22", 3), ("Q23", 3)
    }
    rows = spark.read.parquet(f"{folder}/db-out/alerts").collect()
    assert {r.organization_id for r in rows} == {NUMBER[org] for org in golden.ALERTS}
    described = spark.sql("DESCRIBE EXTENDED ledger_jobs.raw_invoices").collect()
    assert any("Invoices as delivered" in (r.data_type or "") for r in described)


def test_append_job(spark, folder):
    sources = ["--invoices", f"{folder}/inv", "--organizations", f"{folder}/orgs"]
    for days in (3, 1, 0):
        as_of = (golden.AS_OF - timedelta(days=days)).isoformat()
        assert main(["append", *sources, "--as-of", as_of, "--out", f"{folder}/daily"]) == 0
    assert main(["alerts", "--marts", f"{folder}/daily", "--out", f"{folder}/daily-out"]) == 0
    rows = spark.read.parquet(f"{folder}/daily-out/alerts").collect()
    assert {r.organization_id for r in rows} == {NUMBER[org] for org in golden.ALERTS}


def test_alerts_without_a_day(spark, folder):
    early = ["--invoices", f"{folder}/inv", "--organizations", f"{folder}/orgs", "--as-of", "2020-01-01"]
    assert main(["build", *early, "--out", f"{folder}/none"]) == 0
    assert main(["alerts", "--marts", f"{folder}/none", "--out", f"{folder}/no-alerts"]) == 2
    assert spark.read.parquet(f"{folder}/no-alerts/alerts").isEmpty()


def test_threshold_must_have_two_decimals(spark):
    from ledgerfold.operators.alerts import alert_summary

    pairs = spark.createDataFrame([], "snapshot_date date, previous_day_balance decimal(38,8), "
                                      "current_balance decimal(38,8)")
    for bad in ("50.001", "-1", "1e9"):
        with pytest.raises(ValueError):
            alert_summary(pairs, golden.dec(bad))
