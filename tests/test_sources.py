"""CSV loading, stored marts and views."""

from __future__ import annotations

import glob
import os

from datetime import timedelta

import golden
import pytest
from pyspark.errors import AnalysisException

from ledgerfold.operators import alerts, staging
from ledgerfold.operators.balances import daily_activity
from ledgerfold.plans import checks
from ledgerfold.plans import tables as plans
from ledgerfold.schemas import RAW_INVOICES, RAW_ORGANIZATIONS
from ledgerfold.sources import catalog, marts, raw
from ledgerfold.sources.workspace import check_shared, shared_folder

HEADER = ",".join(f.name for f in RAW_INVOICES)
ROW = '1,,11,7,x,paid,USD,USD,card,"1,5",2.50,1,,2024-01-03 08:00:00'


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def by_key(df):
    return sorted(map(str, df.collect()))


def test_csv_files_are_loaded(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, ROW)
    write(tmp_path / "in", "b.csv", HEADER, ROW.replace("1,,11", "2,1,12").replace('"1,5"', '""'))
    df = raw.ingest_csv(spark, f"{tmp_path}/in/*.csv", f"{tmp_path}/raw")
    rows = {r.INVOICE_ID: r for r in df.collect()}
    assert df.schema == RAW_INVOICES
    assert rows[1].PARENT_INVOICE_ID is None and rows[1].AMOUNT == "1,5"
    assert rows[2].PARENT_INVOICE_ID == 1 and rows[2].AMOUNT == ""
    assert rows[1].FX_RATE_PAYMENT is None
    assert by_key(raw.read_invoices(spark, f"{tmp_path}/raw")) == by_key(df)
    staged = staging.stg_invoices(df).orderBy("invoice_id").collect()
    assert [r.amount for r in staged] == [None, None]


def test_organisations_from_csv(spark, tmp_path):
    write(
        tmp_path / "in", "o.csv", ",".join(f.name for f in RAW_ORGANIZATIONS),
        "7,2024-01-01,,840,3,2023-12-31 10:00:00",
    )
    raw.ingest_csv(spark, f"{tmp_path}/in", f"{tmp_path}/raw", RAW_ORGANIZATIONS)
    orgs = staging.stg_organizations(raw.read_organizations(spark, f"{tmp_path}/raw"))
    assert str(orgs.first().organization_created_date) == "2023-12-31"
    assert len(orgs.columns) == 7
    assert staging.dim_organizations(orgs).columns == [
        c for c in orgs.columns if c != "created_date_timestamp"
    ]


def test_missing_csv(spark, tmp_path):
    with pytest.raises(AnalysisException):
        raw.ingest_csv(spark, f"{tmp_path}/none/*.csv", f"{tmp_path}/raw")
    assert not os.path.exists(f"{tmp_path}/raw")


@pytest.mark.parametrize("lines, message", [
    ((HEADER.replace("INVOICE_ID", "OTHER", 1), ROW), "header does not conform"),
    ((HEADER, "1,2,3"), "MALFORMED_CSV_RECORD"),
    ((HEADER, ROW.replace("1,,11", "x,,11")), "CAST_INVALID_INPUT"),
    ((HEADER, ROW.replace("2024-01-03", "2024-99-03")), "CAST_INVALID_INPUT"),
], ids=["other header", "short row", "key not a number", "no such day"])
def test_malformed_csv_fails(spark, tmp_path, lines, message):
    write(tmp_path / "in", "a.csv", *lines)
    with pytest.raises(Exception, match=message):
        raw.read_csv(spark, f"{tmp_path}/in", RAW_INVOICES).collect()


@pytest.mark.parametrize("files", [None, 3])
def test_stored_snapshot(spark, tmp_path, files):
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    as_of = golden.AS_OF.replace(month=3)
    path = f"{tmp_path}/fct"
    marts.write_snapshot(daily_activity(stg, as_of), as_of, path, files_per_month=files)
    stored = marts.read_snapshot(spark, path)
    fresh = plans.daily_snapshot(stg, as_of)
    assert by_key(stored.drop(marts.MONTH)) == by_key(fresh)
    assert len(glob.glob(f"{path}/{marts.MONTH}=*")) == 3
    assert len(glob.glob(f"{path}/{marts.MONTH}=2024-01-01/*.parquet")) <= (files or 2)  # eight tasks over three months
    assert stored.schema["snapshot_date"].metadata["comment"]
    pairs = alerts.balance_day_pairs(stored)
    assert by_key(pairs) == by_key(plans.latest_pairs(stg, as_of))
    # A full refresh replaces what is there.
    marts.write_snapshot(daily_activity(stg), golden.AS_OF, path)
    assert len(glob.glob(f"{path}/{marts.MONTH}=*")) == 1


def test_latest_day_at_a_month_start(spark, tmp_path):
    """The previous day lies in another folder."""
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    as_of = golden.AS_OF.replace(month=2, day=2)
    marts.write_snapshot(daily_activity(stg, as_of), as_of, f"{tmp_path}/fct")
    pairs = alerts.balance_day_pairs(marts.read_snapshot(spark, f"{tmp_path}/fct"))
    assert by_key(pairs) == by_key(plans.latest_pairs(stg, as_of))
    # All have a previous day but E, whose only invoice is from the first of February.
    assert {r[1] for r in pairs.where("previous_day_balance IS NULL").collect()} == {"E"}


def test_only_two_days_are_read(spark, tmp_path):
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    marts.write_snapshot(daily_activity(stg), golden.AS_OF.replace(month=6), f"{tmp_path}/fct")
    latest = spark.createDataFrame([(golden.AS_OF.replace(month=5, day=31),)], "d date").scalar()
    pairs = alerts.balance_day_pairs(marts.read_snapshot(spark, f"{tmp_path}/fct"), latest)
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    scans = plan.split("PartitionFilters: ")[1:]
    assert scans and all(f"{marts.MONTH}#" in scan.split("]")[0] for scan in scans)


def test_no_month_of_an_earlier_snapshot_stays(spark, tmp_path):
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for as_of in (golden.AS_OF.replace(month=6), golden.AS_OF.replace(month=2)):
            marts.write_snapshot(daily_activity(stg, as_of), as_of, f"{tmp_path}/fct")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    latest = alerts.latest_snapshot_date(marts.read_snapshot(spark, f"{tmp_path}/fct")).first()[0]
    assert latest == as_of - timedelta(days=1)


def test_a_short_history_uses_all_tasks(spark, tmp_path):
    rows = [(n, f"2024-01-{3 + n % 5:02d}") for n in range(400)]
    days = spark.createDataFrame(rows, "organization_id long, day string").selectExpr(
        "organization_id", "date(day) AS transaction_date", "CAST(1 AS decimal(38,8)) AS daily_net_change_usd",
        "true AS has_paid",
    )
    marts.write_snapshot(days, golden.AS_OF, f"{tmp_path}/fct")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(glob.glob(f"{tmp_path}/fct/{marts.MONTH}=2024-01-01/*.parquet")) > tasks // 2


def test_a_failed_refresh_keeps_the_last_one(spark, tmp_path, monkeypatch):
    orgs = spark.createDataFrame([], "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
                                 "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, "
                                 "CREATED_DATE timestamp_ntz")
    built = plans.build_tables(golden.raw_invoices(spark), orgs, golden.AS_OF)
    marts.refresh(built, golden.AS_OF, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(marts, "write_snapshot", lambda *a, **b: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            marts.refresh(built, golden.AS_OF, str(tmp_path))
    assert marts.load(spark, str(tmp_path))[marts.FACT].count() == 39
    for _ in range(2):
        marts.refresh(built, golden.AS_OF, str(tmp_path))
    assert marts.load(spark, str(tmp_path))[marts.FACT].count() == 39
    assert len(marts.published(spark, str(tmp_path))) == 3
    with pytest.raises(FileNotFoundError):
        marts.load(spark, f"{tmp_path}/none")


def test_refresh_and_views(spark, tmp_path):
    orgs = spark.createDataFrame(
        [("A", None, None, 840, 0, None)],
        "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
        "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, "
        "CREATED_DATE timestamp_ntz",
    )
    built = plans.build_tables(golden.raw_invoices(spark), orgs, golden.AS_OF)
    stored = marts.refresh(built, golden.AS_OF, str(tmp_path))
    assert set(stored) - set(built) == {"int_daily_activity", "latest_snapshot_date"}
    assert by_key(checks.run_suite(stored, True)) == by_key(checks.run_suite(built, True))
    marts.register_views(stored)
    count = lambda t: spark.sql(f"SELECT count(*) FROM {t}").first()[0]
    assert count("fct_daily_financial_snapshot") == 39
    assert count("dim_organizations") == 1
    assert count("stg_invoices") == 26
    assert str(spark.table("int_global_min_invoice_date").first()[0]) == "2024-01-03"


def test_catalog_marts(spark):
    """Bucketed tables behind views: the same checks, without a shuffle of the snapshot."""
    orgs = spark.createDataFrame(
        [("A", None, None, 840, 0, None)],
        "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
        "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, CREATED_DATE timestamp_ntz",
    )
    as_of = golden.AS_OF.replace(month=3)
    built = plans.build_tables(golden.raw_invoices(spark), orgs, as_of)
    for _ in range(3):
        stored = catalog.refresh(built, as_of, "catalog_marts", buckets=4)
    names = {t.name for t in spark.catalog.listTables("catalog_marts")}
    assert {f"{checks.FACT}{v}" for v in ("", "_v2", "_v3")} == {n for n in names if checks.FACT in n}
    fact = stored[checks.FACT]
    assert by_key(fact.drop(marts.MONTH)) == by_key(built[checks.FACT])
    assert stored["latest_snapshot_date"].first()[0] == as_of - timedelta(days=1)
    assert by_key(checks.run_suite(stored, True)) == by_key(checks.run_suite(built, True))
    report = checks.snapshot_checks(stored, with_relationships=False)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange ") == plan.count("Exchange SinglePartition") == 1
    pairs = alerts.balance_day_pairs(fact, stored["latest_snapshot_date"].scalar())
    assert by_key(pairs) == by_key(plans.latest_pairs(built["stg_invoices"], as_of))
    described = {r.col_name: (r.comment or "") + (r.data_type or "")
                 for r in spark.sql(f"DESCRIBE EXTENDED catalog_marts.{checks.FACT}").collect()}
    assert "Day of the balance" in described["snapshot_date"]
    assert "One row per organisation and day" in described["Comment"]


def test_buckets_follow_the_size(spark, monkeypatch):
    days = daily_activity(staging.stg_invoices(golden.raw_invoices(spark)))
    as_of = golden.AS_OF.replace(year=2030)
    assert catalog.bucket_count(days, as_of) == 1
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 100)
    organizations = days.select("organization_id").distinct().count()
    assert catalog.bucket_count(days, as_of) == organizations * 30 // 100  # some thirty days a month
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 1)
    assert catalog.bucket_count(days, as_of) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert catalog.bucket_count(days.limit(0), as_of) == 1


def test_catalog_table_keeps_comments(spark):
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_test")
    name = "marts_test.fct_daily_financial_snapshot"
    catalog.save_table(plans.daily_snapshot(stg, golden.AS_OF), name)
    catalog.save_table(plans.daily_snapshot(stg, golden.AS_OF), name)
    assert spark.table(name).count() == 39
    described = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    text = {r.col_name: (r.comment or "") + (r.data_type or "") for r in described}
    assert "Day of the balance" in text["snapshot_date"]
    assert "One row per organisation and day" in text["Comment"]


def test_shared_folder_follows_the_setting(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    if before:
        assert folder.startswith(before.rstrip("/"))
    assert folder != shared_folder(spark)


def test_a_folder_of_the_driver_will_not_do_on_a_cluster():
    for place in ("file:/tmp/warehouse", "/tmp/warehouse"):
        for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                check_shared(place, master)
        check_shared(place, "local[8]")
        check_shared(place, "local")
    check_shared("hdfs://store/warehouse", "yarn")


def test_catalog_readers_see_one_version(spark, monkeypatch):
    """A refresh that fails between two marts, or before the last step, changes nothing for any reader."""
    orgs = "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, LEGAL_ENTITY_COUNTRY_CODE int, " \
           "COUNT_TOTAL_CONTRACTS_ACTIVE long, CREATED_DATE timestamp_ntz"
    older = plans.build_tables(golden.raw_invoices(spark), spark.createDataFrame([], orgs), golden.AS_OF)
    later = golden.AS_OF.replace(day=15)
    newer = plans.build_tables(
        golden.raw_invoices(spark), spark.createDataFrame([("A", None, None, 840, 0, None)], orgs), later
    )
    db = "catalog_atomic"

    def seen():
        by_sql = {t: spark.sql(f"SELECT COUNT(*) FROM {db}.{t}").first()[0] for t in catalog.MARTS}
        loaded = {t: df.count() for t, df in catalog.load(spark, db).items()}
        assert by_sql == loaded
        return by_sql, spark.table(f"{db}.latest_snapshot_date").first()[0]

    catalog.refresh(older, golden.AS_OF, db, buckets=2)
    before = seen()
    shown, calls = catalog._show, []

    def stops(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("full")
        shown(*args)

    for name, broken in (("_show", stops), ("_point", lambda *a: (_ for _ in ()).throw(OSError("full")))):
        with monkeypatch.context() as patch:
            patch.setattr(catalog, name, broken)
            with pytest.raises(OSError):
                catalog.refresh(newer, later, db, buckets=2)
        assert seen() == before
    catalog.refresh(newer, later, db, buckets=2)
    after = seen()
    assert after != before and after[0]["dim_organizations"] == 1 and after[1] == later - timedelta(days=1)
    with pytest.raises(FileNotFoundError):
        catalog.load(spark, "default")


def test_new_files_are_loaded_once(spark, tmp_path):
    folder, quarantine = f"{tmp_path}/raw", lambda: sorted(
        (r.reason, r.record, r.file.split("/")[-1]) for r in raw.read_quarantine(spark, f"{tmp_path}/raw").collect()
    )
    two = ROW.replace("1,,11", "2,1,12")
    write(tmp_path / "in", "a.csv", HEADER, ROW, "1,2,3", two)
    load = lambda: sorted(r.INVOICE_ID for r in raw.load_new_files(spark, f"{tmp_path}/in/*.csv", folder).collect())
    assert load() == [1, 2]
    assert load() == [1, 2]
    assert quarantine() == [("malformed record", "1,2,3", "a.csv")]
    three, bad_day = ROW.replace("1,,11", "3,,13"), ROW.replace("1,,11", "x,,14").replace("2024-01-03", "2024-99-03")
    write(tmp_path / "in", "b.csv", HEADER, three, bad_day, f"{ROW},more")
    write(tmp_path / "in", "c.csv", HEADER.replace("INVOICE_ID", "OTHER", 1), ROW)
    assert load() == [1, 2, 3]
    reasons = [reason for reason, _, _ in quarantine()]
    assert reasons == ["invalid INVOICE_ID, CREATED_AT", "malformed record", "malformed record", "other header"]
    assert raw.read_loaded(spark, folder).schema == RAW_INVOICES
    write(tmp_path / "in", "a.csv", HEADER, ROW)
    with pytest.raises(ValueError, match="a.csv"):
        load()
    assert raw.read_loaded(spark, folder).count() == 3


def test_a_failed_load_leaves_no_rows(spark, tmp_path, monkeypatch):
    write(tmp_path / "in", "a.csv", HEADER, ROW)
    with monkeypatch.context() as patch:
        patch.setattr(raw, "_MANIFEST", "no schema")
        with pytest.raises(Exception):
            raw.load_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/raw")
    assert raw.read_loaded(spark, f"{tmp_path}/raw").count() == 0
    assert raw.load_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/raw").count() == 1
    assert raw.read_quarantine(spark, f"{tmp_path}/raw").count() == 0
