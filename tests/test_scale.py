"""What must not grow with the generated days: no sort of them, neither to write nor to check them."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ledgerfold.operators import balances, boundaries, quality, staging
from ledgerfold.operators.balances import daily_activity
from ledgerfold.plans import checks
from ledgerfold.plans import tables as plans
from ledgerfold.sources import catalog, increments, marts
from ledgerfold.sources.workspace import OPEN_FILES

AS_OF = golden.AS_OF.replace(year=2030)
SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def writes(spark, monkeypatch):
    """(files open at once, most folders that a task writes) of each write with a month."""
    found = []

    def noted(name):
        write = getattr(DataFrameWriter, name)

        def noting(self, *args, **more):
            if marts.MONTH in self._df.columns:
                places = self._df.select(F.spark_partition_id().alias("task"), *{marts.MONTH, "bucket"} & set(self._df.columns))
                tasks = places.distinct().groupBy("task").count()
                found.append((int(spark.conf.get(SETTING)), tasks.agg(F.max("count")).first()[0]))
            return write(self, *args, **more)

        monkeypatch.setattr(DataFrameWriter, name, noting)

    noted("parquet")
    noted("saveAsTable")
    return found


def built(spark):
    orgs = spark.createDataFrame([], "ORGANIZATION_ID string, FIRST_PAYMENT_DATE date, LAST_PAYMENT_DATE date, "
                                 "LEGAL_ENTITY_COUNTRY_CODE int, COUNT_TOTAL_CONTRACTS_ACTIVE long, "
                                 "CREATED_DATE timestamp_ntz")
    return plans.build_tables(golden.raw_invoices(spark), orgs, AS_OF)


@pytest.mark.parametrize("store", ["folders", "catalog", "increments"])
def test_days_are_written_without_a_sort(spark, tmp_path, writes, store):
    """Spark sorts no rows by folder where a task may keep all its files open."""
    tables = built(spark)
    if store == "folders":
        stored = marts.refresh(tables, AS_OF, str(tmp_path))
    elif store == "catalog":
        stored = catalog.refresh(tables, AS_OF, "scale_marts", buckets=3)
    else:
        stored = increments.build(tables, AS_OF, str(tmp_path), buckets=3)
    (open_files, folders), = writes
    assert open_files == OPEN_FILES >= folders
    assert int(spark.conf.get(SETTING)) == 0
    assert sorted(map(str, stored[checks.FACT].select(*tables[checks.FACT].columns).collect())) == sorted(
        map(str, tables[checks.FACT].collect()))
    spark.sql("DROP DATABASE IF EXISTS scale_marts CASCADE")


def test_files_of_catalog_tables_are_whole_buckets(spark, tmp_path):
    days = daily_activity(staging.stg_invoices(golden.raw_invoices(spark)), AS_OF)
    spark.sql("CREATE DATABASE scale_buckets")
    catalog.save_snapshot(days, AS_OF, "scale_buckets.fct", 3)
    files = spark.table("scale_buckets.fct").select(
        marts.MONTH, F.pmod(F.hash("organization_id"), F.lit(3)).alias("bucket"), F.input_file_name().alias("file"))
    assert files.distinct().groupBy(marts.MONTH, "bucket").count().agg(F.max("count")).first()[0] == 1
    spark.sql("DROP DATABASE scale_buckets CASCADE")


SCHEMA = ("snapshot_date date, organization_id long, daily_net_change_usd decimal(38,8), "
          "cumulative_net_financial_balance_usd decimal(38,8)")
FIRST = date(2023, 11, 1)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_checks_of_a_lazy_snapshot_sort_no_days(spark):
    """No organisation is suspect, so that neither the second reading nor its sort is left."""
    tables = built(spark)
    for found in (checks.unique_combination(tables), quality.balance_consistency(tables[checks.FACT])):
        plan = plan_of(found)
        generated = plan[:plan.index("Generate explode(sequence")] if "Generate explode(sequence" in plan else ""
        assert "Sort [organization_id" not in generated and "snapshot_date ASC" not in plan, plan


@pytest.mark.parametrize("changes, expected", [
    ([], 0), ([5, 5], 0), ([5, -5, 5, -5], 0), ([1] * 130, 0),
])
def test_stretches_follow_each_other(spark, changes, expected):
    """A balance that comes back leaves runs in order, across the ends of 64 days."""
    rows, balance = [], Decimal(0)
    for n, change in enumerate(changes * 20):
        balance += change
        rows += [(FIRST + timedelta(days=3 * n + k), 1, Decimal(change if k == 0 else 0), balance) for k in range(3)]
    snapshot = spark.createDataFrame(rows, SCHEMA)
    per_key = boundaries.joined(boundaries.stretches(snapshot))
    assert [(r.torn, r.falls, r["rows"]) for r in per_key.collect()] == ([(False, expected, len(rows))] if rows else [])


def test_falls_and_repeats_are_found_where_they_are(spark):
    usd = Decimal(1)
    rows = [(FIRST + timedelta(days=n), org, Decimal(0), usd * 7) for org in (1, 2, 3, None) for n in range(100)]
    rows += [(FIRST + timedelta(days=100), 2, Decimal(0), usd), *[(FIRST + timedelta(days=64), 3, usd, usd * 9)] * 3]
    rows += [(FIRST, None, Decimal(0), usd * 7)]
    snapshot = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r[0] for r in boundaries.repeating(snapshot).collect()} == {3, None}
    assert {r[0] for r in boundaries.suspects(snapshot).collect()} == {2, 3, None}
    assert checks.unique_combination({checks.FACT: snapshot}).first().failures == 2
    assert (FIRST + timedelta(days=100), 2) in {(r[0], r[1]) for r in quality.balance_consistency(snapshot).collect()}


def test_a_checked_snapshot_needs_no_python(spark):
    """Summaries are made where rows are read, and only they are shuffled."""
    found = boundaries.joined(boundaries.stretches(built(spark)[checks.FACT]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert "snapshot_date ASC" not in plan


def test_the_dense_plan_shuffles_no_days(spark, monkeypatch):
    """Days are generated after the last shuffle, in tasks that their number sets, and sorted once."""
    stg = staging.stg_invoices(golden.raw_invoices(spark))
    monkeypatch.setattr(balances, "DAYS_PER_TASK", 100)
    dense = plans.daily_snapshot(stg, AS_OF, plan="dense")
    plan = dense._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    above = plan[:plan.index("Generate explode(sequence")]
    assert "Exchange" not in above and "Join" not in above and above.count("Sort [") == 1, plan
    assert dense.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(str, dense.collect())) == sorted(map(str, plans.daily_snapshot(stg, AS_OF).collect()))
