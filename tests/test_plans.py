"""The physical plans we rely on at scale."""

from __future__ import annotations

import golden
import pytest

import __spark_entry__ as contract
from ledgerfold.operators import balances, staging
from ledgerfold.plans import checks
from ledgerfold.plans.tables import daily_snapshot, latest_pairs
from ledgerfold.sources import raw

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stg(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "invoices")
    rows = golden.raw_invoices(spark)
    rows.withColumn("ORGANIZATION_ID", rows.INVOICE_ID % 5).write.parquet(path)
    return staging.stg_invoices(raw.read_invoices(spark, path))


def executed(df):
    """Lines of the plan that ran, without the initial plans shown beside it."""
    df.collect()
    hidden = None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if hidden is not None and depth >= hidden:
            continue
        hidden = None
        if "== Initial Plan ==" in line:
            hidden = depth
        else:
            yield line


@pytest.mark.parametrize("scope", ["paid", "all"])
def test_snapshot_scans_invoices_once(stg, scope):
    """The spine start reuses the exchange of the daily sums."""
    plan = list(executed(daily_snapshot(stg, golden.AS_OF, spine_scope=scope)))
    assert sum("FileScan" in line for line in plan) == 1, "\n".join(plan)
    assert sum("ReusedExchange" in line for line in plan) == 1


def test_filters_and_columns_reach_the_scan(stg):
    plan = daily_snapshot(stg, golden.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "In(STATUS, [credited,paid,refunded])" in plan
    assert "LessThan(CREATED_AT," in plan
    for unused in ("PAYMENT_METHOD", "TRANSACTION_ID", "PARENT_INVOICE_ID", "TYPE#"):
        assert unused not in plan


def test_map_side_sums_before_every_shuffle_of_invoices(stg):
    plan = daily_snapshot(stg, golden.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_day_generation_keeps_its_task_count(stg):
    plan = daily_snapshot(stg, golden.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_pairs_need_no_further_shuffle(stg):
    """The lag runs in the partitions of the running sum."""
    plan = latest_pairs(stg, golden.AS_OF)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert main.count("Window [") == 2
    assert main.count("Exchange hashpartitioning(organization_id#") <= 2


@pytest.mark.parametrize("name", sorted(contract.balance_queries()))
def test_no_python_and_no_row_pairing(spark, name):
    df = contract.balance_queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in plan


def test_scaffold_aggregates_spans_once(stg):
    spans = balances.organization_spans(stg)
    plan = list(executed(balances.organization_daily_scaffold(spans, golden.AS_OF)))
    assert sum("FileScan" in line for line in plan) == 1, "\n".join(plan)


def test_suite_reads_invoices_three_times_and_generates_days_once(spark, stg):
    """One scan for the snapshot, one for the ids, one for all other checks of invoices."""
    orgs = spark.createDataFrame(
        [(1, 840, golden.AS_OF)],
        "organization_id long, legal_entity_country_code int, organization_created_date date",
    )
    built = {
        "stg_invoices": stg,
        "stg_organizations": orgs,
        "dim_organizations": orgs,
        checks.FACT: daily_snapshot(stg, golden.AS_OF),
    }
    plan = list(executed(checks.run_suite(built, with_relationships=True)))
    assert sum("FileScan" in x for x in plan) == 3, "\n".join(plan)
    assert sum("Generate explode(sequence" in x for x in plan) == 1, "\n".join(plan)
