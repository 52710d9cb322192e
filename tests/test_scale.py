"""Scale guards: plans without windows over raw rows, cross or nested-loop joins;
hot keys (a third of all rows on one key) give exact results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import rollup as ru
from ledgerlake.operators import upsert as up
from ledgerlake.plans import load_all

from .conftest import SF_SMALL

CAT = load_all()
BATCH = sorted(n for n in CAT if not n.startswith("stream_"))
FORBIDDEN = ("Window", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_window_or_cross_join(spark, name):
    plan = CAT[name].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan], name


def test_hot_key_latest_and_rollup(spark):
    n = 30_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("r"), F.col("id").cast("string"))).alias("record_id"),
        F.col("id").alias("version"),
        (F.col("id") % 7).cast("decimal(14,6)").alias("cash_amount"),
        F.lit(dt.date(2025, 1, 1)).alias("bill_date"),
        F.when(F.col("id") % 3 == 0, F.lit("HOTACCT")).otherwise(F.lit("other")).alias("account_id"),
        F.lit("P").alias("product_code"),
        F.lit(0).cast("decimal(14,6)").alias("pretax_amount"),
    ).repartition(8)
    latest = {r.record_id: r.version for r in up.latest_per_key(base, ["record_id"], ["version"]).collect()}
    assert latest["HOT"] == max(i for i in range(n) if i % 3 == 0)
    assert len(latest) == 1 + (n - n // 3)
    daily = {r.account_id: r.cash_total_amount for r in ru.daily_rollup(base).collect()}
    expect = base.groupBy("account_id").agg(F.sum("cash_amount").alias("s")).collect()
    assert {r.account_id: r.s for r in expect} == daily


@pytest.mark.parametrize("name", ["daily_cash_for_cycle", "daily_recent"])
def test_booking_date_reads_prune_partitions(spark, name):
    plan = CAT[name].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "bill_month" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def _scans(spark, name):
    df = CAT[name].fn(spark, SF_SMALL)
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_reconcile_and_patch_scan_each_table_once(spark):
    assert _scans(spark, "reconcile_accounts") == 3  # items, daily table, API totals
    assert _scans(spark, "daily_raw_patched") <= 3
