"""Cycles, period keys, money rounding, keys, breakdown shapes (PRJ2-PRJ16, FLT1-FLT10)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake import functions as lf
from ledgerlake.operators import clean as cl


def test_cycle_strings(spark):
    df = spark.createDataFrame([("202502",), ("2025-02",), ("2025-2",), ("",), (None,), ("2025-13",)], "c string")
    rows = df.select("c", lf.normalize_cycle("c").alias("n")).select("c", "n", lf.valid_cycle("n").alias("ok")).collect()
    got = {r.c: (r.n, r.ok) for r in rows}
    assert got["202502"] == ("2025-02", True)
    assert got["2025-02"] == ("2025-02", True)
    assert got["2025-2"][1] is False  # unpadded is rejected
    assert got[""][1] is False
    assert got["2025-13"][1] is False
    good, bad = cl.split_cycles(df.withColumnRenamed("c", "billing_cycle"))
    assert good.count() == 2 and bad.count() == 4


@pytest.mark.parametrize(
    "as_of,expected",
    [
        ("2027-01-01", {"this_week": "2026-W53", "1d": "2026-12-31", "quarter": "2027-Q1", "last_year": "2026",
                        "last_month": "2026-12", "last_quarter": "2026-Q4"}),
        ("2024-12-30", {"this_week": "2025-W01", "month": "2024-12", "quarter": "2024-Q4"}),
        ("2026-03-31", {"last_month": "2026-02", "1d": "2026-03-30", "quarter": "2026-Q1"}),
        ("2024-02-29", {"last_year": "2023", "this_year": "2024", "1d": "2024-02-28"}),
    ],
)
def test_period_keys(spark, as_of, expected):
    row = spark.range(1).select(F.inline(lf.period_keys_array(as_of))).collect()
    got = {r.report_type: r.period_key for r in row}
    assert len(got) == 8
    for k, v in expected.items():
        assert got[k] == v


def test_month_end_and_in_month(spark):
    df = spark.createDataFrame([("2024-02",), ("2025-03",), ("2025-12",)], "c string")
    ends = [r.e for r in df.select(lf.month_end("c").alias("e")).collect()]
    assert ends == [dt.date(2024, 2, 29), dt.date(2025, 3, 31), dt.date(2025, 12, 31)]
    d = spark.createDataFrame([(dt.date(2025, 2, 28),), (dt.date(2025, 3, 1),), (dt.date(2025, 1, 31),)], "d date")
    assert d.filter(lf.in_month("d", "2025-02")).count() == 1


def test_in_month_pushes_range_to_scan(spark, tmp):
    spark.createDataFrame([(dt.date(2025, 2, 3),)], "bill_date date").write.parquet(tmp + "/t")
    plan = spark.read.parquet(tmp + "/t").filter(lf.in_month("bill_date", "2025-02"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bill_date" in plan and "LessThan(bill_date" in plan


def test_cycle_range_limit(spark):
    with pytest.raises(ValueError):
        lf.cycle_range("c", "2020-01", "2025-01")  # 61 months
    lf.cycle_range("c", "2020-01", "2024-12")  # exactly 60


def test_money_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(D("2.345"),), (D("-2.345"),), (D("2.344"),)], "x decimal(10,3)")
    assert [r.m for r in df.select(lf.money("x").alias("m")).collect()] == [D("2.35"), D("-2.35"), D("2.34")]


def test_payment_amount(spark):
    df = spark.createDataFrame([(D("3"), D("1")), (D("0"), D("-2")), (None, D("4")), (None, None)], "p decimal(10,2), c decimal(10,2)")
    assert [r.v for r in df.select(lf.payment_amount("p", "c").alias("v")).collect()] == [D("3"), D("-2"), D("4"), D("0")]


def test_legacy_account_rules(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("UAT",)], "account_id string")
    got = [r.account_id for r in cl.map_legacy_account(df).collect()]
    assert got == ["POC", "POC", " ", "UAT"]  # a blank-only account is left as it is
    assert [r.account_id for r in cl.fill_empty_account(df).collect()][0] == ""


def test_dedup_key_distinguishes_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(lf.dedup_key("x", "y").alias("k")).collect()]
    assert keys[0] != keys[1] and keys[1] == keys[2] and len(keys[0]) == 64


def test_env_tag(spark):
    df = spark.createDataFrame([('{"env":"UAT"}',), ("{}",), (None,)], "t string")
    assert [r.e for r in df.select(lf.env_tag("t").alias("e")).collect()] == ["UAT", "UNTAGGED", "UNTAGGED"]


def test_breakdown_shapes(spark):
    df = spark.createDataFrame(
        [('{"ECS": 20000, "OSS": -5}',), ('[{"product":"ECS","amount":20000,"pct":40}]',), ("{}",), (None,)], "j string"
    )
    maps = [r.m for r in df.select(lf.conform_breakdown("j").alias("m")).collect()]
    assert maps[0] == {"ECS": D("20000"), "OSS": D("-5")}
    assert maps[1] == {"ECS": D("20000")}
    assert maps[2] == {} and maps[3] is None
    arr = spark.createDataFrame([({"ECS": D("20000")}, D("50000"))], "m map<string,decimal(38,6)>, t decimal(38,6)")
    a = arr.select(lf.breakdown_array("m", "t").alias("a")).first().a[0]
    assert a.product == "ECS" and a.pct == 40.0
    s = arr.select(lf.breakdown_sum("m").alias("s")).first().s
    assert s == D("20000")
