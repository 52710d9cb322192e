"""Reconcile decision rule, status transition and calibration (Q1-Q4, SNK3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlake.operators import reconcile as rc
from ledgerlake.operators import upsert as up

ITEMS = "billing_cycle string, account_id string, bill_date date, cash_amount decimal(14,6)"
DAILY = "bill_date date, account_id string, cash_total_amount decimal(38,6)"
API = "billing_cycle string, account_id string, monthly_api_total decimal(24,6)"


def _run(spark, items, daily, api):
    return {
        (r.billing_cycle, r.account_id): r
        for r in rc.reconcile(
            spark.createDataFrame(items, ITEMS), spark.createDataFrame(daily, DAILY), spark.createDataFrame(api, API)
        ).collect()
    }


def test_tolerance_boundaries(spark):
    d = dt.date(2025, 2, 10)
    items = [("2025-02", a, d, D("100")) for a in ("a0", "a1", "a2", "a3", "a4", "a5")]
    api = [
        ("2025-02", "a0", D("100")),        # drift 0 -> pass
        ("2025-02", "a1", D("99.99")),      # drift 0.01 -> pass (inclusive)
        ("2025-02", "a2", D("99.989999")),  # 0.010001 -> drift
        ("2025-02", "a3", D("100.01")),     # -0.01 -> pass
        ("2025-02", "a4", D("99.988")),     # 0.012 -> drift, stored as 0.01
    ]
    out = _run(spark, items, [], api)
    assert out[("2025-02", "a0")].outcome == "PASS"
    assert out[("2025-02", "a1")].outcome == "PASS"
    assert out[("2025-02", "a2")].outcome == "DRIFT"
    assert out[("2025-02", "a3")].outcome == "PASS"
    assert out[("2025-02", "a4")].outcome == "DRIFT"
    assert out[("2025-02", "a5")].outcome == "UNKNOWN"  # no API total
    assert out[("2025-02", "a5")].data_status is None


def test_zero_line_items_fall_back_to_daily(spark):
    items = [("2025-03", "x", dt.date(2025, 3, 1), D("5")), ("2025-03", "x", dt.date(2025, 3, 2), D("-5"))]
    daily = [(dt.date(2025, 3, 1), "x", D("7")), (dt.date(2025, 3, 31), "x", D("-1.5"))]
    out = _run(spark, items, daily, [("2025-03", "x", D("5.5"))])
    r = out[("2025-03", "x")]
    assert r.line_items_sum == 0 and r.daily_sum == D("5.5") and r.ref_total == D("5.5")
    assert r.outcome == "PASS"


def test_negative_month(spark):
    out = _run(spark, [("2025-10", "p", dt.date(2025, 10, 3), D("-1834.15"))], [], [("2025-10", "p", D("-1834.15"))])
    assert out[("2025-10", "p")].outcome == "PASS"


def test_transition_modes_and_rounding(spark):
    outcome = rc.reconcile(
        spark.createDataFrame([("2025-02", "a", dt.date(2025, 2, 1), D("100"))], ITEMS),
        spark.createDataFrame([], DAILY),
        spark.createDataFrame([("2025-02", "a", D("99.988"))], API),
    )
    t = rc.transition(outcome, "trigger-worker", run_ts="2026-01-01 00:00:00").first()
    assert t.data_status == "DIRTY" and t.drift_amount == D("0.01") and t.write
    p = rc.transition(outcome, "patch").first()
    assert p.data_status == "FINALIZED" and p.drift_amount == D("0.00") and p.line_items_sum == D("99.99")
    dry = rc.transition(outcome, "dry-run").first()
    assert not dry.write and dry.exit_code == 2
    assert not rc.transition(outcome, "report-only").first().write


def test_calibration_rows_and_additive_upsert(spark):
    outcome = rc.reconcile(
        spark.createDataFrame([("2024-02", "a", dt.date(2024, 2, 3), D("10"))], ITEMS),
        spark.createDataFrame([(dt.date(2024, 2, 3), "a", D("10"))], DAILY),
        spark.createDataFrame([("2024-02", "a", D("12.5"))], API),
    )
    cal = rc.calibration_rows(outcome).first()
    assert cal.bill_date == dt.date(2024, 2, 29)  # leap-year month end
    assert cal.total_amount == D("2.5") and cal.product_breakdown == {"系统校准": D("2.5")}
    daily = spark.createDataFrame(
        [(dt.date(2024, 2, 29), "a", D("1"), {"ECS": D("1")})],
        "bill_date date, account_id string, total_amount decimal(38,6), product_breakdown map<string,decimal(38,6)>",
    )
    patch = rc.calibration_rows(outcome).select("bill_date", "account_id", "total_amount", "product_breakdown")
    once = up.upsert_add(daily, patch, ["bill_date", "account_id"], ["total_amount"], ["product_breakdown"]).first()
    assert once.total_amount == D("3.5") and once.product_breakdown == {"ECS": D("1"), "系统校准": D("2.5")}
    # two patches on one day add up; order does not matter
    twice = up.upsert_add(daily, patch.unionByName(patch), ["bill_date", "account_id"], ["total_amount"]).first()
    assert twice.total_amount == D("6")


def test_patched_cycle_reconciles_to_zero(spark):
    items = spark.createDataFrame([("2025-05", "a", dt.date(2025, 5, 2), D("0"))], ITEMS)
    daily = spark.createDataFrame([(dt.date(2025, 5, 2), "a", D("8"))], DAILY)
    api = spark.createDataFrame([("2025-05", "a", D("10"))], API)
    out = rc.reconcile(items, daily, api)
    cal = rc.calibration_rows(out).select("bill_date", "account_id", "cash_total_amount")
    patched = up.upsert_add(daily, cal, ["bill_date", "account_id"], ["cash_total_amount"])
    again = rc.reconcile(items, patched, api).first()
    assert again.drift == 0 and again.outcome == "PASS"


def test_daily_report_flags_refund_days(spark):
    daily = spark.createDataFrame(
        [(dt.date(2025, 2, 1), "a", D("5")), (dt.date(2025, 2, 2), "a", D("-2"))], DAILY
    )
    items = spark.createDataFrame([("2025-02", "a", dt.date(2025, 2, 1), D("3"))], ITEMS)
    out = rc.reconcile(items, daily, spark.createDataFrame([("2025-02", "a", D("3"))], API))
    rep = {r.bill_date: r for r in rc.daily_report(daily, out).collect()}
    assert rep[dt.date(2025, 2, 2)].is_refund_day and not rep[dt.date(2025, 2, 1)].is_refund_day
    assert rep[dt.date(2025, 2, 1)].within_tolerance


def test_cycle_cash_empty_cycle_gives_zero_row(spark):
    items = spark.createDataFrame([("2025-02", "a", dt.date(2025, 2, 1), D("3"))], ITEMS)
    r = rc.cycle_cash(items, "2030-01").collect()
    assert len(r) == 1 and r[0].cash_sum == 0
    assert rc.daily_cash(spark.createDataFrame([(dt.date(2025, 2, 1), "a", D("3"))], DAILY), "2025-02").count() == 1


def test_api_total_falls_back_to_month_status(spark):
    items = [("2025-02", "a", dt.date(2025, 2, 1), D("10")), ("2025-02", "b", dt.date(2025, 2, 1), D("10"))]
    status = spark.createDataFrame(
        [("2025-02", "b", D("10.00")), ("2025-02", "a", D("99.00"))],
        "billing_cycle string, account_id string, monthly_api_total decimal(14,2)",
    )
    out = {
        (r.billing_cycle, r.account_id): r
        for r in rc.reconcile(
            spark.createDataFrame(items, ITEMS), spark.createDataFrame([], DAILY),
            spark.createDataFrame([("2025-02", "a", D("10"))], API), status=status,
        ).collect()
    }
    assert out[("2025-02", "a")].monthly_api_total == D("10")  # the given total wins
    assert out[("2025-02", "b")].outcome == "PASS"  # taken from month status


def test_invariant_days_sum_to_month(spark):
    """Σ of the daily roll-up over a booking month = Σ of that month's line items."""
    from ledgerlake import fixtures as fx
    from ledgerlake.operators import rollup as ru

    from .conftest import SF_SMALL

    items = fx.line_items(spark, SF_SMALL)
    by_day = ru.daily_rollup(items).groupBy(F.date_format("bill_date", "yyyy-MM").alias("m")).agg(
        F.sum("cash_total_amount").alias("s"), F.sum("total_amount").alias("t")
    )
    by_item = items.groupBy(F.date_format("bill_date", "yyyy-MM").alias("m")).agg(
        F.sum("cash_amount").alias("s"), F.sum("pretax_amount").alias("t")
    )
    a = {r.m: (r.s, r.t) for r in by_day.collect()}
    b = {r.m: (r.s, r.t) for r in by_item.collect()}
    assert a == b and len(a) > 12


def test_totals_match_rollups(spark):
    """The totals-only roll-ups give the same totals as the map-building ones."""
    from ledgerlake import fixtures as fx
    from ledgerlake.operators import rollup as ru

    from .conftest import SF_SMALL

    items = fx.line_items(spark, SF_SMALL)
    cols = ["total_amount", "cash_total_amount"]
    a = ru.daily_rollup(items).select("bill_date", "account_id", *cols)
    b = ru.daily_totals(items)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ov = fx.overview_items(items)
    for pos in (False, True):
        m1 = ru.monthly_rollup(ov, positive_only=pos).select("billing_cycle", "account_id", *cols)
        m2 = ru.monthly_totals(ov, positive_only=pos)
        assert m1.exceptAll(m2).count() == 0 and m2.exceptAll(m1).count() == 0


def test_cycle_level_outcomes(spark):
    from ledgerlake.operators import reconcile as rc

    d = lambda x: D(x)
    items = spark.createDataFrame(
        [("2025-01", "a", d("5")), ("2025-01", "b", d("7")), ("2025-02", "a", d("5")), ("2025-03", "a", d("5")), ("2025-03", "b", d("1"))],
        "billing_cycle string, account_id string, cash_amount decimal(14,6)",
    )
    daily = spark.createDataFrame([], "bill_date date, account_id string, cash_total_amount decimal(14,6)")
    api = spark.createDataFrame(
        [("2025-01", "a", d("5")), ("2025-01", "b", d("7.01")), ("2025-02", "a", d("6")), ("2025-03", "a", d("5"))],
        "billing_cycle string, account_id string, monthly_api_total decimal(14,6)",
    )
    got = {r.billing_cycle: r.outcome for r in rc.reconcile(items, daily, api, level="cycle").collect()}
    assert got == {"2025-01": "PASS", "2025-02": "DRIFT", "2025-03": "UNKNOWN"}
    known = {r.billing_cycle: (r.outcome, r.ref_total) for r in rc.reconcile(items, daily, api, level="known").collect()}
    assert known["2025-03"] == ("PASS", D("5.000000"))
