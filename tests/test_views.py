"""Views: categories, scaling, trend, period-over-period, routing (JN2-JN9, AGG10-AGG15, WIN1, WIN2)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from ledgerlake.operators import views as vw


def test_category_precedence_and_scaling(spark):
    mapping = spark.createDataFrame([("ECS", "compute"), ("PROMO_X", "storage")], "product_code string, category string")
    parts = spark.createDataFrame(
        [("c", "ECS", D("30")), ("c", "PROMO_X", D("10")), ("c", "ZZZ", D("20"))],
        "k string, product_code string, cost decimal(14,6)",
    )
    cat = vw.category_of("product_code", mapping, {"PRO": "security"}, parts)
    got = {r.product_code: r.category for r in cat.collect()}
    assert got == {"ECS": "compute", "PROMO_X": "security", "ZZZ": "other"}  # prefix rule wins
    totals = spark.createDataFrame([("c", D("100"))], "k string, total decimal(14,6)")
    exact = {r.category: r.scaled_cost for r in vw.category_breakdown(cat, totals, ["k"]).collect()}
    assert abs(sum(exact.values()) - 100.0) < 1e-9
    rounded = vw.category_breakdown(cat, totals, ["k"], round_to=2).collect()
    assert sum(r.scaled_cost for r in rounded) == D("100.00")  # residual goes to the largest
    zero = spark.createDataFrame([("c", "ECS", D("5")), ("c", "ZZZ", D("-5"))], "k string, product_code string, cost decimal(14,6)")
    z = vw.category_breakdown(vw.category_of("product_code", mapping, {}, zero), totals, ["k"]).collect()
    assert sorted(r.scaled_cost for r in z) == [-5.0, 5.0]  # sum 0: unscaled


def test_period_over_period_gaps_and_zero(spark):
    s = spark.createDataFrame(
        [("p", "2025-01", D("0")), ("p", "2025-02", D("10")), ("p", "2025-04", D("5")), ("p", "2025-05", D("6"))],
        "product_code string, billing_cycle string, amount decimal(14,6)",
    )
    got = {r.billing_cycle: r for r in vw.period_over_period(s, ["product_code"], "billing_cycle", "amount").collect()}
    assert got["2025-01"].is_new
    assert got["2025-02"].pct_change is None and not got["2025-02"].is_new  # predecessor 0
    assert got["2025-04"].is_new  # March missing: calendar-correct, not lag
    assert abs(got["2025-05"].pct_change - 20.0) < 1e-9


def test_product_trend_fills_gaps(spark):
    d = spark.createDataFrame(
        [(dt.date(2025, 1, 1), "p", D("1")), (dt.date(2025, 1, 4), "p", D("2")), (dt.date(2025, 1, 2), "q", D("3"))],
        "bill_date date, product_code string, amount decimal(14,6)",
    )
    rows = vw.product_trend(d).collect()
    p = sorted((r.bill_date, r.amount) for r in rows if r.product_code == "p")
    assert [a for _d, a in p] == [D("1"), D("0"), D("0"), D("2")]
    assert len([r for r in rows if r.product_code == "q"]) == 1


def test_ledger_headline_routing(spark):
    items = spark.createDataFrame(
        [("2025-01", "a", D("0"), D("0")), ("2025-01", "b", D("5"), D("6"))],
        "billing_cycle string, account_id string, pretax_amount decimal(14,6), pretax_gross_amount decimal(14,6)",
    )
    flows = spark.createDataFrame([("2025-01", "b", D("4"), "Income")], "billing_cycle string, account_id string, amount decimal(14,6), transaction_flow string")
    outst = spark.createDataFrame([("2025-01", "c", D("2"))], "billing_cycle string, account_id string, outstanding_amount decimal(14,6)")
    led = vw.ledger(items, flows, outst)
    assert led.count() == 3
    totals = spark.createDataFrame([("2025-01", "a", D("7")), ("2025-01", "b", D("5"))], "billing_cycle string, account_id string, total_amount decimal(14,6)")
    h = {r.account_id: r for r in vw.headline(led, totals).collect()}
    assert h["a"].technical_amount == D("7") and h["a"].finance_amount is None  # C=0, total>0
    assert h["b"].technical_amount == D("5") and h["b"].finance_amount == D("4")
    cfg = spark.createDataFrame([("POC", "a", "api"), ("UAT", "b", None)], "environment string, account_id string, source string")
    assert vw.source_label(cfg).first()[0] == "mixed"
    assert vw.source_label(cfg.filter("source is null")).first()[0] == "oss"
