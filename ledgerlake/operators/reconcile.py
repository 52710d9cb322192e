"""Reconciliation and correction (AGG1, AGG2, JN5, Q1-Q5).

The reference's tool reconciles one cycle at a time from the driver.  Here one lazy
plan reconciles **all** cycles at once: three aggregates (line items by cycle, daily
raw by booking month, API totals) meet in a full outer join on (cycle, account).  The
joined sides are aggregates (cycles x accounts rows), so the join is small whatever
the input size; AQE turns it into a broadcast join at runtime when the measured sides
are small.

Decision rule (fixed values of the reference):
  ref_total = line-items sum if it is non-zero, else the daily sum of the month
  drift     = ref_total - api_total
  PASS      iff |drift| <= 0.01 (inclusive), decided before any rounding
  no API total -> outcome UNKNOWN, status left unchanged
Status machine: PASS -> FINALIZED; DRIFT -> DIRTY (trigger-worker) or FINALIZED with
line_items_sum = api_total and drift 0 after a calibration row (patch); dry-run and
report-only write nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cycles import cycle_of, in_month, month_end, stored_in_month
from ..functions.money import RECONCILE_TOLERANCE, SUM_TYPE, as_sum, money, within_tolerance

from ..fixed_values import (  # noqa: E402
    CALIBRATION_PRODUCT,
    RECONCILE_MODES,
    STATUS_DIRTY,
    STATUS_FINALIZED,
)

KEYS = ["billing_cycle", "account_id"]


def daily_cash(daily: DataFrame, cycle: str | None = None, by_account: bool = False) -> DataFrame:
    """AGG1: Σ cash per booking date across all accounts (optionally per account).

    With ``cycle`` the dates are limited to that month by a pushed-down range (FLT1), and
    by the partition where the table has its booking month ``bill_month``.
    """
    d = daily
    if cycle is not None:
        stored = "bill_month" in daily.columns
        d = daily.filter(stored_in_month("bill_date", "bill_month", cycle) if stored else in_month("bill_date", cycle))
    keys = ["bill_date"] + (["account_id"] if by_account else [])
    return d.groupBy(*keys).agg(
        cycle_of(F.first("bill_date")).alias("billing_cycle"),
        F.coalesce(F.sum("cash_total_amount"), F.lit(0)).cast(SUM_TYPE).alias("cash_sum"),
    )


def cycle_cash(items: DataFrame, cycle: str | None = None, by_account: bool = False) -> DataFrame:
    """AGG2: ``COALESCE(SUM(cash_amount), 0)`` per cycle.

    With ``cycle`` it is a global aggregate over the pruned partition, so an empty cycle
    still yields one row of 0 — as the reference query does.
    """
    if cycle is not None:
        return items.filter(F.col("billing_cycle") == cycle).agg(
            F.lit(cycle).alias("billing_cycle"),
            F.coalesce(F.sum("cash_amount"), F.lit(0)).cast(SUM_TYPE).alias("cash_sum"),
        )
    keys = ["billing_cycle"] + (["account_id"] if by_account else [])
    return items.groupBy(*keys).agg(
        F.coalesce(F.sum("cash_amount"), F.lit(0)).cast(SUM_TYPE).alias("cash_sum")
    )


def reconcile(
    items: DataFrame,
    daily: DataFrame,
    api_totals: DataFrame,
    tol: str = RECONCILE_TOLERANCE,
    level: str = "account",
    status: DataFrame | None = None,
) -> DataFrame:
    """Q1/JN5: outcome per (billing_cycle, account_id) — or per cycle with ``level="cycle"``.

    ``api_totals`` has (billing_cycle, account_id, monthly_api_total): the totals given
    for this run.  Where a key has none, the total recorded in the month-status table
    ``status`` is used (the tool's fallback); with neither, the outcome is UNKNOWN.  At
    cycle level the accounts are summed (the tool reads one all-account total), and the
    cycle is UNKNOWN while one of its accounts has no total; ``level="known"`` sums the
    accounts with a total alone, on both sides.
    """
    if level not in ("account", "cycle", "known"):
        raise ValueError("level is 'account', 'cycle' or 'known'")
    keys = KEYS
    li = items.groupBy(*keys).agg(as_sum(F.sum("cash_amount")).alias("line_items_sum"))
    dd = daily.groupBy(cycle_of(F.col("bill_date")).alias("billing_cycle"), *keys[1:]).agg(
        as_sum(F.sum("cash_total_amount")).alias("daily_sum")
    )
    given = api_totals.select(*KEYS, as_sum(F.col("monthly_api_total")).alias("monthly_api_total"))
    if status is not None:
        stored = status.filter(F.col("monthly_api_total").isNotNull()).select(
            *KEYS, as_sum(F.col("monthly_api_total")).alias("_stored")
        )
        given = given.join(stored, KEYS, "full_outer").select(
            *KEYS, F.coalesce(F.col("monthly_api_total"), F.col("_stored")).alias("monthly_api_total")
        )
    api = given.groupBy(*keys).agg(as_sum(F.sum("monthly_api_total")).alias("monthly_api_total"))
    j = li.join(dd, keys, "full_outer").join(api, keys, "full_outer")
    if level == "known":
        j = j.filter(F.col("monthly_api_total").isNotNull())
    if level != "account":
        keys = ["billing_cycle"]
        unknown = F.count_if(F.col("monthly_api_total").isNull())
        j = j.groupBy(*keys).agg(
            as_sum(F.sum("line_items_sum")).alias("line_items_sum"),
            as_sum(F.sum("daily_sum")).alias("daily_sum"),
            F.when(unknown == 0, as_sum(F.sum("monthly_api_total"))).alias("monthly_api_total"),
        )
    li_sum = F.coalesce(F.col("line_items_sum"), F.lit(0)).cast(SUM_TYPE)
    d_sum = F.coalesce(F.col("daily_sum"), F.lit(0)).cast(SUM_TYPE)
    ref = F.when(li_sum != 0, li_sum).otherwise(d_sum)
    out = j.select(
        *keys,
        li_sum.alias("line_items_sum"),
        d_sum.alias("daily_sum"),
        ref.alias("ref_total"),
        F.col("monthly_api_total"),
    ).withColumn("drift", (F.col("ref_total") - F.col("monthly_api_total")).cast(SUM_TYPE))
    return out.withColumn(
        "outcome",
        F.when(F.col("monthly_api_total").isNull(), F.lit("UNKNOWN"))
        .when(within_tolerance(F.col("drift"), tol), F.lit("PASS"))
        .otherwise(F.lit("DRIFT")),
    ).withColumn(
        "data_status",
        F.when(F.col("outcome") == "PASS", F.lit(STATUS_FINALIZED)).when(F.col("outcome") == "DRIFT", F.lit(STATUS_DIRTY)),
    )


MODES = RECONCILE_MODES + ("dry-run",)  # the tool's --dry-run flag as a mode


def transition(outcome: DataFrame, mode: str = "trigger-worker", run_ts=None) -> DataFrame:
    """Q2: status rows to write for each reconciled key (columns of T6).

    - PASS  -> FINALIZED with the rounded sums (every mode but dry-run/report-only)
    - DRIFT -> DIRTY (trigger-worker) | FINALIZED with line_items_sum = api total and
      drift 0 (patch, together with ``calibration_rows``)
    - UNKNOWN -> nothing written
    dry-run and report-only write nothing (the reference lets report-only fall into the
    trigger branch; that quirk is not copied).  ``exit_code`` is 2 where a dry run sees
    drift, as the tool's CI signal.  Status columns are NUMERIC(14,2): rounding happens
    after the tolerance decision, so a 0.012 drift is DIRTY yet stored as 0.01.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    writes = mode in ("trigger-worker", "patch")
    drift = F.col("outcome") == "DRIFT"
    patched = drift & F.lit(mode == "patch")
    status = F.when(patched, F.lit(STATUS_FINALIZED)).otherwise(F.col("data_status"))
    li = F.when(patched, F.col("monthly_api_total")).otherwise(F.col("ref_total"))
    dr = F.when(patched, F.lit(0)).otherwise(F.col("drift"))
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    keys = [c for c in KEYS if c in outcome.columns]
    return outcome.select(
        *keys,
        status.alias("data_status"),
        money(li).cast("decimal(14,2)").alias("line_items_sum"),
        money(F.col("monthly_api_total")).cast("decimal(14,2)").alias("monthly_api_total"),
        money(dr.cast(SUM_TYPE)).cast("decimal(14,2)").alias("drift_amount"),
        (F.lit(writes) & (F.col("outcome") != "UNKNOWN")).alias("write"),
        F.when(drift & F.lit(mode == "dry-run"), F.lit(2)).otherwise(F.lit(0)).alias("exit_code"),
        ts.alias("last_reconciled_at"),
    )


def calibration_rows(outcome: DataFrame, account: str | None = None) -> DataFrame:
    """Q3: one daily_raw row per drifting key: ``api - ref`` on the cycle's last day.

    The breakdown is ``{"系统校准": diff}``.  The reference writes account ''; by default
    the row goes to the reconciled account itself (our reconcile is per account); pass
    ``account=""`` for the reference's placement.
    """
    diff = (F.col("monthly_api_total") - F.col("ref_total")).cast(SUM_TYPE)
    acct = F.lit(account) if account is not None else F.col("account_id")
    m = F.create_map(F.lit(CALIBRATION_PRODUCT), diff)
    return outcome.filter(F.col("outcome") == "DRIFT").select(
        month_end("billing_cycle").alias("bill_date"),
        acct.alias("account_id"),
        diff.alias("total_amount"),
        m.alias("product_breakdown"),
        diff.alias("cash_total_amount"),
        m.alias("cash_product_breakdown"),
    )


def daily_report(daily: DataFrame, outcome: DataFrame) -> DataFrame:
    """Q4: per (cycle, account, day) the day's cash, a refund-day flag, and the
    account's month verdict (local total, API total, signed drift, within tolerance).

    Days are those of the cycle's calendar month; the month verdict is joined on
    (cycle, account) — a small side, one row per key.
    """
    days = daily.select(
        cycle_of(F.col("bill_date")).alias("billing_cycle"),
        "account_id",
        "bill_date",
        as_sum(F.col("cash_total_amount")).alias("day_cash"),
    )
    verdict = outcome.select(
        *KEYS,
        F.col("ref_total").alias("local_total"),
        "monthly_api_total",
        F.col("drift").alias("drift_signed"),
        F.when(F.col("monthly_api_total").isNotNull(), within_tolerance(F.col("drift"))).alias("within_tolerance"),
    )
    return days.withColumn("is_refund_day", F.col("day_cash") < 0).join(verdict, KEYS, "left")


def parts_check(parts: DataFrame, totals: DataFrame, keys: list[str], part_col: str, total_col: str,
                tol: str = RECONCILE_TOLERANCE) -> DataFrame:
    """Q5: Σ parts (categories) equals the total within tolerance, per key."""
    s = parts.groupBy(*keys).agg(as_sum(F.sum(part_col)).alias("parts_sum"))
    t = totals.select(*keys, as_sum(F.col(total_col)).alias("total"))
    j = s.join(t, keys, "full_outer")
    diff = (F.coalesce(F.col("parts_sum"), F.lit(0)) - F.coalesce(F.col("total"), F.lit(0))).cast(SUM_TYPE)
    return j.withColumn("difference", diff).withColumn("balanced", within_tolerance(diff, tol))
