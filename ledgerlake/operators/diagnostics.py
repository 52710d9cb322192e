"""The reference's diagnostic SQL as DataFrame functions (AGG3-AGG6, AGG24, PRJ1,
Q8, Q9, SRT1, SRT2, LIM1, SET1).

``as_of`` replaces ``CURRENT_DATE``.  Orderings follow PostgreSQL: NULLs last on
ascending keys, first on descending ones (Spark's defaults are the opposite).
The three prior-cycle reports filter the same rows; on a cycle-partitioned line-item
table the cycle predicate prunes to two partitions and the date range is pushed to
the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cycles import last_cycles, last_days, period_keys_for, prior_cycles_booked, stored_last_days
from ..functions.money import SUM_TYPE, as_sum, money


def prior_cycle_rows(items: DataFrame, as_of: dt.date | str) -> DataFrame:
    """FLT4: last month's (and last year's same-month) cycle booked in the as_of month."""
    return items.filter(prior_cycles_booked("billing_cycle", "bill_date", as_of))


def is_reversal() -> F.Column:
    """FLT5: ``cash_amount < 0 OR is_reversal``."""
    return (F.col("cash_amount") < 0) | F.coalesce(F.col("is_reversal"), F.lit(False))


def prior_cycle_summary(items: DataFrame, as_of: dt.date | str) -> DataFrame:
    """AGG3: COUNT, MIN/MAX bill_date (as text) per cycle."""
    return prior_cycle_rows(items, as_of).groupBy("billing_cycle").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("bill_date").cast("string").alias("min_bill_date"),
        F.max("bill_date").cast("string").alias("max_bill_date"),
    )


DETAIL_COLUMNS = (
    "record_id", "bill_date", "billing_cycle", "product_code", "product_name", "cash_amount",
    "pretax_amount", "is_reversal", "account_id", "synced_at", "created_at",
)


def prior_cycle_detail(items: DataFrame, as_of: dt.date | str) -> DataFrame:
    """AGG4: the rows, ordered by cycle, date, cash (NULLs last)."""
    return (
        prior_cycle_rows(items, as_of)
        .select(*DETAIL_COLUMNS)
        .orderBy(
            F.col("billing_cycle").asc_nulls_last(),
            F.col("bill_date").asc_nulls_last(),
            F.col("cash_amount").asc_nulls_last(),
        )
    )


def prior_cycle_reversals(items: DataFrame, as_of: dt.date | str) -> DataFrame:
    """AGG5: COUNT, SUM(cash), SUM(pretax) of reversal rows per cycle."""
    return (
        prior_cycle_rows(items, as_of)
        .filter(is_reversal())
        .groupBy("billing_cycle")
        .agg(
            F.count(F.lit(1)).alias("reversal_count"),
            as_sum(F.sum("cash_amount")).alias("cash_sum"),
            as_sum(F.sum("pretax_amount")).alias("pretax_sum"),
        )
    )


def aggregate_listing(agg: DataFrame) -> DataFrame:
    """Q9.1: aggregate rows with ROUND(total, 2), ordered by report type and key."""
    return agg.select(
        "report_type",
        "period_key",
        "metric_type",
        money("total_amount").alias("total_amount"),
        "account_id",
        F.to_date(F.col("last_success_at")).alias("last_success")
        if "last_success_at" in agg.columns
        else F.lit(None).cast("date").alias("last_success"),
    ).orderBy(F.col("report_type").asc_nulls_last(), F.col("period_key").asc_nulls_last())


def daily_recent(daily: DataFrame, as_of: dt.date | str, days: int = 30) -> DataFrame:
    """Q9.2 / FLT2: daily_raw of the last ``days`` days, newest first.

    A table with its booking month ``bill_month`` is read from that of the first day on.
    """
    stored = "bill_month" in daily.columns
    recent = stored_last_days("bill_date", "bill_month", as_of, days) if stored else last_days("bill_date", as_of, days)
    return (
        daily.filter(recent)
        .select(
            "bill_date",
            money("total_amount").alias("total_amount"),
            money("cash_total_amount").alias("cash_total_amount"),
            "account_id",
        )
        .orderBy(F.col("bill_date").desc_nulls_first())
    )


def monthly_recent(monthly: DataFrame, as_of: dt.date | str, months: int = 12) -> DataFrame:
    """Q9.3 / FLT3: monthly_raw of the last ``months`` cycles, newest first."""
    return (
        monthly.filter(last_cycles("billing_cycle", as_of, months))
        .select(
            "billing_cycle",
            money("total_amount").alias("total_amount"),
            money(F.coalesce(F.col("cash_total_amount"), F.lit(0).cast(SUM_TYPE))).alias("cash_total_amount"),
            "account_id",
        )
        .orderBy(F.col("billing_cycle").desc_nulls_first())
    )


def report_type_summary(agg: DataFrame, metric: str = "payment") -> DataFrame:
    """AGG6 / FLT7: rows and ROUND(SUM, 2) per report type for one metric.

    The count is of rows (per account as well), although the reference's title speaks
    of period keys.
    """
    return (
        agg.filter(F.col("metric_type") == metric)
        .groupBy("report_type")
        .agg(F.count(F.lit(1)).alias("row_count"), money(F.sum("total_amount")).alias("sum_total_amount"))
        .orderBy(F.col("report_type").asc_nulls_last())
    )


def expected_periods(dates: DataFrame, date_col: str = "as_of") -> DataFrame:
    """PRJ11/SET1 per row: the eight (report_type, period_key) pairs of each date."""
    arr = F.array(
        *[
            F.struct(F.lit(t).alias("report_type"), k.alias("expected_period_key"))
            for t, k in period_keys_for(F.col(date_col))
        ]
    )
    return dates.select(date_col, F.inline(arr))


def missing_periods(agg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Q8: expected (report_type, period_key) for ``as_of`` that have no aggregate row."""
    spark = agg.sparkSession
    a = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    wanted = expected_periods(spark.range(1).select(F.lit(a).alias("as_of"))).select(
        "report_type", F.col("expected_period_key").alias("period_key")
    )
    have = agg.select("report_type", "period_key").distinct()
    return F.broadcast(wanted).join(have, ["report_type", "period_key"], "left_anti")


def row_probe(df: DataFrame, cond: F.Column | None = None, name: str = "") -> DataFrame:
    """AGG24: ``COUNT(*)`` with an optional predicate, as one row (table, cnt)."""
    d = df if cond is None else df.filter(cond)
    return d.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")



def cash_flow(tx: DataFrame) -> DataFrame:
    """PRJ1 / V1 ``finops_cash_flow``: renamed projection of the BSS transactions."""
    return tx.select(
        F.col("transaction_number").alias("flow_id"),
        "account_id",
        F.col("transaction_time").alias("occurred_at"),
        "amount",
        F.col("transaction_type").alias("flow_type"),
        "transaction_flow",
        "billing_cycle",
        "currency",
        "synced_at",
    )
