"""Roll-ups: daily, monthly, period aggregates, bill summary, metric unpivot
(AGG7, AGG8, AGG9, AGG22, PRJ8, SET2).

Every roll-up is a two-level ``groupBy``: per (keys, product) first — Spark runs it
as partial + final hash aggregation, so a hot key is pre-combined on the map side
before the shuffle — then per keys, where each group holds at most one row per
product.  No window, no per-row Python.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import METRIC_CONSUMPTION, METRIC_PAYMENT, STATUS_PRELIMINARY
from ..functions.breakdown import AMOUNT, breakdown_array, map_from_entries_sorted
from ..functions.cycles import cycle_of, cycle_periods, day_periods, period_keys_for
from ..functions.money import payment_amount

METRICS = (METRIC_CONSUMPTION, METRIC_PAYMENT)


def _rollup(df: DataFrame, keys: Sequence[str], product: str, amounts: dict[str, str]) -> DataFrame:
    """Totals and product maps per ``keys`` for each amount column.

    A NULL amount (e.g. a zero payment that must not count) adds nothing to the total
    and no entry to the map; totals default to 0.
    """
    per_product = df.groupBy(*keys, F.coalesce(F.col(product), F.lit("")).alias("_p")).agg(
        *[F.sum(F.col(c)).cast(AMOUNT).alias(f"_a{i}") for i, c in enumerate(amounts)]
    )
    aggs = []
    for i, prefix in enumerate(amounts.values()):
        a = F.col(f"_a{i}")
        aggs.append(F.coalesce(F.sum(a), F.lit(0)).cast(AMOUNT).alias(f"{prefix}total_amount"))
        entry = F.when(a.isNotNull(), F.struct(F.col("_p").alias("key"), a.alias("value")))
        aggs.append(map_from_entries_sorted(F.collect_list(entry)).alias(f"{prefix}product_breakdown"))
    return per_product.groupBy(*keys).agg(*aggs)


def daily_rollup(items: DataFrame) -> DataFrame:
    """AGG7: line items -> T13 ``cost_cloud_bill_daily_raw`` per (bill_date, account_id).

    total/product_breakdown = PretaxAmount (consumption);
    cash_total_amount/cash_product_breakdown = CashAmount (payment).
    """
    return _rollup(
        items,
        ("bill_date", "account_id"),
        "product_code",
        {"pretax_amount": "", "cash_amount": "cash_"},
    )


def with_month(daily: DataFrame) -> DataFrame:
    """``daily`` with its booking month ``bill_month``, by which stored daily tables are partitioned."""
    return daily.withColumn("bill_month", cycle_of(F.col("bill_date")))


def monthly_rollup(*overviews: DataFrame, positive_only: bool = False) -> DataFrame:
    """AGG8: overview items -> T12 ``cost_cloud_bill_monthly_raw`` per (cycle, account).

    The reference queries the overview once per subscription type and merges the
    results; pass each result (or one frame holding both) — they are unioned by name
    (SET2) and summed.  Cash = PaymentAmount if non-zero else CashAmount (PRJ7); a row
    whose cash is 0 does not count.  ``positive_only`` (FLT9) keeps only rows with
    PaymentAmount > 0 for the cash metric.
    """
    df = overviews[0]
    for o in overviews[1:]:
        df = df.unionByName(o, allowMissingColumns=True)
    if positive_only:
        cash = F.when(F.col("PaymentAmount") > 0, F.col("PaymentAmount"))
    else:
        pay = payment_amount("PaymentAmount", "CashAmount")
        cash = F.when(pay != 0, pay)
    df = df.withColumn("_cash", cash)
    return _rollup(
        df,
        ("billing_cycle", "account_id"),
        "ProductCode",
        {"PretaxAmount": "", "_cash": "cash_"},
    )


def unpivot_metrics(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PRJ8: wide (total, cash_total + two maps) -> rows with ``metric_type``.

    ``inline`` of a two-element array keeps each amount with its own map, in one pass.
    """
    return raw.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.lit(METRIC_CONSUMPTION).alias("metric_type"),
                    F.col("total_amount").alias("total_amount"),
                    F.col("product_breakdown").alias("product_breakdown"),
                ),
                F.struct(
                    F.lit(METRIC_PAYMENT).alias("metric_type"),
                    F.col("cash_total_amount").alias("total_amount"),
                    F.col("cash_product_breakdown").alias("product_breakdown"),
                ),
            )
        ),
    )


def _merge_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum totals and merge product maps over rows sharing ``keys``.

    Relies on the roll-up invariant total = Σ map values (``_rollup`` builds both from
    the same per-product sums; ``upsert_add`` keeps it).  One explode, then two
    aggregations: per (keys, product), then per keys — a row with an empty map still
    yields its key with total 0.
    """
    exploded = df.select(*keys, F.explode_outer("product_breakdown").alias("_p", "_v"))
    per_product = exploded.groupBy(*keys, "_p").agg(F.sum("_v").cast(AMOUNT).alias("_v"))
    entry = F.when(F.col("_p").isNotNull() & F.col("_v").isNotNull(), F.struct(F.col("_p").alias("key"), F.col("_v").alias("value")))
    return per_product.groupBy(*keys).agg(
        F.coalesce(F.sum("_v"), F.lit(0)).cast(AMOUNT).alias("total_amount"),
        map_from_entries_sorted(F.collect_list(entry)).alias("product_breakdown"),
    )


def period_aggregate(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """AGG9 (history form): T14 ``cost_cloud_bill_aggregate`` for every period in the data.

    Day-based report types (``1d``, ``this_week``) come from daily_raw by booking date;
    month-based ones (``month``, ``quarter``, ``this_year``) from monthly_raw by billing
    cycle, as the reference's UI notes state.  One ``inline`` of the period array per
    raw row (no scan per period), then one merge per (report_type, period_key, account,
    metric_type).  Inputs are already aggregated, so the fan-out is small.
    """
    keys = ["report_type", "period_key", "account_id", "metric_type"]
    d = unpivot_metrics(daily, ["bill_date", "account_id"]).select(
        F.inline(day_periods("bill_date")), "account_id", "metric_type", "total_amount", "product_breakdown"
    )
    m = unpivot_metrics(monthly, ["billing_cycle", "account_id"]).select(
        F.inline(cycle_periods("billing_cycle")), "account_id", "metric_type", "total_amount", "product_breakdown"
    )
    merged = _merge_by(d.unionByName(m), keys)
    return merged.withColumn("data_status", F.lit(STATUS_PRELIMINARY))


def inputs_as_of(daily: DataFrame, monthly: DataFrame, as_of: dt.date | str) -> tuple[DataFrame, DataFrame]:
    """The daily and monthly rows that the report types of ``as_of`` can need.

    Days: yesterday and the ISO week of ``as_of``; cycles: its year and the one before.
    Literal ranges on the grouping columns, so they are pushed to the scan below.
    """
    a = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    monday = a - dt.timedelta(days=a.weekday())
    low = min(monday, a - dt.timedelta(days=1))
    days = F.col("bill_date").between(F.lit(low), F.lit(monday + dt.timedelta(days=6)))
    cycles = F.col("billing_cycle").between(F.lit(f"{a.year - 1:04d}-01"), F.lit(f"{a.year:04d}-12"))
    return daily.filter(days), monthly.filter(cycles)


def period_aggregate_as_of(history: DataFrame, as_of: dt.date | str) -> DataFrame:
    """AGG9 (ETL form): the eight report types the ETL writes on ``as_of``.

    ``last_month``/``last_quarter``/``last_year`` reuse the history rows of the
    month/quarter/year key one period back; ``1d`` is yesterday.  The expected keys
    are an 8-row literal table (PRJ11), broadcast into an equi-join.
    """
    source_type = {
        "1d": "1d", "this_week": "this_week", "month": "month", "last_month": "month",
        "quarter": "quarter", "last_quarter": "quarter", "this_year": "this_year", "last_year": "this_year",
    }
    spark = history.sparkSession
    wanted = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("report_type"),
                        F.lit(source_type[t]).alias("source_type"),
                        k.alias("period_key"),
                    )
                    for t, k in period_keys_for(as_of)
                ]
            )
        )
    )
    h = history.withColumnRenamed("report_type", "source_type")
    return F.broadcast(wanted).join(h, ["source_type", "period_key"]).drop("source_type")


def bill_summary(daily: DataFrame) -> DataFrame:
    """AGG22: T4 ``cost_cloud_bill_summary`` per (day, cycle ``YYYYMM``), all accounts.

    total_amount = consumption total; ``product_breakdown`` in the array shape with pct
    (PRJ14).  The cycle is the booking month written ``YYYYMM`` as in the reference's
    sample row.
    """
    exploded = daily.select(
        F.col("bill_date").alias("day"),
        F.date_format("bill_date", "yyyyMM").alias("billing_cycle"),
        F.explode("product_breakdown").alias("_p", "_v"),
    )
    summed = _rollup(
        exploded.withColumnRenamed("_v", "amount"), ("day", "billing_cycle"), "_p", {"amount": ""}
    )
    return summed.select(
        "day",
        "billing_cycle",
        "total_amount",
        breakdown_array("product_breakdown", "total_amount").alias("product_breakdown"),
    )


def recompute_daily_window(items: DataFrame, as_of: dt.date | str, lookback: int = 7) -> DataFrame:
    """ST3 (daily): daily_raw for T-1 and the ``lookback`` days before it.

    Late corrections are never dropped: the window is re-aggregated from the line
    items each run and written over those (date, account) slices.
    """
    a = F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
    window = (F.col("bill_date") >= F.date_sub(a, lookback + 1)) & (F.col("bill_date") <= F.date_sub(a, 1))
    return daily_rollup(items.filter(window))


def recompute_cycles(
    items: DataFrame, as_of: dt.date | str, overview: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """ST3 (monthly): monthly_raw for the as_of cycle and the one before it.

    ``overview`` turns line items into the overview rows that the roll-up reads.
    """
    a = F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
    touched = items.filter(F.col("billing_cycle").isin(cycle_of(a), cycle_of(F.add_months(a, -1))))
    return monthly_rollup(overview(touched))


def daily_totals(items: DataFrame) -> DataFrame:
    """AGG7 totals only: (bill_date, account_id, total_amount, cash_total_amount).

    The same totals as ``daily_rollup`` in one aggregation (no per-product step), for
    consumers that never read the breakdown (reconcile, daily cash, listings).
    """
    return items.groupBy("bill_date", "account_id").agg(
        F.coalesce(F.sum("pretax_amount"), F.lit(0)).cast(AMOUNT).alias("total_amount"),
        F.coalesce(F.sum("cash_amount"), F.lit(0)).cast(AMOUNT).alias("cash_total_amount"),
    )


def monthly_totals(*overviews: DataFrame, positive_only: bool = False) -> DataFrame:
    """AGG8 totals only: (billing_cycle, account_id, total_amount, cash_total_amount)."""
    df = overviews[0]
    for o in overviews[1:]:
        df = df.unionByName(o, allowMissingColumns=True)
    if positive_only:
        cash = F.when(F.col("PaymentAmount") > 0, F.col("PaymentAmount"))
    else:
        pay = payment_amount("PaymentAmount", "CashAmount")
        cash = F.when(pay != 0, pay)
    return df.groupBy("billing_cycle", "account_id").agg(
        F.coalesce(F.sum("PretaxAmount"), F.lit(0)).cast(AMOUNT).alias("total_amount"),
        F.coalesce(F.sum(cash), F.lit(0)).cast(AMOUNT).alias("cash_total_amount"),
    )
