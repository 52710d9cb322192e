"""User-facing views: environments, categories, ledger, trends (JN2, JN3, JN6, JN8,
JN9, AGG10-AGG15, WIN1, WIN2, SET2).

Joins with dimension tables (environment config, category mapping) and between
aggregates (cycles x accounts, or periods x products) carry no hint: Spark's byte
threshold and AQE decide at runtime whether a side is broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import METRIC_CONSUMPTION, METRIC_PAYMENT
from ..functions.money import SUM_TYPE, as_sum, ratio


# ----------------------------------------------------------------- dimensions
def with_environment(df: DataFrame, env: DataFrame) -> DataFrame:
    """JN2: attach environment, display name and sort order by account (left join)."""
    e = env.select("account_id", "environment", "display_name", "sort_order")
    return df.join(e, "account_id", "left")


def category_of(product_col: str, mapping: DataFrame, prefix_rules: dict[str, str], df: DataFrame,
                default: str = "other") -> DataFrame:
    """JN3: category = prefix rule first, mapping table second, ``default`` last.

    Prefix rules are configuration (a handful of entries) and become one CASE
    expression; the mapping table is a broadcast left join.  The fallback literal
    ``other`` is ours.
    """
    rule = None
    for prefix, cat in prefix_rules.items():
        cond = F.col(product_col).startswith(prefix)
        rule = F.when(cond, F.lit(cat)) if rule is None else rule.when(cond, F.lit(cat))
    m = mapping.select(F.col("product_code").alias("_pc"), F.col("category").alias("_mapped"))
    j = df.join(m, F.col(product_col) == F.col("_pc"), "left")
    parts = ([rule] if rule is not None else []) + [F.col("_mapped"), F.lit(default)]
    return j.withColumn("category", F.coalesce(*parts)).drop("_pc", "_mapped")


def category_breakdown(parts: DataFrame, totals: DataFrame, keys: Sequence[str], round_to: int | None = None) -> DataFrame:
    """AGG10: category sums scaled so that they add up to the total, per ``keys``.

    ``parts`` has (keys, category, cost); ``totals`` has (keys, total).  scaled =
    cost * total / Σcost.  Σcost = 0 leaves the costs unscaled (ours).  With
    ``round_to`` the scaled amounts are rounded and the rounding residual goes to the
    largest category, so the rounded parts add up exactly to the rounded total.
    Without it the scaled value is an exact-ratio double.
    """
    keys = list(keys)
    by_cat = parts.groupBy(*keys, "category").agg(as_sum(F.sum("cost")).alias("cost"))
    sums = by_cat.groupBy(*keys).agg(
        as_sum(F.sum("cost")).alias("parts_sum"),
        F.max_by("category", F.struct(F.abs(F.col("cost")), F.col("category"))).alias("_largest"),
    )
    j = by_cat.join(sums, keys).join(totals.select(*keys, as_sum(F.col("total")).alias("total")), keys, "left")
    factor = ratio(F.col("total"), F.col("parts_sum"))
    if round_to is None:
        scaled = F.when(F.col("parts_sum") == 0, F.col("cost").cast("double")).otherwise(
            F.col("cost").cast("double") * factor
        )
        return j.select(*keys, "category", "cost", "total", "parts_sum", scaled.alias("scaled_cost"))
    # exact decimal scaling, rounded; residual to the largest category
    exact = F.when(F.col("parts_sum") == 0, F.col("cost")).otherwise(
        F.col("cost") * F.col("total") / F.col("parts_sum")
    )
    rounded = j.withColumn("_r", F.round(exact, round_to).cast(SUM_TYPE))
    resid = rounded.groupBy(*keys).agg(
        (F.round(F.first("total"), round_to) - F.sum("_r")).cast(SUM_TYPE).alias("_resid"),
    )
    out = rounded.join(resid, keys).withColumn(
        "scaled_cost",
        F.when(
            (F.col("category") == F.col("_largest")) & (F.col("parts_sum") != 0), F.col("_r") + F.col("_resid")
        ).otherwise(F.col("_r")).cast(SUM_TYPE),
    )
    return out.select(*keys, "category", "cost", "total", "parts_sum", "scaled_cost")


def apportioned(parts: DataFrame, totals: DataFrame, keys: Sequence[str], places: int = 2) -> DataFrame:
    """AGG10 in decimal: the total of each key shared among its categories by their cost, to the cent.

    Largest remainders: a category gets its exact share rounded down, and the units still
    missing go one each to the greatest remainders (ties: by category).  Shares, remainders
    and order are computed in whole units, so the parts sum to the rounded total exactly,
    also with negative costs.  Costs that sum to 0 are rounded, not scaled (ours).  A key's
    categories are those of the configuration, so its array is bounded.
    """
    keys, whole = list(keys), "decimal(38,0)"
    by_cat = parts.groupBy(*keys, "category").agg(as_sum(F.sum("cost")).alias("cost"))
    sums = by_cat.groupBy(*keys).agg(as_sum(F.sum("cost")).alias("parts_sum"))
    total = totals.select(*keys, F.round(F.col("total"), places).cast("decimal(38,2)").alias("total"))
    j = by_cat.join(sums, keys).join(total, keys)
    weight = (F.abs("parts_sum") * F.lit(10**6)).cast(whole)
    signed = F.when(F.col("parts_sum") < 0, -F.col("cost")).otherwise(F.col("cost"))
    units = (F.col("total") * F.lit(10**places)).cast(whole)
    share = (units * (signed * F.lit(10**6)).cast(whole)).cast(whole)
    rest = F.pmod(share, F.nullif(weight, F.lit(0)))
    floor = ((share - rest) / F.nullif(weight, F.lit(0))).cast(whole)
    one = F.struct((-rest).alias("order"), F.col("category"), F.col("cost"), floor.alias("floor"))
    lists = j.groupBy(*keys, "total", "parts_sum").agg(F.array_sort(F.collect_list(one)).alias("_c"), F.sum(floor).cast(whole).alias("_floors"))
    missing = (F.col("total") * F.lit(10**places)).cast(whole) - F.col("_floors")
    each = lists.select(*keys, "total", "parts_sum", missing.alias("_missing"), F.posexplode("_c").alias("_k", "_p"))
    got = (F.col("_p.floor") + F.when(F.col("_k") < F.col("_missing"), 1).otherwise(0)) / F.lit(10**places)
    unscaled = F.round(F.col("_p.cost"), places)
    return each.select(
        *keys, F.col("_p.category").alias("category"), F.col("_p.cost").alias("cost"), "total",
        F.when(F.col("parts_sum") == 0, unscaled).otherwise(got).cast("decimal(38,2)").alias("part"),
    )


def environment_totals(df: DataFrame, keys: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """AGG11: total per environment and over all environments (``rollup``).

    The all-environment row has ``environment`` NULL and ``is_total`` true; accounts
    without an environment are the environment ``unassigned``.
    """
    return (
        df.withColumn("environment", F.coalesce("environment", F.lit("unassigned"))).rollup(*keys, "environment")
        .agg(as_sum(F.sum(amount)).alias("total_amount"), F.grouping("environment").alias("_g"))
        .filter(F.col(keys[0]).isNotNull() if keys else F.lit(True))
        .withColumn("is_total", F.col("_g") == 1)
        .drop("_g")
    )


# ----------------------------------------------------------------- BSS / ledger
def flow_summary(flows: DataFrame) -> DataFrame:
    """AGG12: Σ amount and count by (flow type, direction, cycle, account) over V1."""
    return flows.groupBy("billing_cycle", "account_id", "flow_type", "transaction_flow").agg(
        as_sum(F.sum("amount")).alias("amount"), F.count(F.lit(1)).alias("flow_count")
    )


def outstanding_by_cycle(bills: DataFrame) -> DataFrame:
    """AGG13: Σ outstanding per (cycle, account) of T9."""
    return bills.groupBy("billing_cycle", "account_id").agg(
        as_sum(F.sum("outstanding_amount")).alias("outstanding_amount")
    )


def ledger(items: DataFrame, flows: DataFrame, outstanding: DataFrame) -> DataFrame:
    """AGG14: ledger dimensions per (cycle, account).

    C = Σ pretax (consumption); G = Σ pretax_gross (ours: the reference leaves G
    undefined); P = Σ paid (Income flows); U = Σ outstanding.  The fifth dimension the
    reference mentions is undefined and omitted.  One full outer join per dimension,
    each side already aggregated.
    """
    keys = ["billing_cycle", "account_id"]
    cg = items.groupBy(*keys).agg(
        as_sum(F.sum("pretax_amount")).alias("C"), as_sum(F.sum("pretax_gross_amount")).alias("G")
    )
    p = flows.filter(F.col("transaction_flow") == "Income").groupBy(*keys).agg(as_sum(F.sum("amount")).alias("P"))
    u = outstanding.groupBy(*keys).agg(as_sum(F.sum("outstanding_amount")).alias("U"))
    return cg.join(p, keys, "full_outer").join(u, keys, "full_outer")


def headline(ledger_df: DataFrame, totals: DataFrame) -> DataFrame:
    """AGG15: headline amount per track.

    technical: C, but the total when C = 0 and total > 0; finance: P when present
    (0 included), never the total (NULL when P is absent).
    """
    keys = ["billing_cycle", "account_id"]
    j = ledger_df.join(totals.select(*keys, as_sum(F.col("total_amount")).alias("total")), keys, "left")
    c = F.coalesce(F.col("C"), F.lit(0).cast(SUM_TYPE))
    technical = F.when((c == 0) & (F.col("total") > 0), F.col("total")).otherwise(c)
    return j.select(*keys, technical.cast(SUM_TYPE).alias("technical_amount"), F.col("P").alias("finance_amount"))


def headline_by_period(periods: DataFrame) -> DataFrame:
    """AGG15 by period and track, from the period aggregate (T14).

    technical: consumption; finance: payment, but consumption for ``month`` too.
    """
    def total(metric: Column) -> Column:
        own = F.when(F.col("metric_type") == metric, F.col("total_amount"))
        return F.coalesce(F.sum(own), F.lit(0)).cast(SUM_TYPE)

    finance = F.when(F.col("report_type") == "month", F.lit(METRIC_CONSUMPTION)).otherwise(F.lit(METRIC_PAYMENT))
    return periods.groupBy("report_type", "period_key", "account_id").agg(
        total(F.lit(METRIC_CONSUMPTION)).alias("technical_amount"), total(finance).alias("finance_amount")
    )


def match_transactions(tx: DataFrame, items: DataFrame) -> DataFrame:
    """JN6: transactions with the number of line items sharing their record id;
    ``matched`` false marks a transaction without any (the left-anti report)."""
    per_record = items.groupBy(F.col("sub_order_id").alias("record_id")).agg(
        F.count(F.lit(1)).alias("line_item_count"), as_sum(F.sum("cash_amount")).alias("line_item_cash")
    )
    return tx.join(per_record, "record_id", "left").withColumn("matched", F.col("line_item_count").isNotNull())


def route_sources(oss: DataFrame, api: DataFrame, config: DataFrame, default: str = "oss") -> DataFrame:
    """JN8: per environment take C/G from the configured source (``oss`` | ``api``).

    ``config`` has (environment, account_id, source) with source NULL meaning the
    default.  Both source frames have (billing_cycle, account_id, amount); each is
    filtered to its accounts by a broadcast semi join, then unioned by name.
    """
    cfg = config.select(
        "environment", "account_id", F.coalesce(F.col("source"), F.lit(default)).alias("source")
    )
    cfg_b = cfg
    o = oss.join(cfg_b.filter(F.col("source") == "oss"), "account_id").withColumn("source", F.lit("oss"))
    a = api.join(cfg_b.filter(F.col("source") == "api"), "account_id").withColumn("source", F.lit("api"))
    return o.unionByName(a, allowMissingColumns=True)


def source_label(config: DataFrame, default: str = "oss") -> DataFrame:
    """JN8 label: the single source when all environments agree, else ``mixed``."""
    s = F.coalesce(F.col("source"), F.lit(default))
    return config.agg(
        F.when(F.count_distinct(s) == 1, F.first(s)).otherwise(F.lit("mixed")).alias("finops_cg_source")
    )


def silent_accounts(env: DataFrame, raw: DataFrame) -> DataFrame:
    """JN9: configured environments whose account has no bill rows."""
    return env.join(raw.select("account_id").distinct(), "account_id", "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """JN7: child rows whose foreign key has no parent row (left anti)."""
    pk = parent_key or key
    return child.join(parent.select(F.col(pk).alias(key)).distinct(), key, "left_anti")


# ----------------------------------------------------------------- trends
def period_over_period(series: DataFrame, keys: Sequence[str], period: str, amount: str, kind: str = "month") -> DataFrame:
    """WIN1: change vs the previous calendar period per ``keys``.

    A self-join on the computed previous key (not ``lag``, which would compare with
    the previous *present* period across a gap).  ``is_new`` only when the previous
    period has no row; a previous amount of 0 gives pct NULL, not new.
    """
    keys = list(keys)
    if kind == "month":
        prev_key = F.date_format(F.add_months(F.to_date(F.concat(F.col(period), F.lit("-01"))), -1), "yyyy-MM")
    elif kind == "day":
        prev_key = F.date_sub(F.col(period), 1)
    else:
        raise ValueError("kind is month or day")
    cur = series.select(*keys, period, as_sum(F.col(amount)).alias("amount"), prev_key.alias("_prev"))
    prev = series.select(*keys, F.col(period).alias("_prev"), as_sum(F.col(amount)).alias("prev_amount"))
    j = cur.join(prev, keys + ["_prev"], "left")
    pct = F.try_divide((F.col("amount") - F.col("prev_amount")).cast("double"), F.col("prev_amount").cast("double")) * F.lit(100.0)
    return j.select(
        *keys, period, "amount", "prev_amount",
        F.when(F.col("prev_amount") != 0, pct).alias("pct_change"),
        F.col("prev_amount").isNull().alias("is_new"),
    )


def product_trend(daily_products: DataFrame, product: str | None = None,
                  start: dt.date | str | None = None, end: dt.date | str | None = None) -> DataFrame:
    """WIN2: per product a gap-free daily series (missing days are 0, ours).

    ``daily_products`` has (bill_date, product_code, amount).  Each product gets its
    own calendar from ``sequence(first, last)`` — generated per product, then an
    equi-join with the sums on (product, date); no cross join.
    """
    d = daily_products
    if product is not None:
        d = d.filter(F.col("product_code") == product)
    if start is not None:
        d = d.filter(F.col("bill_date") >= F.lit(start))
    if end is not None:
        d = d.filter(F.col("bill_date") <= F.lit(end))
    sums = d.groupBy("product_code", "bill_date").agg(as_sum(F.sum("amount")).alias("amount"))
    span = sums.groupBy("product_code").agg(F.min("bill_date").alias("_lo"), F.max("bill_date").alias("_hi"))
    cal = span.select("product_code", F.explode(F.sequence("_lo", "_hi")).alias("bill_date"))
    return cal.join(sums, ["product_code", "bill_date"], "left").select(
        "product_code", "bill_date", F.coalesce(F.col("amount"), F.lit(0).cast(SUM_TYPE)).alias("amount")
    )
