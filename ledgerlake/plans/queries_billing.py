"""Billing queries of the catalog (reconcile, diagnostics, roll-ups, views, writes)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import fixtures as fx
from ..operators import reconcile as rc
from ..operators import rollup as ru
from ..session import checkpoint_root
from .catalog import query
from .fixture_sql import with_ctes

AS_OF = fx.BILL_AS_OF


# ------------------------------------------------------------------ shared inputs
def _items(spark: SparkSession, sf: str) -> DataFrame:
    return fx.line_items(spark, sf)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return ru.daily_rollup(_items(spark, sf))


def _monthly(spark: SparkSession, sf: str, positive_only: bool = False) -> DataFrame:
    return ru.monthly_rollup(fx.overview_items(_items(spark, sf)), positive_only=positive_only)


def _daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The stored daily table without its breakdowns."""
    return fx.daily_raw(spark, sf).select("bill_date", "account_id", "total_amount", "cash_total_amount", "bill_month")


def _monthly_totals(spark: SparkSession, sf: str, positive_only: bool = False) -> DataFrame:
    return ru.monthly_totals(fx.overview_items(_items(spark, sf)), positive_only=positive_only)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared root and read back."""
    path = f"{checkpoint_root(df.sparkSession)}/stored/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _outcome(spark: SparkSession, sf: str) -> DataFrame:
    return rc.reconcile(_items(spark, sf), _daily_totals(spark, sf), fx.api_totals(spark, sf))


# ------------------------------------------------------- step 1: reconcile slice
@query(
    "reconcile_accounts",
    ids=("Q1", "JN5", "AGG2", "FLT6"),
    headline=True,
    sql=with_ctes(
        "SELECT billing_cycle, account_id, line_items_sum, daily_sum, ref_total, monthly_api_total, "
        "drift, outcome, data_status FROM outcome",
        "outcome",
    ),
)
def reconcile_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(spark, sf)


_CYCLES_SQL = """
SELECT billing_cycle, line_items_sum, daily_sum, ref_total, monthly_api_total,
       CAST(ref_total - monthly_api_total AS DECIMAL(38,6)) AS drift,
       CASE WHEN monthly_api_total IS NULL THEN 'UNKNOWN'
            WHEN abs(ref_total - monthly_api_total) <= 0.01 THEN 'PASS' ELSE 'DRIFT' END AS outcome
FROM (
  SELECT billing_cycle, line_items_sum, daily_sum, monthly_api_total,
         CASE WHEN line_items_sum <> 0 THEN line_items_sum ELSE daily_sum END AS ref_total
  FROM (
    SELECT billing_cycle, CAST(SUM(COALESCE(li.s, 0)) AS DECIMAL(38,6)) AS line_items_sum,
           CAST(SUM(COALESCE(dd.s, 0)) AS DECIMAL(38,6)) AS daily_sum,
           CAST(CASE WHEN COUNT(*) = COUNT(a.s) THEN SUM(a.s) END AS DECIMAL(38,6)) AS monthly_api_total
    FROM (SELECT billing_cycle, account_id, SUM(cash_amount) AS s FROM line_items GROUP BY 1, 2) li
    FULL OUTER JOIN (SELECT strftime(bill_date, '%Y-%m') AS billing_cycle, account_id, SUM(cash_total_amount) AS s
                     FROM daily_raw GROUP BY 1, 2) dd USING (billing_cycle, account_id)
    FULL OUTER JOIN (
      SELECT billing_cycle, account_id,
             SUM(cash_amount) - CASE WHEN m % 3 = 2 AND account_id = 'EUROPE' THEN 5 ELSE 0 END AS s
      FROM (SELECT *, CAST(substr(billing_cycle, 6, 2) AS INTEGER) AS m FROM line_items)
      WHERE m % 3 <> 0 OR account_id <> 'MIDDLE EAST' GROUP BY billing_cycle, account_id, m
    ) a USING (billing_cycle, account_id)
    WHERE {which}
    GROUP BY billing_cycle
  )
)
"""


@query(
    "reconcile_cycles",
    ids=("Q1",),
    sql=with_ctes(_CYCLES_SQL.format(which="true"), "line_items", "daily_raw"),
)
def reconcile_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """All accounts together: UNKNOWN while one account's API total is missing, else PASS or DRIFT."""
    items = _items(spark, sf)
    out = rc.reconcile(items, _daily_totals(spark, sf), fx.api_cycle_totals(items), level="cycle")
    return out.drop("data_status")


@query(
    "reconcile_known_cycles",
    ids=("Q1",),
    sql=with_ctes(_CYCLES_SQL.format(which="a.s IS NOT NULL"), "line_items", "daily_raw"),
)
def reconcile_known_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """The accounts with an API total together, on both sides."""
    items = _items(spark, sf)
    out = rc.reconcile(items, _daily_totals(spark, sf), fx.api_cycle_totals(items), level="known")
    return out.drop("data_status")


@query(
    "daily_cash_sum",
    ids=("AGG1",),
    sql=with_ctes(
        "SELECT bill_date, strftime(bill_date, '%Y-%m') AS billing_cycle, "
        "CAST(COALESCE(SUM(cash_total_amount), 0) AS DECIMAL(38,6)) AS cash_sum "
        "FROM daily_raw GROUP BY bill_date",
        "daily_raw",
    ),
)
def daily_cash_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rc.daily_cash(_daily_totals(spark, sf))


@query(
    "cycle_cash_sum",
    ids=("AGG2",),
    sql=with_ctes(
        "SELECT billing_cycle, CAST(COALESCE(SUM(cash_amount), 0) AS DECIMAL(38,6)) AS cash_sum "
        "FROM line_items GROUP BY billing_cycle",
        "line_items",
    ),
)
def cycle_cash_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rc.cycle_cash(_items(spark, sf))


@query(
    "daily_report",
    ids=("Q4",),
    sql=with_ctes(
        """
SELECT strftime(d.bill_date, '%Y-%m') AS billing_cycle, d.account_id, d.bill_date,
       CAST(d.cash_total_amount AS DECIMAL(38,6)) AS day_cash,
       d.cash_total_amount < 0 AS is_refund_day,
       o.ref_total AS local_total, o.monthly_api_total, o.drift AS drift_signed,
       CASE WHEN o.monthly_api_total IS NULL THEN NULL ELSE abs(o.drift) <= 0.01 END AS within_tolerance
FROM daily_raw d
LEFT JOIN outcome o ON o.billing_cycle = strftime(d.bill_date, '%Y-%m') AND o.account_id = d.account_id
""",
        "daily_raw",
        "outcome",
    ),
)
def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    return rc.daily_report(_daily_totals(spark, sf), _outcome(spark, sf))


# ------------------------------------------------------- step 2: diagnostics
from ..functions.cycles import cycle_range  # noqa: E402
from ..operators import clean as cl  # noqa: E402
from ..operators import diagnostics as dg  # noqa: E402
from ..operators import upsert as up  # noqa: E402
from ..operators import views as vw  # noqa: E402
from ..functions.breakdown import flatten_breakdown  # noqa: E402

_FLT4 = """
WHERE billing_cycle IN (strftime(DATE '{a}' - INTERVAL 1 MONTH, '%Y-%m'),
                        strftime(DATE '{a}' - INTERVAL 13 MONTH, '%Y-%m'))
  AND bill_date >= date_trunc('month', DATE '{a}')
  AND bill_date < date_trunc('month', DATE '{a}') + INTERVAL 1 MONTH
""".format(a=AS_OF)


@query(
    "prior_cycle_summary",
    ids=("AGG3", "FLT4"),
    headline=True,
    sql=with_ctes(
        "SELECT COUNT(*) AS cnt, billing_cycle, CAST(MIN(bill_date) AS VARCHAR) AS min_bill_date, "
        "CAST(MAX(bill_date) AS VARCHAR) AS max_bill_date FROM line_items " + _FLT4 + " GROUP BY billing_cycle",
        "line_items",
    ),
)
def prior_cycle_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dg.prior_cycle_summary(_items(spark, sf), AS_OF)


@query(
    "prior_cycle_detail",
    ids=("AGG4", "FLT4", "SRT1"),
    sql=with_ctes(
        "SELECT " + ", ".join(dg.DETAIL_COLUMNS) + " FROM line_items " + _FLT4
        + " ORDER BY billing_cycle, bill_date, cash_amount",
        "line_items",
    ),
)
def prior_cycle_detail(spark: SparkSession, sf: str) -> DataFrame:
    return dg.prior_cycle_detail(_items(spark, sf), AS_OF)


@query(
    "prior_cycle_reversals",
    ids=("AGG5", "FLT4", "FLT5"),
    sql=with_ctes(
        "SELECT billing_cycle, COUNT(*) AS reversal_count, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS cash_sum, "
        "CAST(SUM(pretax_amount) AS DECIMAL(38,6)) AS pretax_sum FROM line_items " + _FLT4
        + " AND (cash_amount < 0 OR is_reversal = TRUE) GROUP BY billing_cycle",
        "line_items",
    ),
)
def prior_cycle_reversals(spark: SparkSession, sf: str) -> DataFrame:
    return dg.prior_cycle_reversals(_items(spark, sf), AS_OF)


def _period_key_sql(d: str) -> str:
    q = "CAST((month({x}) - 1) // 3 + 1 AS VARCHAR)"
    return f"""
SELECT {d} AS as_of, '1d' AS report_type, strftime({d} - 1, '%Y-%m-%d') AS expected_period_key FROM src
UNION ALL SELECT {d}, 'this_week', strftime({d}, '%G-W%V') FROM src
UNION ALL SELECT {d}, 'month', strftime({d}, '%Y-%m') FROM src
UNION ALL SELECT {d}, 'last_month', strftime({d} - INTERVAL 1 MONTH, '%Y-%m') FROM src
UNION ALL SELECT {d}, 'quarter', strftime({d}, '%Y') || '-Q' || {q.format(x=d)} FROM src
UNION ALL SELECT {d}, 'this_year', strftime({d}, '%Y') FROM src
UNION ALL SELECT {d}, 'last_year', strftime({d} - INTERVAL 1 YEAR, '%Y') FROM src
UNION ALL SELECT {d}, 'last_quarter', strftime({d} - INTERVAL 3 MONTH, '%Y') || '-Q' ||
  {q.format(x=d + ' - INTERVAL 3 MONTH')} FROM src
"""


@query(
    "period_keys_by_date",
    ids=("PRJ11", "SET1"),
    sql=with_ctes(
        _period_key_sql("as_of").replace("FROM src", "FROM (SELECT DISTINCT bill_date AS as_of FROM line_items) src"),
        "line_items",
    ),
)
def period_keys_by_date(spark: SparkSession, sf: str) -> DataFrame:
    dates = _items(spark, sf).select(F.col("bill_date").alias("as_of")).distinct()
    return dg.expected_periods(dates)


@query(
    "report_type_summary",
    ids=("AGG6", "FLT7", "SRT1"),
    sql=with_ctes(
        "SELECT report_type, COUNT(*) AS row_count, CAST(ROUND(SUM(total_amount), 2) AS DECIMAL(35,2)) AS sum_total_amount "
        "FROM period_agg WHERE metric_type = 'payment' GROUP BY report_type ORDER BY report_type",
        "period_agg",
    ),
)
def report_type_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dg.report_type_summary(_period_agg(spark, sf))


@query(
    "aggregate_listing",
    ids=("Q9", "PRJ13", "SRT1"),
    sql=with_ctes(
        "SELECT report_type, period_key, metric_type, CAST(ROUND(total_amount, 2) AS DECIMAL(35,2)) AS total_amount, account_id, "
        "CAST(NULL AS DATE) AS last_success FROM period_agg ORDER BY report_type, period_key",
        "period_agg",
    ),
)
def aggregate_listing(spark: SparkSession, sf: str) -> DataFrame:
    return dg.aggregate_listing(_period_agg(spark, sf))


@query(
    "daily_recent",
    ids=("Q9", "FLT2", "SRT2", "PRJ13"),
    sql=with_ctes(
        "SELECT bill_date, CAST(ROUND(total_amount, 2) AS DECIMAL(35,2)) AS total_amount, "
        "CAST(ROUND(cash_total_amount, 2) AS DECIMAL(35,2)) AS cash_total_amount, "
        f"account_id FROM daily_raw WHERE bill_date >= CAST(DATE '{AS_OF}' - INTERVAL 30 DAY AS DATE) "
        "ORDER BY bill_date DESC",
        "daily_raw",
    ),
)
def daily_recent(spark: SparkSession, sf: str) -> DataFrame:
    return dg.daily_recent(_daily_totals(spark, sf), AS_OF)


@query(
    "monthly_recent",
    ids=("Q9", "FLT3", "SRT2", "PRJ13"),
    sql=with_ctes(
        "SELECT billing_cycle, CAST(ROUND(total_amount, 2) AS DECIMAL(35,2)) AS total_amount, "
        "CAST(ROUND(COALESCE(cash_total_amount, 0), 2) AS DECIMAL(35,2)) AS cash_total_amount, account_id FROM monthly_raw "
        f"WHERE billing_cycle >= strftime(DATE '{AS_OF}' - INTERVAL 12 MONTH, '%Y-%m') ORDER BY billing_cycle DESC",
        "monthly_raw",
    ),
)
def monthly_recent(spark: SparkSession, sf: str) -> DataFrame:
    return dg.monthly_recent(_monthly_totals(spark, sf), AS_OF)


GAP_AS_OF = "2001-10-15"  # after the last billing cycle of the data: month periods are missing


@query(
    "missing_periods",
    ids=("Q8", "PRJ11"),
    sql=with_ctes(
        "SELECT e.report_type, e.expected_period_key AS period_key FROM ("
        + _period_key_sql(f"DATE '{GAP_AS_OF}'").replace("FROM src", "FROM (SELECT 1) src")
        + ") e WHERE NOT EXISTS (SELECT 1 FROM period_agg p WHERE p.period_key = e.expected_period_key "
        "AND p.report_type = CASE e.report_type WHEN 'last_month' THEN 'month' WHEN 'last_quarter' THEN 'quarter' "
        "WHEN 'last_year' THEN 'this_year' ELSE e.report_type END)",
        "period_agg",
    ),
)
def missing_periods(spark: SparkSession, sf: str) -> DataFrame:
    etl_rows = ru.period_aggregate_as_of(_period_agg(spark, sf, GAP_AS_OF), GAP_AS_OF)
    return dg.missing_periods(etl_rows, GAP_AS_OF)


@query(
    "row_probes",
    ids=("AGG24", "LIM1"),
    sql=with_ctes(
        "SELECT 'line_items' AS table_name, COUNT(*) AS cnt FROM line_items WHERE cash_amount < 0 OR is_reversal "
        "UNION ALL SELECT 'daily_raw', COUNT(*) FROM daily_raw WHERE cash_total_amount < 0 "
        "UNION ALL SELECT 'monthly_raw', COUNT(*) FROM monthly_raw WHERE total_amount < 0",
        "line_items", "daily_raw", "monthly_raw",
    ),
)
def row_probes(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf)
    return (
        dg.row_probe(items, dg.is_reversal(), "line_items")
        .unionByName(dg.row_probe(ru.daily_totals(items), F.col("cash_total_amount") < 0, "daily_raw"))
        .unionByName(dg.row_probe(_monthly_totals(spark, sf), F.col("total_amount") < 0, "monthly_raw"))
    )


@query(
    "cash_flow_view",
    ids=("PRJ1",),
    sql=with_ctes(
        "SELECT transaction_number AS flow_id, account_id, transaction_time AS occurred_at, amount, "
        "transaction_type AS flow_type, transaction_flow, billing_cycle, currency, synced_at FROM bss_tx",
        "bss_tx",
    ),
)
def cash_flow_view(spark: SparkSession, sf: str) -> DataFrame:
    return dg.cash_flow(fx.bss_transactions(spark, sf))


# ------------------------------------------------------- step 3: cleaning
@query(
    "monthly_legacy_cleaned",
    ids=("JN1", "PRJ2"),
    sql=with_ctes(
        """
SELECT billing_cycle,
       CASE WHEN account_id IS NULL OR account_id = '' THEN 'POC' ELSE account_id END AS account_id,
       total_amount, cash_total_amount
FROM monthly_raw_legacy m
WHERE COALESCE(account_id, '') <> ''
   OR NOT EXISTS (SELECT 1 FROM monthly_raw_legacy o
                  WHERE o.billing_cycle = m.billing_cycle AND COALESCE(o.account_id, '') <> '')
""",
        "monthly_raw_legacy",
    ),
)
def monthly_legacy_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.line_items(spark, sf, legacy_empty=True)
    m = cl.fill_empty_account(ru.monthly_totals(fx.overview_items(items)))
    m = cl.map_legacy_account(cl.drop_shadowed_empty(m, "billing_cycle"))
    return m.select("billing_cycle", "account_id", "total_amount", "cash_total_amount")


@query(
    "daily_legacy_cleaned",
    ids=("JN1", "PRJ2"),
    sql=with_ctes(
        """
SELECT bill_date,
       CASE WHEN account_id IS NULL OR account_id = '' THEN 'POC' ELSE account_id END AS account_id,
       total_amount, cash_total_amount
FROM daily_raw_legacy d
WHERE COALESCE(account_id, '') <> ''
   OR NOT EXISTS (SELECT 1 FROM daily_raw_legacy o
                  WHERE o.bill_date = d.bill_date AND COALESCE(o.account_id, '') <> '')
""",
        "daily_raw_legacy",
    ),
)
def daily_legacy_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.line_items(spark, sf, legacy_empty=True)
    d = cl.map_legacy_account(cl.drop_shadowed_empty(ru.daily_totals(items), "bill_date"))
    return d.select("bill_date", "account_id", "total_amount", "cash_total_amount")


@query(
    "bill_summary",
    ids=("AGG22", "PRJ14", "PRJ6", "FLT10", "PRJ15"),
    sql=with_ctes(
        """
SELECT t.day, t.billing_cycle,
       regexp_replace(t.billing_cycle, '^(\\d{4})(\\d{2})$', '\\1-\\2') AS cycle_normalized,
       regexp_matches(regexp_replace(t.billing_cycle, '^(\\d{4})(\\d{2})$', '\\1-\\2'), '^\\d{4}-\\d{2}$')
         AND try_strptime(regexp_replace(t.billing_cycle, '^(\\d{4})(\\d{2})$', '\\1-\\2'), '%Y-%m') IS NOT NULL
         AS cycle_valid,
       t.total_amount, p.product, p.amount,
       CASE WHEN t.total_amount = 0 THEN NULL
            ELSE CAST(p.amount AS DOUBLE) / CAST(t.total_amount AS DOUBLE) * 100.0 END AS pct
FROM (SELECT bill_date AS day, strftime(bill_date, '%Y%m') AS billing_cycle,
             CAST(SUM(amount) AS DECIMAL(38,6)) AS total_amount
      FROM daily_products GROUP BY bill_date) t
JOIN (SELECT bill_date AS day, product_code AS product, CAST(SUM(amount) AS DECIMAL(38,6)) AS amount
      FROM daily_products GROUP BY bill_date, product_code) p ON t.day = p.day
""",
        "daily_products",
    ),
)
def bill_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = cl.with_cycle_check(ru.bill_summary(_daily(spark, sf)))
    return s.select(
        "day", "billing_cycle", "cycle_normalized", "cycle_valid", "total_amount",
        F.inline("product_breakdown"),
    )


# ------------------------------------------------------- step 5: roll-ups
@query(
    "daily_rollup",
    ids=("AGG7",),
    headline=True,
    sql=with_ctes(
        "SELECT bill_date, account_id, CAST(SUM(amount) AS DECIMAL(38,6)) AS total_amount, "
        "CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS cash_total_amount, COUNT(*) AS product_count, "
        "COUNT(cash_amount) AS cash_product_count FROM daily_products GROUP BY bill_date, account_id",
        "daily_products",
    ),
)
def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    d = _daily(spark, sf)
    return d.select(
        "bill_date", "account_id", "total_amount", "cash_total_amount",
        F.size("product_breakdown").cast("bigint").alias("product_count"),
        F.size("cash_product_breakdown").cast("bigint").alias("cash_product_count"),
    )


@query(
    "daily_breakdown",
    ids=("AGG7", "PRJ8", "PRJ15"),
    sql=with_ctes(
        "SELECT bill_date, account_id, 'consumption' AS metric_type, product_code, amount FROM daily_products "
        "UNION ALL SELECT bill_date, account_id, 'payment', product_code, cash_amount FROM daily_products",
        "daily_products",
    ),
)
def daily_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    u = ru.unpivot_metrics(_daily(spark, sf), ["bill_date", "account_id"]).drop("total_amount")
    return flatten_breakdown(u, "product_breakdown")


@query(
    "monthly_rollup",
    ids=("AGG8", "PRJ7", "SET2"),
    headline=True,
    sql=with_ctes(
        "SELECT m.billing_cycle, m.account_id, m.total_amount, m.cash_total_amount, p.product_count, "
        "p.cash_product_count FROM monthly_raw m JOIN (SELECT billing_cycle, account_id, COUNT(*) AS product_count, "
        "COUNT(cash_amount) AS cash_product_count FROM monthly_products GROUP BY 1, 2) p "
        "USING (billing_cycle, account_id)",
        "monthly_raw", "monthly_products",
    ),
)
def monthly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    m = _monthly(spark, sf)
    return m.select(
        "billing_cycle", "account_id", "total_amount", "cash_total_amount",
        F.size("product_breakdown").cast("bigint").alias("product_count"),
        F.size("cash_product_breakdown").cast("bigint").alias("cash_product_count"),
    )


@query(
    "monthly_breakdown",
    ids=("AGG8", "PRJ8", "PRJ15"),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, 'consumption' AS metric_type, product_code, amount FROM monthly_products "
        "UNION ALL SELECT billing_cycle, account_id, 'payment', product_code, cash_amount FROM monthly_products "
        "WHERE cash_amount IS NOT NULL",
        "monthly_products",
    ),
)
def monthly_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    u = ru.unpivot_metrics(_monthly(spark, sf), ["billing_cycle", "account_id"]).drop("total_amount")
    return flatten_breakdown(u, "product_breakdown")


@query(
    "monthly_payments_only",
    ids=("FLT9", "AGG8"),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, CAST(COALESCE(SUM(CASE WHEN PaymentAmount > 0 THEN PaymentAmount END), 0) "
        "AS DECIMAL(38,6)) AS cash_total_amount FROM overview GROUP BY billing_cycle, account_id",
        "overview",
    ),
)
def monthly_payments_only(spark: SparkSession, sf: str) -> DataFrame:
    return _monthly_totals(spark, sf, positive_only=True).select("billing_cycle", "account_id", "cash_total_amount")


@query(
    "monthly_range",
    ids=("FLT8",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, total_amount FROM monthly_raw "
        "WHERE billing_cycle BETWEEN '1997-01' AND '1998-12'",
        "monthly_raw",
    ),
)
def monthly_range(spark: SparkSession, sf: str) -> DataFrame:
    m = _monthly_totals(spark, sf)
    return m.filter(cycle_range("billing_cycle", "1997-01", "1998-12")).select(
        "billing_cycle", "account_id", "total_amount"
    )


def _period_agg(spark: SparkSession, sf: str, as_of: str | None = None) -> DataFrame:
    items = _items(spark, sf)
    daily, monthly = ru.daily_rollup(items), ru.monthly_rollup(fx.overview_items(items))
    if as_of is not None:
        daily, monthly = ru.inputs_as_of(daily, monthly, as_of)
    return ru.period_aggregate(daily, monthly)


@query(
    "period_aggregate",
    ids=("AGG9", "PRJ8", "PRJ11"),
    headline=True,
    sql=with_ctes(
        "SELECT report_type, period_key, account_id, metric_type, total_amount, product_count, data_status "
        "FROM period_agg",
        "period_agg",
    ),
)
def period_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    p = _period_agg(spark, sf)
    return p.select(
        "report_type", "period_key", "account_id", "metric_type", "total_amount",
        F.size("product_breakdown").cast("bigint").alias("product_count"), "data_status",
    )


@query(
    "period_aggregate_as_of",
    ids=("AGG9", "PRJ11"),
    sql=with_ctes(
        "SELECT e.report_type, e.expected_period_key AS period_key, p.account_id, p.metric_type, p.total_amount "
        "FROM (" + _period_key_sql(f"DATE '{AS_OF}'").replace("FROM src", "FROM (SELECT 1) src") + ") e "
        "JOIN period_agg p ON p.period_key = e.expected_period_key AND p.report_type = CASE e.report_type "
        "WHEN 'last_month' THEN 'month' WHEN 'last_quarter' THEN 'quarter' WHEN 'last_year' THEN 'this_year' "
        "ELSE e.report_type END",
        "period_agg",
    ),
)
def period_aggregate_as_of(spark: SparkSession, sf: str) -> DataFrame:
    a = ru.period_aggregate_as_of(_period_agg(spark, sf, AS_OF), AS_OF)
    return a.select("report_type", "period_key", "account_id", "metric_type", "total_amount")


# ------------------------------------------------------- step 4: idempotent writes
_LI_COLS = (
    "record_id", "bill_date", "billing_cycle", "product_code", "product_name", "sub_order_id", "instance_id",
    "billing_item", "subscription_type", "cash_amount", "pretax_amount", "pretax_gross_amount", "currency",
    "is_reversal", "account_id", "ingestion_channel", "region", "raw_payload", "synced_at", "created_at",
)


def _order_sql(keys: tuple[str, ...], order: tuple[str, ...], cols: tuple[str, ...]) -> str:
    """ORDER BY of the oracle's row_number: order columns, then every other column, desc."""
    rest = [c for c in cols if c not in keys and c not in order]
    return ", ".join(f"{c} DESC NULLS LAST" for c in list(order) + rest)


def _redelivered(items: DataFrame) -> DataFrame:
    """A re-delivered batch: the reversal rows again, a day later, from the export channel."""
    return items.filter(F.col("is_reversal")).withColumn(
        "synced_at", F.col("synced_at") + F.expr("INTERVAL 1 DAY")
    ).withColumn("ingestion_channel", F.lit("oss_bill_export"))


@query(
    "line_items_upsert",
    ids=("SNK5", "WIN4"),
    sql=with_ctes(
        "SELECT record_id, synced_at, ingestion_channel, cash_amount, account_id FROM ("
        "SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY "
        + _order_sql(("record_id",), ("synced_at",), _LI_COLS)
        + ") AS rn FROM (SELECT * FROM line_items UNION ALL SELECT * REPLACE ("
        "synced_at + INTERVAL 1 DAY AS synced_at, 'oss_bill_export' AS ingestion_channel) "
        "FROM line_items WHERE is_reversal)) WHERE rn = 1",
        "line_items",
    ),
)
def line_items_upsert(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).select(*_LI_COLS)
    out = up.upsert_latest(items, _redelivered(items), ["record_id"], ["synced_at"])
    return out.select("record_id", "synced_at", "ingestion_channel", "cash_amount", "account_id")


@query(
    "line_items_latest_by_line",
    ids=("WIN4",),
    sql=with_ctes(
        "SELECT sub_order_id, billing_item, record_id, synced_at, cash_amount FROM ("
        "SELECT *, row_number() OVER (PARTITION BY sub_order_id, billing_item ORDER BY "
        + _order_sql(("sub_order_id", "billing_item"), ("synced_at",), _LI_COLS)
        + ") AS rn FROM line_items) WHERE rn = 1",
        "line_items",
    ),
)
def line_items_latest_by_line(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).select(*_LI_COLS)
    out = up.latest_per_key(items, ["sub_order_id", "billing_item"], ["synced_at"])
    return out.select("sub_order_id", "billing_item", "record_id", "synced_at", "cash_amount")


def _fact_rows(spark: SparkSession, sf: str, amount: str = "cash_amount") -> DataFrame:
    return fx.fact_rows(_items(spark, sf), fx.environments(spark, sf), amount)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return up.latest_per_key(_fact_rows(spark, sf), ["account_id", "dedup_key"], ["ingested_at"])


@query(
    "fact_upsert",
    ids=("SNK6", "PRJ9", "PRJ10", "JN2"),
    sql=with_ctes(
        "SELECT account_id, dedup_key, billing_cycle, usage_date, env, product_code, amount FROM fact",
        "fact",
    ),
)
def fact_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).select("account_id", "dedup_key", "billing_cycle", "usage_date", "env", "product_code", "amount")


@query(
    "fact_rekey",
    ids=("SNK9", "PRJ9"),
    sql=with_ctes(
        "SELECT account_id, dedup_key, billing_cycle, amount FROM ("
        "SELECT *, row_number() OVER (PARTITION BY account_id, dedup_key ORDER BY ingested_at DESC NULLS LAST, "
        "billing_cycle DESC NULLS LAST, usage_date DESC NULLS LAST, account_alias DESC NULLS LAST, "
        "env DESC NULLS LAST, product_code DESC NULLS LAST, instance_id DESC NULLS LAST, item_code DESC NULLS LAST, "
        "amount DESC NULLS LAST, currency DESC NULLS LAST, tags_json DESC NULLS LAST, "
        "source_object DESC NULLS LAST) AS rn FROM ("
        "SELECT * REPLACE (sha256(concat_ws(chr(31), billing_cycle, CAST(usage_date AS VARCHAR), instance_id, "
        "item_code, product_code, record_id)) AS dedup_key) FROM fact_rows)) WHERE rn = 1",
        "fact_rows",
    ),
)
def fact_rekey(spark: SparkSession, sf: str) -> DataFrame:
    """SNK9: after a key change (product added to the key), re-key the source rows and reload."""
    rows = fx.fact_rows(_items(spark, sf), fx.environments(spark, sf), with_record_id=True)
    out = up.rekey(rows, ["billing_cycle", "usage_date", "instance_id", "item_code", "product_code", "record_id"])
    return out.select("account_id", "dedup_key", "billing_cycle", "amount")


@query(
    "fact_slice_replace",
    ids=("SNK7",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, dedup_key, usage_date, amount FROM fact_rows r "
        "WHERE NOT EXISTS (SELECT 1 FROM fact_rows n WHERE n.billing_cycle = r.billing_cycle "
        "AND n.account_id = r.account_id AND n.billing_cycle IN ("
        f"strftime(DATE '{AS_OF}' - INTERVAL 1 MONTH, '%Y-%m'), strftime(DATE '{AS_OF}' - INTERVAL 13 MONTH, '%Y-%m'))) "
        "UNION ALL SELECT billing_cycle, account_id, dedup_key, usage_date, CAST(pretax_amount AS DECIMAL(18,6)) "
        f"FROM fact_rows WHERE billing_cycle IN (strftime(DATE '{AS_OF}' - INTERVAL 1 MONTH, '%Y-%m'), "
        f"strftime(DATE '{AS_OF}' - INTERVAL 13 MONTH, '%Y-%m'))",
        "fact_rows",
    ),
)
def fact_slice_replace(spark: SparkSession, sf: str) -> DataFrame:
    """SNK7: reload the two prior-cycle slices (pretax instead of cash) over the fact."""
    from ..functions.cycles import cycle_of

    old = _fact_rows(spark, sf)
    a = F.lit(AS_OF).cast("date")
    cycles = [cycle_of(F.add_months(a, -1)), cycle_of(F.add_months(a, -13))]
    new = _fact_rows(spark, sf, amount="pretax_amount").filter(F.col("billing_cycle").isin(*cycles))
    out = up.replace_slices_logical(old, new, ["billing_cycle", "account_id"])
    return out.select("billing_cycle", "account_id", "dedup_key", "usage_date", "amount")


@query(
    "env_config_seeded",
    ids=("SNK4", "PRJ4"),
    sql=with_ctes(
        "SELECT * FROM (VALUES ('POC', 'POC', 'POC 演示账号', 1), ('UAT', 'UAT', 'UAT 中国站', 2), "
        "('FAT', 'FAT', 'FAT 测试', 3), ('PROD', 'PROD', 'PROD 生产', 4)) s(environment, account_id, display_name, "
        "sort_order) UNION ALL SELECT COALESCE(m.environment, r.r_name), r.r_name, r.r_name, "
        "CAST(r.r_regionkey + 1 AS INTEGER) FROM region r LEFT JOIN (VALUES ('AFRICA', 'POC'), ('AMERICA', 'UAT'), "
        "('ASIA', 'FAT'), ('EUROPE', 'PROD')) m(r_name, environment) ON r.r_name = m.r_name "
        "WHERE COALESCE(m.environment, r.r_name) NOT IN ('POC', 'UAT', 'FAT', 'PROD')",
    ),
)
def env_config_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """SNK4: region-derived environments inserted into the seeded config if absent."""
    seeds = spark.createDataFrame(fv.SEED_ENVIRONMENTS, "environment string, account_id string, display_name string, sort_order int")
    mapping = spark.createDataFrame(list(fx.REGION_ENVIRONMENT.items()), "r_name string, environment string")
    region = fx.table(spark, sf, "region")
    new = region.join(F.broadcast(mapping), "r_name", "left").select(
        F.coalesce(F.col("environment"), F.col("r_name")).alias("environment"),
        F.col("r_name").alias("account_id"),
        F.col("r_name").alias("display_name"),
        (F.col("r_regionkey") + 1).cast("int").alias("sort_order"),
    )
    return up.insert_absent(seeds, new, ["environment"])


_RUN_TS = "2026-01-01 00:00:00"


def _month_status(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf)
    old = items.select("billing_cycle", "account_id").distinct().select(
        "billing_cycle", "account_id",
        F.lit("PRELIMINARY").alias("data_status"),
        F.lit(None).cast("decimal(14,2)").alias("line_items_sum"),
        F.lit(None).cast("decimal(14,2)").alias("monthly_api_total"),
        F.lit(None).cast("decimal(14,2)").alias("drift_amount"),
        F.lit(None).cast("timestamp").alias("last_reconciled_at"),
        F.lit("initial load").alias("notes"),
    )
    new = rc.transition(_outcome(spark, sf), "trigger-worker", run_ts=_RUN_TS).filter("write").drop("write", "exit_code")
    update = ["data_status", "line_items_sum", "monthly_api_total", "drift_amount", "last_reconciled_at"]
    return up.upsert_columns(old, new, ["billing_cycle", "account_id"], update)


@query(
    "month_status_upsert",
    ids=("SNK1", "SNK2", "Q2"),
    headline=True,
    sql=with_ctes(
        "SELECT billing_cycle, account_id, data_status, line_items_sum, monthly_api_total, drift_amount, notes "
        "FROM month_status",
        "month_status",
    ),
)
def month_status_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _month_status(spark, sf).drop("last_reconciled_at")


@query(
    "status_reset_keep_finalized",
    ids=("SNK8",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, data_status, line_items_sum, monthly_api_total, drift_amount, notes "
        "FROM month_status WHERE data_status = 'FINALIZED'",
        "month_status",
    ),
)
def status_reset_keep_finalized(spark: SparkSession, sf: str) -> DataFrame:
    return up.reset_status(_month_status(spark, sf), keep_finalized=True).drop("last_reconciled_at")


@query(
    "daily_raw_patched",
    ids=("Q3", "SNK3", "PRJ12"),
    sql=with_ctes(
        """
SELECT bill_date, account_id, CAST(SUM(total) AS DECIMAL(38,6)) AS total_amount,
       CAST(SUM(cash) AS DECIMAL(38,6)) AS cash_total_amount, COUNT(DISTINCT product_code) AS product_count
FROM (
  SELECT bill_date, account_id, product_code, amount AS total, cash_amount AS cash FROM daily_products
  UNION ALL
  SELECT last_day(CAST(billing_cycle || '-01' AS DATE)), account_id, '系统校准',
         monthly_api_total - ref_total, monthly_api_total - ref_total
  FROM outcome WHERE outcome = 'DRIFT'
) u GROUP BY bill_date, account_id
""",
        "daily_products", "outcome",
    ),
)
def daily_raw_patched(spark: SparkSession, sf: str) -> DataFrame:
    """The stored daily table with a calibration row for each drifting month and account.

    The rows are written first, as a calibration run leaves them (one for each drifting key).
    """
    calib = _stored(rc.calibration_rows(_outcome(spark, sf)), "calibration")
    out = up.upsert_add(
        fx.daily_raw(spark, sf).drop("bill_month"), calib, ["bill_date", "account_id"], ["total_amount", "cash_total_amount"],
        maps=["product_breakdown", "cash_product_breakdown"],
    )
    return out.select(
        "bill_date", "account_id", "total_amount", "cash_total_amount",
        F.size("product_breakdown").cast("bigint").alias("product_count"),
    )


@query(
    "latest_balance",
    ids=("WIN3",),
    sql=with_ctes(
        "SELECT account_id, MAX(snapshot_date) AS snapshot_date, arg_max(available_amount, snapshot_date) "
        "AS available_amount FROM (SELECT account_id, CAST(transaction_time AS DATE) AS snapshot_date, "
        "MAX(amount) AS available_amount FROM bss_tx GROUP BY 1, 2) GROUP BY account_id",
        "bss_tx",
    ),
)
def latest_balance(spark: SparkSession, sf: str) -> DataFrame:
    return up.latest_balance(fx.balance_snapshots(fx.bss_transactions(spark, sf)))


RETENTION_AS_OF = "2001-10-15"


@query(
    "monthly_expired",
    ids=("SNK11",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, total_amount FROM monthly_raw "
        f"WHERE NOT (billing_cycle >= strftime(DATE '{RETENTION_AS_OF}' - INTERVAL 60 MONTH, '%Y-%m'))",
        "monthly_raw",
    ),
)
def monthly_expired(spark: SparkSession, sf: str) -> DataFrame:
    """SNK11: monthly rows past the 60-month history window (the ones to drop)."""
    _kept, expired = up.expire(_monthly_totals(spark, sf), "billing_cycle", RETENTION_AS_OF, months=fv.HISTORY_MONTHS)
    return expired.select("billing_cycle", "account_id", "total_amount")


def _objects(spark: SparkSession, sf: str) -> DataFrame:
    """Export objects per (account, cycle) with their last-modified time (max sync)."""
    return _items(spark, sf).groupBy("account_id", "billing_cycle").agg(
        F.max("synced_at").alias("last_modified")
    ).select(
        "account_id",
        F.concat(F.lit("billing-data/"), F.col("account_id"), F.lit("/"), F.col("billing_cycle"), F.lit(".csv")).alias("object_key"),
        "last_modified",
    )


def _checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """High-water marks: configured environments' accounts at the bill as-of date."""
    return fx.environments(spark, sf).select(
        "account_id", F.lit(AS_OF + " 00:00:00").cast("timestamp_ntz").alias("max_object_last_modified")
    )


_CKPT_SQL = (
    "SELECT account_id, CAST(TIMESTAMP '" + AS_OF + " 00:00:00' AS TIMESTAMP) AS max_object_last_modified "
    "FROM env_config"
)
_OBJ_SQL = (
    "SELECT account_id, 'billing-data/' || account_id || '/' || billing_cycle || '.csv' AS object_key, "
    "MAX(synced_at) AS last_modified FROM line_items GROUP BY account_id, billing_cycle"
)


@query(
    "changed_objects",
    ids=("SRC6", "JN4"),
    sql=with_ctes(
        f"SELECT o.account_id, o.object_key, o.last_modified FROM ({_OBJ_SQL}) o LEFT JOIN ({_CKPT_SQL}) c "
        "ON o.account_id = c.account_id "
        "WHERE o.last_modified > COALESCE(c.max_object_last_modified, TIMESTAMP '1970-01-01 00:00:00')",
        "line_items", "env_config",
    ),
)
def changed_objects(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.exports import changed_objects as changed

    return changed(_objects(spark, sf), _checkpoint(spark, sf))


@query(
    "checkpoint_advance",
    ids=("SNK12", "SRC6"),
    sql=with_ctes(
        f"SELECT COALESCE(c.account_id, n.account_id) AS account_id, "
        "greatest(COALESCE(c.max_object_last_modified, TIMESTAMP '1970-01-01 00:00:00'), "
        "COALESCE(n.m, TIMESTAMP '1970-01-01 00:00:00')) AS max_object_last_modified "
        f"FROM ({_CKPT_SQL}) c FULL OUTER JOIN (SELECT o.account_id, MAX(o.last_modified) AS m FROM ({_OBJ_SQL}) o "
        f"LEFT JOIN ({_CKPT_SQL}) c2 ON o.account_id = c2.account_id "
        "WHERE o.last_modified > COALESCE(c2.max_object_last_modified, TIMESTAMP '1970-01-01 00:00:00') "
        "GROUP BY o.account_id) n ON c.account_id = n.account_id",
        "line_items", "env_config",
    ),
)
def checkpoint_advance(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.exports import changed_objects as changed

    ckpt = _checkpoint(spark, sf)
    return up.advance_checkpoint(ckpt, changed(_objects(spark, sf), ckpt))


# ------------------------------------------------------- step 6: views
@query(
    "accounts_with_environment",
    ids=("JN2",),
    sql=with_ctes(
        "SELECT m.billing_cycle, m.account_id, e.environment, e.display_name, e.sort_order, m.total_amount "
        "FROM monthly_raw m LEFT JOIN env_config e ON m.account_id = e.account_id",
        "monthly_raw", "env_config",
    ),
)
def accounts_with_environment(spark: SparkSession, sf: str) -> DataFrame:
    m = _monthly_totals(spark, sf).select("billing_cycle", "account_id", "total_amount")
    return vw.with_environment(m, fx.environments(spark, sf))


_CATEGORY_SQL = (
    "COALESCE(CASE WHEN starts_with(li.product_code, 'PRO') THEN 'security' END, cm.category, 'other')"
)


def _category_parts(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).select("billing_cycle", "product_code", F.col("cash_amount").alias("cost"))
    return vw.category_of("product_code", fx.category_mapping(spark), fx.PREFIX_RULES, items)


def _cycle_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _monthly_totals(spark, sf).groupBy("billing_cycle").agg(F.sum("cash_total_amount").alias("total"))


@query(
    "category_breakdown",
    ids=("JN3", "AGG10"),
    headline=True,
    sql=with_ctes(
        f"""
SELECT c.billing_cycle, c.category, c.cost, t.total, s.parts_sum,
       CASE WHEN s.parts_sum = 0 THEN CAST(c.cost AS DOUBLE)
            ELSE CAST(c.cost AS DOUBLE) * (CAST(t.total AS DOUBLE) / CAST(s.parts_sum AS DOUBLE)) END AS scaled_cost
FROM (SELECT li.billing_cycle, {_CATEGORY_SQL} AS category, CAST(SUM(li.cash_amount) AS DECIMAL(38,6)) AS cost
      FROM line_items li LEFT JOIN category_map cm ON li.product_code = cm.product_code GROUP BY 1, 2) c
JOIN (SELECT billing_cycle, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS parts_sum FROM line_items GROUP BY 1) s
  USING (billing_cycle)
LEFT JOIN (SELECT billing_cycle, CAST(SUM(cash_total_amount) AS DECIMAL(38,6)) AS total FROM monthly_raw GROUP BY 1) t
  USING (billing_cycle)
""",
        "line_items", "category_map", "monthly_raw",
    ),
)
def category_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return vw.category_breakdown(_category_parts(spark, sf), _cycle_totals(spark, sf), ["billing_cycle"])


@query(
    "category_parts_check",
    ids=("Q5", "AGG10"),
    sql=with_ctes(
        """
SELECT billing_cycle, s.parts_sum, t.total,
       CAST(COALESCE(s.parts_sum, 0) - COALESCE(t.total, 0) AS DECIMAL(38,6)) AS difference,
       abs(COALESCE(s.parts_sum, 0) - COALESCE(t.total, 0)) <= 0.01 AS balanced
FROM (SELECT billing_cycle, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS parts_sum FROM line_items GROUP BY 1) s
FULL OUTER JOIN (SELECT billing_cycle, CAST(SUM(cash_total_amount) AS DECIMAL(38,6)) AS total
                 FROM monthly_raw GROUP BY 1) t USING (billing_cycle)
""",
        "line_items", "monthly_raw",
    ),
)
def category_parts_check(spark: SparkSession, sf: str) -> DataFrame:
    parts = _category_parts(spark, sf)
    return rc.parts_check(parts, _cycle_totals(spark, sf), ["billing_cycle"], "cost", "total")


@query(
    "environment_totals",
    ids=("AGG11", "JN2"),
    sql=with_ctes(
        "SELECT billing_cycle, environment, CAST(SUM(total_amount) AS DECIMAL(38,6)) AS total_amount, "
        "GROUPING(environment) = 1 AS is_total FROM (SELECT m.*, COALESCE(e.environment, 'unassigned') AS environment "
        "FROM monthly_raw m LEFT JOIN env_config e ON m.account_id = e.account_id) "
        "GROUP BY GROUPING SETS ((billing_cycle, environment), (billing_cycle))",
        "monthly_raw", "env_config",
    ),
)
def environment_totals(spark: SparkSession, sf: str) -> DataFrame:
    m = _monthly_totals(spark, sf).join(
        fx.environments(spark, sf).select("account_id", "environment"), "account_id", "left"
    )
    return vw.environment_totals(m, ["billing_cycle"])


@query(
    "flow_summary",
    ids=("AGG12", "PRJ1"),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, transaction_type AS flow_type, transaction_flow, "
        "CAST(SUM(amount) AS DECIMAL(38,6)) AS amount, COUNT(*) AS flow_count FROM bss_tx GROUP BY 1, 2, 3, 4",
        "bss_tx",
    ),
)
def flow_summary(spark: SparkSession, sf: str) -> DataFrame:
    return vw.flow_summary(dg.cash_flow(fx.bss_transactions(spark, sf)))


@query(
    "outstanding_by_cycle",
    ids=("AGG13",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, CAST(outstanding_amount AS DECIMAL(38,6)) AS outstanding_amount "
        "FROM outstanding",
        "outstanding",
    ),
)
def outstanding_by_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return vw.outstanding_by_cycle(fx.outstanding_monthly(fx.bss_transactions(spark, sf)))


_LEDGER_SQL = """
SELECT billing_cycle, account_id, cg.C, cg.G, p.P, u.U
FROM (SELECT billing_cycle, account_id, CAST(SUM(pretax_amount) AS DECIMAL(38,6)) AS C,
             CAST(SUM(pretax_gross_amount) AS DECIMAL(38,6)) AS G FROM line_items GROUP BY 1, 2) cg
FULL OUTER JOIN (SELECT billing_cycle, account_id, CAST(SUM(amount) AS DECIMAL(38,6)) AS P FROM bss_tx
                 WHERE transaction_flow = 'Income' GROUP BY 1, 2) p USING (billing_cycle, account_id)
FULL OUTER JOIN (SELECT billing_cycle, account_id, CAST(SUM(outstanding_amount) AS DECIMAL(38,6)) AS U
                 FROM outstanding GROUP BY 1, 2) u USING (billing_cycle, account_id)
"""


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    tx = fx.bss_transactions(spark, sf)
    return vw.ledger(_items(spark, sf), dg.cash_flow(tx), fx.outstanding_monthly(tx))


@query("ledger", ids=("AGG14",), headline=True, sql=with_ctes(_LEDGER_SQL, "line_items", "bss_tx", "outstanding"))
def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return _ledger(spark, sf)


@query(
    "headline",
    ids=("AGG15",),
    sql=with_ctes(
        "SELECT l.billing_cycle, l.account_id, CAST(CASE WHEN COALESCE(l.C, 0) = 0 AND m.total_amount > 0 "
        "THEN m.total_amount ELSE COALESCE(l.C, 0) END AS DECIMAL(38,6)) AS technical_amount, l.P AS finance_amount "
        f"FROM ({_LEDGER_SQL}) l LEFT JOIN monthly_raw m USING (billing_cycle, account_id)",
        "line_items", "bss_tx", "outstanding", "monthly_raw",
    ),
)
def headline(spark: SparkSession, sf: str) -> DataFrame:
    return vw.headline(_ledger(spark, sf), _monthly_totals(spark, sf))


@query(
    "period_over_period",
    ids=("WIN1",),
    sql=with_ctes(
        """
SELECT c.product_code, c.billing_cycle, c.amount, p.amount AS prev_amount,
       CASE WHEN p.amount <> 0 THEN CAST(c.amount - p.amount AS DOUBLE) / CAST(p.amount AS DOUBLE) * 100.0 END
         AS pct_change,
       p.amount IS NULL AS is_new
FROM (SELECT product_code, billing_cycle, CAST(SUM(amount) AS DECIMAL(38,6)) AS amount
      FROM monthly_products GROUP BY 1, 2) c
LEFT JOIN (SELECT product_code, billing_cycle, CAST(SUM(amount) AS DECIMAL(38,6)) AS amount
           FROM monthly_products GROUP BY 1, 2) p
  ON p.product_code = c.product_code
 AND p.billing_cycle = strftime(CAST(c.billing_cycle || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
""",
        "monthly_products",
    ),
)
def period_over_period(spark: SparkSession, sf: str) -> DataFrame:
    m = flatten_breakdown(_monthly(spark, sf).select("billing_cycle", "product_breakdown"), "product_breakdown")
    series = m.groupBy("product_code", "billing_cycle").agg(F.sum("amount").alias("amount"))
    return vw.period_over_period(series, ["product_code"], "billing_cycle", "amount", kind="month")


@query(
    "product_trend",
    ids=("WIN2",),
    sql=with_ctes(
        """
SELECT s.product_code, CAST(g.d AS DATE) AS bill_date,
       COALESCE(x.amount, CAST(0 AS DECIMAL(38,6))) AS amount
FROM (SELECT product_code, MIN(bill_date) AS lo, MAX(bill_date) AS hi FROM daily_products GROUP BY 1) s
CROSS JOIN LATERAL (SELECT unnest(generate_series(CAST(s.lo AS TIMESTAMP), CAST(s.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g
LEFT JOIN (SELECT product_code, bill_date, CAST(SUM(amount) AS DECIMAL(38,6)) AS amount
           FROM daily_products GROUP BY 1, 2) x
  ON x.product_code = s.product_code AND x.bill_date = CAST(g.d AS DATE)
""",
        "daily_products",
    ),
)
def product_trend(spark: SparkSession, sf: str) -> DataFrame:
    d = flatten_breakdown(_daily(spark, sf).select("bill_date", "product_breakdown"), "product_breakdown")
    return vw.product_trend(d)


def _source_config(spark: SparkSession, sf: str) -> DataFrame:
    """Per-environment C/G source: POC overridden to ``api``, the rest default (oss)."""
    return fx.environments(spark, sf).select(
        "environment", "account_id", F.when(F.col("environment") == "POC", F.lit("api")).alias("source")
    )


@query(
    "route_sources",
    ids=("JN8", "SET2"),
    sql=with_ctes(
        """
SELECT f.account_id, f.billing_cycle, CAST(SUM(f.amount) AS DECIMAL(38,6)) AS amount, e.environment, 'oss' AS source
FROM fact f JOIN env_config e ON f.account_id = e.account_id WHERE e.environment <> 'POC'
GROUP BY f.account_id, f.billing_cycle, e.environment
UNION ALL
SELECT m.account_id, m.billing_cycle, m.cash_total_amount, e.environment, 'api'
FROM monthly_raw m JOIN env_config e ON m.account_id = e.account_id WHERE e.environment = 'POC'
""",
        "fact", "monthly_raw", "env_config",
    ),
)
def route_sources(spark: SparkSession, sf: str) -> DataFrame:
    oss = _fact(spark, sf).groupBy("account_id", "billing_cycle").agg(
        F.sum("amount").cast("decimal(38,6)").alias("amount")
    )
    api = _monthly_totals(spark, sf).select("account_id", "billing_cycle", F.col("cash_total_amount").alias("amount"))
    return vw.route_sources(oss, api, _source_config(spark, sf))


@query(
    "cg_source_label",
    ids=("JN8",),
    sql=with_ctes(
        "SELECT CASE WHEN COUNT(DISTINCT CASE WHEN environment = 'POC' THEN 'api' ELSE 'oss' END) = 1 "
        "THEN MIN(CASE WHEN environment = 'POC' THEN 'api' ELSE 'oss' END) ELSE 'mixed' END AS finops_cg_source "
        "FROM env_config",
        "env_config",
    ),
)
def cg_source_label(spark: SparkSession, sf: str) -> DataFrame:
    return vw.source_label(_source_config(spark, sf))


SILENT_AS_OF = "2001-10-15"


@query(
    "silent_accounts",
    ids=("JN9",),
    sql=with_ctes(
        "SELECT e.* FROM env_config e WHERE NOT EXISTS (SELECT 1 FROM monthly_raw m WHERE m.account_id = e.account_id "
        f"AND m.billing_cycle = strftime(DATE '{SILENT_AS_OF}', '%Y-%m'))",
        "env_config", "monthly_raw",
    ),
)
def silent_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """JN9: configured environments without bill rows in the as-of cycle."""
    m = _monthly_totals(spark, sf).filter(F.col("billing_cycle") == SILENT_AS_OF[:7])
    return vw.silent_accounts(fx.environments(spark, sf), m)


@query(
    "match_transactions",
    ids=("JN6",),
    sql=with_ctes(
        "SELECT t.transaction_number, t.record_id, n.line_item_count, n.line_item_cash, "
        "n.line_item_count IS NOT NULL AS matched FROM bss_tx t LEFT JOIN (SELECT sub_order_id AS record_id, "
        "COUNT(*) AS line_item_count, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS line_item_cash FROM line_items "
        "GROUP BY 1) n ON t.record_id = n.record_id",
        "bss_tx", "line_items",
    ),
)
def match_transactions(spark: SparkSession, sf: str) -> DataFrame:
    tx = fx.bss_transactions(spark, sf).select("transaction_number", "record_id")
    return vw.match_transactions(tx, _items(spark, sf))
