"""The fixture derivations of ``ledgerlake.fixtures`` as DuckDB SQL (oracle side).

Each entry is a named CTE with its dependencies; ``with_ctes(body, *names)`` emits
the needed CTEs in dependency order in front of a query body.  The SQL is written
independently of the Spark code, from FIXTURES.md section 2, so that a slip in either
shows up as a mismatch.
"""

from __future__ import annotations

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    _CTES[name] = (sql.strip(), deps)


_LINE_ITEMS = """
SELECT
  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) || '-' ||
    CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS record_id,
  CAST(l.l_shipdate AS DATE) AS bill_date,
  strftime(o.o_orderdate, '%Y-%m') AS billing_cycle,
  p.p_type AS product_code,
  p.p_name AS product_name,
  CAST(l.l_orderkey AS VARCHAR) AS sub_order_id,
  p.p_brand AS instance_id,
  CAST(l.l_linenumber AS VARCHAR) AS billing_item,
  CASE l.l_linestatus WHEN 'O' THEN 'PayAsYouGo' WHEN 'F' THEN 'Subscription' END AS subscription_type,
  CAST((CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END) * CAST(l.l_extendedprice AS DECIMAL(12,2))
       * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(14,6)) AS cash_amount,
  CAST((CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END) * CAST(l.l_extendedprice AS DECIMAL(12,2))
       AS DECIMAL(14,6)) AS pretax_amount,
  CAST((CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END) * CAST(l.l_extendedprice AS DECIMAL(12,2))
       * (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DECIMAL(14,6)) AS pretax_gross_amount,
  'CNY' AS currency,
  l.l_returnflag = 'R' AS is_reversal,
  {account} AS account_id,
  'api_query_account_bill' AS ingestion_channel,
  n.n_name AS region,
  CAST(NULL AS VARCHAR) AS raw_payload,
  CAST(l.l_shipdate AS TIMESTAMP) AS synced_at,
  CAST(o.o_orderdate AS TIMESTAMP) AS created_at
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

_cte("line_items", _LINE_ITEMS.format(account="r.r_name"))
_cte(
    "line_items_legacy",
    _LINE_ITEMS.format(account="CASE WHEN n.n_nationkey % 5 = 0 THEN '' ELSE r.r_name END"),
)

_cte(
    "daily_products",
    """
SELECT bill_date, account_id, product_code,
       CAST(SUM(pretax_amount) AS DECIMAL(38,6)) AS amount,
       CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS cash_amount
FROM line_items GROUP BY bill_date, account_id, product_code
""",
    ("line_items",),
)
_cte(
    "daily_raw",
    """
SELECT bill_date, account_id,
       CAST(SUM(pretax_amount) AS DECIMAL(38,6)) AS total_amount,
       CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS cash_total_amount
FROM line_items GROUP BY bill_date, account_id
""",
    ("line_items",),
)
_cte(
    "overview",
    """
SELECT billing_cycle, account_id, product_code AS ProductCode, subscription_type AS SubscriptionType,
       pretax_amount AS PretaxAmount,
       CASE WHEN subscription_type = 'PayAsYouGo' THEN pretax_gross_amount
            ELSE CAST(0 AS DECIMAL(14,6)) END AS PaymentAmount,
       cash_amount AS CashAmount
FROM line_items
""",
    ("line_items",),
)
_cte(
    "overview_cash",
    """
SELECT *,
       CASE WHEN COALESCE(PaymentAmount, 0) <> 0 THEN COALESCE(PaymentAmount, 0)
            ELSE COALESCE(CashAmount, 0) END AS pay_choice
FROM overview
""",
    ("overview",),
)
_cte(
    "monthly_products",
    """
SELECT billing_cycle, account_id, ProductCode AS product_code,
       CAST(SUM(PretaxAmount) AS DECIMAL(38,6)) AS amount,
       CAST(SUM(CASE WHEN pay_choice <> 0 THEN pay_choice END) AS DECIMAL(38,6)) AS cash_amount
FROM overview_cash GROUP BY billing_cycle, account_id, ProductCode
""",
    ("overview_cash",),
)
_cte(
    "monthly_raw",
    """
SELECT billing_cycle, account_id,
       CAST(SUM(PretaxAmount) AS DECIMAL(38,6)) AS total_amount,
       CAST(COALESCE(SUM(CASE WHEN pay_choice <> 0 THEN pay_choice END), 0) AS DECIMAL(38,6)) AS cash_total_amount
FROM overview_cash GROUP BY billing_cycle, account_id
""",
    ("overview_cash",),
)
_cte(
    "api_totals",
    """
SELECT billing_cycle, account_id,
       CAST(SUM(cash_amount) + CASE account_id WHEN 'AFRICA' THEN 0.00 WHEN 'AMERICA' THEN 0.01
                                              WHEN 'ASIA' THEN 0.02 WHEN 'EUROPE' THEN -5.00 END
            AS DECIMAL(24,6)) AS monthly_api_total
FROM line_items
WHERE account_id IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')
GROUP BY billing_cycle, account_id
""",
    ("line_items",),
)
_cte(
    "reconciled",
    """
SELECT billing_cycle, account_id, line_items_sum, daily_sum,
       CASE WHEN line_items_sum <> 0 THEN line_items_sum ELSE daily_sum END AS ref_total,
       monthly_api_total,
       CAST(CASE WHEN line_items_sum <> 0 THEN line_items_sum ELSE daily_sum END - monthly_api_total
            AS DECIMAL(38,6)) AS drift
FROM (
  SELECT billing_cycle, account_id,
         CAST(COALESCE(li.s, 0) AS DECIMAL(38,6)) AS line_items_sum,
         CAST(COALESCE(dd.s, 0) AS DECIMAL(38,6)) AS daily_sum,
         CAST(a.monthly_api_total AS DECIMAL(38,6)) AS monthly_api_total
  FROM (SELECT billing_cycle, account_id, SUM(cash_amount) AS s FROM line_items GROUP BY 1, 2) li
  FULL OUTER JOIN (SELECT strftime(bill_date, '%Y-%m') AS billing_cycle, account_id, SUM(cash_total_amount) AS s
                   FROM daily_raw GROUP BY 1, 2) dd USING (billing_cycle, account_id)
  FULL OUTER JOIN api_totals a USING (billing_cycle, account_id)
) t
""",
    ("line_items", "daily_raw", "api_totals"),
)
_cte(
    "outcome",
    """
SELECT *,
       CASE WHEN monthly_api_total IS NULL THEN 'UNKNOWN'
            WHEN abs(drift) <= 0.01 THEN 'PASS' ELSE 'DRIFT' END AS outcome,
       CASE WHEN monthly_api_total IS NULL THEN NULL
            WHEN abs(drift) <= 0.01 THEN 'FINALIZED' ELSE 'DIRTY' END AS data_status
FROM reconciled
""",
    ("reconciled",),
)
_cte(
    "bss_tx",
    """
SELECT 'T-' || CAST(o.o_orderkey AS VARCHAR) AS transaction_number,
       r.r_name AS account_id,
       CAST(o.o_orderdate AS TIMESTAMP) AS transaction_time,
       CAST(o.o_totalprice AS DECIMAL(14,6)) AS amount,
       o.o_orderpriority AS transaction_type,
       CASE WHEN o.o_orderstatus = 'F' THEN 'Income' ELSE 'Expense' END AS transaction_flow,
       CAST(o.o_orderkey AS VARCHAR) AS record_id,
       strftime(o.o_orderdate, '%Y-%m') AS billing_cycle,
       'CNY' AS currency,
       CAST(o.o_orderdate AS TIMESTAMP) AS synced_at,
       o.o_orderstatus
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""",
)
_cte(
    "outstanding",
    """
SELECT billing_cycle, account_id, CAST(SUM(amount) AS DECIMAL(24,6)) AS outstanding_amount
FROM bss_tx WHERE o_orderstatus IN ('O', 'P') GROUP BY billing_cycle, account_id
""",
    ("bss_tx",),
)
_cte(
    "env_config",
    """
SELECT m.environment, r.r_name AS account_id,
       m.environment || ' ' || upper(substr(r.r_name, 1, 1)) || lower(substr(r.r_name, 2)) AS display_name,
       CAST(r.r_regionkey + 1 AS INTEGER) AS sort_order
FROM region r
JOIN (VALUES ('AFRICA', 'POC'), ('AMERICA', 'UAT'), ('ASIA', 'FAT'), ('EUROPE', 'PROD')) m(r_name, environment)
  ON r.r_name = m.r_name
""",
)
_cte(
    "category_map",
    """
SELECT * FROM (VALUES
  ('ECS', 'compute'), ('ACK', 'compute'), ('CS', 'compute'), ('ecs_workflow', 'compute'),
  ('OSS', 'storage'), ('NAS', 'storage'), ('DISK', 'storage'),
  ('CDN', 'network'), ('SLB', 'network'), ('VPC', 'network'), ('EIP', 'network'),
  ('CDT', 'other'), ('SFM', 'other'),
  ('STANDARD', 'compute'), ('ECONOMY', 'compute'), ('MEDIUM', 'storage'), ('LARGE', 'network')
) t(product_code, category)
""",
)
_cte(
    "ev",
    """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events
""",
)


# legacy-account variants (account '' for every fifth nation)
for _n in ("daily_raw", "overview", "overview_cash", "monthly_raw"):
    _sql, _deps = _CTES[_n]
    _CTES[_n + "_legacy"] = (
        _sql.replace("FROM line_items", "FROM line_items_legacy").replace("FROM overview_cash", "FROM overview_cash_legacy")
        .replace("FROM overview\n", "FROM overview_legacy\n").replace("FROM overview ", "FROM overview_legacy "),
        tuple(d + "_legacy" for d in _deps),
    )
_CTES["overview_cash_legacy"] = (_CTES["overview_cash"][0].replace("FROM overview", "FROM overview_legacy"), ("overview_legacy",))

_cte(
    "period_rows",
    """
SELECT '1d' AS report_type, strftime(bill_date, '%Y-%m-%d') AS period_key, account_id, metric_type, product_code, amount
FROM (SELECT bill_date, account_id, 'consumption' AS metric_type, product_code, amount FROM daily_products
      UNION ALL SELECT bill_date, account_id, 'payment', product_code, cash_amount FROM daily_products) d
UNION ALL
SELECT 'this_week', strftime(bill_date, '%G-W%V'), account_id, metric_type, product_code, amount
FROM (SELECT bill_date, account_id, 'consumption' AS metric_type, product_code, amount FROM daily_products
      UNION ALL SELECT bill_date, account_id, 'payment', product_code, cash_amount FROM daily_products) d
UNION ALL
SELECT r.report_type,
       CASE r.report_type WHEN 'month' THEN billing_cycle
            WHEN 'quarter' THEN substr(billing_cycle, 1, 4) || '-Q' ||
                 CAST((CAST(substr(billing_cycle, 6, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR)
            ELSE substr(billing_cycle, 1, 4) END,
       account_id, metric_type, product_code, amount
FROM (SELECT billing_cycle, account_id, 'consumption' AS metric_type, product_code, amount FROM monthly_products
      UNION ALL SELECT billing_cycle, account_id, 'payment', product_code, cash_amount FROM monthly_products) m
CROSS JOIN (VALUES ('month'), ('quarter'), ('this_year')) r(report_type)
""",
    ("daily_products", "monthly_products"),
)
_cte(
    "period_agg",
    """
SELECT report_type, period_key, account_id, metric_type,
       CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,6)) AS total_amount,
       COUNT(DISTINCT CASE WHEN amount IS NOT NULL THEN product_code END) AS product_count,
       'PRELIMINARY' AS data_status
FROM period_rows GROUP BY report_type, period_key, account_id, metric_type
""",
    ("period_rows",),
)
_cte(
    "fact_rows",
    """
SELECT li.billing_cycle, li.bill_date AS usage_date, li.region AS account_alias, li.account_id,
       COALESCE(json_extract_string(t.tags_json, '$.env'), 'UNTAGGED') AS env,
       li.product_code, li.sub_order_id AS instance_id, li.billing_item AS item_code,
       CAST(li.cash_amount AS DECIMAL(18,6)) AS amount, li.currency, t.tags_json,
       'billing-data/' || li.account_id || '/' || li.billing_cycle || '.csv' AS source_object,
       sha256(concat_ws(chr(31), li.billing_cycle, CAST(li.bill_date AS VARCHAR), li.sub_order_id, li.billing_item, li.record_id))
         AS dedup_key,
       li.synced_at AS ingested_at,
       li.pretax_amount, li.record_id
FROM line_items li
LEFT JOIN (SELECT account_id, '{"env":"' || environment || '"}' AS tags_json FROM env_config) t
  ON li.account_id = t.account_id
""",
    ("line_items", "env_config"),
)
_cte(
    "fact",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY account_id, dedup_key
    ORDER BY ingested_at DESC NULLS LAST, billing_cycle DESC NULLS LAST, usage_date DESC NULLS LAST,
             account_alias DESC NULLS LAST, env DESC NULLS LAST, product_code DESC NULLS LAST,
             instance_id DESC NULLS LAST, item_code DESC NULLS LAST, amount DESC NULLS LAST,
             currency DESC NULLS LAST, tags_json DESC NULLS LAST, source_object DESC NULLS LAST) AS rn
  FROM (SELECT * EXCLUDE (pretax_amount, record_id) FROM fact_rows)
) WHERE rn = 1
""",
    ("fact_rows",),
)
_cte(
    "status_new",
    """
SELECT billing_cycle, account_id, data_status,
       CAST(ROUND(ref_total, 2) AS DECIMAL(14,2)) AS line_items_sum,
       CAST(ROUND(monthly_api_total, 2) AS DECIMAL(14,2)) AS monthly_api_total,
       CAST(ROUND(drift, 2) AS DECIMAL(14,2)) AS drift_amount
FROM outcome WHERE outcome <> 'UNKNOWN'
""",
    ("outcome",),
)
_cte(
    "month_status",
    """
SELECT COALESCE(o.billing_cycle, n.billing_cycle) AS billing_cycle,
       COALESCE(o.account_id, n.account_id) AS account_id,
       CASE WHEN n.billing_cycle IS NOT NULL THEN n.data_status ELSE o.data_status END AS data_status,
       CASE WHEN n.billing_cycle IS NOT NULL THEN n.line_items_sum ELSE NULL END AS line_items_sum,
       CASE WHEN n.billing_cycle IS NOT NULL THEN n.monthly_api_total ELSE NULL END AS monthly_api_total,
       CASE WHEN n.billing_cycle IS NOT NULL THEN n.drift_amount ELSE NULL END AS drift_amount,
       CASE WHEN o.billing_cycle IS NOT NULL THEN o.notes ELSE NULL END AS notes
FROM (SELECT DISTINCT billing_cycle, account_id, 'PRELIMINARY' AS data_status, 'initial load' AS notes
      FROM line_items) o
FULL OUTER JOIN status_new n ON o.billing_cycle = n.billing_cycle AND o.account_id = n.account_id
""",
    ("line_items", "status_new"),
)


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS (\n{_CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
