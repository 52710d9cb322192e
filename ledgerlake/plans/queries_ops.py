"""Operational queries of the catalog (namespace cost, workload CPU, SLO, logs, risks,
sync runs) and the data-quality reports, over the driver's ``events`` and bill tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import ops_metrics as om
from ..operators import quality as qa
from ..operators import rollup as ru
from ..operators import views as vw
from .catalog import query
from .fixture_sql import with_ctes

_SVC = "'svc-' || CAST(user_id % 5 AS VARCHAR)"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    return fx.events(spark, sf)


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


@query(
    "namespace_daily",
    ids=("AGG16",),
    sql=with_ctes(
        f"""
SELECT day, namespace, CAST(SUM(billable) AS DECIMAL(18,2)) AS billable_cost, CAST(SUM(used) AS DECIMAL(18,2)) AS usage_cost,
       CAST(SUM(billable) - SUM(used) AS DECIMAL(18,2)) AS waste_cost,
       CASE WHEN SUM(billable) = 0 THEN NULL
            ELSE CAST(CAST(SUM(used) AS DECIMAL(18,2)) AS DOUBLE) / CAST(CAST(SUM(billable) AS DECIMAL(18,2)) AS DOUBLE) * 100.0 END
         AS efficiency,
       COUNT(*) AS pod_count, COUNT(*) FILTER (WHERE max_activity < 20) AS zombie_count
FROM (SELECT CAST(ts AS DATE) AS day, event_type AS namespace, user_id,
             SUM(CAST(value AS DECIMAL(10,2))) AS billable,
             SUM(CASE WHEN {_K} >= 20 THEN CAST(value AS DECIMAL(10,2)) ELSE 0 END) AS used,
             MAX({_K}) AS max_activity
      FROM ev GROUP BY 1, 2, 3) p
GROUP BY day, namespace
""",
        "ev",
    ),
)
def namespace_daily(spark: SparkSession, sf: str) -> DataFrame:
    return om.namespace_daily(fx.pod_samples(_ev(spark, sf)))


@query(
    "workload_hourly",
    ids=("AGG17",),
    headline=True,
    sql=with_ctes(
        "SELECT date_trunc('hour', ts) AS time_bucket, event_type AS namespace, "
        "'wl-' || CAST(user_id % 10 AS VARCHAR) AS workload_name, MAX(CAST(value AS DECIMAL(10,4))) AS max_cpu_usage, "
        "quantile_disc(CAST(value AS DECIMAL(10,4)), 0.95) AS p95_cpu_usage, "
        "CAST(SUM(CAST(value AS DECIMAL(10,4))) AS DOUBLE) / COUNT(*) AS avg_cpu_usage, COUNT(*) AS samples "
        "FROM ev GROUP BY 1, 2, 3",
        "ev",
    ),
)
def workload_hourly(spark: SparkSession, sf: str) -> DataFrame:
    w = om.workload_hourly(fx.workload_samples(_ev(spark, sf)))
    return w.select(_ntz("time_bucket"), *[c for c in w.columns if c != "time_bucket"])


@query(
    "roi_savings",
    ids=("AGG18",),
    sql=with_ctes(
        f"SELECT {_SVC} AS namespace, event_type, CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS savings_amount, "
        "COUNT(*) AS events FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2",
        "ev",
    ),
)
def roi_savings(spark: SparkSession, sf: str) -> DataFrame:
    return om.roi_savings(fx.roi_events(_ev(spark, sf)))


@query(
    "slo_daily",
    ids=("AGG19",),
    sql=with_ctes(
        f"""
SELECT day, slo_id, service_name, good, total, availability,
       100.0 * (1.0 - CASE WHEN 1.0 - 0.8 = 0 THEN NULL ELSE (1.0 - availability) / (1.0 - CAST(CAST('0.8000' AS DECIMAL(5,4)) AS DOUBLE)) END)
         AS error_budget_remaining,
       CASE WHEN 100.0 * (1.0 - (1.0 - availability) / (1.0 - CAST(CAST('0.8000' AS DECIMAL(5,4)) AS DOUBLE))) >= 25 THEN 'HEALTHY'
            WHEN 100.0 * (1.0 - (1.0 - availability) / (1.0 - CAST(CAST('0.8000' AS DECIMAL(5,4)) AS DOUBLE))) >= 0 THEN 'AT_RISK'
            ELSE 'BREACHED' END AS status
FROM (SELECT CAST(ts AS DATE) AS day, CAST(user_id % 5 + 1 AS INTEGER) AS slo_id, {_SVC} AS service_name,
             COUNT(*) FILTER (WHERE event_type <> 'error') AS good, COUNT(*) AS total,
             CAST(COUNT(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS availability
      FROM ev GROUP BY 1, 2, 3) d
""",
        "ev",
    ),
)
def slo_daily(spark: SparkSession, sf: str) -> DataFrame:
    ev = _ev(spark, sf)
    return om.slo_daily(fx.slo_requests(ev), fx.slo_definitions(ev))


@query(
    "slo_orphans",
    ids=("JN7",),
    sql=with_ctes(
        "SELECT CAST(ts AS DATE) AS day, CAST(user_id % 5 + 1 AS INTEGER) AS slo_id, COUNT(*) AS total FROM ev "
        "WHERE CAST(user_id % 5 + 1 AS INTEGER) NOT IN (SELECT DISTINCT CAST(user_id % 5 + 1 AS INTEGER) FROM ev "
        "WHERE event_type <> 'error') GROUP BY 1, 2",
        "ev",
    ),
)
def slo_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """JN7: history rows whose slo_id has no definition (definitions from non-error traffic)."""
    ev = _ev(spark, sf)
    history = ev.groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 5 + 1).cast("int").alias("slo_id")).agg(
        F.count(F.lit(1)).alias("total")
    )
    defs = fx.slo_definitions(ev.filter(F.col("event_type") != "error"))
    return vw.orphans(history, defs, "slo_id", "id")


@query(
    "error_counts",
    ids=("AGG20",),
    sql=with_ctes(
        f"SELECT date_trunc('hour', ts) AS bucket_start, {_SVC} AS service, COUNT(*) AS errors FROM ev "
        "WHERE event_type = 'error' GROUP BY 1, 2",
        "ev",
    ),
)
def error_counts(spark: SparkSession, sf: str) -> DataFrame:
    e = om.error_counts(fx.error_logs(_ev(spark, sf)))
    return e.select(_ntz("bucket_start"), "service", "errors")


@query(
    "latency_stats",
    ids=("AGG21",),
    sql=with_ctes(
        f"SELECT {_SVC} AS service, '/' || event_type AS path, COUNT(*) AS requests, "
        "quantile_disc(CAST(value AS DECIMAL(10,2)), 0.5) AS p50_latency_ms, "
        "quantile_disc(CAST(value AS DECIMAL(10,2)), 0.95) AS p95_latency_ms, "
        "MAX(CAST(value AS DECIMAL(10,2))) AS max_latency_ms, "
        "COUNT(*) FILTER (WHERE event_type = 'error') AS server_errors FROM ev GROUP BY 1, 2",
        "ev",
    ),
)
def latency_stats(spark: SparkSession, sf: str) -> DataFrame:
    return om.latency_stats(fx.sampled_logs(_ev(spark, sf)))


@query(
    "risk_counts",
    ids=("AGG23",),
    sql=with_ctes(
        f"SELECT event_type AS risk_type, CASE WHEN {_K} >= 90 THEN 'critical' WHEN {_K} >= 70 THEN 'high' "
        f"WHEN {_K} >= 40 THEN 'medium' ELSE 'low' END AS severity, "
        f"CASE WHEN {_K} % 2 = 0 THEN 'open' ELSE 'resolved' END AS status, {_SVC} AS namespace, COUNT(*) AS risks "
        "FROM ev GROUP BY 1, 2, 3, 4",
        "ev",
    ),
)
def risk_counts(spark: SparkSession, sf: str) -> DataFrame:
    return om.risk_counts(fx.risks(_ev(spark, sf)))


@query(
    "incident_counts",
    ids=("AGG23",),
    sql=with_ctes(
        f"SELECT {_SVC} AS service_name, CASE WHEN {_K} >= 70 THEN 'capacity' WHEN {_K} >= 40 THEN 'dependency' "
        f"ELSE 'config' END AS root_cause_type, CASE WHEN {_K} % 3 = 0 THEN 'resolved' ELSE 'open' END AS status, "
        f"COUNT(*) AS incidents, CAST(SUM({_K}) AS BIGINT) AS score_sum, MAX({_K}) AS max_score "
        "FROM ev WHERE event_type = 'error' GROUP BY 1, 2, 3",
        "ev",
    ),
)
def incident_counts(spark: SparkSession, sf: str) -> DataFrame:
    return om.incident_counts(fx.incidents(_ev(spark, sf)))


@query(
    "sync_run_summary",
    ids=("AGG25",),
    sql=with_ctes(
        f"""
SELECT status, COUNT(*) AS jobs, CAST(SUM(epoch_us(completed_at) - epoch_us(started_at)) AS BIGINT) AS total_duration_us,
       CAST(SUM(epoch_us(completed_at) - epoch_us(started_at)) AS DOUBLE) / COUNT(*) / 1e6 AS avg_duration_s,
       CAST(SUM(progress_current) AS DOUBLE) / CAST(SUM(progress_total) AS DOUBLE) AS progress_ratio
FROM (SELECT CAST(ts AS DATE) AS day, MIN(ts) AS started_at, MAX(ts) AS completed_at,
             CASE WHEN MAX(CASE WHEN event_type = 'error' AND {_K} >= 95 THEN 1 ELSE 0 END) = 1 THEN 'failed'
                  ELSE 'succeeded' END AS status,
             COUNT(*) FILTER (WHERE event_type <> 'error') AS progress_current, COUNT(*) AS progress_total
      FROM ev GROUP BY 1) j
GROUP BY status
""",
        "ev",
    ),
)
def sync_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return om.sync_run_summary(fx.sync_jobs(_ev(spark, sf)))


# ------------------------------------------------------------------ quality
def _constraint_sql() -> str:
    from ..schemas import DECIMAL_BOUNDS, MAX_LENGTH, NOT_NULL

    parts = []
    for table, src in (("cost_cloud_bill_line_items", "line_items"), ("cost_cloud_bill_monthly_raw", "monthly_raw")):
        cols = {
            "line_items": (
                "record_id", "bill_date", "billing_cycle", "product_code", "product_name", "sub_order_id",
                "instance_id", "billing_item", "subscription_type", "cash_amount", "pretax_amount",
                "pretax_gross_amount", "currency", "is_reversal", "account_id", "ingestion_channel", "region",
                "raw_payload", "synced_at", "created_at",
            ),
            "monthly_raw": ("billing_cycle", "account_id", "total_amount", "cash_total_amount"),
        }[src]
        for c in NOT_NULL.get(table, ()):
            if c in cols:
                parts.append(f"SELECT '{table}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
                             f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {src}")
        for c, n in MAX_LENGTH.get(table, {}).items():
            if c in cols:
                parts.append(f"SELECT '{table}', 'max_length', '{c}', COUNT(*) FILTER (WHERE length({c}) > {n}) FROM {src}")
        for c, (p, s) in DECIMAL_BOUNDS.get(table, {}).items():
            if c in cols:
                parts.append(f"SELECT '{table}', 'decimal_overflow', '{c}', "
                             f"COUNT(*) FILTER (WHERE abs({c}) >= {10 ** (p - s)}) FROM {src}")
    # the breakdown map exists exactly when the monthly row has product rows
    parts.append("SELECT 'cost_cloud_bill_monthly_raw', 'not_null', 'product_breakdown', COUNT(*) FROM monthly_raw m "
                 "WHERE NOT EXISTS (SELECT 1 FROM monthly_products p WHERE p.billing_cycle = m.billing_cycle "
                 "AND p.account_id = m.account_id)")
    parts.append("SELECT 'cost_cloud_bill_line_items', 'duplicate_key', 'record_id', "
                 "CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) FROM (SELECT record_id, COUNT(*) AS n "
                 "FROM line_items GROUP BY 1)")
    parts.append("SELECT 'cost_cloud_bill_monthly_raw', 'duplicate_key', 'billing_cycle,account_id', "
                 "CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) FROM (SELECT billing_cycle, account_id, COUNT(*) AS n "
                 "FROM monthly_raw GROUP BY 1, 2)")
    return with_ctes(" UNION ALL ".join(parts), "line_items", "monthly_raw", "monthly_products")


@query("constraint_report", ids=("Q6",), sql=_constraint_sql())
def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.line_items(spark, sf)
    monthly = ru.monthly_rollup(fx.overview_items(items))
    return qa.constraints(items, "cost_cloud_bill_line_items").unionByName(
        qa.constraints(monthly, "cost_cloud_bill_monthly_raw")
    ).withColumn("violations", F.col("violations").cast("bigint"))


@query(
    "table_readiness",
    ids=("Q7", "LIM1"),
    sql=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, TRUE AS readable, COUNT(*) > 0 AS has_rows FROM (SELECT 1 FROM {t} LIMIT 1)"
        for t in fx.DRIVER_TABLES
    ),
)
def table_readiness(spark: SparkSession, sf: str) -> DataFrame:
    import os

    return qa.readiness(spark, {t: os.path.join(sf, f"{t}.parquet") for t in fx.DRIVER_TABLES})
