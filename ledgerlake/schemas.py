"""Explicit schemas of the billing tables (T1-T23) and their column defaults.

Spark does not enforce keys or NOT NULL on files; keys are kept by the write path
(``operators.upsert``) and checked by ``operators.quality.constraints`` with the rules
below (``KEYS``, ``NOT_NULL``, ``MAX_LENGTH``, ``DECIMAL_BOUNDS``).
Fixed-point types follow the DDL; sums are widened to decimal(38,6) in queries.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed_values import (
    DEFAULT_CHANNEL,
    DEFAULT_CURRENCY,
    DEFAULT_ENV,
    METRIC_CONSUMPTION,
    STATUS_PRELIMINARY,
)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, TS, TSN, B, I, L = (
    T.StringType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.IntegerType(), T.LongType(),
)


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


BREAKDOWN = T.MapType(S, dec(38, 6))

SCHEMAS: dict[str, T.StructType] = {
    "cost_daily_namespace": _s(
        ("day", D), ("namespace", S), ("billable_cost", dec(10, 2)), ("usage_cost", dec(10, 2)),
        ("waste_cost", dec(10, 2)), ("efficiency", dec(5, 2)), ("pod_count", I), ("zombie_count", I),
    ),
    "cost_hourly_workload": _s(
        ("time_bucket", TS), ("namespace", S), ("workload_name", S), ("workload_kind", S),
        ("request_cores", dec(10, 4)), ("limit_cores", dec(10, 4)), ("max_cpu_usage", dec(10, 4)),
        ("p95_cpu_usage", dec(10, 4)), ("avg_cpu_usage", dec(10, 4)),
    ),
    "cost_roi_events": _s(
        ("id", L), ("event_time", TS), ("namespace", S), ("service_name", S), ("event_type", S),
        ("savings_amount", dec(10, 2)), ("description", S),
    ),
    "cost_cloud_bill_summary": _s(
        ("day", D), ("billing_cycle", S), ("total_amount", dec(12, 2)), ("product_breakdown", S),
        ("created_at", TS), ("updated_at", TS),
    ),
    "cost_cloud_bill_line_items": _s(
        ("record_id", S), ("bill_date", D), ("billing_cycle", S), ("product_code", S), ("product_name", S),
        ("sub_order_id", S), ("instance_id", S), ("billing_item", S), ("subscription_type", S),
        ("cash_amount", dec(14, 6)), ("pretax_amount", dec(14, 6)), ("pretax_gross_amount", dec(14, 6)),
        ("currency", S), ("is_reversal", B), ("account_id", S), ("ingestion_channel", S), ("region", S),
        ("raw_payload", S), ("synced_at", TSN), ("created_at", TSN), ("updated_at", TSN),
    ),
    "cost_cloud_bill_month_status": _s(
        ("billing_cycle", S), ("account_id", S), ("data_status", S), ("line_items_sum", dec(14, 2)),
        ("monthly_api_total", dec(14, 2)), ("drift_amount", dec(14, 2)), ("last_reconciled_at", TS),
        ("last_full_sync_at", TS), ("finalized_at", TS), ("notes", S), ("created_at", TS), ("updated_at", TS),
    ),
    "cost_bss_transactions": _s(
        ("transaction_number", S), ("account_id", S), ("transaction_time", TSN), ("amount", dec(14, 6)),
        ("transaction_type", S), ("transaction_flow", S), ("record_id", S), ("billing_cycle", S),
        ("currency", S), ("synced_at", TSN),
    ),
    "cost_bss_balance_snapshot": _s(
        ("account_id", S), ("snapshot_date", D), ("available_amount", dec(14, 6)), ("currency", S), ("synced_at", TSN),
    ),
    "cost_bill_outstanding_monthly": _s(
        ("billing_cycle", S), ("account_id", S), ("outstanding_amount", dec(14, 6)), ("synced_at", TSN),
    ),
    "finops_billing_fact": _s(
        ("billing_cycle", S), ("usage_date", D), ("account_alias", S), ("account_id", S), ("env", S),
        ("product_code", S), ("instance_id", S), ("item_code", S), ("amount", dec(18, 6)), ("currency", S),
        ("tags_json", S), ("source_object", S), ("dedup_key", S), ("ingested_at", TSN),
    ),
    "finops_oss_sync_checkpoint": _s(("account_id", S), ("max_object_last_modified", TS), ("updated_at", TS)),
    "cost_cloud_bill_monthly_raw": _s(
        ("billing_cycle", S), ("total_amount", dec(38, 6)), ("product_breakdown", BREAKDOWN),
        ("cash_total_amount", dec(38, 6)), ("cash_product_breakdown", BREAKDOWN), ("snapshot_at", TS),
        ("created_at", TS), ("account_id", S), ("region", S),
    ),
    "cost_cloud_bill_daily_raw": _s(
        ("bill_date", D), ("total_amount", dec(38, 6)), ("product_breakdown", BREAKDOWN),
        ("cash_total_amount", dec(38, 6)), ("cash_product_breakdown", BREAKDOWN), ("snapshot_at", TS),
        ("created_at", TS), ("account_id", S), ("region", S),
    ),
    "cost_cloud_bill_aggregate": _s(
        ("report_type", S), ("period_key", S), ("account_id", S), ("metric_type", S), ("total_amount", dec(38, 6)),
        ("product_breakdown", BREAKDOWN), ("data_status", S), ("last_success_at", TS), ("created_at", TS),
        ("updated_at", TS), ("region", S),
    ),
    "cost_env_account_config": _s(
        ("environment", S), ("account_id", S), ("display_name", S), ("sort_order", I), ("created_at", TS),
    ),
    "product_category_mapping": _s(("product_code", S), ("category", S), ("created_at", TS)),
    "slo_definitions": _s(
        ("id", I), ("namespace", S), ("service_name", S), ("target_slo", dec(5, 4)), ("time_window", S),
        ("error_budget_policy", S),
    ),
    "slo_daily_history": _s(
        ("day", D), ("slo_id", I), ("availability", dec(7, 6)), ("error_budget_remaining", dec(5, 2)), ("status", S),
    ),
    "finops_sync_job": _s(
        ("id", L), ("status", S), ("phase", S), ("config_snapshot", S), ("warnings", S), ("error_message", S),
        ("created_at", TS), ("started_at", TS), ("completed_at", TS), ("data_version", L),
        ("progress_current", I), ("progress_total", I), ("phase_detail", S),
    ),
    "rca_incidents": _s(
        ("id", I), ("incident_time", TS), ("service_name", S), ("snapshot_data", S), ("root_cause_type", S),
        ("ai_summary", S), ("status", S),
    ),
    "prevention_risks": _s(
        ("id", I), ("detected_at", TS), ("namespace", S), ("target", S), ("risk_type", S), ("severity", S),
        ("description", S), ("evidence_metrics", S), ("status", S),
    ),
    "logs_error": _s(
        ("timestamp", TS), ("service", S), ("namespace", S), ("level", S), ("message", S), ("trace_id", S),
        ("event_date", D),
    ),
    "logs_sampled": _s(
        ("timestamp", TS), ("service", S), ("path", S), ("status_code", I), ("latency_ms", dec(10, 2)),
        ("trace_id", S), ("event_date", D),
    ),
}

# Column defaults of the DDL, applied to absent columns only.
DEFAULTS: dict[str, dict[str, object]] = {
    "cost_cloud_bill_line_items": {
        "currency": DEFAULT_CURRENCY, "is_reversal": False, "account_id": "", "ingestion_channel": DEFAULT_CHANNEL,
    },
    "cost_cloud_bill_month_status": {"account_id": "", "data_status": STATUS_PRELIMINARY},
    "cost_bss_transactions": {"account_id": "", "currency": DEFAULT_CURRENCY},
    "cost_bss_balance_snapshot": {"currency": DEFAULT_CURRENCY},
    "cost_bill_outstanding_monthly": {"account_id": ""},
    "finops_billing_fact": {"account_id": "", "env": DEFAULT_ENV, "item_code": "", "currency": DEFAULT_CURRENCY},
    "cost_cloud_bill_monthly_raw": {"cash_total_amount": 0, "account_id": ""},
    "cost_cloud_bill_daily_raw": {"cash_total_amount": 0, "account_id": ""},
    "cost_cloud_bill_aggregate": {"account_id": "", "metric_type": METRIC_CONSUMPTION, "data_status": STATUS_PRELIMINARY},
    "cost_env_account_config": {"sort_order": 0},
    "finops_sync_job": {
        "status": "queued", "phase": "", "data_version": 0, "progress_current": 0, "progress_total": 0, "phase_detail": "",
    },
}

# Primary / unique keys of the DDL.
KEYS: dict[str, tuple[str, ...]] = {
    "cost_daily_namespace": ("day", "namespace"),
    "cost_hourly_workload": ("time_bucket", "namespace", "workload_name"),
    "cost_cloud_bill_summary": ("day", "billing_cycle"),
    "cost_cloud_bill_line_items": ("record_id",),
    "cost_cloud_bill_month_status": ("billing_cycle", "account_id"),
    "cost_bss_transactions": ("transaction_number",),
    "cost_bss_balance_snapshot": ("account_id", "snapshot_date"),
    "cost_bill_outstanding_monthly": ("billing_cycle", "account_id"),
    "finops_billing_fact": ("account_id", "dedup_key"),
    "finops_oss_sync_checkpoint": ("account_id",),
    "cost_cloud_bill_monthly_raw": ("billing_cycle", "account_id"),
    "cost_cloud_bill_daily_raw": ("bill_date", "account_id"),
    "cost_cloud_bill_aggregate": ("report_type", "period_key", "account_id", "metric_type"),
    "cost_env_account_config": ("environment",),
    "product_category_mapping": ("product_code",),
    "slo_daily_history": ("day", "slo_id"),
}

NOT_NULL: dict[str, tuple[str, ...]] = {
    "cost_cloud_bill_line_items": ("record_id", "bill_date", "billing_cycle", "cash_amount", "is_reversal", "account_id", "synced_at"),
    "cost_cloud_bill_month_status": ("billing_cycle", "account_id", "data_status"),
    "cost_bss_transactions": ("transaction_number", "account_id", "transaction_time", "amount"),
    "finops_billing_fact": ("billing_cycle", "usage_date", "account_id", "env", "item_code", "amount", "dedup_key"),
    "cost_cloud_bill_monthly_raw": ("billing_cycle", "total_amount", "product_breakdown", "cash_total_amount", "account_id"),
    "cost_cloud_bill_daily_raw": ("bill_date", "total_amount", "product_breakdown", "cash_total_amount", "account_id"),
    "cost_cloud_bill_aggregate": ("report_type", "period_key", "account_id", "metric_type", "total_amount", "data_status"),
}

MAX_LENGTH: dict[str, dict[str, int]] = {
    "cost_cloud_bill_line_items": {
        "record_id": 128, "billing_cycle": 32, "product_code": 64, "product_name": 128, "sub_order_id": 128,
        "instance_id": 128, "billing_item": 128, "subscription_type": 32, "currency": 8, "account_id": 64,
        "ingestion_channel": 32, "region": 32,
    },
    "finops_billing_fact": {
        "billing_cycle": 7, "account_alias": 256, "account_id": 64, "env": 32, "product_code": 128,
        "instance_id": 512, "item_code": 1024, "currency": 8, "source_object": 1024, "dedup_key": 128,
    },
    "cost_cloud_bill_monthly_raw": {"billing_cycle": 32, "account_id": 64, "region": 32},
}

# Stored precision of amounts the DDL declares narrower than our sums.
DECIMAL_BOUNDS: dict[str, dict[str, tuple[int, int]]] = {
    "cost_cloud_bill_monthly_raw": {"total_amount": (12, 6), "cash_total_amount": (12, 6)},
    "cost_cloud_bill_daily_raw": {"total_amount": (12, 6), "cash_total_amount": (12, 6)},
    "cost_cloud_bill_aggregate": {"total_amount": (12, 6)},
    "cost_cloud_bill_line_items": {"cash_amount": (14, 6), "pretax_amount": (14, 6)},
}
