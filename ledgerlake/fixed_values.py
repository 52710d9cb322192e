"""Constants that must equal the reference's for right results.

Everything here is taken as stated by the reference (SQL, DDL, tool, docs); the rest
of the package imports these names instead of repeating the literals.
"""

from __future__ import annotations

# --- fixed values ------------------------------------------------------------------

# Reconciliation
RECONCILE_TOLERANCE = "0.01"  # |drift| <= 0.01 passes (inclusive)
CALIBRATION_PRODUCT = "系统校准"  # breakdown key of a calibration row
STATUS_PRELIMINARY = "PRELIMINARY"
STATUS_DIRTY = "DIRTY"
STATUS_FINALIZED = "FINALIZED"
RECONCILE_MODES = ("trigger-worker", "patch", "report-only")  # the tool's --mode choices

# Metrics and report types of the aggregate table
METRIC_CONSUMPTION = "consumption"  # PretaxAmount
METRIC_PAYMENT = "payment"  # CashAmount
REPORT_TYPES = ("1d", "this_week", "month", "last_month", "quarter", "this_year", "last_year")

# Column defaults of the DDL
DEFAULT_CURRENCY = "CNY"
DEFAULT_CHANNEL = "api_query_account_bill"
DEFAULT_ENV = "UNTAGGED"
LEGACY_ACCOUNT = "POC"

# Limits and retention
MAX_CUSTOM_RANGE_MONTHS = 60
HISTORY_MONTHS = 60
ERROR_LOG_TTL_DAYS = 14
SAMPLED_LOG_TTL_DAYS = 3
LATE_LOOKBACK_DAYS = 7

# Seeded environments: (environment, account_id, display_name, sort_order)
SEED_ENVIRONMENTS = [
    ("POC", "POC", "POC 演示账号", 1),
    ("UAT", "UAT", "UAT 中国站", 2),
    ("FAT", "FAT", "FAT 测试", 3),
    ("PROD", "PROD", "PROD 生产", 4),
]

# Seeded product-code -> category rows
SEED_CATEGORIES = [
    ("ECS", "compute"), ("ACK", "compute"), ("CS", "compute"), ("ecs_workflow", "compute"),
    ("OSS", "storage"), ("NAS", "storage"), ("DISK", "storage"),
    ("CDN", "network"), ("SLB", "network"), ("VPC", "network"), ("EIP", "network"),
    ("CDT", "other"), ("SFM", "other"),
]

# Export header names (grouped "group/field" headers of the bill-detail CSV)
HEADER_BILLING_CYCLE = "账单信息/账单月份"
HEADER_BILLING_DATE = "账单信息/账单日期"
HEADER_CONSUME_TIME = "账单信息/消费时间"
HEADER_PRODUCT_CODE = "产品信息/产品Code"
HEADER_PRODUCT_NAME = "产品信息/产品名称"
HEADER_BILLING_ITEM = "产品信息/计费项名称"
HEADER_INSTANCE_ID = "资源信息/实例ID（出账粒度）"
HEADER_AMOUNT = "应付信息/应付金额（含税）"

# Substrings by which export columns are found, in order of preference: the field of the
# grouped header (no parenthetical note), then the English name of the JSON form
EXPORT_FIELDS = {
    "billing_cycle": ["账单月份", "BillingCycle"],
    "usage_date": ["账单日期", "BillingDate"],
    "consume_time": ["消费时间", "UsageTime"],
    "product_code": ["产品Code", "ProductCode"],
    "product_name": ["产品名称", "ProductName"],
    "item_code": ["计费项名称", "BillingItem"],
    "instance_id": ["实例ID", "InstanceID"],
    "amount": ["应付金额", "PretaxAmount"],
}

# --- end of fixed values -------------------------------------------------------------
