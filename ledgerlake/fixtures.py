"""Driver tables -> billing tables (FIXTURES.md section 2).

The driver ships TPC-H-like tables; the billing domain needs line items, API month
totals, BSS feeds, environment config and log/metric samples.  Each function below
derives one billing table from the driver tables with plain DataFrame operations, so
its work grows with the input.  ``plans/fixture_sql.py`` states the same derivations
in SQL for the DuckDB oracle; the two must stay in step.

Scale notes: the line-item base frame is ``lineitem ⋈ orders ⋈ customer ⋈ part`` plus
``nation ⋈ region``.  nation/region are fixed 25/5-row dimensions and are broadcast;
the other joins are shuffle joins on their keys and Catalyst/AQE choose the strategy.
The result is staged once per input (``session.stage``), partitioned by
``billing_cycle``, so every query after the first reads a pruned Parquet table.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixed_values import DEFAULT_CHANNEL, DEFAULT_CURRENCY, SEED_CATEGORIES
from .operators.rollup import daily_rollup, with_month
from .session import is_staged, spread_by, stage

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Fixed values of the fixture mapping (FIXTURES.md section 2).
REGION_ENVIRONMENT = {"AFRICA": "POC", "AMERICA": "UAT", "ASIA": "FAT", "EUROPE": "PROD"}
# API month total = line-item sum + offset; MIDDLE EAST has no API total (unknown).
API_TOTAL_OFFSET = {"AFRICA": "0.00", "AMERICA": "0.01", "ASIA": "0.02", "EUROPE": "-5.00"}
# Legacy empty-account rows: customers of every fifth nation carry account ''.
LEGACY_EMPTY_NATION_MOD = 5
# Default as-of dates for the bill tables and the event tables.
BILL_AS_OF = "1998-03-15"
EVENT_AS_OF = "2024-01-30"

MONEY = "decimal(14,6)"
# Bump when a staged derivation changes, so old staged copies are not reused.
FIXTURE_VERSION = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _paths(sf_dir: str, names) -> list[str]:
    return [os.path.join(sf_dir, f"{n}.parquet") for n in names]


def accounts(spark: SparkSession, sf_dir: str, legacy_empty: bool = False) -> DataFrame:
    """customer -> (c_custkey, account_id, region); account = region name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )
    acct = F.col("r_name")
    if legacy_empty:
        acct = F.when(F.col("n_nationkey") % LEGACY_EMPTY_NATION_MOD == 0, F.lit("")).otherwise(acct)
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey).select(
        "c_custkey", acct.alias("account_id"), F.col("n_name").alias("region")
    )


def _dec(c: str, t: str) -> Column:
    return F.col(c).cast(t)


def build_line_items(spark: SparkSession, sf_dir: str, legacy_empty: bool = False, deal: bool = False) -> DataFrame:
    """T5 cost_cloud_bill_line_items from lineitem ⋈ orders ⋈ customer ⋈ part (unstaged).

    ``deal``: dealt by cycle, for the partitioned write.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    acct = accounts(spark, sf_dir, legacy_empty)
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    price = _dec("l_extendedprice", "decimal(12,2)")
    disc = _dec("l_discount", "decimal(4,2)")
    tax = _dec("l_tax", "decimal(4,2)")
    # orders get their account first (orders-sized shuffle), so the lineitem-sized
    # side is shuffled only twice: on the order key, then on the part key
    orders_acct = orders.join(acct, orders.o_custkey == acct.c_custkey)
    base = li.join(orders_acct, li.l_orderkey == orders_acct.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    base = base.withColumn("billing_cycle", F.date_format("o_orderdate", "yyyy-MM"))
    if deal:  # before the texts made from the columns, which take up twice their room
        base = spread_by(base, ["billing_cycle"])
    return base.select(
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
        ).alias("record_id"),
        F.to_date("l_shipdate").alias("bill_date"),
        "billing_cycle",
        F.col("p_type").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("l_orderkey").cast("string").alias("sub_order_id"),
        F.col("p_brand").alias("instance_id"),
        F.col("l_linenumber").cast("string").alias("billing_item"),
        F.when(F.col("l_linestatus") == "O", "PayAsYouGo")
        .when(F.col("l_linestatus") == "F", "Subscription")
        .alias("subscription_type"),
        (sign * price * (F.lit(1) - disc)).cast(MONEY).alias("cash_amount"),
        (sign * price).cast(MONEY).alias("pretax_amount"),
        (sign * price * (F.lit(1) + tax)).cast(MONEY).alias("pretax_gross_amount"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        (F.col("l_returnflag") == "R").alias("is_reversal"),
        F.col("account_id"),
        F.lit(DEFAULT_CHANNEL).alias("ingestion_channel"),
        F.col("region"),
        F.lit(None).cast("string").alias("raw_payload"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("synced_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )


_LINE_ITEM_INPUTS = ("lineitem", "orders", "customer", "part", "nation", "region")


def _line_items_name(legacy_empty: bool = False) -> str:
    return ("line_items_legacy" if legacy_empty else "line_items") + f"_v{FIXTURE_VERSION}"


def line_items(spark: SparkSession, sf_dir: str, legacy_empty: bool = False) -> DataFrame:
    """Staged T5: written once per input under the checkpoint root, partitioned by cycle."""
    df = stage(
        spark,
        _line_items_name(legacy_empty),
        _paths(sf_dir, _LINE_ITEM_INPUTS),
        lambda: build_line_items(spark, sf_dir, legacy_empty, deal=True),
        partition_by=("billing_cycle",),
        sort_within=("account_id", "bill_date"),
        dealt=True,
    )
    return df.withColumn("billing_cycle", F.col("billing_cycle").cast("string"))


def line_items_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 for a job that reads it a single time: the staged table if it is there, else the
    rows as the joins give them, which are then neither dealt by cycle nor written."""
    if is_staged(spark, _line_items_name(), _paths(sf_dir, _LINE_ITEM_INPUTS)):
        return line_items(spark, sf_dir)
    return build_line_items(spark, sf_dir)


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged T13 (daily roll-up with breakdowns), partitioned by booking month ``bill_month``."""
    df = stage(
        spark, f"daily_raw_v{FIXTURE_VERSION}", _paths(sf_dir, _LINE_ITEM_INPUTS),
        lambda: with_month(daily_rollup(line_items(spark, sf_dir))),
        partition_by=("bill_month",), sort_within=("bill_date", "account_id"),
    )
    return df.withColumn("bill_month", F.col("bill_month").cast("string"))


def api_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged API month totals (what the provider would answer), one row per cycle and account."""
    return stage(
        spark, f"api_totals_v{FIXTURE_VERSION}", _paths(sf_dir, _LINE_ITEM_INPUTS),
        lambda: api_month_totals(line_items(spark, sf_dir), spark),
    )


def overview_items(items: DataFrame) -> DataFrame:
    """QueryBillOverview-style items (SRC7 shape) derived from line items.

    PaymentAmount is the tax-inclusive amount for PayAsYouGo rows and 0 for
    Subscription rows (prepaid), so the PRJ7 choice falls back to CashAmount for them.
    """
    return items.select(
        "billing_cycle",
        "account_id",
        F.col("product_code").alias("ProductCode"),
        F.col("subscription_type").alias("SubscriptionType"),
        F.col("pretax_amount").alias("PretaxAmount"),
        F.when(F.col("subscription_type") == "PayAsYouGo", F.col("pretax_gross_amount"))
        .otherwise(F.lit(0).cast(MONEY))
        .alias("PaymentAmount"),
        F.col("cash_amount").alias("CashAmount"),
        F.when(F.col("is_reversal"), "Adjustment").otherwise("Normal").alias("Item"),
    )


def api_month_totals(items: DataFrame, spark: SparkSession) -> DataFrame:
    """API month total per (cycle, account): line-item cash sum + fixed offset.

    Accounts without an offset entry (MIDDLE EAST) get no row: their total is unknown.
    The offsets are a 4-row literal table, broadcast.
    """
    offsets = spark.createDataFrame(
        [(k, v) for k, v in API_TOTAL_OFFSET.items()], "account_id string, offset string"
    ).select("account_id", F.col("offset").cast("decimal(6,2)").alias("offset"))
    sums = items.groupBy("billing_cycle", "account_id").agg(F.sum("cash_amount").alias("s"))
    return sums.join(F.broadcast(offsets), "account_id").select(
        "billing_cycle",
        "account_id",
        (F.col("s") + F.col("offset")).cast("decimal(24,6)").alias("monthly_api_total"),
    )


def api_cycle_totals(items: DataFrame) -> DataFrame:
    """API totals of all accounts in which cycles of every outcome occur.

    By the cycle's month: 1, 4, 7, 10 the line-item sum itself; 2, 5, 8, 11 five less for
    EUROPE; 3, 6, 9, 12 no total for MIDDLE EAST.
    """
    turn = F.substring("billing_cycle", 6, 2).cast("int") % 3
    sums = items.groupBy("billing_cycle", "account_id").agg(F.sum("cash_amount").alias("s"))
    less = F.when((turn == 2) & (F.col("account_id") == "EUROPE"), F.lit(5)).otherwise(F.lit(0))
    return sums.filter((turn != 0) | (F.col("account_id") != "MIDDLE EAST")).select(
        "billing_cycle", "account_id", (F.col("s") - less).cast("decimal(24,6)").alias("monthly_api_total")
    )


def environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T15 cost_env_account_config from the region table (MIDDLE EAST unmapped)."""
    mapping = spark.createDataFrame(
        list(REGION_ENVIRONMENT.items()), "r_name string, environment string"
    )
    region = table(spark, sf_dir, "region")
    return region.join(F.broadcast(mapping), "r_name").select(
        "environment",
        F.col("r_name").alias("account_id"),
        F.concat(F.col("environment"), F.lit(" "), F.initcap("r_name")).alias("display_name"),
        (F.col("r_regionkey") + 1).cast("int").alias("sort_order"),
    )


# Fixture additions: part types -> categories; PROMO goes through the prefix rule.
FIXTURE_CATEGORIES = [
    ("STANDARD", "compute"), ("ECONOMY", "compute"), ("MEDIUM", "storage"), ("LARGE", "network"),
]
PREFIX_RULES = {"PRO": "security"}


def category_mapping(spark: SparkSession) -> DataFrame:
    """T16 product_category_mapping: seed rows plus the fixture rows (config, 17 rows)."""
    return spark.createDataFrame(
        SEED_CATEGORIES + FIXTURE_CATEGORIES, "product_code string, category string"
    )


def bss_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 cost_bss_transactions from orders (one transaction per order)."""
    orders = table(spark, sf_dir, "orders")
    acct = accounts(spark, sf_dir)
    o = orders.join(acct, orders.o_custkey == acct.c_custkey)
    return o.select(
        F.concat(F.lit("T-"), F.col("o_orderkey").cast("string")).alias("transaction_number"),
        "account_id",
        F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_time"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.when(F.col("o_orderstatus") == "F", "Income").otherwise("Expense").alias("transaction_flow"),
        F.col("o_orderkey").cast("string").alias("record_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("billing_cycle"),
        F.lit("CNY").alias("currency"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("synced_at"),
        F.col("o_orderstatus"),
    )


def outstanding_monthly(tx: DataFrame) -> DataFrame:
    """T9 cost_bill_outstanding_monthly: open (O/P) orders summed by (cycle, account)."""
    return (
        tx.filter(F.col("o_orderstatus").isin("O", "P"))
        .groupBy("billing_cycle", "account_id")
        .agg(F.sum("amount").cast("decimal(24,6)").alias("outstanding_amount"))
    )


def balance_snapshots(tx: DataFrame) -> DataFrame:
    """T8 cost_bss_balance_snapshot: max order total per (account, order date)."""
    return tx.groupBy("account_id", F.to_date("transaction_time").alias("snapshot_date")).agg(
        F.max("amount").alias("available_amount")
    )


# ---------------------------------------------------------------- events-derived
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events with ``ts`` as a zoned timestamp (session zone UTC) for windows."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def service_of(user_id: Column) -> Column:
    return F.concat(F.lit("svc-"), (user_id % 5).cast("string"))


def workload_samples(ev: DataFrame) -> DataFrame:
    """CPU samples: namespace = event_type, workload = user_id % 10, cpu = value."""
    return ev.select(
        "ts",
        F.col("event_type").alias("namespace"),
        F.concat(F.lit("wl-"), (F.col("user_id") % 10).cast("string")).alias("workload_name"),
        F.col("value").cast("decimal(10,4)").alias("cpu_usage"),
    )


def error_logs(ev: DataFrame) -> DataFrame:
    """T22 logs_error rows: error events; service = svc-(user_id % 5)."""
    return ev.filter(F.col("event_type") == "error").select(
        F.col("ts").alias("timestamp"),
        service_of(F.col("user_id")).alias("service"),
        F.col("event_type").alias("namespace"),
        F.lit("ERROR").alias("level"),
        F.col("props").alias("message"),
    )


def sampled_logs(ev: DataFrame) -> DataFrame:
    """T23 logs_sampled rows: every event; latency = value ms, status 500 on errors."""
    return ev.select(
        F.col("ts").alias("timestamp"),
        service_of(F.col("user_id")).alias("service"),
        F.concat(F.lit("/"), F.col("event_type")).alias("path"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).cast("int").alias("status_code"),
        F.col("value").cast("decimal(10,2)").alias("latency_ms"),
    )


def fact_rows(
    items: DataFrame, env: DataFrame, amount: str = "cash_amount", with_record_id: bool = False
) -> DataFrame:
    """T10 ``finops_billing_fact`` rows (the OSS export path) from line items.

    tags_json carries the account's environment ({"env": ..}) when it is configured;
    env is read back from it (PRJ10), so unconfigured accounts are UNTAGGED.  The
    dedup key (PRJ9) is over (cycle, usage date, order, line, record id): a re-delivered
    line collides, distinct records do not.
    """
    from .functions.keys import dedup_key, env_tag

    tags = env.select(
        "account_id", F.concat(F.lit('{"env":"'), F.col("environment"), F.lit('"}')).alias("tags_json")
    )
    j = items.join(F.broadcast(tags), "account_id", "left")  # five rows of configuration: the items stay where they lie
    return j.select(
        "billing_cycle",
        F.col("bill_date").alias("usage_date"),
        F.col("region").alias("account_alias"),
        "account_id",
        env_tag("tags_json").alias("env"),
        "product_code",
        F.col("sub_order_id").alias("instance_id"),
        F.col("billing_item").alias("item_code"),
        F.col(amount).cast("decimal(18,6)").alias("amount"),
        "currency",
        "tags_json",
        F.concat(F.lit("billing-data/"), F.col("account_id"), F.lit("/"), F.col("billing_cycle"), F.lit(".csv")).alias(
            "source_object"
        ),
        dedup_key("billing_cycle", "bill_date", "sub_order_id", "billing_item", "record_id").alias("dedup_key"),
        F.col("synced_at").alias("ingested_at"),
        *(["record_id"] if with_record_id else []),
    )


def activity_of(props: Column) -> Column:
    """Evidence/activity score of an event: the ``k`` member of its JSON props."""
    return F.get_json_object(props, "$.k").cast("int")


def pod_samples(ev: DataFrame) -> DataFrame:
    """Pod cost samples: namespace = event_type, pod = user, cost = value, activity = k."""
    return ev.select(
        "ts",
        F.col("event_type").alias("namespace"),
        F.concat(F.lit("pod-"), F.col("user_id").cast("string")).alias("pod"),
        F.col("value").cast("decimal(10,2)").alias("cost"),
        activity_of(F.col("props")).alias("activity"),
    )


def roi_events(ev: DataFrame) -> DataFrame:
    """T3 cost_roi_events: purchase events; savings = value."""
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("ts").alias("event_time"),
        service_of(F.col("user_id")).alias("namespace"),
        F.col("event_type"),
        F.col("value").cast("decimal(10,2)").alias("savings_amount"),
    )


# Ours: availability target of every derived SLO.
SLO_TARGET = "0.8000"


def slo_requests(ev: DataFrame) -> DataFrame:
    """Requests per service: an event is good unless it is an error."""
    return ev.select("ts", service_of(F.col("user_id")).alias("service_name"), (F.col("event_type") != "error").alias("good"))


def slo_definitions(ev: DataFrame) -> DataFrame:
    """T17 slo_definitions: one SLO per service seen in the events (id = service + 1)."""
    return ev.select((F.col("user_id") % 5 + 1).cast("int").alias("id"), service_of(F.col("user_id")).alias("service_name")).distinct().select(
        "id", "service_name", F.lit(SLO_TARGET).cast("decimal(5,4)").alias("target_slo"),
        F.lit("30d").alias("time_window"), F.lit("alert").alias("error_budget_policy"),
    )


def risks(ev: DataFrame) -> DataFrame:
    """T21 prevention_risks: every event as a risk; severity from its k score."""
    from .operators.ops_metrics import severity_of

    k = activity_of(F.col("props"))
    return ev.select(
        F.col("ts").alias("detected_at"),
        service_of(F.col("user_id")).alias("namespace"),
        F.col("event_type").alias("risk_type"),
        severity_of(k).alias("severity"),
        F.when(k % 2 == 0, "open").otherwise("resolved").alias("status"),
        F.col("props").alias("evidence_metrics"),
    )


def incidents(ev: DataFrame) -> DataFrame:
    """T20 rca_incidents: one per error event; root cause by its k score (ours)."""
    k = activity_of(F.col("props"))
    return ev.filter(F.col("event_type") == "error").select(
        F.col("ts").alias("incident_time"),
        service_of(F.col("user_id")).alias("service_name"),
        F.col("props").alias("snapshot_data"),
        F.when(k >= 70, "capacity").when(k >= 40, "dependency").otherwise("config").alias("root_cause_type"),
        F.when(k % 3 == 0, "resolved").otherwise("open").alias("status"),
    )


def sync_jobs(ev: DataFrame) -> DataFrame:
    """T19 finops_sync_job: one job per event day; failed when an error scored >= 95."""
    k = activity_of(F.col("props"))
    return ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("completed_at"),
        F.max(F.when((F.col("event_type") == "error") & (k >= 95), F.lit(1)).otherwise(F.lit(0))).alias("_failed"),
        F.count_if(F.col("event_type") != "error").cast("int").alias("progress_current"),
        F.count(F.lit(1)).cast("int").alias("progress_total"),
    ).select(
        "day", F.when(F.col("_failed") == 1, "failed").otherwise("succeeded").alias("status"),
        "started_at", "completed_at", "progress_current", "progress_total",
    )
