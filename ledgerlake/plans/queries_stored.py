"""Queries over stored tables: declared-schema scans, physical slice replacement, resets
with a rebuild, log retention, quarantined cycles, period headlines.

Each writes what it needs to a fresh folder under the shared checkpoint root, derived
from the whole driver tables, and reads it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import fixtures as fx
from ..operators import clean as cl
from ..operators import rollup as ru
from ..operators import upsert as up
from ..operators import views as vw
from ..session import checkpoint_root
from ..sources import feeds as fd
from .catalog import query
from .fixture_sql import with_ctes


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/stored/{name}-{uuid.uuid4().hex}"


@query(
    "stored_transactions_scan",
    ids=("SRC9", "SRC12"),
    sql=with_ctes(
        "SELECT transaction_number, account_id, transaction_flow, amount, record_id, billing_cycle FROM bss_tx", "bss_tx"
    ),
)
def stored_transactions_scan(spark: SparkSession, sf: str) -> DataFrame:
    """T7 written as a table and scanned with its declared schema."""
    path = _folder(spark, "transactions")
    fx.bss_transactions(spark, sf).write.parquet(path)
    t = fd.read_table(spark, path, "cost_bss_transactions")
    return t.select("transaction_number", "account_id", "transaction_flow", "amount", "record_id", "billing_cycle")


@query(
    "stored_balances_scan",
    ids=("SRC9", "SRC12", "WIN3"),
    sql=with_ctes(
        "SELECT account_id, CAST(transaction_time AS DATE) AS snapshot_date, MAX(amount) AS available_amount "
        "FROM bss_tx GROUP BY 1, 2",
        "bss_tx",
    ),
)
def stored_balances_scan(spark: SparkSession, sf: str) -> DataFrame:
    """T8 written as a table and scanned with its declared schema."""
    path = _folder(spark, "balances")
    fx.balance_snapshots(fx.bss_transactions(spark, sf)).write.parquet(path)
    return fd.read_table(spark, path, "cost_bss_balance_snapshot").select("account_id", "snapshot_date", "available_amount")


REPLACED, EMPTIED = ("1997-03", "1998-02"), "1996-05"


@query(
    "fact_slices_replaced_in_place",
    ids=("SNK7",),
    sql=with_ctes(
        "SELECT billing_cycle, COUNT(*) AS line_count, CAST(SUM(CASE WHEN billing_cycle IN "
        f"('{REPLACED[0]}', '{REPLACED[1]}') THEN pretax_amount ELSE amount END) AS DECIMAL(38,6)) AS amount "
        f"FROM fact_rows WHERE billing_cycle <> '{EMPTIED}' GROUP BY 1",
        "fact_rows",
    ),
)
def fact_slices_replaced_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """SNK7 physically: two cycles reloaded with pretax amounts, one reloaded with nothing."""
    path, items, env = _folder(spark, "fact"), fx.line_items(spark, sf), fx.environments(spark, sf)
    up.replace_slices(fx.fact_rows(items, env), path, ["billing_cycle"], dealt=True)  # as the line items are
    new = fx.fact_rows(items.filter(F.col("billing_cycle").isin(*REPLACED)), env, "pretax_amount")
    slices = spark.createDataFrame([(c,) for c in (*REPLACED, EMPTIED)], "billing_cycle string")
    up.replace_slices(new, path, ["billing_cycle"], slices, dealt=True)
    return spark.read.parquet(path).groupBy("billing_cycle").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("amount").cast("decimal(38,6)").alias("amount")
    )


MOVED_TO = "1999-01"


@query(
    "fact_merged_by_key_index",
    ids=("SNK5", "SNK6"),
    sql=with_ctes(
        f"SELECT CASE WHEN CAST(instance_id AS BIGINT) % 7 = 0 THEN '{MOVED_TO}' ELSE billing_cycle END AS billing_cycle, "
        "COUNT(*) AS line_count, COUNT(DISTINCT account_id || '|' || dedup_key) AS key_count, "
        "CAST(SUM(CASE WHEN CAST(instance_id AS BIGINT) % 7 = 0 THEN 2 * amount ELSE amount END) AS DECIMAL(38,6)) AS amount "
        "FROM fact_rows GROUP BY 1",
        "fact_rows",
    ),
)
def fact_merged_by_key_index(spark: SparkSession, sf: str) -> DataFrame:
    """A stored fact, then a batch in which every seventh order's lines come again, later, with
    twice the amount and in another cycle: each has one copy, where the batch puts it."""
    path = _folder(spark, "fact-merged")
    rows = fx.fact_rows(fx.line_items(spark, sf), fx.environments(spark, sf))
    keys, order = ["account_id", "dedup_key"], ["ingested_at"]
    up.upsert_into(rows, path, keys, order, "billing_cycle", f"{path}-first", dealt=True)
    again = rows.filter(F.col("instance_id").cast("long") % 7 == 0).withColumns({
        "billing_cycle": F.lit(MOVED_TO),
        "amount": (F.col("amount") * 2).cast(rows.schema["amount"].dataType),
        "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
    })
    up.upsert_into(again, path, keys, order, "billing_cycle", f"{path}-second")
    return spark.read.parquet(path).groupBy("billing_cycle").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_distinct("account_id", F.unhex("dedup_key")).alias("key_count"),  # hex: half as long as bytes
        F.sum("amount").cast("decimal(38,6)").alias("amount"),
    )


RESET_CYCLES = ("1998-01", "1998-02")


@query(
    "monthly_reset_and_rebuilt",
    ids=("SNK8", "ST3", "AGG8"),
    sql=with_ctes("SELECT billing_cycle, account_id, total_amount, cash_total_amount FROM monthly_raw", "monthly_raw"),
)
def monthly_reset_and_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """A stored monthly_raw with two wrong cycles: those slices are rebuilt from the line
    items and written back; the others stay as they are."""
    path, items = _folder(spark, "monthly"), fx.line_items(spark, sf)
    monthly = ru.monthly_totals(fx.overview_items(items))
    wrong = F.col("billing_cycle").isin(*RESET_CYCLES)
    spoiled = monthly.withColumn("total_amount", F.when(wrong, F.lit(0)).otherwise(F.col("total_amount")).cast("decimal(38,6)"))
    up.replace_slices(spoiled, path, ["billing_cycle"])
    rebuilt = ru.monthly_totals(fx.overview_items(items.filter(wrong)))
    slices = spark.createDataFrame([(c,) for c in RESET_CYCLES], "billing_cycle string")
    up.replace_slices(rebuilt, path, ["billing_cycle"], slices)
    return spark.read.parquet(path).select("billing_cycle", "account_id", "total_amount", "cash_total_amount")


LOGS_AS_OF = "2024-01-25"


@query(
    "logs_retained",
    ids=("SNK10", "SNK11", "SRC10"),
    sql=with_ctes(
        "SELECT 'logs_error' AS store, CAST(ts AS DATE) AS event_date, COUNT(*) AS row_count FROM ev "
        f"WHERE event_type = 'error' AND CAST(ts AS DATE) >= DATE '{LOGS_AS_OF}' - INTERVAL {fv.ERROR_LOG_TTL_DAYS} DAY "
        "GROUP BY 2 UNION ALL SELECT 'logs_sampled', CAST(ts AS DATE), COUNT(*) FROM ev "
        f"WHERE CAST(ts AS DATE) >= DATE '{LOGS_AS_OF}' - INTERVAL {fv.SAMPLED_LOG_TTL_DAYS} DAY GROUP BY 2",
        "ev",
    ),
)
def logs_retained(spark: SparkSession, sf: str) -> DataFrame:
    """Both log stores written by day, expired by their retention, counted by day."""
    ev = fx.events(spark, sf)
    out = None
    for name, rows, days in (
        ("logs_error", fx.error_logs(ev), fv.ERROR_LOG_TTL_DAYS),
        ("logs_sampled", fx.sampled_logs(ev), fv.SAMPLED_LOG_TTL_DAYS),
    ):
        path = _folder(spark, name)
        fd.write_logs(rows, path)
        kept, _ = up.expire(fd.read_logs(spark, path, name), "event_date", LOGS_AS_OF, days=days)
        counts = kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))
        counts = counts.select(F.lit(name).alias("store"), "event_date", "row_count")
        out = counts if out is None else out.unionByName(counts)
    return out


_RAW_CYCLE = (
    "CASE WHEN product_code LIKE 'PROMO%' THEN '{bad}' || billing_cycle "
    "WHEN subscription_type = 'PayAsYouGo' THEN {compact} ELSE billing_cycle END"
)


@query(
    "cycles_quarantined",
    ids=("PRJ6", "FLT10"),
    sql=with_ctes(
        "SELECT CASE WHEN product_code LIKE 'PROMO%' THEN 'P' || billing_cycle ELSE billing_cycle END AS billing_cycle, "
        "CASE WHEN product_code LIKE 'PROMO%' THEN 'cycle is not yyyy-MM' END AS reject_reason, "
        "COUNT(*) AS line_count, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS amount FROM line_items GROUP BY 1, 2",
        "line_items",
    ),
)
def cycles_quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """Compact cycles are normalised; those of PROMO products are spoiled and set aside."""
    raw = F.expr(_RAW_CYCLE.format(bad="P", compact="replace(billing_cycle, '-', '')"))
    good, bad = cl.split_cycles(fx.line_items(spark, sf).withColumn("billing_cycle", raw))
    both = good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)
    return both.groupBy("billing_cycle", "reject_reason").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("cash_amount").cast("decimal(38,6)").alias("amount")
    )


@query(
    "monthly_null_account_filled",
    ids=("PRJ3",),
    sql=with_ctes(
        "SELECT billing_cycle, COALESCE(NULLIF(account_id, 'ASIA'), '') AS account_id, total_amount FROM monthly_raw",
        "monthly_raw",
    ),
)
def monthly_null_account_filled(spark: SparkSession, sf: str) -> DataFrame:
    """One account's rows come without it (NULL), and get the empty account."""
    m = ru.monthly_totals(fx.overview_items(fx.line_items(spark, sf)))
    m = m.withColumn("account_id", F.nullif("account_id", F.lit("ASIA")))
    return cl.fill_empty_account(m).select("billing_cycle", "account_id", "total_amount")


DEFINED_SLOS = 3


@query(
    "slo_history_orphans",
    ids=("JN7",),
    sql=with_ctes(
        "SELECT CAST(ts AS DATE) AS day, CAST(user_id % 5 + 1 AS INTEGER) AS slo_id, COUNT(*) AS total FROM ev "
        f"WHERE user_id % 5 + 1 > {DEFINED_SLOS} GROUP BY 1, 2",
        "ev",
    ),
)
def slo_history_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """History of every service against the definitions of the first three only."""
    ev = fx.events(spark, sf)
    history = ev.groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 5 + 1).cast("int").alias("slo_id")).agg(
        F.count(F.lit(1)).alias("total")
    )
    return vw.orphans(history, fx.slo_definitions(ev).filter(F.col("id") <= DEFINED_SLOS), "slo_id", "id")


@query(
    "accounts_silent_on_day",
    ids=("JN9",),
    sql=with_ctes(
        "SELECT d.bill_date, e.account_id FROM (SELECT DISTINCT bill_date FROM daily_raw) d CROSS JOIN env_config e "
        "WHERE NOT EXISTS (SELECT 1 FROM daily_raw m WHERE m.account_id = e.account_id AND m.bill_date = d.bill_date)",
        "env_config", "daily_raw",
    ),
)
def accounts_silent_on_day(spark: SparkSession, sf: str) -> DataFrame:
    """For every booked day, the configured accounts without a bill row."""
    daily = ru.daily_totals(fx.line_items(spark, sf)).select("bill_date", "account_id")
    configured = fx.environments(spark, sf).agg(F.collect_set("account_id").alias("ids"))  # one row of configuration
    days = daily.select("bill_date").distinct()
    wanted = days.select("bill_date", F.explode(configured.scalar()).alias("account_id"))
    return wanted.join(daily, ["bill_date", "account_id"], "left_anti")


@query(
    "headline_by_period",
    ids=("AGG15", "AGG9"),
    sql=with_ctes(
        f"""
SELECT report_type, period_key, account_id,
       CAST(COALESCE(SUM(total_amount) FILTER (WHERE metric_type = '{fv.METRIC_CONSUMPTION}'), 0) AS DECIMAL(38,6))
         AS technical_amount,
       CAST(COALESCE(SUM(total_amount) FILTER (WHERE metric_type =
         CASE WHEN report_type = 'month' THEN '{fv.METRIC_CONSUMPTION}' ELSE '{fv.METRIC_PAYMENT}' END), 0)
         AS DECIMAL(38,6)) AS finance_amount
FROM period_agg GROUP BY 1, 2, 3
""",
        "period_agg",
    ),
)
def headline_by_period(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.line_items(spark, sf)
    agg = ru.period_aggregate(ru.daily_rollup(items), ru.monthly_rollup(fx.overview_items(items)))
    return vw.headline_by_period(agg)
