"""Streaming queries of the catalog: each runs a Structured Streaming job over the
driver's ``events`` file (trigger availableNow) into the shared checkpoint folder,
then returns the compacted result as a DataFrame.  The events are in time order, so
no row is later than the watermark and the result equals the batch SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixed_values import LATE_LOOKBACK_DAYS as LOOKBACK_DAYS
from ..operators import rollup as ru
from ..streaming import jobs as sj
from .catalog import query
from .fixture_sql import with_ctes

_SVC = "'svc-' || CAST(user_id % 5 AS VARCHAR)"


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = fx.table(spark, sf, "events").schema
    return sj.event_stream(spark, sf, "events.parquet", schema)


@query(
    "stream_workload_hourly",
    ids=("ST4",),
    sql=with_ctes(
        "SELECT date_trunc('hour', ts) AS time_bucket, event_type AS namespace, "
        "'wl-' || CAST(user_id % 10 AS VARCHAR) AS workload_name, MAX(CAST(value AS DECIMAL(10,4))) AS max_cpu_usage, "
        "quantile_disc(CAST(value AS DECIMAL(10,4)), 0.95) AS p95_cpu_usage, "
        "CAST(SUM(CAST(value AS DECIMAL(10,4))) AS DOUBLE) / COUNT(*) AS avg_cpu_usage, COUNT(*) AS samples "
        "FROM ev GROUP BY 1, 2, 3",
        "ev",
    ),
)
def stream_workload_hourly(spark: SparkSession, sf: str) -> DataFrame:
    out, ckpt = sj.stream_dirs(spark, "workload")
    sj.stream_workload(fx.workload_samples(_events_stream(spark, sf)), out, ckpt)
    res = sj.current_state(spark, out, ["time_bucket", "namespace", "workload_name"])
    return res.withColumn("time_bucket", F.col("time_bucket").cast("timestamp_ntz"))


@query(
    "stream_error_counts",
    ids=("ST5",),
    sql=with_ctes(
        f"SELECT date_trunc('hour', ts) AS bucket_start, {_SVC} AS service, COUNT(*) AS errors FROM ev "
        "WHERE event_type = 'error' GROUP BY 1, 2",
        "ev",
    ),
)
def stream_error_counts(spark: SparkSession, sf: str) -> DataFrame:
    out, ckpt = sj.stream_dirs(spark, "errors")
    sj.stream_errors(fx.error_logs(_events_stream(spark, sf)), out, ckpt)
    res = sj.current_state(spark, out, ["bucket_start", "service"])
    return res.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))


@query(
    "stream_dedup_events",
    ids=("ST6",),
    sql="SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events",
)
def stream_dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every event delivered twice (two file streams over the same folder); the dedup
    keeps one copy of each."""
    out, ckpt = sj.stream_dirs(spark, "dedup")
    twice = _events_stream(spark, sf).unionByName(_events_stream(spark, sf))
    sj.stream_dedup(twice.select("event_id", "ts", "user_id", "event_type", "value"), ["event_id"], out, ckpt)
    res = spark.read.parquet(out).drop("batch_id")
    return res.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


LATE_AS_OF = fx.BILL_AS_OF


@query(
    "late_window_recompute",
    ids=("ST3",),
    sql=with_ctes(
        "SELECT bill_date, account_id, total_amount, cash_total_amount FROM daily_raw "
        f"WHERE bill_date >= CAST(DATE '{LATE_AS_OF}' - INTERVAL {LOOKBACK_DAYS + 1} DAY AS DATE) "
        f"AND bill_date <= CAST(DATE '{LATE_AS_OF}' - INTERVAL 1 DAY AS DATE)",
        "daily_raw",
    ),
)
def late_window_recompute(spark: SparkSession, sf: str) -> DataFrame:
    """ST3: re-aggregate only the touched daily slices: T-1 plus the look-back window."""
    items = fx.line_items(spark, sf)
    return ru.recompute_daily_window(items, LATE_AS_OF, LOOKBACK_DAYS).select(
        "bill_date", "account_id", "total_amount", "cash_total_amount"
    )


@query(
    "late_cycle_recompute",
    ids=("ST3",),
    sql=with_ctes(
        "SELECT billing_cycle, account_id, total_amount, cash_total_amount FROM monthly_raw "
        f"WHERE billing_cycle IN (strftime(DATE '{LATE_AS_OF}', '%Y-%m'), "
        f"strftime(DATE '{LATE_AS_OF}' - INTERVAL 1 MONTH, '%Y-%m'))",
        "monthly_raw",
    ),
)
def late_cycle_recompute(spark: SparkSession, sf: str) -> DataFrame:
    """ST3: re-aggregate the current and the previous cycle (pruned to two partitions)."""
    items = fx.line_items(spark, sf)
    return ru.recompute_cycles(items, LATE_AS_OF, fx.overview_items).select(
        "billing_cycle", "account_id", "total_amount", "cash_total_amount"
    )
