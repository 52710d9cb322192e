"""Queries of whole runs and reports: parts to the cent, ordered listings, incremental
ingest with marks, dropped partitions, quantiles from stored sketches, JSON evidence."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import fixtures as fx
from ..operators import clean as cl
from ..operators import ingest as ig
from ..operators import ops_metrics as om
from ..operators import ordering as od
from ..operators import quality as qa
from ..operators import retention as rt
from ..operators import rollup as ru
from ..operators import upsert as up
from ..operators import views as vw
from ..schemas import DEFAULTS, DECIMAL_BOUNDS, MAX_LENGTH, NOT_NULL, SCHEMAS
from ..session import checkpoint_root, short_shuffles
from ..sources import feeds as fd
from . import queries_billing as qb
from . import queries_files as qf
from .catalog import query
from .fixture_sql import with_ctes


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/runs/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ parts to the cent
@query(
    "category_apportioned",
    ids=("AGG10",),
    sql=with_ctes(
        f"""
SELECT * FROM (WITH c AS (
  SELECT li.billing_cycle, {qb._CATEGORY_SQL} AS category, CAST(SUM(li.cash_amount) AS DECIMAL(38,6)) AS cost
  FROM line_items li LEFT JOIN category_map cm ON li.product_code = cm.product_code GROUP BY 1, 2
),
t AS (SELECT billing_cycle, CAST(ROUND(SUM(total_amount), 2) AS DECIMAL(38,2)) AS total FROM monthly_raw GROUP BY 1),
j AS (
  SELECT c.*, t.total, CAST(t.total * 100 AS HUGEINT) AS units, CAST(c.cost * 1000000 AS HUGEINT) AS w,
         CAST(SUM(c.cost) OVER (PARTITION BY c.billing_cycle) * 1000000 AS HUGEINT) AS whole
  FROM c JOIN t USING (billing_cycle)
),
r AS (
  SELECT *, units * w * sign(whole)::HUGEINT AS share, abs(whole) AS weight FROM j WHERE whole <> 0
),
f AS (SELECT *, ((share % weight) + weight) % weight AS rest FROM r),
g AS (SELECT *, (share - rest) // weight AS units_down FROM f),
k AS (
  SELECT *, row_number() OVER (PARTITION BY billing_cycle ORDER BY rest DESC, category) AS k,
         units - SUM(units_down) OVER (PARTITION BY billing_cycle) AS missing FROM g
)
SELECT billing_cycle, category, cost, total,
       CAST(CAST(units_down + CASE WHEN k <= missing THEN 1 ELSE 0 END AS DECIMAL(36,0)) / 100 AS DECIMAL(38,2)) AS part
FROM k
UNION ALL SELECT billing_cycle, category, cost, total, CAST(ROUND(cost, 2) AS DECIMAL(38,2)) FROM j WHERE whole = 0) x
""",
        "line_items", "category_map", "monthly_raw",
    ),
)
def category_apportioned(spark: SparkSession, sf: str) -> DataFrame:
    """Each cycle's consumption total shared among its categories by their cash, to the cent."""
    totals = qb._monthly_totals(spark, sf).groupBy("billing_cycle").agg(F.sum("total_amount").alias("total"))
    return vw.apportioned(qb._category_parts(spark, sf), totals, ["billing_cycle"])


# ------------------------------------------------------------------ ordered listings
@query(
    "daily_recent_ordered",
    ids=("SRT2", "Q9"),
    sql=with_ctes(
        "SELECT bill_date, account_id, total_amount, row_number() OVER (ORDER BY bill_date DESC NULLS FIRST, "
        "account_id NULLS LAST, total_amount) AS position FROM ("
        f"SELECT CASE WHEN bill_date >= DATE '{qb.AS_OF}' THEN bill_date END AS bill_date, "
        "NULLIF(account_id, 'ASIA') AS account_id, CAST(ROUND(total_amount, 2) AS DECIMAL(35,2)) AS total_amount "
        f"FROM daily_raw WHERE bill_date >= CAST(DATE '{qb.AS_OF}' - INTERVAL 30 DAY AS DATE)) t",
        "daily_raw",
    ),
)
def daily_recent_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The recent daily rows, newest first, with their places; NULL dates come first, NULL accounts last."""
    recent = qb.dg.daily_recent(qb._daily_totals(spark, sf), qb.AS_OF)
    rows = recent.select(
        F.when(F.col("bill_date") >= F.lit(qb.AS_OF).cast("date"), F.col("bill_date")).alias("bill_date"),
        F.nullif("account_id", F.lit("ASIA")).alias("account_id"),
        "total_amount",
    )
    return od.with_position(
        rows, [F.col("bill_date").desc_nulls_first(), F.col("account_id").asc_nulls_last(), F.col("total_amount").asc()]
    )


@query(
    "prior_cycle_detail_ordered",
    ids=("SRT1", "AGG4"),
    sql=with_ctes(
        "SELECT account_id, billing_cycle, record_id, row_number() OVER (ORDER BY account_id, billing_cycle, record_id) AS position "
        "FROM line_items " + qb._FLT4,
        "line_items",
    ),
)
def prior_cycle_detail_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of prior cycles booked in the as-of month, in ascending order over three keys."""
    rows = qb.dg.prior_cycle_rows(fx.line_items(spark, sf), qb.AS_OF).select("account_id", "billing_cycle", "record_id")
    return od.with_position(rows, [F.col(c).asc_nulls_last() for c in ("account_id", "billing_cycle", "record_id")])


# ------------------------------------------------------------------ ingest in runs
class _Lost(Exception):
    """A run that ends before its marks are written."""


@query(
    "exports_ingested_in_runs",
    ids=("SRC6", "JN4", "SNK12", "SNK6"),
    sql=with_ctes(
        "SELECT account_id, billing_cycle, COUNT(*) AS line_count, CAST(SUM(CASE WHEN account_id = 'AFRICA' AND "
        "subscription_type = 'Subscription' THEN 2 ELSE 1 END * cash_amount) AS DECIMAL(38,6)) AS amount "
        "FROM line_items GROUP BY 1, 2",
        "line_items",
    ),
)
def exports_ingested_in_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals.  The run over the first is lost before its marks, and done again; the
    second brings other files and one account's files rewritten in place with other amounts."""
    root, fact, marks = (_folder(spark, n) for n in ("exports", "fact", "marks"))
    rows, prefixes = qf._export_rows(fx.line_items_once(spark, sf)), qf._prefixes(spark, sf)

    def land(some: DataFrame, cols) -> None:
        # one folder for each account; a folder landed again is written anew
        layout = some.select("account_id", *[F.col(c).alias(h) for h, c in cols])
        with short_shuffles(spark):
            layout.write.mode("overwrite").option("header", True).option("compression", "gzip").partitionBy("account_id").csv(
                f"{root}/{cols[0][1]}")

    def run(**how) -> None:
        ig.ingest_changed(spark, root, prefixes, fact, marks, glob="*.csv.gz", **how)

    def lose() -> None:
        raise _Lost

    first, second = (rows.filter(F.col("subscription_type") == k) for k in ("Subscription", "PayAsYouGo"))
    land(first, qf.LAYOUT_A)
    try:
        run(before_marks=lose)
    except _Lost:
        run()
    land(second, qf.LAYOUT_B)
    twice = (F.col("amount_s").cast("decimal(14,6)") * 2).cast("decimal(14,6)").cast("string")
    land(first.filter("account_id = 'AFRICA'").withColumn("amount_s", twice), qf.LAYOUT_A)
    run()
    return spark.read.parquet(fact).groupBy("account_id", F.col("billing_cycle").cast("string").alias("billing_cycle")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("amount").cast("decimal(38,6)").alias("amount")
    )


# ------------------------------------------------------------------ dropped partitions
_DROP_AS_OF, _MONTHS_AS_OF = "2024-01-25", "2001-10-15"


@query(
    "expired_partitions_dropped",
    ids=("SNK10", "SNK11"),
    sql=with_ctes(
        "SELECT 'logs_error' AS store, CAST(CAST(ts AS DATE) AS VARCHAR) AS part, COUNT(*) AS row_count FROM ev "
        f"WHERE event_type = 'error' AND CAST(ts AS DATE) >= DATE '{_DROP_AS_OF}' - INTERVAL {fv.ERROR_LOG_TTL_DAYS} DAY "
        "GROUP BY 2 UNION ALL SELECT 'logs_sampled', CAST(CAST(ts AS DATE) AS VARCHAR), COUNT(*) FROM ev "
        f"WHERE CAST(ts AS DATE) >= DATE '{_DROP_AS_OF}' - INTERVAL {fv.SAMPLED_LOG_TTL_DAYS} DAY GROUP BY 2 "
        "UNION ALL SELECT 'monthly_raw', billing_cycle, COUNT(*) FROM monthly_raw "
        f"WHERE billing_cycle >= strftime(DATE '{_MONTHS_AS_OF}' - INTERVAL {fv.HISTORY_MONTHS} MONTH, '%Y-%m') GROUP BY 2",
        "ev", "monthly_raw",
    ),
)
def expired_partitions_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Both log stores and monthly_raw stored by partition, what has expired dropped, the folders counted."""
    ev, out = fx.events(spark, sf), None
    monthly = ru.monthly_totals(fx.overview_items(fx.line_items(spark, sf)))
    for name, column, rows, how in (
        ("logs_error", "event_date", fx.error_logs(ev), {"as_of": _DROP_AS_OF, "days": fv.ERROR_LOG_TTL_DAYS}),
        ("logs_sampled", "event_date", fx.sampled_logs(ev), {"as_of": _DROP_AS_OF, "days": fv.SAMPLED_LOG_TTL_DAYS}),
        ("monthly_raw", "billing_cycle", monthly, {"as_of": _MONTHS_AS_OF, "months": fv.HISTORY_MONTHS}),
    ):
        path = _folder(spark, name)
        if column == "event_date":
            fd.write_logs(rows, path)
            schema = rows.withColumn(column, F.to_date("timestamp")).schema
        else:
            up.replace_slices(rows, path, [column])
            schema = rows.schema
        rt.drop_expired(spark, path, rt.register(spark, path, schema, column), column, **how)
        left = spark.read.schema(schema).parquet(path).groupBy(F.col(column).cast("string").alias("part"))
        counts = left.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("store"), "part", "row_count")
        out = counts if out is None else out.unionByName(counts)
    return out


# ------------------------------------------------------------------ quantiles from sketches
@query(
    "latency_from_sketches",
    ids=("AGG21", "AGG17"),
    sql=with_ctes(
        "SELECT CAST(ts AS DATE) AS day, 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service, COUNT(*) AS n, "
        "true AS p50_within, true AS p95_within, true AS p99_within FROM ev WHERE value IS NOT NULL GROUP BY 1, 2",
        "ev",
    ),
)
def latency_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Daily latency quantiles from hourly sketches stored once; each held against its rank in the logs."""
    logs = fx.sampled_logs(fx.events(spark, sf))
    path = _folder(spark, "sketches")
    om.latency_sketches(logs).write.parquet(path)
    merged = om.merged_quantiles(spark.read.parquet(path), ("service",))
    ranks = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    seen = logs.filter("latency_ms IS NOT NULL").select(F.to_date("timestamp").alias("day"), "service", F.col("latency_ms").cast("double").alias("v"))
    held = seen.join(merged, ["day", "service"]).groupBy("day", "service", "n").agg(
        *[F.count_if(F.col("v") < F.col(c)).alias(f"{c}_below") for c in ranks],
        *[F.count_if(F.col("v") <= F.col(c)).alias(f"{c}_upto") for c in ranks],
    )
    # the rank asked for lies between those of the value's first and last copy, but for the error
    within = [
        (
            (F.col(f"{c}_below") <= (q + 2 * om.RANK_ERROR) * F.col("n") + 1) & (F.col(f"{c}_upto") >= (q - 2 * om.RANK_ERROR) * F.col("n") - 1)
        ).alias(f"{c}_within")
        for c, q in ranks.items()
    ]
    return held.select("day", "service", "n", *within)


# ------------------------------------------------------------------ JSON evidence
_EVIDENCE = (
    "CASE WHEN k IS NULL THEN NULL WHEN k % 10 = 0 THEN '{\"metrics\":{\"band\":' "
    "WHEN k % 10 = 1 THEN '{\"metrics\":{\"load\":' || CAST(k AS {text}) || '}}' "
    "WHEN k % 10 = 2 THEN '[' || CAST(k AS {text}) || ']' "
    "ELSE '{\"metrics\":{\"band\":\"b' || CAST(k % 7 AS {text}) || '\",\"load\":' || CAST(k AS {text}) || '},\"pods\":[1,2]}' END"
)


@query(
    "incident_evidence",
    ids=("AGG23",),
    sql=with_ctes(
        "SELECT event_type AS kind, CASE WHEN json_valid(j) THEN json_extract_string(j, '$.metrics.band') END AS field, "
        "j IS NOT NULL AND NOT json_valid(j) AS bad_json, COUNT(*) AS n FROM (SELECT event_type, "
        + _EVIDENCE.replace("{text}", "VARCHAR")
        + " AS j FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM ev) a) b GROUP BY 1, 2, 3",
        "ev",
    ),
)
def incident_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence documents of several shapes counted by a nested field; broken ones apart."""
    ev = fx.events(spark, sf).withColumn("k", fx.activity_of(F.col("props")))
    docs = ev.select(F.col("event_type").alias("kind"), F.expr(_EVIDENCE.replace("{text}", "STRING")).alias("j"))
    return om.evidence_counts(docs, "j", "$.metrics.band", ("kind",))


# ------------------------------------------------------------------ rules checked in the write
_SEEDED = {
    "account_id": ("CAST(sub_order_id AS BIGINT) % 97 = 0", "NULL"),
    "synced_at": ("CAST(sub_order_id AS BIGINT) % 83 = 0", "NULL"),
    "region": ("CAST(sub_order_id AS BIGINT) % 89 = 0", "repeat('x', 33)"),
    "billing_cycle": ("CAST(sub_order_id AS BIGINT) % 79 = 0", "repeat('9', 33)"),
}
_DEFINED_SLOS = 3
_HISTORY = (
    "SELECT CAST(ts AS DATE) AS day, CAST(user_id % 5 + 1 AS INTEGER) AS slo_id FROM ev GROUP BY 1, 2"
)


def _checks_sql() -> str:
    table = "cost_cloud_bill_line_items"
    columns = [
        "record_id", "bill_date", "billing_cycle", "product_code", "product_name", "sub_order_id", "instance_id",
        "billing_item", "subscription_type", "cash_amount", "pretax_amount", "pretax_gross_amount", "currency",
        "is_reversal", "account_id", "ingestion_channel", "region", "synced_at",
    ]
    seeded = ", ".join(
        f"CASE WHEN {_SEEDED[c][0]} THEN {_SEEDED[c][1]} ELSE {c} END AS {c}" if c in _SEEDED else c for c in columns
    )
    rules = [("not_null", c, f"{c} IS NULL") for c in NOT_NULL[table]]
    rules += [("max_length", c, f"length({c}) > {n}") for c, n in MAX_LENGTH[table].items()]
    rules += [("decimal_overflow", c, f"abs({c}) >= {10 ** (p - s)}") for c, (p, s) in DECIMAL_BOUNDS[table].items()]
    parts = [
        f"SELECT '{table}' AS table_name, '{r}' AS rule, '{c}' AS column_name, COUNT(*) FILTER (WHERE {cond}) AS violations "
        f"FROM (SELECT {seeded} FROM line_items) s"
        for r, c, cond in rules
    ]
    parts.append(
        "SELECT 'slo_daily_history', 'foreign_key', 'slo_id', COUNT(*) FROM ("
        f"{_HISTORY}) h WHERE slo_id > {_DEFINED_SLOS}"
    )
    return with_ctes(" UNION ALL ".join(parts), "line_items", "ev")


@query("rules_checked_in_the_write", ids=("Q6",), sql=_checks_sql())
def rules_checked_in_the_write(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with seeded faults, counted by the job that writes them; history rows
    whose SLO is not defined."""
    items = fx.line_items(spark, sf)
    for c, (cond, value) in _SEEDED.items():
        items = items.withColumn(c, F.when(F.expr(cond), F.expr(value).cast(items.schema[c].dataType)).otherwise(F.col(c)))
    report = qa.write_checked(items, "cost_cloud_bill_line_items", _folder(spark, "checked"))
    ev = fx.events(spark, sf)
    history = ev.select(F.to_date("ts").alias("day"), (F.col("user_id") % 5 + 1).cast("int").alias("slo_id")).distinct()
    defined = fx.slo_definitions(ev).filter(F.col("id") <= _DEFINED_SLOS)
    return report.unionByName(qa.foreign_key(history, "slo_daily_history", "slo_id", defined, "id"))


# ------------------------------------------------------------------ declared tables
def _control_plane(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The eight tables that a deployment probes before it opens, from the driver tables."""
    ev = fx.events(spark, sf)
    summary = ru.bill_summary(fx.daily_raw(spark, sf))
    return {
        "cost_daily_namespace": om.namespace_daily(fx.pod_samples(ev)),
        "cost_hourly_workload": om.workload_hourly(fx.workload_samples(ev)),
        "cost_roi_events": fx.roi_events(ev),
        "cost_cloud_bill_summary": summary.withColumn("product_breakdown", F.to_json("product_breakdown")),
        "slo_definitions": fx.slo_definitions(ev),
        "slo_daily_history": om.slo_daily(fx.slo_requests(ev), fx.slo_definitions(ev)),
        "rca_incidents": fx.incidents(ev),
        "prevention_risks": fx.risks(ev),
    }


_EACH_TABLE = {
    "cost_daily_namespace": "SELECT DISTINCT CAST(ts AS DATE), event_type FROM ev",
    "cost_hourly_workload": "SELECT DISTINCT date_trunc('hour', ts), event_type, user_id % 10 FROM ev",
    "cost_roi_events": "SELECT 1 FROM ev WHERE event_type = 'purchase'",
    "cost_cloud_bill_summary": "SELECT DISTINCT bill_date FROM daily_raw",
    "slo_definitions": "SELECT DISTINCT user_id % 5 FROM ev",
    "slo_daily_history": "SELECT DISTINCT CAST(ts AS DATE), user_id % 5 FROM ev",
    "rca_incidents": "SELECT 1 FROM ev WHERE event_type = 'error'",
    "prevention_risks": "SELECT 1 FROM ev",
}


@query(
    "control_plane_ready",
    ids=("Q7", "SRC12", "LIM1"),
    sql=with_ctes(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, true AS readable, COUNT(*) > 0 AS has_rows, COUNT(*) AS row_count, "
            f"{len(SCHEMAS[t].fields)} AS column_count FROM ({q}) t{k}"
            for k, (t, q) in enumerate(_EACH_TABLE.items())
        ),
        "ev", "daily_raw",
    ),
)
def control_plane_ready(spark: SparkSession, sf: str) -> DataFrame:
    """The eight tables stored with their declared schemas, probed, and scanned by these schemas."""
    paths = {}
    for name, rows in _control_plane(spark, sf).items():
        paths[name] = _folder(spark, name)
        cl.conform(rows, SCHEMAS[name], DEFAULTS.get(name, {})).write.parquet(paths[name])
    counts = None
    for name, path in paths.items():
        table = fd.read_table(spark, path, name)
        one = table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(table.columns)).alias("column_count")
        )
        counts = one if counts is None else counts.unionByName(one)
    return qa.readiness(spark, paths).join(counts, "table_name")
