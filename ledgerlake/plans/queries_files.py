"""File round-trip queries: landed exports, feeds and log folders written by Spark
from the driver tables, then read back by the package's readers.

The writers stand in for the cloud side (bill-detail export to object storage, API
responses landed as JSON, the log shipper); every file is derived from the driver
tables, so the readers are exercised on data that grows with them.  Files land once
per input under the shared checkpoint folder (``session.land``).
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.breakdown import AMOUNT, conform_breakdown, flatten_breakdown
from ..operators import clean as cl
from ..operators import reconcile as rc
from ..operators import rollup as ru
from ..schemas import DEFAULTS, SCHEMAS
from ..session import land
from ..sources import exports as ex
from ..sources import feeds as fd
from ..streaming import jobs as sj
from .catalog import query
from .fixture_sql import with_ctes

_LI_INPUTS = ("lineitem", "orders", "customer", "part", "nation", "region")


def _inputs(sf: str, names=_LI_INPUTS) -> list[str]:
    return [os.path.join(sf, f"{n}.parquet") for n in names]


# Export column layouts (fixed values: the export's grouped header names).
LAYOUT_A = [
    ("账单信息/账单月份", "billing_cycle"), ("账单信息/账单日期", "bill_date_s"), ("账单信息/消费时间", "consume_s"),
    ("产品信息/产品Code", "product_code"), ("产品信息/产品名称", "product_name"), ("产品信息/计费项名称", "billing_item"),
    ("资源信息/实例ID（出账粒度）", "sub_order_id"), ("应付信息/应付金额（含税）", "amount_s"), ("账单信息/明细ID", "record_id"),
]
LAYOUT_B = [
    ("应付信息/应付金额（含税）", "amount_s"), ("资源信息/实例ID（出账粒度）", "sub_order_id"),
    ("产品信息/产品Code", "product_code"), ("账单信息/账单日期", "bill_date_s"), ("账单信息/账单月份", "cycle_compact"),
    ("账单信息/消费时间", "consume_s"), ("产品信息/计费项名称", "billing_item"), ("其它/备注", "note"),
    ("账单信息/明细ID", "record_id"),
]


# The landed files, and the zero-byte placeholder, which has no rows to compress.
EXPORT_GLOB = "*.{csv,csv.gz}"


def _export_rows(items: DataFrame) -> DataFrame:
    return items.select(
        "account_id", "billing_cycle", "subscription_type", "product_code", "product_name", "billing_item",
        "sub_order_id",
        "record_id",
        F.xxhash64("record_id").alias("spread"),
        F.date_format("bill_date", "yyyy-MM-dd").alias("bill_date_s"),
        F.date_format("synced_at", "yyyy-MM-dd HH:mm:ss").alias("consume_s"),
        F.date_format(F.to_date(F.concat("billing_cycle", F.lit("-01"))), "yyyyMM").alias("cycle_compact"),
        F.col("cash_amount").cast("string").alias("amount_s"),
        F.lit("n/a").alias("note"),
    )


def landed_exports(spark: SparkSession, sf: str) -> str:
    """CSV exports per account folder: Subscription rows in layout A, PayAsYouGo rows
    in layout B (other column order, compact cycle, an unknown column, no name), plus
    one zero-byte placeholder object (SRC3: skipped without affecting the rest).

    Each task writes its files, one for each account, compressed.  A layout holds half of the
    lines, so without staged line items the joins give each line once."""

    def write(path: str) -> None:
        rows = _export_rows(fx.line_items_once(spark, sf))
        for layout, cols, kind in (("a", LAYOUT_A, "Subscription"), ("b", LAYOUT_B, "PayAsYouGo")):
            (
                rows.filter(F.col("subscription_type") == kind)
                .select("account_id", *[F.col(c).alias(h) for h, c in cols])
                .write.mode("overwrite").option("header", True).option("compression", "gzip").partitionBy("account_id")
                .csv(f"{path}/layout={layout}")
            )
        # a zero-byte placeholder object (an empty frame writes one empty part file)
        spark.createDataFrame([], "x string").coalesce(1).write.mode("overwrite").csv(f"{path}/layout=a/placeholder")

    return land(spark, "exports_v5", _inputs(sf), write)


def _prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Prefix config: one folder per account (derived from the region table)."""
    return fx.table(spark, sf, "region").select(
        F.concat(F.lit("account_id="), F.col("r_name"), F.lit("/")).alias("prefix"), F.col("r_name").alias("account_id")
    )


_EXPORT_SQL = """
SELECT account_id, billing_cycle, bill_date AS usage_date, product_code, sub_order_id AS instance_id,
       billing_item AS item_code, CAST(cash_amount AS DECIMAL(18,6)) AS amount, CAST(NULL AS VARCHAR) AS parse_error
FROM line_items
"""


@query("export_roundtrip", ids=("SRC1", "SRC3", "SRC4", "PRJ6"), sql=with_ctes(_EXPORT_SQL, "line_items"))
def export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = ex.read_bill_exports(spark, landed_exports(spark, sf), _prefixes(spark, sf), glob=EXPORT_GLOB)
    return rows.select("account_id", "billing_cycle", "usage_date", "product_code", "instance_id", "item_code", "amount", "parse_error")


def _item_over_lines() -> tuple:
    """A billing item that holds a line break, quotes and a comma on every second line."""
    long = F.concat("billing_item", F.lit('\n5" disk, '), "instance_id")
    item = F.when(F.col("billing_item").cast("int") % 2 == 0, long).otherwise(F.col("billing_item"))
    return item, F.concat(F.lit('"'), F.replace(item, F.lit('"'), F.lit('""')), F.lit('"'))


_TITLE = '费用账单 "导出"\n账单日期与应付金额见下表\n'
_TOP_KEYS = ("account_id", "year", "kind")


def _with_tops(batches):
    """The rows of a task, and before those of each of its files a title (kind 0) and a header (kinds 0, 1)."""
    seen = set()
    for batch in batches:
        keys = pa.Table.from_batches([batch.select(_TOP_KEYS)]).group_by(list(_TOP_KEYS)).aggregate([]).to_pylist()
        new = {tuple(k[c] for c in _TOP_KEYS) for k in keys} - seen
        seen |= new
        heads = [(*k, 1, ",".join(h for h, _ in LAYOUT_A)) for k in new if k[2] in (0, 1)]
        tops = heads + [(*k, 0, _TITLE) for k in new if k[2] == 0]
        if tops:
            columns = zip(batch.schema, zip(*tops))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for f, c in columns], schema=batch.schema)
        yield batch


def landed_ragged_exports(spark: SparkSession, sf: str) -> str:
    """CSV exports as offices make them: quoted line breaks and doubled quotes; a third of
    the files begin with title lines, a third with the header, a third have no header.

    Each task writes its files, one for each account, year and kind, compressed."""

    def write(path: str) -> None:
        items = fx.line_items_once(spark, sf).withColumn("kind", F.col("sub_order_id").cast("long") % 3)
        line = F.concat_ws(
            ",", "billing_cycle", F.date_format("bill_date", "yyyy-MM-dd"), F.date_format("synced_at", "yyyy-MM-dd HH:mm:ss"),
            "product_code", F.concat(F.lit('"'), "product_name", F.lit('"')), _item_over_lines()[1], "sub_order_id",
            F.col("cash_amount").cast("string"), "record_id",
        )
        data = items.select("account_id", F.year("bill_date").alias("year"), "kind", F.lit(2).alias("turn"), line.alias("value"))
        every = data.mapInArrow(_with_tops, "account_id string, year int, kind long, turn int, value string")
        # the lines of a file stay in order behind its header
        (
            every.sortWithinPartitions(*_TOP_KEYS, "turn")
            .drop("turn").write.mode("overwrite").option("compression", "gzip").partitionBy(*_TOP_KEYS).text(path)
        )

    return land(spark, "ragged_exports_v2", _inputs(sf), write)


@query("export_records_over_lines", ids=("SRC1", "SRC4"), sql=with_ctes(
    """
SELECT account_id,
       CASE WHEN bad THEN NULL ELSE billing_cycle END AS billing_cycle,
       CASE WHEN bad THEN NULL ELSE bill_date END AS usage_date,
       CASE WHEN bad THEN NULL ELSE product_code END AS product_code,
       CASE WHEN bad THEN NULL ELSE sub_order_id END AS instance_id,
       CASE WHEN bad THEN '' ELSE item END AS item_code,
       CASE WHEN bad THEN NULL ELSE CAST(cash_amount AS DECIMAL(18,6)) END AS amount,
       CASE WHEN bad THEN 'no header in the file: ' || concat_ws(',', billing_cycle, CAST(bill_date AS VARCHAR),
         strftime(synced_at, '%Y-%m-%d %H:%M:%S'), product_code, '"' || product_name || '"',
         '"' || replace(item, '"', '""') || '"', sub_order_id, CAST(cash_amount AS VARCHAR), record_id) END AS parse_error
FROM (
  SELECT *, CAST(sub_order_id AS BIGINT) % 3 = 2 AS bad,
         billing_item || CASE WHEN CAST(billing_item AS INTEGER) % 2 = 0
                              THEN chr(10) || '5" disk, ' || instance_id ELSE '' END AS item
  FROM line_items
) t
""", "line_items"))
def export_records_over_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item comes out of the ragged exports once: as a fact, or quarantined with its text."""
    rows = ex.read_bill_exports(spark, landed_ragged_exports(spark, sf), _prefixes(spark, sf), glob="*.txt.gz")
    return rows.select("account_id", "billing_cycle", "usage_date", "product_code", "instance_id", "item_code", "amount", "parse_error")


@query("json_export_roundtrip", ids=("SRC2", "SRC4", "PRJ9"), sql=with_ctes(
    """
SELECT account_id, billing_cycle, bill_date AS usage_date, product_code, sub_order_id AS instance_id,
       billing_item AS item_code, CAST(cash_amount AS DECIMAL(18,6)) AS amount, CAST(NULL AS VARCHAR) AS parse_error,
       sha256(concat_ws(chr(31), billing_cycle, CAST(bill_date AS VARCHAR), strftime(synced_at, '%Y-%m-%d %H:%M:%S'),
                        sub_order_id, billing_item, product_code, record_id)) AS dedup_key
FROM line_items
""", "line_items"))
def json_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The export as JSON lines, one folder per account, read into fact rows."""

    def write(path: str) -> None:
        rows = _export_rows(fx.line_items(spark, sf))
        names = [("billing_cycle", "billing_cycle"), ("usage_date", "bill_date_s"), ("consume_time", "consume_s"),
                 ("product_code", "product_code"), ("product_name", "product_name"), ("item_code", "billing_item"),
                 ("instance_id", "sub_order_id"), ("amount", "amount_s"), ("record_id", "record_id")]
        rows.select("account_id", *[F.col(c).alias(ex.CANDIDATES[f][-1]) for f, c in names]).write.mode(
            "overwrite").option("compression", "gzip").partitionBy("account_id").json(path)

    root = land(spark, "json_exports_v2", _inputs(sf), write)
    rows = ex.read_json_bill_exports(spark, root, _prefixes(spark, sf), glob="*.json.gz")
    return rows.select("account_id", "billing_cycle", "usage_date", "product_code", "instance_id", "item_code",
                       "amount", "parse_error", "dedup_key")


@query("facts_per_line", ids=("SNK6", "PRJ9"), sql=with_ctes(
    "SELECT COUNT(*) AS facts, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS amount FROM line_items", "line_items"))
def facts_per_line(spark: SparkSession, sf: str) -> DataFrame:
    """No line is lost on the way to the fact: as many facts as lines, and all their cash."""
    from ..operators.upsert import latest_per_key

    rows = fx.fact_rows(fx.line_items(spark, sf), fx.environments(spark, sf))
    fact = latest_per_key(rows, ["account_id", "dedup_key"], ["ingested_at"])
    return fact.agg(F.count(F.lit(1)).alias("facts"), F.sum("amount").cast("decimal(38,6)").alias("amount"))


@query(
    "export_current_month",
    ids=("SRC5",),
    sql=with_ctes(
        "SELECT account_id, billing_cycle, CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS amount FROM line_items "
        f"WHERE billing_cycle = strftime(DATE '{fx.BILL_AS_OF}', '%Y-%m') GROUP BY 1, 2",
        "line_items",
    ),
)
def export_current_month(spark: SparkSession, sf: str) -> DataFrame:
    """Exports re-landed by cycle folder; ``current_month`` keeps the as-of cycle's objects."""

    def write(path: str) -> None:
        rows = _export_rows(fx.line_items(spark, sf)).select(
            "account_id", F.col("billing_cycle").alias("cycle"), "spread", *[F.col(c).alias(h) for h, c in LAYOUT_A]
        )
        rows.repartitionByRange("account_id", "cycle", "spread").drop("spread").write.mode("overwrite").option("header", True).partitionBy(
            "account_id", "cycle"
        ).csv(path)

    root = land(spark, "exports_by_cycle_v2", _inputs(sf), write)
    rows = ex.read_bill_exports(spark, root, _prefixes(spark, sf), mode="current_month", as_of=fx.BILL_AS_OF)
    return rows.groupBy("account_id", "billing_cycle").agg(F.sum("amount").cast("decimal(38,6)").alias("amount"))


@query(
    "export_header_drift",
    ids=("SRC11",),
    sql=(
        # the expected findings: layout A matches every field; layout B carries one
        # unknown column and lacks the product name
        "SELECT * FROM (VALUES ('', 'none', false), ('其它/备注', 'product_name', false)) "
        "t(unmatched, missing_fields, no_header)"
    ),
)
def export_header_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct drift findings over every landed export file (one per layout)."""
    d = ex.header_drift(spark, landed_exports(spark, sf), EXPORT_GLOB)
    return d.select(
        F.array_join("unmatched", "|").alias("unmatched"),
        F.when(F.size("missing_fields") == 0, F.lit("none")).otherwise(F.array_join("missing_fields", "|")).alias("missing_fields"),
        "no_header",
    ).distinct()


@query(
    "stream_export_ingest",
    ids=("ST1", "ST2", "SNK6", "SRC1"),
    sql=with_ctes(
        "SELECT DISTINCT account_id, sha256(concat_ws(chr(31), billing_cycle, CAST(bill_date AS VARCHAR), "
        "strftime(synced_at, '%Y-%m-%d %H:%M:%S'), sub_order_id, billing_item, product_code, record_id)) AS dedup_key, "
        "billing_cycle, bill_date AS usage_date, CAST(cash_amount AS DECIMAL(18,6)) AS amount FROM line_items",
        "line_items",
    ),
)
def stream_export_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """File-source stream over the landed exports, upserted into a fact table."""
    out, _ckpt = sj.stream_dirs(spark, "export-ingest")
    sj.stream_exports(spark, landed_exports(spark, sf), out, _prefixes(spark, sf), glob=EXPORT_GLOB)
    return spark.read.parquet(out).select("account_id", "dedup_key", "billing_cycle", "usage_date", "amount")


def landed_overview(spark: SparkSession, sf: str) -> str:
    """Overview responses as JSON lines: one per (cycle, account), items per (product,
    subscription type) — two-level roll-up, so each list holds at most 2 x products."""

    def write(path: str) -> None:
        ov = fx.overview_items(fx.line_items(spark, sf))
        per_item = ov.groupBy("billing_cycle", "account_id", "ProductCode", "SubscriptionType").agg(
            F.sum("PretaxAmount").alias("p"), F.sum("PaymentAmount").alias("pay"), F.sum("CashAmount").alias("c")
        )
        item = F.struct(
            F.col("p").cast("string").alias("PretaxAmount"), F.col("pay").cast("string").alias("PaymentAmount"),
            F.col("c").cast("string").alias("CashAmount"), F.col("ProductCode").alias("ProductCode"),
            F.col("SubscriptionType").alias("SubscriptionType"), F.lit("Normal").alias("Item"),
        )
        docs = per_item.groupBy("billing_cycle", "account_id").agg(F.collect_list(item).alias("items"))
        docs.select(
            F.col("billing_cycle").alias("BillingCycle"), F.col("account_id").alias("AccountID"),
            F.struct(F.struct(F.col("items").alias("Item")).alias("Items")).alias("data"),
        ).write.mode("overwrite").json(path)

    return land(spark, "overview_v1", _inputs(sf), write)


@query(
    "overview_feed_monthly",
    ids=("SRC7", "AGG8", "PRJ7"),
    sql=with_ctes(
        """
SELECT billing_cycle, account_id, CAST(SUM(p) AS DECIMAL(38,6)) AS total_amount,
       CAST(COALESCE(SUM(CASE WHEN ch <> 0 THEN ch END), 0) AS DECIMAL(38,6)) AS cash_total_amount
FROM (SELECT billing_cycle, account_id, SUM(PretaxAmount) AS p,
             CASE WHEN SUM(PaymentAmount) <> 0 THEN SUM(PaymentAmount) ELSE SUM(CashAmount) END AS ch
      FROM overview GROUP BY billing_cycle, account_id, ProductCode, SubscriptionType) i
GROUP BY billing_cycle, account_id
""",
        "overview",
    ),
)
def overview_feed_monthly(spark: SparkSession, sf: str) -> DataFrame:
    items = fd.read_overview(spark, landed_overview(spark, sf), multi_line=False)
    return ru.monthly_rollup(items).select("billing_cycle", "account_id", "total_amount", "cash_total_amount")


def landed_account_bill(spark: SparkSession, sf: str) -> str:
    """Daily account-bill feed as JSON lines: line items (kind=items) and per-product
    day sums (kind=grouped)."""

    def write(path: str) -> None:
        items = fx.line_items(spark, sf)
        items.select(
            F.col("billing_cycle").alias("BillingCycle"), F.date_format("bill_date", "yyyy-MM-dd").alias("BillingDate"),
            F.col("account_id").alias("AccountID"), F.col("record_id").alias("RecordID"),
            F.col("product_code").alias("ProductCode"), F.col("product_name").alias("ProductName"),
            F.col("subscription_type").alias("SubscriptionType"), F.col("pretax_amount").cast("string").alias("PretaxAmount"),
            F.col("pretax_gross_amount").cast("string").alias("PretaxGrossAmount"),
            F.col("cash_amount").cast("string").alias("CashAmount"), F.col("instance_id").alias("InstanceID"),
            F.col("billing_item").alias("BillingItem"), F.col("sub_order_id").alias("SubOrderID"), F.col("region").alias("Region"),
        ).write.mode("overwrite").option("compression", "gzip").json(f"{path}/kind=items")
        items.groupBy("bill_date", "account_id", "product_code").agg(
            F.sum("pretax_amount").alias("p"), F.sum("cash_amount").alias("c")
        ).select(
            F.date_format("bill_date", "yyyyMMdd").alias("BillingDate"), F.col("account_id").alias("AccountID"),
            F.col("product_code").alias("ProductCode"), F.col("p").cast("string").alias("PretaxAmount"),
            F.col("c").cast("string").alias("CashAmount"),
        ).write.mode("overwrite").option("compression", "gzip").json(f"{path}/kind=grouped")

    return land(spark, "account_bill_v2", _inputs(sf), write)


_DAILY_SQL = "SELECT bill_date, account_id, total_amount, cash_total_amount FROM daily_raw"


@query("account_bill_feed_items", ids=("SRC8", "AGG7"), sql=with_ctes(_DAILY_SQL, "daily_raw"))
def account_bill_feed_items(spark: SparkSession, sf: str) -> DataFrame:
    items = fd.read_account_bill(spark, landed_account_bill(spark, sf) + "/kind=items", grouped=False)
    return ru.daily_rollup(items).select("bill_date", "account_id", "total_amount", "cash_total_amount")


@query("account_bill_feed_grouped", ids=("SRC8",), sql=with_ctes(_DAILY_SQL, "daily_raw"))
def account_bill_feed_grouped(spark: SparkSession, sf: str) -> DataFrame:
    rows = fd.read_account_bill(spark, landed_account_bill(spark, sf) + "/kind=grouped", grouped=True)
    return ru.daily_rollup(rows).select("bill_date", "account_id", "total_amount", "cash_total_amount")


@query(
    "json_export_cycles",
    ids=("AGG2",),
    sql=with_ctes(
        "SELECT account_id AS AccountID, billing_cycle AS BillingCycle, "
        "CAST(SUM(cash_amount) AS DECIMAL(38,6)) AS amount, COUNT(*) AS line_count FROM line_items GROUP BY 1, 2",
        "line_items",
    ),
)
def json_export_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """The export as JSON lines (English field names), read with an explicit schema."""
    path = landed_account_bill(spark, sf) + "/kind=items"
    rows = ex.read_json_exports(spark, path, fd.ACCOUNT_BILL_SCHEMA)
    return rows.groupBy("AccountID", "BillingCycle").agg(
        F.sum(F.col("CashAmount").try_cast("decimal(14,6)")).cast("decimal(38,6)").alias("amount"),
        F.count(F.lit(1)).alias("line_count"),
    )


LOG_START, LOG_END = "2024-01-10", "2024-01-20"


@query(
    "log_store_roundtrip",
    ids=("SNK10", "SRC10"),
    sql=with_ctes(
        "SELECT CAST(ts AS DATE) AS event_date, 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service, COUNT(*) AS errors "
        f"FROM ev WHERE event_type = 'error' AND CAST(ts AS DATE) BETWEEN DATE '{LOG_START}' AND DATE '{LOG_END}' "
        "GROUP BY 1, 2",
        "ev",
    ),
)
def log_store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Error logs written one folder per day (ordered by service, time), read back for
    a date range: only the range's folders are listed (partition pruning)."""
    path = land(spark, "logs_error_v1", _inputs(sf, ("events",)), lambda p: fd.write_logs(fx.error_logs(fx.events(spark, sf)), p))
    logs = fd.read_logs(spark, path, "logs_error", LOG_START, LOG_END)
    return logs.groupBy("event_date", "service").agg(F.count(F.lit(1)).alias("errors"))


# ------------------------------------------------------------ remaining functions
@query(
    "daily_cash_for_cycle",
    ids=("FLT1", "AGG1"),
    sql=with_ctes(
        "SELECT bill_date, strftime(bill_date, '%Y-%m') AS billing_cycle, "
        "CAST(COALESCE(SUM(cash_total_amount), 0) AS DECIMAL(38,6)) AS cash_sum FROM daily_raw "
        f"WHERE strftime(bill_date, '%Y-%m') = strftime(DATE '{fx.BILL_AS_OF}' - INTERVAL 1 MONTH, '%Y-%m') "
        "GROUP BY bill_date",
        "daily_raw",
    ),
)
def daily_cash_for_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """AGG1 as the tool runs it: one month's days (``--month``), of the stored table's partition."""
    return rc.daily_cash(fx.daily_raw(spark, sf), "1998-02")


@query(
    "bill_summary_shape_roundtrip",
    ids=("PRJ16", "PRJ14", "PRJ15"),
    sql=with_ctes(
        "SELECT bill_date AS day, product_code, CAST(SUM(amount) AS DECIMAL(38,6)) AS amount FROM daily_products "
        "GROUP BY 1, 2",
        "daily_products",
    ),
)
def bill_summary_shape_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Array-shaped JSON breakdowns (as stored in the bill summary) conformed back to
    the map shape and flattened."""
    s = ru.bill_summary(ru.daily_rollup(fx.line_items(spark, sf)))
    as_json = s.select("day", F.to_json("product_breakdown").alias("j"))
    m = as_json.select("day", conform_breakdown("j").alias("m"))
    return flatten_breakdown(m, "m").select("day", "product_code", F.col("amount").cast(AMOUNT).alias("amount"))


@query(
    "line_items_conformed",
    ids=("PRJ5", "PRJ4"),
    sql=with_ctes(
        "SELECT record_id, bill_date, cash_amount, 'CNY' AS currency, is_reversal, account_id, "
        "'api_query_account_bill' AS ingestion_channel, CAST(NULL AS DECIMAL(14,6)) AS pretax_gross_amount "
        "FROM line_items",
        "line_items",
    ),
)
def line_items_conformed(spark: SparkSession, sf: str) -> DataFrame:
    """A pre-migration extract (no currency, channel or gross amount columns) conformed
    to the current line-item schema: absent columns take their DDL defaults."""
    old = fx.line_items(spark, sf).drop("currency", "ingestion_channel", "pretax_gross_amount")
    t = cl.conform(old, SCHEMAS["cost_cloud_bill_line_items"], DEFAULTS["cost_cloud_bill_line_items"])
    return t.select("record_id", "bill_date", "cash_amount", "currency", "is_reversal", "account_id", "ingestion_channel", "pretax_gross_amount")
