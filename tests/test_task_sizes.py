"""Sizes of tasks, shuffles and staged copies: what grows with the input stays bounded."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake import fixtures as fx
from ledgerlake.operators import ingest as ig
from ledgerlake.operators import upsert as up
from ledgerlake.plans import queries_files as qf
from ledgerlake.session import checkpoint_root, is_staged, path_exists
from ledgerlake.sources import exports as ex

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def tables(spark, tmp_path):
    """Small driver tables: 40 orders of five accounts, two lines each."""
    sf = str(tmp_path / "sf")
    spark.sql("SELECT CAST(id AS INT) AS r_regionkey, element_at(array('AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST'), CAST(id + 1 AS INT)) AS r_name FROM range(5)").write.parquet(f"{sf}/region.parquet")
    spark.sql("SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name, CAST(id AS INT) AS n_regionkey FROM range(5)").write.parquet(f"{sf}/nation.parquet")
    spark.sql("SELECT id AS c_custkey, CAST(id AS INT) AS c_nationkey FROM range(5)").write.parquet(f"{sf}/customer.parquet")
    spark.sql("SELECT id AS p_partkey, concat('part ', id) AS p_name, 'Brand#1' AS p_brand, 'PROMO' AS p_type FROM range(3)").write.parquet(f"{sf}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, id % 5 AS o_custkey, CAST(DATE '1998-01-15' + CAST(id AS INT) AS TIMESTAMP_NTZ) AS o_orderdate FROM range(40)").write.parquet(f"{sf}/orders.parquet")
    spark.sql(
        "SELECT id DIV 2 AS l_orderkey, id % 3 AS l_partkey, id AS l_suppkey, CAST(id % 2 + 1 AS INT) AS l_linenumber, "
        "1.0D AS l_quantity, 10.0D + id AS l_extendedprice, 0.05D AS l_discount, 0.1D AS l_tax, "
        "if(id % 7 = 0, 'R', 'N') AS l_returnflag, if(id % 2 = 0, 'O', 'F') AS l_linestatus, "
        "CAST(DATE '1998-02-01' + CAST(id AS INT) AS TIMESTAMP_NTZ) AS l_shipdate FROM range(80)"
    ).write.parquet(f"{sf}/lineitem.parquet")
    return sf


def _facts(spark, n, cycle="2025-01", day=1):
    return spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("record_id"), F.lit(cycle).alias("billing_cycle"),
        F.lit(dt.datetime(2025, 1, day)).alias("synced_at"),
    )


def test_tasks_behind_a_shuffle_do_not_grow_with_a_small_default(spark):
    given = {
        "spark.sql.shuffle.partitions": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    kept = {k: spark.conf.get(k) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    seen = []

    def query(session, _sf):
        rows = up.latest_per_key(_facts(session, 40000), ["record_id"], ["synced_at"])
        seen.append(rows.rdd.getNumPartitions())
        return rows

    try:
        assert entry._wrap(query, sized=True)(spark, "").count() == 40000
        assert seen[0] > 8  # two partitions of 20,000 rows before
    finally:
        spark.conf.unset(INITIAL)
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_billing_queries_are_sized():
    assert entry._wrap.__defaults__ == (False,)
    sized = {name: f.__closure__ for name, f in entry.queries().items()}
    assert any(c.cell_contents is True for c in sized["fact_upsert"] if isinstance(c.cell_contents, bool))


def test_line_items_are_dealt_before_their_texts_are_made(spark, tables):
    plain, dealt = (fx.build_line_items(spark, tables, deal=d) for d in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.count() == 80
    assert sorted(map(str, fx.line_items(spark, tables).select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("concat_ws") < plan.index("RebalancePartitions")  # the texts above it


def test_a_merge_leaves_no_staged_copy(spark, tmp_path):
    path = f"{tmp_path}/fact"
    for n, (cycle, day) in enumerate((("2025-01", 1), ("2025-02", 2))):
        got = up.upsert_into(
            _facts(spark, 50, cycle, day), path, ["record_id"], ["synced_at"], "billing_cycle", f"{tmp_path}/s{n}", buckets=4
        )
        assert sorted(got) == (["2025-01"] if n == 0 else ["2025-01", "2025-02"])
    assert glob.glob(f"{tmp_path}/s*") == []
    rows = spark.read.parquet(path)
    assert rows.count() == 50 and {r[0] for r in rows.select(F.col("billing_cycle").cast("string")).collect()} == {"2025-02"}


def test_an_ingest_run_leaves_no_copy_of_its_rows(spark, tables, tmp_path):
    root = f"{tmp_path}/exports"
    rows = qf._export_rows(fx.line_items(spark, tables))
    rows.select("account_id", *[F.col(c).alias(h) for h, c in qf.LAYOUT_A]).write.option("header", True).option(
        "compression", "gzip").partitionBy("account_id").csv(root)
    base = f"{checkpoint_root(spark)}/ingest"
    before = set(os.listdir(base.removeprefix("file:"))) if path_exists(spark, base) else set()
    n = ig.ingest_changed(spark, root, None, f"{tmp_path}/fact", f"{tmp_path}/marks", glob="*.csv.gz")
    after = set(os.listdir(base.removeprefix("file:"))) if path_exists(spark, base) else set()
    assert n > 0 and after == before
    assert spark.read.parquet(f"{tmp_path}/fact").count() == 80


def test_exports_land_compressed_and_without_a_shuffle(spark, tables):
    spark.conf.unset(INITIAL)
    root = qf.landed_exports(spark, tables).removeprefix("file:")
    files = [f for f in glob.glob(f"{root}/layout=*/account_id=*/*") if os.path.getsize(f)]
    assert files and all(f.endswith(".csv.gz") for f in files)
    out = qf.export_roundtrip(spark, tables)
    assert out.count() == 80 and out.filter("parse_error IS NOT NULL OR amount IS NULL").count() == 0
    js = qf.json_export_roundtrip(spark, tables)
    assert js.count() == 80 and js.filter("parse_error IS NOT NULL").count() == 0
    assert qf.json_export_cycles(spark, tables).agg(F.sum("line_count")).first()[0] == 80
    # both layouts' headers are read from the compressed files
    assert sorted(map(tuple, qf.export_header_drift(spark, tables).collect())) == [("", "none", False), ("其它/备注", "product_name", False)]


def test_streamed_exports_leave_no_copy_of_their_rows(spark, tables):
    out = qf.stream_export_ingest(spark, tables)
    assert out.count() == 80 and out.select("account_id", "dedup_key").distinct().count() == 80
    left = glob.glob(checkpoint_root(spark).removeprefix("file:") + "/streams/exports-*/_checkpoint/rows/*")
    assert left == []


def test_ragged_exports_land_without_staged_line_items(spark, tables):
    """Each file has its title and header on top; the line items are not staged for them."""
    root = qf.landed_ragged_exports(spark, tables)
    names = ("lineitem", "orders", "customer", "part", "nation", "region")
    assert not is_staged(spark, fx._line_items_name(), fx._paths(tables, names))
    lines = spark.read.text(root).withColumn("file", F.col("_metadata.file_path")).withColumn("id", F.monotonically_increasing_id())
    files = {}
    for r in lines.orderBy("id").collect():
        files.setdefault((r.file, r.kind), []).append(r.value)
    head = ",".join(h for h, _ in qf.LAYOUT_A)
    assert {k for _, k in files} == {0, 1, 2} and all(f.endswith(".txt.gz") for f, _ in files)
    for (_, kind), values in files.items():
        top = {0: [*qf._TITLE.split("\n")[:2], "", head], 1: [head], 2: []}[kind]
        assert values[: len(top)] == top and head not in values[len(top) :]
    assert entry.queries()["export_records_over_lines"](spark, tables).count() == 80


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stored_facts_are_written_as_the_line_items_lie(spark, tables):
    """The facts pass no shuffle: neither by account for their tags, nor by cycle for the write."""
    items = fx.line_items(spark, tables)
    facts = fx.fact_rows(items, fx.environments(spark, tables))
    assert _shuffles(facts) == 0 and facts.count() == 80
    seen = []
    spread, up.spread_by = up.spread_by, lambda *a: seen.append(a) or spread(*a)
    try:
        out = entry.queries()["fact_slices_replaced_in_place"](spark, tables).collect()
    finally:
        up.spread_by = spread
    assert seen == [] and sum(r.line_count for r in out) == 80


def test_export_rows_are_dealt_before_their_key_is_made(spark, tables):
    root = qf.landed_exports(spark, tables)
    plain, dealt = (ex.read_bill_exports(spark, root, qf._prefixes(spark, tables), glob=qf.EXPORT_GLOB, deal=d) for d in (False, True))
    assert dealt.columns == plain.columns and sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2") < plan.index("RebalancePartitions")  # the key above it


@pytest.mark.parametrize("name", ["stream_export_ingest", "exports_ingested_in_runs"])
def test_exports_are_ingested_without_staged_line_items(spark, tables, name):
    spark.conf.unset(INITIAL)
    out = entry.queries()[name](spark, tables)
    if name == "stream_export_ingest":
        assert out.count() == 80
    else:
        want = fx.build_line_items(spark, tables).groupBy("account_id", "billing_cycle").agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("cash_amount") * F.when(F.expr("account_id = 'AFRICA' AND subscription_type = 'Subscription'"), 2).otherwise(1)
                  ).cast("decimal(38,6)").alias("amount"))
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert not is_staged(spark, fx._line_items_name(), fx._paths(tables, fx._LINE_ITEM_INPUTS))
