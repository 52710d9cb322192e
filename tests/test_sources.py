"""Export files: header matching, zero-byte objects, prefixes, incremental listing,
header drift, landed overview JSON (SRC1-SRC11)."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import random
import time
from decimal import Decimal as D

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.sources import exports as ex
from ledgerlake.sources import feeds as fd
from ledgerlake.sources.csv_records import _split_pieces, pieces, records

H1 = "账单信息/账单月份,账单信息/账单日期,账单信息/消费时间,产品信息/产品Code,产品信息/产品名称,产品信息/计费项名称,资源信息/实例ID（出账粒度）,应付信息/应付金额（含税）"
H2 = "应付信息/应付金额（含税）,资源信息/实例ID（出账粒度）,产品信息/产品Code,账单信息/账单日期,账单信息/账单月份,其它/新列"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _fixture(root):
    _write(f"{root}/billing-data/UAT/consumedetailbillv2-2025-02.csv",
           H1 + "\n2025-02,2025-02-03,2025-02-03 10:00,ecs,云服务器,规格,i-1,12.50\n"
           '2025-02,2025-02-04,2025-02-04 10:00,oss,"存储,标准",容量,i-2,"1,000.25"\n')
    _write(f"{root}/billing-data/POC/sub/bill-202502.csv",
           H2 + "\n-3.00,i-9,cdn,2025-02-05,202502,x\nabc,i-10,cdn,2025-02-06,2025-02,y\n")
    _write(f"{root}/billing-data/POC/empty-2025-03.csv", "")  # zero-byte placeholder
    _write(f"{root}/other/noheader-2025-01.csv", "1,2,3\n")


def test_read_exports_header_orders_and_quarantine(spark, tmp):
    _fixture(tmp)
    prefixes = spark.createDataFrame([("billing-data/UAT/", "UAT"), ("billing-data/POC", "POC"), ("billing-data/", "ROOT")],
                                     "prefix string, account_id string")
    rows = ex.read_bill_exports(spark, tmp, prefixes).collect()
    good = {r.instance_id: r for r in rows if r.parse_error is None}
    assert good["i-1"].amount == D("12.50") and good["i-1"].account_id == "UAT" and good["i-1"].product_code == "ecs"
    assert good["i-2"].amount == D("1000.25")  # quoted comma inside a field
    assert good["i-9"].amount == D("-3.00") and good["i-9"].billing_cycle == "2025-02" and good["i-9"].account_id == "POC"
    assert good["i-9"].usage_date == dt.date(2025, 2, 5)
    bad = {r.instance_id: r for r in rows if r.parse_error is not None}
    assert set(bad) == {"i-10", None} and "amount" in bad["i-10"].parse_error
    # the headerless file has no header to map its columns: its rows are kept as errors
    assert bad[None].parse_error == "no header in the file: 1,2,3" and bad[None].amount is None
    assert len(rows) == 5


def test_current_month_and_incremental(spark, tmp):
    _fixture(tmp)
    prefixes = spark.createDataFrame([("billing-data/UAT/", "UAT"), ("billing-data/POC/", "POC")], "prefix string, account_id string")
    cur = ex.read_bill_exports(spark, tmp, prefixes, mode="current_month", as_of="2025-02-20").collect()
    assert len(cur) == 4
    assert ex.read_bill_exports(spark, tmp, prefixes, mode="current_month", as_of="2025-03-01").count() == 0
    # the UAT file is rewritten in place after the mark: only it is selected
    time.sleep(1.1)
    mark = dt.datetime.now()
    time.sleep(1.1)
    p = f"{tmp}/billing-data/UAT/consumedetailbillv2-2025-02.csv"
    _write(p, open(p, encoding="utf-8").read())
    ck = spark.createDataFrame([("UAT", mark), ("POC", mark)], "account_id string, max_object_last_modified timestamp")
    inc = ex.read_bill_exports(spark, tmp, prefixes, checkpoint=ck).collect()
    # of the unbound file, which has no mark, the headerless row comes as an error
    assert sorted((r.account_id, r.parse_error is None) for r in inc) == [("", False), ("UAT", True), ("UAT", True)]
    listing = ex.bind_prefixes(ex.list_objects(spark, tmp), prefixes)
    changed = ex.changed_objects(listing, ck.filter("account_id = 'UAT'")).collect()
    # POC and the unbound file have no mark -> epoch: they count as changed
    assert {r.account_id for r in changed} == {"UAT", "POC", None}  # unbound file: no account


def test_header_drift(spark, tmp):
    _fixture(tmp)
    got = {os.path.basename(r.file_path): r for r in ex.header_drift(spark, tmp).collect()}
    assert got["bill-202502.csv"].unmatched == ["其它/新列"]
    assert "product_name" in got["bill-202502.csv"].missing_fields
    assert got["noheader-2025-01.csv"].no_header
    assert "empty-2025-03.csv" not in got  # zero bytes: no lines, skipped


def test_cycle_from_name(spark):
    df = spark.createDataFrame([("a-2025-02.csv",), ("b202511.csv",), ("none.csv",)], "n string")
    assert [r.c for r in df.select(ex.cycle_from_name(df.n).alias("c")).collect()] == ["2025-02", "2025-11", None]


def test_read_overview(spark, tmp):
    doc = {"BillingCycle": "2025-10", "AccountID": "UAT", "data": {"Items": {"Item": [
        {"PretaxAmount": "10.5", "PaymentAmount": "0", "CashAmount": "-3", "PipCode": "ecs", "Item": "Adjustment"},
        {"PretaxAmount": "x", "PaymentAmount": "2", "CashAmount": "2", "ProductCode": "oss", "Item": "Normal"},
    ]}}}
    _write(f"{tmp}/ov/a.json", json.dumps(doc))
    rows = fd.read_overview(spark, f"{tmp}/ov").collect()
    assert [r.ProductCode for r in rows] == ["ecs", "oss"]
    assert rows[0].CashAmount == D("-3") and rows[1].PretaxAmount is None


def _read_one(spark, tmp, text, folder="billing-data/UAT", **kw):
    _write(f"{tmp}/{folder}/b-2025-02.csv", text)
    return ex.read_bill_exports(spark, tmp, **kw)


def test_wide_export_keeps_far_columns(spark, tmp):
    pad = [f"其它/列{k}" for k in range(72)]
    head = ",".join(["账单信息/账单日期", *pad, "产品信息/产品Code", "资源信息/实例ID", "应付信息/应付金额（含税）"])
    row = ",".join(["2025-02-03", *["x"] * 72, "ecs", "i-1", "2.50"])
    (r,) = _read_one(spark, tmp, f"{head}\n{row}\n").collect()
    assert (r.product_code, r.instance_id, r.amount, r.parse_error) == ("ecs", "i-1", D("2.50"), None)


def test_quoted_header_comma_and_header_like_row(spark, tmp):
    head = '账单信息/账单日期,"其它/备注, 说明",产品信息/产品名称,产品信息/产品Code,应付信息/应付金额（含税）'
    rows = "2025-02-03,n,账单日期 应付金额,ecs,1.00\n2025-02-04,n,b,oss,2.00\n"
    got = {r.product_code: r for r in _read_one(spark, tmp, f"\n{head}\n{rows}").collect()}
    assert {k: r.amount for k, r in got.items()} == {"ecs": D("1.00"), "oss": D("2.00")}
    assert all(r.parse_error is None for r in got.values())


def test_deep_prefix_binds(spark, tmp):
    deep = "/".join("abcdefghijk")
    prefixes = spark.createDataFrame([(deep, "DEEP"), ("a/b", "TOP")], "prefix string, account_id string")
    (r,) = _read_one(spark, tmp, H1 + "\n2025-02,2025-02-03,t,ecs,n,s,i,1.00\n", deep, prefixes=prefixes).collect()
    assert r.account_id == "DEEP"


def test_account_without_mark_is_read(spark, tmp):
    row = "\n2025-02,2025-02-03,t,ecs,n,s,i,1.00\n"
    _write(f"{tmp}/billing-data/NEW/a.csv", H1 + row)
    _write(f"{tmp}/billing-data/UAT/a.csv", H1 + row)
    prefixes = spark.createDataFrame([("billing-data/UAT", "UAT"), ("billing-data/NEW", "NEW")], "prefix string, account_id string")
    marks = spark.createDataFrame([("UAT", dt.datetime(2100, 1, 1))], "account_id string, max_object_last_modified timestamp")
    got = ex.read_bill_exports(spark, tmp, prefixes, checkpoint=marks).collect()
    assert [r.account_id for r in got] == ["NEW"]


def test_current_month_prunes_files(spark, tmp):
    row = "\n2025-02,2025-02-03,t,ecs,n,s,i,1.00\n"
    for m in ("2025-01", "2025-02", "2025-03"):
        _write(f"{tmp}/billing-data/UAT/bill-{m}.csv", H1 + row)
    df = ex.read_bill_exports(spark, tmp, mode="current_month", as_of="2025-02-10")
    assert [r.source_object.endswith("bill-2025-02.csv") for r in df.collect()] == [True]
    lines = ex.current_month(ex._lines(spark, tmp, "*.csv"), "2025-02-10")
    lines.collect()
    assert lines.rdd.getNumPartitions() == 1 or "file_path" in lines._jdf.queryExecution().executedPlan().toString()


def test_json_exports_have_the_fact_shape(spark, tmp):
    good = {"BillingCycle": "2025-02", "BillingDate": "2025-02-03", "ProductCode": "ecs", "InstanceID": "i-1",
            "BillingItem": "b", "PretaxAmount": "1,000.25", "RecordID": "r1"}
    _write(f"{tmp}/billing-data/UAT/a.json", json.dumps(good) + "\n" + json.dumps(good | {"PretaxAmount": "x"}) + "\nnot json\n")
    prefixes = spark.createDataFrame([("billing-data/UAT", "UAT")], "prefix string, account_id string")
    rows = ex.read_json_bill_exports(spark, tmp, prefixes).collect()
    ok = [r for r in rows if r.parse_error is None]
    assert len(rows) == 3 and len(ok) == 1
    assert (ok[0].amount, ok[0].account_id, ok[0].billing_cycle) == (D("1000.25"), "UAT", "2025-02")
    assert len(ok[0].dedup_key) == 64


def _csv_lines(text):
    """(lines of each record, whether it is closed) by Python's csv module."""
    lines = text.split("\n")
    reader, at, out = csv.reader(iter([x + "\n" for x in lines])), 0, []
    for _ in reader:
        out.append(lines[at : reader.line_num])
        at = reader.line_num
    return out


def test_records_over_lines_equal_the_csv_module(spark):
    rng = random.Random(11)
    cases = ["".join(rng.choice('a,"\n' + '"' * (k % 3)) for _ in range(rng.randint(1, 30))) for k in range(600)]
    cases += ['a,"b\n""c""\n",d\ne', '"a""', '"', 'x"y\nz"', ' "a\nb"', '"a"b\n"c\nd" e,"\n"']
    rows = []
    for k, text in enumerate(cases):
        block = 0
        for n, value in enumerate(text.split("\n")):
            block = n if rng.random() < 0.3 else block
            rows.append((str(k), None, block, n, value))
    lines = spark.createDataFrame(rows, "file_path string, last_modified timestamp, block_start long, line long, value string")
    got = {}
    for r in records(lines.repartition(3)).collect():
        got.setdefault(int(r.file_path), []).append((r.record, r.value, r.closed))
    for k, text in enumerate(cases):
        want = _csv_lines(text)
        unclosed = want and _open_at_end(text)
        expect = [(n + 1, "\n".join(x), True) for n, x in enumerate(want[:-1] if unclosed else want)]
        if unclosed:
            expect += [(len(want), x, False) for x in want[-1]]
        assert sorted(got[k]) == sorted(expect), text


def _open_at_end(text):
    state = "begin"
    for c in text:
        if state == "quoted":
            state = "quote" if c == '"' else state
        elif state == "quote" and c == '"':
            state = "quoted"
        elif c in ",\n":
            state = "begin"
        elif state == "begin" and c == '"':
            state = "quoted"
        else:
            state = "plain"
    return state == "quoted"


TITLED = "费用账单 账单日期 应付金额 导出\n\n" + H1 + "\n"


def test_titles_breaks_and_quotes(spark, tmp):
    text = TITLED + (
        '2025-02,2025-02-03,t,ecs,"云\n服务器","say ""hi"",\n\nthen go",i-1,12.50\n'
        "2025-02,2025-02-04,t,oss,n,plain,i-2,1.25\n"
        + H1 + "\n"  # a header in the middle is no data
        + '2025-02,2025-02-05,t,ecs,n,"5"" disk",i-3,2.00\n'
    )
    _write(f"{tmp}/billing-data/UAT/a.csv", text)
    _write(f"{tmp}/billing-data/UAT/b.csv", H1 + "\n2025-02,2025-02-03,t,ecs,n,b,i-4,3.00\n")
    _write(f"{tmp}/billing-data/UAT/c.csv", "title\n" + H1 + "\n2025-02,2025-02-03,t,ecs,n,b,i-5,4.00\n")
    _write(f"{tmp}/billing-data/UAT/d.csv", H1 + '\n2025-02,2025-02-03,t,ecs,n,b,i-6,5.00\n2025-02,2025-02-03,t,ecs,n,"b,i-7,5.00\nlast\n')
    _write(f"{tmp}/billing-data/UAT/e.csv", 'no "header\nat" all\n')
    for size in ("134217728", "64"):  # also with records over splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = ex.read_bill_exports(spark, f"{tmp}/billing-data").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        good = {r.instance_id: (r.item_code, str(r.amount.normalize())) for r in rows if r.parse_error is None}
        assert good == {
            "i-1": ('say "hi",\n\nthen go', "12.5"), "i-2": ("plain", "1.25"), "i-3": ('5" disk', "2"),
            "i-4": ("b", "3"), "i-5": ("b", "4"), "i-6": ("b", "5"),
        }
        bad = sorted(r.parse_error for r in rows if r.parse_error is not None)
        assert bad == [
            'no header in the file: at" all', 'no header in the file: no "header',
            'quote not closed: 2025-02,2025-02-03,t,ecs,n,"b,i-7,5.00', "quote not closed: last",
        ]


def test_csv_and_json_lines_have_one_key(spark, tmp):
    item = 'say ""hi"", "'
    _write(f"{tmp}/csv/a.csv", H1 + ',明细ID\n2025-02,2025-02-03,t,ecs,n,"' + item.replace('"', '""') + '",i-1,1.00,r1\n')
    row = {"BillingCycle": "2025-02", "BillingDate": "2025-02-03", "UsageTime": "t", "ProductCode": "ecs",
           "InstanceID": "i-1", "BillingItem": item, "PretaxAmount": "1.00", "RecordID": "r1"}
    _write(f"{tmp}/json/a.json", json.dumps(row) + "\n")
    (a,), (b,) = ex.read_bill_exports(spark, f"{tmp}/csv").collect(), ex.read_json_bill_exports(spark, f"{tmp}/json").collect()
    assert a.item_code == b.item_code == item and a.dedup_key == b.dedup_key


def test_pieces_of_a_split_are_whole_records_or_loose_lines(spark):
    rng = random.Random(5)
    cases = ["".join(rng.choice('a,"\n' + '"' * (k % 3)) for _ in range(rng.randint(1, 30))) for k in range(400)]
    cases += ['a,"b\n""c""\n",d\ne', 'a,"' + "b\n" * 9 + '"\nc', '"a\nb'] + ["x\ny"] * 3
    rows = []
    for k, text in enumerate(cases):
        block = 0
        for n, value in enumerate(text.split("\n")):
            block = n if rng.random() < 0.3 else block
            rows.append((str(k), None, block, n, value))
    schema = "file_path string, last_modified timestamp, block_start long, line long, value string"
    for size in ("7", "10000"):  # also with records over batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            made = pieces(spark.createDataFrame(rows, schema).coalesce(1)).localCheckpoint()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got = {}
        for r in made.filter("NOT loose").collect():
            got.setdefault(int(r.file_path), []).append((r.line, r.value, True))
        for r in records(made.filter("loose").drop("loose")).collect():
            got.setdefault(int(r.file_path), []).append((r.line, r.value, r.closed))
        for k, text in enumerate(cases):
            want, expect, at = _csv_lines(text), [], 0
            for n, record in enumerate(want):
                if n == len(want) - 1 and _open_at_end(text):
                    expect += [(at + i, x, False) for i, x in enumerate(record)]
                else:
                    expect.append((at, "\n".join(record), True))
                at += len(record)
            assert sorted(got[k]) == sorted(expect), text


def test_long_records_are_left_to_the_scan(spark):
    lines = ["h", '"a', *["b"] * 50, '"', "c", '"d', 'e"']
    batch = [(f"{k}", None, 0, k, v, '"' in v and v[0] == '"', '"' not in v) for k, v in enumerate(lines)]
    columns = list(zip(*batch))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * len(lines)), pa.array([None] * len(lines), pa.timestamp("us")), pa.array([0] * len(lines)),
         pa.array(columns[3]), pa.array(columns[4]), pa.array(columns[5]), pa.array(columns[6])],
        ["file_path", "last_modified", "block_start", "line", "value", "if_closed", "if_open"],
    )
    cut = [rows.slice(k, 3) for k in range(0, len(lines), 3)]
    out = [r for b in _split_pieces(iter(cut), held_lines=8) for r in b.to_pylist()]
    assert [(r["line"], r["value"]) for r in out if not r["loose"]] == [(0, "h"), (53, "c"), (54, '"d\ne"')]
    assert sorted(r["line"] for r in out if r["loose"]) == list(range(1, 53))


def test_lines_over_records_are_not_shuffled(spark, tmp):
    """The lines of a file pass no shuffle: only those at the ends of a split do."""
    row = '2025-02,2025-02-03,t,ecs,n,"b\n""x"" disk",i-%d,1.00\n'
    _write(f"{tmp}/billing-data/UAT/a.csv", TITLED + "".join(row % k for k in range(3000)))
    lines = ex._lines(spark, f"{tmp}/billing-data", "*.csv").withColumn("line", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        made = pieces(lines)
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        got = {r.loose: r.n for r in made.groupBy("loose").agg(F.count(F.lit(1)).alias("n")).collect()}
        splits = lines.select("block_start").distinct().count()
        rows = ex.read_bill_exports(spark, f"{tmp}/billing-data").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits > 3 and got[True] <= 6 * splits and got[False] >= 2900
    assert len(rows) == 3000 and {r.item_code for r in rows} == {'b\n"x" disk'}
