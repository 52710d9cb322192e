"""Idempotent writes (SNK1-SNK12, WIN3, WIN4)."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal as D

from ledgerlake.operators import clean as cl
from ledgerlake.operators import upsert as up

LI = "record_id string, billing_cycle string, cash_amount decimal(14,6), synced_at timestamp_ntz, note string"


def ts(h):
    return dt.datetime(2025, 2, 1, h)


def test_upsert_latest_same_key_in_batch_and_rerun(spark):
    old = spark.createDataFrame([("r1", "2025-02", D("1"), ts(1), "old")], LI)
    new = spark.createDataFrame(
        [("r1", "2025-02", D("2"), ts(3), "newer"), ("r1", "2025-02", D("3"), ts(2), "new"), ("r2", "2025-02", D("5"), ts(1), "x")],
        LI,
    )
    once = up.upsert_latest(old, new, ["record_id"], ["synced_at"])
    got = {r.record_id: (r.cash_amount, r.note) for r in once.collect()}
    assert got == {"r1": (D("2"), "newer"), "r2": (D("5"), "x")}
    twice = up.upsert_latest(once, new, ["record_id"], ["synced_at"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_equal_synced_at_is_deterministic(spark):
    rows = [("r1", "2025-02", D("1"), ts(1), "a"), ("r1", "2025-02", D("1"), ts(1), "b")]
    a = up.latest_per_key(spark.createDataFrame(rows, LI), ["record_id"], ["synced_at"]).first().note
    b = up.latest_per_key(spark.createDataFrame(rows[::-1], LI), ["record_id"], ["synced_at"]).first().note
    assert a == b == "b"


def test_upsert_columns_null_overwrites_and_kept_columns(spark):
    schema = "k string, v decimal(10,2), waste decimal(10,2), notes string"
    old = spark.createDataFrame([("a", D("1"), D("9"), "keep"), ("b", D("2"), D("8"), "b")], schema)
    new = spark.createDataFrame([("a", None, D("0"), "x"), ("c", D("3"), D("7"), "new")], schema)
    got = {r.k: r for r in up.upsert_columns(old, new, ["k"], ["v"]).collect()}
    assert got["a"].v is None and got["a"].waste == D("9") and got["a"].notes == "keep"
    assert got["b"].v == D("2")
    assert got["c"].v == D("3") and got["c"].notes == "new"


def test_insert_absent(spark):
    old = spark.createDataFrame([("POC", "POC")], "environment string, account_id string")
    new = spark.createDataFrame([("POC", "other"), ("DEV", "d"), ("DEV", "d")], "environment string, account_id string")
    got = {r.environment: r.account_id for r in up.insert_absent(old, new, ["environment"]).collect()}
    assert got == {"POC": "POC", "DEV": "d"}


def test_drop_shadowed_empty_before_poc(spark):
    df = spark.createDataFrame(
        [("2025-01", "", D("1")), ("2025-01", "POC", D("2")), ("2025-02", "", D("3")), ("2025-03", None, D("4")),
         ("2025-03", "UAT", D("5"))],
        "billing_cycle string, account_id string, total decimal(10,2)",
    )
    out = cl.map_legacy_account(cl.drop_shadowed_empty(df, "billing_cycle"))
    got = sorted((r.billing_cycle, r.account_id, r.total) for r in out.collect())
    assert got == [("2025-01", "POC", D("2")), ("2025-02", "POC", D("3")), ("2025-03", "UAT", D("5"))]


def test_replace_slices_and_upsert_into(spark, tmp):
    path = tmp + "/fact"
    base = spark.createDataFrame(
        [("r1", "2025-01", D("1"), ts(1), "a"), ("r2", "2025-02", D("2"), ts(1), "b")], LI
    )
    up.replace_slices(base, path, ["billing_cycle"])
    up.upsert_into(
        spark.createDataFrame([("r2", "2025-02", D("20"), ts(2), "b2"), ("r3", "2025-02", D("3"), ts(1), "c")], LI),
        path, ["record_id"], ["synced_at"], "billing_cycle", tmp + "/stage1",
    )
    got = {r.record_id: r.cash_amount for r in spark.read.parquet(path).collect()}
    assert got == {"r1": D("1"), "r2": D("20"), "r3": D("3")}
    # re-delivery of the same batch changes nothing
    up.upsert_into(
        spark.createDataFrame([("r2", "2025-02", D("20"), ts(2), "b2")], LI),
        path, ["record_id"], ["synced_at"], "billing_cycle", tmp + "/stage2",
    )
    assert {r.record_id: r.cash_amount for r in spark.read.parquet(path).collect()} == got


def test_reset_expire_checkpoint_balance(spark):
    st = spark.createDataFrame([("2025-01", "FINALIZED"), ("2025-02", "DIRTY")], "billing_cycle string, data_status string")
    assert up.reset_status(st, keep_finalized=True).count() == 1 and up.reset_status(st).count() == 0
    m = spark.createDataFrame([("2019-12",), ("2020-01",), ("2025-01",)], "billing_cycle string")
    # same rule as the reference's listing: cycle >= to_char(as_of - 60 months)
    kept, expired = up.expire(m, "billing_cycle", "2025-01-15", months=60)
    assert [r.billing_cycle for r in expired.collect()] == ["2019-12"] and kept.count() == 2
    ck = spark.createDataFrame([("a", dt.datetime(2025, 1, 5))], "account_id string, max_object_last_modified timestamp")
    seen = spark.createDataFrame(
        [("a", dt.datetime(2025, 1, 1)), ("b", dt.datetime(2025, 1, 2))], "account_id string, last_modified timestamp"
    )
    got = {r.account_id: r.max_object_last_modified for r in up.advance_checkpoint(ck, seen).collect()}
    assert got == {"a": dt.datetime(2025, 1, 5), "b": dt.datetime(2025, 1, 2)}  # never moves back
    snaps = spark.createDataFrame(
        [("a", dt.date(2025, 1, 1), D("5")), ("a", dt.date(2025, 1, 3), D("1"))],
        "account_id string, snapshot_date date, available_amount decimal(14,6)",
    )
    assert up.latest_balance(snaps).first().available_amount == D("1")


def test_moved_key_leaves_one_copy(spark, tmp):
    path = tmp + "/fact"
    up.replace_slices(spark.createDataFrame([("r1", "2025-01", D("1"), ts(1), "a"), ("r2", "2025-01", D("1"), ts(1), "a")], LI), path, ["billing_cycle"])
    moved = spark.createDataFrame([("r1", "2025-02", D("2"), ts(2), "b"), ("r2", "2025-02", D("3"), ts(2), "b")], LI)
    up.upsert_into(moved, path, ["record_id"], ["synced_at"], "billing_cycle", tmp + "/s1")
    got = sorted((r.record_id, r.billing_cycle, r.cash_amount) for r in spark.read.parquet(path).collect())
    assert got == [("r1", "2025-02", D("2")), ("r2", "2025-02", D("3"))]


def test_emptied_slice_is_cleared(spark, tmp):
    path = tmp + "/fact"
    base = spark.createDataFrame([("r1", "2025-01", D("1"), ts(1), "a"), ("r2", "2025-02", D("2"), ts(1), "b")], LI)
    up.replace_slices(base, path, ["billing_cycle"])
    both = spark.createDataFrame([("2025-01",), ("2025-02",)], "billing_cycle string")
    up.replace_slices(spark.createDataFrame([("r3", "2025-02", D("5"), ts(1), "c")], LI), path, ["billing_cycle"], both)
    assert [r.record_id for r in spark.read.parquet(path).collect()] == ["r3"]


def test_add_keeps_other_columns_and_empty_maps(spark):
    schema = "k string, v decimal(38,6), m map<string,decimal(38,6)>, c map<string,decimal(38,6)>, note string, n int"
    old = spark.createDataFrame([("a", D("1"), {"x": D("1")}, {}, "keep", 1), ("b", D("2"), None, {}, "b", 2)], schema)
    new = spark.createDataFrame([("a", D("4"), {"x": D("1"), "y": D("3")}, {}, "other", 9), ("c", D("3"), {}, None, "new", 3)], schema)
    out = up.upsert_add(old, new, ["k"], ["v"], ["m", "c"])
    assert out.columns == old.columns
    got = {r.k: (r.v, r.m, r.c, r.note, r.n) for r in out.collect()}
    assert got == {
        "a": (D("5"), {"x": D("2"), "y": D("3")}, {}, "keep", 1),
        "b": (D("2"), None, {}, "b", 2),
        "c": (D("3"), {}, None, "new", 3),
    }


def test_emptied_slices_of_any_name_are_cleared(spark, tmp):
    path, schema = tmp + "/t", "p string, v int"
    names = ["a:b", "x/y", "100%", "é =", None, "kept"]
    up.replace_slices(spark.createDataFrame([(n, 1) for n in names], schema), path, ["p"])
    slices = spark.createDataFrame([(n,) for n in names[:-1]] + [("never there",)], "p string")
    up.replace_slices(spark.createDataFrame([("x/y", 2)], schema), path, ["p"], slices)
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [("kept", 1), ("x/y", 2)]
    # '' lies in the folder of NULL: new rows for the one are not removed with the other
    up.replace_slices(spark.createDataFrame([("", 3)], schema), path, ["p"], spark.createDataFrame([(None,), ("kept",)], "p string"))
    assert sorted((r.p or "", r.v) for r in spark.read.parquet(path).collect()) == [("", 3), ("x/y", 2)]


def test_key_index_is_read_in_place(spark, tmp):
    path = tmp + "/fact"
    rows = [(f"r{k}", f"2025-{1 + k % 3:02d}", D(k), ts(1), "a") for k in range(300)]
    up.upsert_into(spark.createDataFrame(rows, LI), path, ["record_id"], ["synced_at"], "billing_cycle", tmp + "/s0", buckets=8)
    name = up.key_index(spark, path, ["record_id"], "billing_cycle", 8)
    new = spark.createDataFrame([("r5",), ("zz",)], "record_id string")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = up.key_slices(new, spark.table(name), ["record_id"])
        assert [tuple(r) for r in found.collect()] == [("r5", "2025-03")]
        # below the join: the scan of the index, at most sorted; the exchange is the batch's
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        stored, batch = final.split("SortMergeJoin", 1)[1].split("FileScan", 1)
        assert "Exchange" not in stored and "Bucketed: true" in batch and "Exchange" in batch
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_moved_keys_over_batches_and_a_lost_job(spark, tmp):
    path, keys = tmp + "/fact", ["record_id"]

    def merge(rows, n):
        up.upsert_into(spark.createDataFrame(rows, LI), path, keys, ["synced_at"], "billing_cycle", f"{tmp}/s{n}", buckets=4)

    def held():
        return sorted((r.record_id, r.billing_cycle, r.cash_amount) for r in spark.read.parquet(path).collect())

    merge([("r1", "2025-01", D("1"), ts(1), "a"), ("r2", "2025-01", D("1"), ts(1), "a"), ("r3", "2025-03", D("9"), ts(1), "a")], 0)
    kept = [f for f in os.listdir(path + "/billing_cycle=2025-03") if f.endswith(".parquet")]
    merge([("r1", "2025-02", D("2"), ts(2), "b")], 1)
    assert [f for f in os.listdir(path + "/billing_cycle=2025-03") if f.endswith(".parquet")] == kept  # not touched
    # a batch whose keys were added to the index, but whose rows were never written
    name = up.key_index(spark, path, keys, "billing_cycle", 4)
    up._append_keys(spark.createDataFrame([("r1", "2025-05")], "record_id string, _slice string"), name, keys, 4)
    merge([("r1", "2025-04", D("4"), ts(4), "d")], 2)
    assert held() == [("r1", "2025-04", D("4")), ("r2", "2025-01", D("1")), ("r3", "2025-03", D("9"))]
    up.compact_keys(spark, path, keys, "billing_cycle", 4)
    index = spark.table(up.key_index(spark, path, keys, "billing_cycle", 4))
    assert sorted(map(tuple, index.collect())) == [("r1", "2025-04"), ("r2", "2025-01"), ("r3", "2025-03")]
    merge([("r1", "2025-01", D("5"), ts(5), "e"), ("r4", "2025-01", D("6"), ts(5), "e")], 3)
    assert held() == [("r1", "2025-01", D("5")), ("r2", "2025-01", D("1")), ("r3", "2025-03", D("9")), ("r4", "2025-01", D("6"))]


def test_a_merge_in_turns_gives_the_rows_of_one(spark, tmp, monkeypatch):
    monkeypatch.setattr(up, "TURN_ROWS", 64)
    schema = "account_id string, dedup_key string, billing_cycle string, v int, at timestamp_ntz"
    keys, order = ["account_id", "dedup_key"], ["at"]
    names = ["ab" * 32, "AB" * 32, "0" * 63, "f" * 64, "", "é" * 30, "short", "a b" * 20, None]
    old = [(a, k, c, n, ts(1)) for n, (a, k, c) in enumerate(
        (a, k, c) for a in ("x", None) for k in names for c in ("2025-01", "2025-02", None))]
    old += [("y", f"{n:064x}", f"2025-{1 + n % 4:02d}", n, ts(1)) for n in range(60)]
    new = [("y", f"{n:064x}", "2025-07", -n, ts(2)) for n in range(0, 60, 7)]
    new += [("y", f"{n:064x}", "", -n, ts(0)) for n in range(3)]
    new += [("x", k, "2025-02", 99, ts(2)) for k in names] + [("z", "new", c, 1, ts(1)) for c in ("2025-01", "", None)]
    o, n = (spark.createDataFrame(rows, schema) for rows in (old, new))
    path = tmp + "/fact"
    up.replace_slices(o, path, ["billing_cycle"])
    turns = []
    real = up._merged
    monkeypatch.setattr(up, "_merged", lambda *a: turns.append(a[-1]) or real(*a))
    got = up.upsert_into(n, path, keys, order, "billing_cycle", tmp + "/s", buckets=4)
    assert turns == [3] and sorted(map(str, got)) == ["2025-01", "2025-02", "2025-03", "2025-04", "2025-07", "None"]
    want = up.latest_per_key(o.unionByName(n), keys, order)
    plain = [tuple(r[:2]) + (r[2] or None,) + tuple(r[3:]) for r in want.collect()]
    held = spark.read.schema(schema).parquet(path).select(*o.columns).collect()
    assert sorted(map(str, (tuple(r) for r in held))) == sorted(map(str, plain))
    assert [f for f in os.listdir(tmp) if f not in ("fact", "fact_keys")] == []


def test_a_first_write_settles_repeated_keys(spark, tmp, monkeypatch):
    rows = [(f"r{k}", f"2025-{1 + k % 3:02d}", D(k), ts(1), "a") for k in range(40)]
    again = [(f"r{k}", f"2025-{5 + k % 2:02d}", D(k), ts(2), "b") for k in range(0, 40, 5)] + [(None, None, D(1), ts(h), "c") for h in (1, 2)]
    new = spark.createDataFrame(rows + again, LI)
    want = sorted(map(str, up.latest_per_key(new, ["record_id"], ["synced_at"]).collect()))
    assert len(want) == 41
    for n, (most, dealt) in enumerate([(100, False), (100, True), (0, True)]):
        monkeypatch.setattr(up, "REPEATED_KEYS", most)
        got = up.upsert_into(new, f"{tmp}/t{n}", ["record_id"], ["synced_at"], "billing_cycle", f"{tmp}/s{n}", buckets=2, dealt=dealt)
        held = spark.read.schema(LI).parquet(f"{tmp}/t{n}").select(*new.columns)
        assert sorted(map(str, held.collect())) == want and None in got
    assert [f for f in os.listdir(tmp) if f.startswith("s")] == []


def test_long_keys_are_digests_in_the_index(spark, tmp):
    schema, path = "account_id string, dedup_key string, p string, v int", tmp + "/t"
    rows = [("a", f"{k:064x}", f"p{k % 3}", k) for k in range(30)]
    keys = ["account_id", "dedup_key"]
    up.upsert_into(spark.createDataFrame(rows, schema), path, keys, ["v"], "p", tmp + "/s0", buckets=2)
    index = spark.table(up.key_index(spark, path, keys, "p", 2))
    assert {len(r.dedup_key) for r in index.collect()} == {11} and index.distinct().count() == 30
    moved = [("a", f"{k:064x}", "p9", 100 + k) for k in range(0, 30, 4)]
    up.upsert_into(spark.createDataFrame(moved, schema), path, keys, ["v"], "p", tmp + "/s1", buckets=2)
    got = {r.dedup_key: (r.p, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {k: (p, v) for _, k, p, v in rows} | {k: (p, v) for _, k, p, v in moved}
    assert spark.read.parquet(path).count() == 30


def test_texts_are_packed_and_come_back(spark):
    texts = ["", "ab", "AB", "abc", "00", "zz", "é", "f" * 64, "0F", " ab", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", up._pack("t").alias("b"))
    got = df.select("t", "b", up._unpack("b").alias("u")).collect()
    assert [r.u for r in got] == texts and len({bytes(r.b) for r in got if r.b is not None}) == 10
    assert len(got[7].b) == 33
