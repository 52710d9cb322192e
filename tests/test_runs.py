"""Whole runs and reports: ordered positions, apportionment, retention, ingest with marks, sketches, evidence."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal as D
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import ingest as ig
from ledgerlake.operators import ops_metrics as om
from ledgerlake.operators import ordering as od
from ledgerlake.operators import retention as rt
from ledgerlake.operators import upsert as up
from ledgerlake.operators import views as vw

from .test_sources import H1, _write


def test_positions_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(9)]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = od.with_position(df, [F.col("a").desc_nulls_first(), F.col("b").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 501))
    assert od.with_position(df.limit(0), [F.col("a").asc()]).count() == 0


def test_parts_sum_to_the_cent(spark):
    rng = random.Random(8)
    parts, totals = [], []
    for k in range(60):
        for c in "abcdef"[: rng.randint(1, 6)]:
            parts.append((k, c, D(rng.randint(-500, 3000)).scaleb(-2)))
        totals.append((k, D(rng.randint(-100_000, 900_000)).scaleb(-3)))
    parts += [(99, "a", D("1.005")), (99, "b", D("-1.005"))]
    totals.append((99, D(7)))
    p = spark.createDataFrame(parts, "k int, category string, cost decimal(14,6)")
    t = spark.createDataFrame(totals, "k int, total decimal(14,6)")
    got = vw.apportioned(p, t, ["k"]).collect()
    for k, total in totals[:-1]:
        mine = [r for r in got if r.k == k]
        whole = sum(c for j, _, c in parts if j == k)
        assert len(mine) == sum(j == k for j, _, _ in parts)
        if whole:
            assert sum(r.part for r in mine) == mine[0].total
            for r in mine:  # less than a cent from the exact share
                assert abs(Fraction(r.part) - Fraction(r.total) * Fraction(r.cost) / Fraction(whole)) < Fraction(1, 100)
    assert sorted(r.part for r in got if r.k == 99) == [D("-1.01"), D("1.01")]


def test_expired_partitions_go_and_others_stay(spark, tmp):
    path = f"{tmp}/t"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)] + [None]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(days)], "v int, event_date date")
    up.replace_slices(df, path, ["event_date"])
    name = rt.register(spark, path, df.schema, "event_date")
    kept = {f: os.listdir(f"{path}/{f}") for f in os.listdir(path) if f.endswith(("-03", "__"))}
    assert rt.drop_expired(spark, path, name, "event_date", "2024-01-04", days=1) == ["2024-01-01", "2024-01-02"]
    assert {f: os.listdir(f"{path}/{f}") for f in os.listdir(path) if "=" in f} == kept and len(kept) == 2
    assert sorted(r.v for r in spark.table(name).collect()) == [2, 3]
    assert rt.drop_expired(spark, path, name, "event_date", "2024-01-04", days=1) == []
    with pytest.raises(ValueError):
        rt.drop_expired(spark, path, name, "event_date", "2024-01-04")


def test_a_lost_run_is_read_again_and_changes_nothing(spark, tmp):
    prefixes = spark.createDataFrame([("UAT", "UAT"), ("POC", "POC")], "prefix string, account_id string")
    line = "\n2025-02,2025-02-03,t,ecs,n,s,{},{}"
    _write(f"{tmp}/in/UAT/a.csv", H1 + line.format("i-1", "1.00") + line.format("i-2", "x"))
    _write(f"{tmp}/in/POC/b.csv", H1 + line.format("i-3", "3.00"))

    def run(before_marks=None):
        return ig.ingest_changed(spark, f"{tmp}/in", prefixes, f"{tmp}/fact", f"{tmp}/marks", before_marks=before_marks)

    def held():
        return sorted((r.account_id, r.instance_id, r.amount) for r in spark.read.parquet(f"{tmp}/fact").collect())

    def lose():
        raise RuntimeError("lost")

    want = [("POC", "i-3", D(3)), ("UAT", "i-1", D(1))]
    with pytest.raises(RuntimeError):
        run(lose)
    assert held() == want and ig.read_marks(spark, f"{tmp}/marks")[1] == 0
    assert run() == 2 and held() == want
    assert run() == 0  # nothing is newer than the marks
    _write(f"{tmp}/in/POC/b.csv", H1 + line.format("i-3", "9.00"))
    os.utime(f"{tmp}/in/POC/b.csv", (2_000_000_000, 2_000_000_000))
    assert run() == 1 and held() == [("POC", "i-3", D(9)), ("UAT", "i-1", D(1))]
    marks, version = ig.read_marks(spark, f"{tmp}/marks")
    assert version == 2 and marks.filter("account_id = 'POC'").first().max_object_last_modified.year == 2033


def test_sketches_of_a_hot_key_hold_their_rank(spark):
    n = 60_000
    t = dt.datetime(2024, 1, 1)
    logs = spark.range(n).select(
        (F.lit(t) + F.make_dt_interval(secs=F.col("id") % 7200)).alias("timestamp"), F.lit("hot").alias("service"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("latency_ms"),
    ).repartition(6)
    sketches = om.latency_sketches(logs)
    assert sketches.count() == 2
    (r,) = om.merged_quantiles(sketches, ("service",)).collect()
    assert r.n == n
    values = sorted(x.latency_ms for x in logs.collect())
    for q, v in ((0.5, r.p50), (0.95, r.p95), (0.99, r.p99)):
        rank = sum(x <= v for x in values) / n
        assert abs(rank - q) <= 2 * om.RANK_ERROR


def test_evidence_of_several_shapes(spark):
    rows = [("a", '{"m":{"b":"x"}}'), ("a", '{"m":{"b":1}}'), ("a", '{"m":{}}'), ("a", "{broken"), ("a", None), ("b", "[1]"), ("b", '{"m":{"b":null}}')]
    df = spark.createDataFrame(rows, "k string, j string")
    got = {(r.k, r.field, r.bad_json): r.n for r in om.evidence_counts(df, "j", "$.m.b", ("k",)).collect()}
    assert got == {("a", "x", False): 1, ("a", "1", False): 1, ("a", None, False): 2, ("a", None, True): 1, ("b", None, False): 2}
    shapes = {r.k: r.shape for r in om.evidence_schema(df.filter("k = 'a'"), "j", ("k",)).collect()}
    assert "OBJECT<m: OBJECT<b: VARIANT>>" in shapes["a"]
