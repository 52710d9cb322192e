"""Property tests of the write-path invariants:
upsert twice = once; additive upsert is order-free; latest-per-key ignores row order."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import upsert as up

SCHEMA = "k string, v decimal(14,6), ts timestamp_ntz"
rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.integers(-500, 500).map(lambda x: D(x) / 100),
        st.integers(0, 3).map(lambda h: dt.datetime(2025, 1, 1, h)),
    ),
    max_size=8,
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _set(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(old=rows, new=rows)
def test_upsert_twice_equals_once(spark, old, new):
    o, n = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    once = up.upsert_latest(o, n, ["k"], ["ts"])
    assert _set(up.upsert_latest(once, n, ["k"], ["ts"])) == _set(once)


@SETTINGS
@given(base=rows, a=rows, b=rows)
def test_additive_upsert_is_order_free(spark, base, a, b):
    o, x, y = (spark.createDataFrame(r, SCHEMA).drop("ts") for r in (base, a, b))
    ab = up.upsert_add(up.upsert_add(o, x, ["k"], ["v"]), y, ["k"], ["v"])
    ba = up.upsert_add(up.upsert_add(o, y, ["k"], ["v"]), x, ["k"], ["v"])
    assert _set(ab) == _set(ba)


@SETTINGS
@given(data=rows)
def test_latest_per_key_ignores_row_order(spark, data):
    fwd = up.latest_per_key(spark.createDataFrame(data, SCHEMA), ["k"], ["ts"])
    rev = up.latest_per_key(spark.createDataFrame(list(reversed(data)), SCHEMA).repartition(3), ["k"], ["ts"])
    assert _set(fwd) == _set(rev)
