"""Every catalog query against its DuckDB SQL on the sf0.001 driver tables
(SURVEY section 5 layer b), plus the entry contract."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from ledgerlake.plans import load_all  # noqa: E402

from .conftest import SF_SMALL  # noqa: E402

CAT = load_all()


@pytest.fixture(scope="module")
def duck():
    import oracle_check

    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(CAT))
def test_query_matches_oracle(spark, duck, name):
    import oracle_check

    r = oracle_check.check(spark, duck, CAT[name], SF_SMALL)
    assert r["status"] in ("OK", "rows-only"), r


def test_entry_contract(spark):
    import importlib.util

    p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", p)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    df = m.entry(spark)
    assert df.count() > 0
    assert set(m.oracle_sql()) <= set(m.queries())
