"""Cleaning: legacy accounts, schema conform, cycle checks (PRJ2-PRJ6, JN1, FLT10).

Order matters: drop shadowed empty accounts (JN1) **before** mapping the legacy
empty account to 'POC' (PRJ2), or '' and 'POC' rows of one cycle collide on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cycles import normalize_cycle, valid_cycle
from ..functions.keys import legacy_account


def drop_shadowed_empty(df: DataFrame, period_key: str) -> DataFrame:
    """JN1: delete rows with an empty account where a non-empty account exists for
    the same period (cycle for monthly_raw, date for daily_raw); keep lone empties.

    The correlated EXISTS becomes a left-anti join against the distinct periods that
    have a real account (one row per period: small, and AQE broadcasts it).
    """
    empty = F.coalesce(F.col("account_id"), F.lit("")) == ""
    real_periods = df.filter(~empty).select(period_key).distinct()
    empties = df.filter(empty).join(real_periods, period_key, "left_anti")
    return df.filter(~empty).unionByName(empties.select(*df.columns))


def map_legacy_account(df: DataFrame) -> DataFrame:
    """PRJ2 on a table: NULL or '' account -> 'POC'."""
    return df.withColumn("account_id", legacy_account("account_id"))


def fill_empty_account(df: DataFrame) -> DataFrame:
    """PRJ3: NULL account -> ''."""
    return df.fillna({"account_id": ""})


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """PRJ4/PRJ5: shape ``df`` to ``schema``: cast present columns, add absent ones.

    A SQL column default fills an *absent* column, not an explicit NULL, so defaults
    apply only to columns missing from ``df``; present NULLs stay NULL.
    """
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def split_cycles(df: DataFrame, cycle_col: str = "billing_cycle") -> tuple[DataFrame, DataFrame]:
    """PRJ6 + FLT10: normalise ``YYYYMM`` to ``YYYY-MM``, then split (good, rejected).

    Rejected rows keep their raw cycle and carry ``reject_reason``; nothing is dropped
    silently.
    """
    norm = df.withColumn(cycle_col, normalize_cycle(cycle_col))
    ok = valid_cycle(cycle_col)
    good = norm.filter(ok)
    bad = norm.filter(~ok).withColumn("reject_reason", F.lit("cycle is not yyyy-MM"))
    return good, bad


def with_cycle_check(df: DataFrame, cycle_col: str = "billing_cycle") -> DataFrame:
    """PRJ6 + FLT10 as columns: ``cycle_normalized`` and ``cycle_valid``."""
    n = normalize_cycle(cycle_col)
    return df.withColumn("cycle_normalized", n).withColumn("cycle_valid", valid_cycle(n))
