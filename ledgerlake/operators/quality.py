"""Data-quality reports (Q6, Q7, JN7).

``constraints`` checks, in one pass of conditional aggregates per table, the rules
the reference's DDL enforces and Spark does not: NOT NULL, VARCHAR lengths, decimal
precision of the stored columns; plus duplicate keys through a second (partial,
skew-safe) aggregation on the key.  Output is long: one row per (table, rule, column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import DECIMAL_BOUNDS, KEYS, MAX_LENGTH, NOT_NULL


def _rules(table: str, cols: Sequence[str]) -> list[tuple[str, str, Column]]:
    out: list[tuple[str, str, Column]] = []
    for c in NOT_NULL.get(table, ()):
        if c in cols:
            out.append(("not_null", c, F.col(c).isNull()))
    for c, n in MAX_LENGTH.get(table, {}).items():
        if c in cols:
            out.append(("max_length", c, F.length(F.col(c)) > n))
    for c, (p, s) in DECIMAL_BOUNDS.get(table, {}).items():
        if c in cols:
            out.append(("decimal_overflow", c, F.abs(F.col(c)) >= F.lit(10 ** (p - s)).cast("decimal(38,0)")))
    return out


def constraints(df: DataFrame, table: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Q6: violation counts per rule for ``df`` checked as table ``table``.

    Rows: (table_name, rule, column_name, violations).  ``duplicate_key`` counts rows
    beyond the first per key (a key seen 3 times adds 2).
    """
    rules = _rules(table, df.columns)
    parts: list[DataFrame] = []
    if rules:
        agg = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_r, _c, cond) in enumerate(rules)])
        arr = F.array(
            *[
                F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), F.col(f"r{i}").alias("violations"))
                for i, (r, c, _cond) in enumerate(rules)
            ]
        )
        parts.append(agg.select(F.lit(table).alias("table_name"), F.inline(arr)))
    key = list(keys or KEYS.get(table, ()))
    if key:
        dup = (
            df.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("violations"))
            .select(
                F.lit(table).alias("table_name"),
                F.lit("duplicate_key").alias("rule"),
                F.lit(",".join(key)).alias("column_name"),
                "violations",
            )
        )
        parts.append(dup)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


REPORT = "table_name string, rule string, column_name string, violations long"


def write_checked(df: DataFrame, table: str, path: str) -> DataFrame:
    """Q6 in the write: write ``df`` as ``table`` and report its violated rules, in one scan.

    The counts are metrics that the writing job itself gathers (``Observation``); rows are
    written as they are.  NOT NULL, length and precision rules; keys need ``constraints``,
    references ``foreign_key``.
    """
    rules = _rules(table, df.columns)
    seen = Observation(f"rules of {table}")
    counts = [F.count_if(cond).alias(f"r{i}") for i, (_r, _c, cond) in enumerate(rules)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(path)
    found = seen.get
    rows = [(table, r, c, int(found[f"r{i}"])) for i, (r, c, _cond) in enumerate(rules)]
    return df.sparkSession.createDataFrame(rows, REPORT)


def foreign_key(df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q6: how many rows name a parent that is not there (NULL names none)."""
    lost = df.filter(F.col(column).isNotNull()).join(
        parent.select(F.col(parent_column).alias(column)), column, "left_anti"
    )
    return lost.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("foreign_key").alias("rule"), F.lit(column).alias("column_name"), "violations"
    )


def readiness(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Q7: each required table exists, is readable (a LIMIT 1 read) and has rows.

    One tiny job per table, unioned; a table that cannot be resolved reports
    ``readable = false`` instead of failing the report.
    """
    parts: list[DataFrame] = []
    missing: list[str] = []
    for name, path in tables.items():
        try:
            probe = spark.read.format(fmt).load(path).limit(1)
            parts.append(
                probe.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(name).alias("table_name"), F.lit(True).alias("readable"), (F.col("n") > 0).alias("has_rows")
                )
            )
        except Exception:  # unresolvable path: report, do not fail
            missing.append(name)
    if missing:
        parts.append(
            spark.createDataFrame([(m, False, False) for m in missing], "table_name string, readable boolean, has_rows boolean")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
