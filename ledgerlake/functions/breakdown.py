"""Product breakdowns: map shape, array shape, flatten, conform (PRJ14-PRJ16).

Two JSON shapes occur in the reference: a map ``{"product": amount}`` and an array
``[{"product", "amount", "pct"}]``.  The map is the canonical in-memory shape
(``map<string, decimal(38,6)>``); the array is built from it for the bill summary.

Building a map is a two-step roll-up: first sum per (keys, product) — a partial
aggregation that pre-combines hot keys map-side — then collect at most one entry per
product for each key.  The collected list is bounded by the number of distinct
products, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = "decimal(38,6)"
BREAKDOWN_TYPE = T.MapType(T.StringType(), T.DecimalType(38, 6))


def breakdown_entries(product: Column, amount: Column) -> Column:
    """One sortable map entry; use inside ``collect_list`` after a per-product sum."""
    return F.struct(product.alias("key"), amount.cast(AMOUNT).alias("value"))


def map_from_entries_sorted(entries: Column) -> Column:
    """Deterministic map (keys sorted) from collected entries."""
    return F.map_from_entries(F.array_sort(entries))



def flatten_breakdown(df: DataFrame, col: str, key_name: str = "product_code", value_name: str = "amount") -> DataFrame:
    """PRJ15: one row per map entry (``explode``); the other columns are kept."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(F.col(col)).alias(key_name, value_name))


def breakdown_sum(col: Column | str) -> Column:
    """PRJ15 without exploding: ``Σ map_values`` via ``aggregate``."""
    m = F.col(col) if isinstance(col, str) else col
    return F.aggregate(F.map_values(m), F.lit(0).cast(AMOUNT), lambda acc, x: (acc + x).cast(AMOUNT))


def breakdown_array(m: Column | str, total: Column | str) -> Column:
    """PRJ14 array shape: ``[{product, amount, pct}]`` with pct = amount / total * 100.

    20000 of 50000 gives pct 40.0.  pct is a double; NULL when the total is 0.
    """
    mc = F.col(m) if isinstance(m, str) else m
    tc = F.col(total) if isinstance(total, str) else total
    return F.transform(
        F.map_entries(mc),
        lambda e: F.struct(
            e["key"].alias("product"),
            e["value"].alias("amount"),
            (F.try_divide(e["value"].cast("double"), tc.cast("double")) * F.lit(100.0)).alias("pct"),
        ),
    )


_ARRAY_SHAPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("product", T.StringType()),
            T.StructField("amount", T.DecimalType(38, 6)),
            T.StructField("pct", T.DoubleType()),
        ]
    )
)


def conform_breakdown(json_col: Column | str) -> Column:
    """PRJ16: parse either JSON shape into the canonical map.

    ``{}`` -> empty map; an array ``[{"product","amount",...}]`` -> map of product to
    amount; anything else -> NULL.  Both parses are tried; the shape decides which wins.
    """
    j = F.col(json_col) if isinstance(json_col, str) else json_col
    trimmed = F.ltrim(j)
    as_map = F.from_json(j, BREAKDOWN_TYPE)
    as_array = F.from_json(j, _ARRAY_SHAPE)
    from_array = F.map_from_entries(
        F.transform(as_array, lambda e: F.struct(e["product"].alias("key"), e["amount"].alias("value")))
    )
    return (
        F.when(trimmed.startswith("["), from_array)
        .when(trimmed.startswith("{"), as_map)
    )
