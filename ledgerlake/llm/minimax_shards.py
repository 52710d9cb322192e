"""Shards of near equal bytes: minimax contiguous partition of ordered atomic groups.

Groups (rows with equal texts) are ordered by their first doc_id, and their sizes summed
to running totals in blocks of the order.  A binary search finds the smallest capacity
for which greedy filling needs no more than ``shards`` shards; the cuts are those of
that filling.  A greedy step asks for the last running total up to a bound: the driver
holds the totals of the blocks (one number for each) and fetches the running totals of
the few blocks in which a bound falls.

Defined results: a null text counts as empty and has size 1; a null doc_id sorts first;
fewer groups than shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import body, written

GROUPS_A_BLOCK = 200_000


def smallest_capacity(total: int, largest: int, shards: int, reach: Callable[[int], int]) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the running totals at which shards end.

    ``reach(x)`` is the largest running total that is at most ``x``.
    """

    def cuts(capacity: int) -> list[int] | None:
        ends, at = [], 0
        for _ in range(shards):
            at = reach(at + capacity)
            ends.append(at)
            if at == total:
                return ends
        return None

    low, high = max(-(-total // shards), largest), max(total, 1)
    while low < high:
        mid = (low + high) // 2
        if cuts(mid) is None:
            low = mid + 1
        else:
            high = mid
    return low, cuts(low) or []


def minimax_shards(
    docs: DataFrame,
    shards: int = 8,
    text: str = "text",
    doc_id: str = "doc_id",
    groups_a_block: int = GROUPS_A_BLOCK,
) -> DataFrame:
    """Return doc_id, size, text_crc32, shard, slot for each row of ``docs``."""
    spark = docs.sparkSession
    data = body(text)
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            F.unhex(F.sha2(data, 256)).alias("group"),
        ),
        "shard-rows",
    )
    grouped = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first"))
    grouped = written(grouped, "shard-groups")
    n_groups, total, largest = grouped.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))
    ).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(least, -(-n_groups // groups_a_block))
    row_parts = max(least, -(-rows.count() // groups_a_block))  # few groups may have many copies
    blocks = written(
        grouped.repartitionByRange(n_parts, F.col("first").asc_nulls_first(), F.col("group")).withColumn(
            "block", F.spark_partition_id()
        ),
        "shard-blocks",
    )
    in_block = W.partitionBy("block").orderBy(F.col("first").asc_nulls_first(), "group")
    sums = written(
        blocks.withColumn("upto", F.sum("bytes").over(in_block.rowsBetween(W.unboundedPreceding, 0))),
        "shard-sums",
    )
    # one row for each block: bounded by the number of blocks
    of_block = sorted((r["block"], r["b"]) for r in sums.groupBy("block").agg(F.sum("bytes").alias("b")).collect())
    ids = [b for b, _ in of_block]
    ends = np.cumsum([n for _, n in of_block], dtype=np.int64).tolist()
    starts = [0, *ends[:-1]]
    held: dict[int, np.ndarray] = {}

    def reach(x: int) -> int:
        if not ends or x < 0:
            return 0
        k = bisect_right(ends, x)
        if k == len(ends):
            return ends[-1]
        if k not in held:
            if len(held) >= 32:
                held.pop(next(iter(held)))
            got = sums.filter(F.col("block") == ids[k]).select("upto").toPandas()["upto"]
            held[k] = np.sort(got.to_numpy(dtype=np.int64))
        i = int(np.searchsorted(held[k], x - starts[k], side="right"))
        return starts[k] + (int(held[k][i - 1]) if i else 0)

    _, cut = smallest_capacity(total, largest, shards, reach)
    offsets = spark.createDataFrame(list(zip(ids, starts)) or [(0, 0)], "block int, before long")
    before = F.col("before") + F.col("upto") - F.col("bytes")
    shard = sum([(before >= F.lit(c)).cast("int") for c in cut[:-1]], F.lit(0))
    placed = sums.join(F.broadcast(offsets), "block").select(
        F.col("group"), F.col("first"), shard.cast("int").alias("shard")
    )
    dealt = rows.join(written(placed, "shard-placed"), "group")
    order = ["shard", F.col("first").asc_nulls_first(), "group", F.col("doc_id").asc_nulls_first()]
    dealt = written(
        dealt.repartitionByRange(row_parts, *order).withColumn("block", F.spark_partition_id()), "shard-dealt"
    )
    counts = dealt.groupBy("block", "shard").agg(F.count(F.lit(1)).alias("n")).collect()
    seen, base = {}, []
    for r in sorted(counts, key=lambda r: (r["shard"], r["block"])):
        base.append((r["block"], r["shard"], seen.get(r["shard"], 0)))
        seen[r["shard"]] = seen.get(r["shard"], 0) + r["n"]
    bases = spark.createDataFrame(base or [(0, 0, 0)], "block int, shard int, base long")
    number = F.row_number().over(W.partitionBy("block", "shard").orderBy(*order[1:]))
    return (
        dealt.withColumn("number", number)
        .join(F.broadcast(bases), ["block", "shard"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("number") - 1).alias("slot"))
    )
