"""Positions in a global order (SRT1, SRT2) without gathering rows in one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``.

    Rows are dealt by ranges of the order and sorted within each; a row's place is its
    place in its range after the rows of the ranges before.  The ranges are written, since
    a scan that is done again must meet the same ones; their sizes (one number each) come
    to the driver.  Rows equal in ``order`` get places in any order among them: name enough
    columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/ordered/{uuid.uuid4().hex}"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(map(tuple, stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()))
    before, upto = [], 0
    for number, n in sizes:
        before.append((number, upto))
        upto += n
    offsets = spark.createDataFrame(before or [(0, 0)], "_part long, _before long")
    return stored.join(F.broadcast(offsets), part == F.col("_part")).select(
        *df.columns, (F.col("_before") + within + 1).alias(name)
    )
