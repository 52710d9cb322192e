"""Exact duplicate groups by distributed MSD radix partitioning.

Texts are split by their byte length and then by successive runs of bytes, most
significant first.  After each round a group with one row is finished, and so is a
group whose texts have ended: all bytes were compared, so its texts are equal and no
digest is needed.  Only the other rows go on to the next run, which is ``growth`` times
longer.  A round is one aggregation of (group, run) and one join of the rows with the
groups of two or more, which AQE splits when a group is hot.

Defined results: a null text counts as empty; rows that repeat a doc_id within a group
keep one row (the last by file and row); a null doc_id sorts below all others; an empty table
gives an empty result; other columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import body, free_name, numbered, scratch_path

FIRST_RUN = 64
GROWTH = 16
LONGEST_RUN = 1 << 22


def radix_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    carry: tuple[str, ...] | None = None,
    first_run: int = FIRST_RUN,
    growth: int = GROWTH,
    longest_run: int = LONGEST_RUN,
) -> DataFrame:
    """Return ``row`` (the carried columns), doc_id, keep_id, group_size, kept, text_sha256.

    ``carry`` defaults to no column.
    """
    spark = docs.sparkSession
    carried = tuple(carry or ())
    data = body(text)
    number = free_name(docs, "__uid")
    state = numbered(docs, number).select(
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(number).alias("uid"),
        F.struct(F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("row")).alias("gid"),
        F.octet_length(data).cast("long").alias("size"),
        F.unhex(F.sha2(data, 256)).alias("digest"),
        data.alias("bytes"),
    )
    start, run, tables, rounds = 0, first_run, [], 0
    root = scratch_path(spark, "radix")
    while True:
        keyed = state.withColumn("digit", F.substring("bytes", start + 1, run))
        keys = ["gid", "size", "digit"]
        many = (
            keyed.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.max(F.struct("doc_id", "uid")).alias("top"),
                F.min("uid").alias("next_gid"),
            )
            .filter("n > 1")
        )
        many.write.parquet(f"{root}/groups-{rounds}")
        many = spark.read.schema(many.schema).parquet(f"{root}/groups-{rounds}")
        ended = F.col("size") <= start + run
        done = F.col("n").isNull() | ended
        # a sort-merge join whatever the size: its hot keys can be split
        split = keyed.join(many.hint("merge"), keys, "left").select(
            "row",
            "doc_id",
            "uid",
            F.coalesce("next_gid", "gid").alias("gid"),
            "size",
            "digest",
            F.when(~done, F.col("bytes")).alias("bytes"),
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            (F.col("n").isNull() | (F.col("top.uid") == F.col("uid"))).alias("kept"),
            done.alias("done"),
        )
        path = f"{root}/round-{rounds}"
        split.write.partitionBy("done").parquet(path)
        table = spark.read.schema(split.schema).parquet(path)
        tables.append(table.filter("done"))
        state = table.filter("NOT done").select("row", "doc_id", "uid", "gid", "size", "digest", "bytes")
        if state.isEmpty():
            break
        start, run, rounds = start + run, min(run * growth, longest_run), rounds + 1
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.select(
        "row", "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def radix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts, all columns."""
    groups = radix_groups(docs, text, doc_id, carry=tuple(docs.columns))
    return groups.filter("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
