"""Mixing sources to target weights by cutting each source's random order at its budget.

Sources in code-point order (null last) take the weights in turn and share a total of
words by them; a target stops at ``most`` times its source's words and what is over is
shared again by weight until no target is above.  Within a source the documents are
sorted by a hash-random key.  The rows lie range-sorted by (source, key) in parts of near
equal size, so a source of any size spreads over many; running totals of words within a
part, and of whole parts before it, give every document its place in its source.  The mix
takes the source as often as its budget holds it whole, then once more up to the word at
which the budget ends: the document there is taken in part.

DataFrame functions alone.  Tables of one row for each part and source are joined without
a hint; the driver holds a few sums.

Defined results: a null text has no words; null sources are one source; the key hangs on
the doc_id (null: empty) and the text, so reruns agree; rows alike in all columns take
what their places give, one with another; a source without words takes none; an empty
table gives an empty result; other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import body, written

WEIGHTS = (3, 1, 2)
ROWS_A_PART = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def waterline(sources: DataFrame, total: float) -> float:
    """Words for each unit of weight, where targets stop at ``cap`` and share ``total``.

    A round takes the sources that the level of the last one fills as full, and shares
    what they leave among the others; the level only rises, so it ends.
    """
    level, full = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        n, left, weight = sources.agg(
            F.count_if(over),
            F.lit(total) - F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if n == full or not weight:
            return level
        level, full = left / weight, n


def mix_sources(
    docs: DataFrame,
    share: float = 1.5,
    weights: Sequence[int] = WEIGHTS,
    most: float = 2.0,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    rows_a_part: int = ROWS_A_PART,
) -> DataFrame:
    """Return doc_id, source, size, source_size, target, epochs, taken for each row.

    ``share`` is the mix's size as a multiple of all words, ``epochs`` how often the whole
    source is in the mix.
    """
    spark = docs.sparkSession
    data = body(text)
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(data))
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).isNull().alias("unnamed"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
            F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
            F.monotonically_increasing_id().alias("turn"),  # parts rows that are alike
        ),
        "mix-rows",
    )
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_a_part))
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("turn")]
    parts = written(
        rows.repartitionByRange(n_parts, "unnamed", "source", *order).withColumn("part", F.spark_partition_id()),
        "mix-parts",
    )
    which = ["unnamed", "source"]
    sums = written(parts.groupBy(*which, "part").agg(F.sum("size").alias("words")), "mix-sums")
    sources = _weighted(sums, weights).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    sources = written(sources, "mix-sources")
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = waterline(sources, words * share)
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    budget = F.round("target").cast("long")
    sources = sources.withColumn("target", target).select(
        *which,
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.expr("CAST(round(target) AS BIGINT) div source_size")).otherwise(0).alias("epochs"),
        budget.alias("budget"),
    )
    before = F.sum("words").over(W.partitionBy(*which).orderBy("part")) - F.col("words")
    places = written(sums.select(*which, "part", before.alias("before")).join(sources, which), "mix-places")
    upto = F.sum("size").over(W.partitionBy("part", *which).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    placed = parts.withColumn("upto", upto).join(places, ["part", *which])
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    start = F.col("before") + F.col("upto") - F.col("size")
    cut = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - start))
    return placed.select(
        "doc_id",
        F.when(~F.col("unnamed"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        "epochs",
        (F.col("epochs") * F.col("size") + cut).alias("taken"),
    )


def _weighted(sums: DataFrame, weights: Sequence[int]) -> DataFrame:
    """The sources with source_size and the weight that their place in the order gives.

    The parts lie in the order of the sources: a source's place is its place among those
    that begin in the same part after those that begin in parts before.
    """
    first = sums.groupBy("unnamed", "source").agg(F.min("part").alias("part"), F.sum("words").alias("source_size"))
    # one row for each part
    begun = first.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    begun = begun.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("earlier"))
    here = F.row_number().over(W.partitionBy("part").orderBy("unnamed", "source")) - 1
    turn = F.pmod(F.col("earlier") + F.col("here"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1)
    return (
        first.withColumn("here", here).join(begun, "part").select("unnamed", "source", "source_size", weight.alias("weight"))
    )
