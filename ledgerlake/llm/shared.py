"""Helpers shared by the operators: scratch tables in the shared folder, body column.

Scratch tables replace lineage where a later step reads a result more than once.  They
live under ``spark.checkpoint.dir`` (shared by driver and executors), so a lost
executor never takes one with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..session import checkpoint_root


def shared_root(spark: SparkSession) -> str:
    """The shared folder as the session names it; a local session without one gets its own.

    With its scheme, so that code which opens files itself meets the file system that Spark
    resolves the name against, not an executor's own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = spark._jvm.org.apache.hadoop.fs.Path(named.rstrip("/") if named else checkpoint_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a new scratch table and read it back (empty tables included)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str = "uid") -> DataFrame:
    """``docs`` with a number for each row that every later scan gives again.

    It is the row's place: its file (hashed) and its index in that file.  Unlike a number
    made in the task it does not hang on how files are split, which changes with the
    executors at hand.  Rows that are not read from Parquet files are written first.
    """

    def place(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(
            name, F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row"))
        )

    try:
        out = place(docs)
        out.schema  # noqa: B018  (the analysis tells whether there are files)
        return out
    except AnalysisException:
        return place(written(docs, "numbered"))


UID = "struct<file:bigint,row:bigint>"


def body(text: str | Column) -> Column:
    """The text as bytes; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("binary"), F.lit(b""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
