"""Token counts by scanning flat token files for end-of-document identifiers.

``write_token_files`` puts the ids of whole texts, each followed by the separator, into
flat files of fixed-width integers without any index.  ``scan_token_files`` reads such
files in blocks, finds the separators of a block by one vectorised comparison, and
stitches the documents that cross blocks with a prefix scan of the blocks' counts and
last separators (first within stretches of blocks, then over the stretches).

A writer task names its file by a fresh identifier and reports it in the manifest, so a
task that is run again leaves only an unlisted file behind.  Files are opened through
``pyarrow.fs`` by their URI (local or shared mounts, HDFS, object stores).

Defined results: a null or empty text is a document of 0 tokens; ids after a file's last
separator are a document that is not ``ended``; a file's trailing bytes short of one id
are an error; empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .byte_bpe import PieceIds
from .shared import scratch_path, written

SEPARATOR = 50256
WIDTH = 2
BLOCK_IDS = 1 << 20
STRETCH = 1024


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write_token_files(
    docs: DataFrame,
    folder: str,
    ranks: str,
    text: str = "text",
    doc_id: str = "doc_id",
    separator: int = SEPARATOR,
) -> DataFrame:
    """Write the texts' ids to flat files in ``folder``; return the manifest.

    The manifest has file, ordinal and doc_id (which document was written as the
    how-manieth of its file) and ids_upto (the file's ids up to its separator).  Ids have two bytes, little-endian.
    """
    if separator >= 1 << (8 * WIDTH):
        raise ValueError(f"a separator of {separator} does not fit {WIDTH} bytes")

    def run(batches: Iterator[pa.RecordBatch]):
        pieces = PieceIds(ranks)
        where, out, name, ids, ordinal = None, None, f"{folder}/{uuid.uuid4().hex}.bin", 0, 0
        end = np.array([separator], dtype="<u2").tobytes()
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    where, path = _open(name)
                    where.create_dir(path.rpartition("/")[0], recursive=True)
                    out = where.open_output_stream(path)
                texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
                ends = []
                for packed in pieces.encode(texts):
                    own = np.frombuffer(packed, dtype="<u4").astype("<u2")
                    out.write(own.tobytes() + end)
                    ids += len(own) + 1
                    ends.append(ids)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * n, pa.string()),
                        pa.array(range(ordinal, ordinal + n), pa.int64()),
                        batch.column("doc_id"),
                        pa.array(ends, pa.int64()),
                    ],
                    ["file", "ordinal", "doc_id", "ids_upto"],
                )
                ordinal += n
        finally:
            if out is not None:
                out.close()

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    made = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"file string, ordinal long, doc_id {kind}, ids_upto long"
    )
    return written(made, "token-manifest")


def scan_token_files(
    spark: SparkSession,
    files: DataFrame,
    separator: int = SEPARATOR,
    width: int = WIDTH,
    block_ids: int = BLOCK_IDS,
    stretch: int = STRETCH,
) -> DataFrame:
    """Return file, ordinal, start, n_tokens, ended for every document in ``files``.

    ``files`` has the column ``file``.  Lengths come from the file system.
    """
    kind = np.dtype(f"<u{width}")

    def blocks(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                where, path = _open(name)
                size = where.get_file_info(path).size
                if size % width:
                    raise ValueError(f"{name} has {size} bytes, not a multiple of {width}")
                n = -(-size // (width * block_ids))
                for k in range(0, n, 10_000):
                    own = range(k, min(n, k + 10_000))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own), pa.string()), pa.array(own, pa.int64())], ["file", "block"]
                    )

    def scan(batches):
        for batch in batches:
            for name, b in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
                where, path = _open(name)
                with where.open_input_file(path) as f:
                    f.seek(b * block_ids * width)
                    ids = np.frombuffer(f.read(block_ids * width), dtype=kind)
                at = np.flatnonzero(ids == separator).astype(np.int64) + b * block_ids
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        pa.array([b], pa.int64()),
                        pa.array([b * block_ids + len(ids)], pa.int64()),
                        pa.array([at], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "upto", "ends"],
                )

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = written(
        files.select("file")
        .mapInArrow(blocks, "file string, block long")
        .repartition(tasks, "file", "block")
        .mapInArrow(scan, "file string, block long, upto long, ends array<long>"),
        "token-blocks",
    )
    each = found.select(
        "file",
        "block",
        F.floor(F.col("block") / stretch).alias("stretch"),
        F.size("ends").cast("long").alias("n"),
        F.try_element_at("ends", F.lit(-1)).alias("last"),
        "upto",
    )
    # the prefix scan: stretches of blocks, then the blocks of a stretch
    over = W.partitionBy("file").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    stretches = each.groupBy("file", "stretch").agg(
        F.sum("n").alias("n"), F.max("last").alias("last"), F.max("upto").alias("upto")
    )
    stretches = stretches.select(
        "file",
        "stretch",
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("seen0"),
        F.max("last").over(over).alias("last0"),
    )
    within = W.partitionBy("file", "stretch").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = each.select(
        "file",
        "block",
        "stretch",
        F.coalesce(F.sum("n").over(within), F.lit(0)).alias("seen1"),
        F.max("last").over(within).alias("last1"),
    ).join(stretches, ["file", "stretch"])
    carried = carried.select(
        "file",
        "block",
        (F.col("seen0") + F.col("seen1")).alias("seen"),
        F.coalesce("last1", "last0", F.lit(-1)).alias("before"),
    )
    size = each.groupBy("file").agg(F.max("upto").alias("size"))
    joined = found.join(carried, ["file", "block"]).join(size, "file")
    tail = (F.col("upto") == F.col("size")) & (F.coalesce(F.try_element_at("ends", F.lit(-1)), "before") < F.col("size") - 1)
    # a last stretch without a separator ends, unfinished, at the file's size
    ends = F.when(tail, F.concat("ends", F.array("size"))).otherwise(F.col("ends"))
    starts = F.slice(F.concat(F.array("before"), ends), F.lit(1), F.size(ends))
    return (
        joined.select("file", "seen", "size", F.posexplode(F.arrays_zip(starts.alias("after"), ends.alias("end"))).alias("k", "doc"))
        .select(
            "file",
            (F.col("seen") + F.col("k")).alias("ordinal"),
            (F.col("doc.after") + 1).alias("start"),
            (F.col("doc.end") - F.col("doc.after") - 1).alias("n_tokens"),
            (F.col("doc.end") < F.col("size")).alias("ended"),
        )
    )


def count_tokens(docs: DataFrame, ranks: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, n_tokens, ended of each text, by way of flat token files."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, scratch_path(spark, "tokens"), ranks, text, doc_id)
    scanned = scan_token_files(spark, manifest.select("file").distinct())
    return manifest.join(scanned, ["file", "ordinal"]).select("doc_id", "n_tokens", "ended")
