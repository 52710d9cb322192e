"""Structured Streaming jobs (ST1-ST6).

The reference runs a nightly ETL with incremental object listing; these are its
incremental semantics as streams:

* ST1 ``stream_exports``: file source over the export folder; each micro-batch holds
  whole files, parsed by the batch parser (``parse_export_lines``) and upserted into
  the fact table (ST2) in ``foreachBatch``.  Spark tracks seen *paths*: an object
  rewritten in place is not picked up again (the batch SRC6 path catches it).
* ST2 ``upsert_batch``: idempotent micro-batch upsert: re-delivery changes nothing.
* ST3 ``stream_corrections``: late and corrected line items as they arrive; the slices they
  touch, and those in which a corrected line lay before, are recomputed and written back.
* ST4/ST5 windowed aggregates with a watermark, emitted in ``update`` mode into an
  append-only log of (key, batch_id) rows; the current result is the latest row per
  key (``latest_per_key``), so a replayed batch after a failure is harmless.
* ST6 ``stream_dedup``: ``dropDuplicatesWithinWatermark`` on the event key.

Checkpoints and outputs live under the session's shared checkpoint folder; a job
resumes from its checkpoint after executor or driver loss.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ops_metrics as om
from ..operators.rollup import daily_rollup, monthly_rollup, with_month
from ..operators.upsert import latest_per_key, replace_slices, upsert_into
from ..session import checkpoint_root, delete_folder, packed, short_shuffles
from ..sources.exports import parse_export_lines, scan_columns


def stream_dirs(spark: SparkSession, name: str, run_id: str | None = None) -> tuple[str, str]:
    """(output folder, checkpoint folder) of a stream run under the shared root."""
    rid = run_id or uuid.uuid4().hex[:12]
    base = f"{checkpoint_root(spark)}/streams/{name}-{rid}"
    return f"{base}/out", f"{base}/_checkpoint"


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "update") -> int:
    """Run a stream over everything available now, through ``foreachBatch``, then stop.

    Returns the rows that came later than the watermark and were left out, over all batches.
    The unit is Spark's: rows at the stateful operator.  Aggregates combine rows per task
    before it, so there one stands for the late rows of a group in a task of a batch.
    """
    dropped: dict[tuple[int, str], int] = {}
    started = threading.Event()

    def note() -> None:
        for p in q.recentProgress:  # the last few batches only, hence noted at every batch
            dropped[p["batchId"], p["timestamp"]] = sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"])

    def noted(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        note()
        sink(batch, batch_id)

    q = (
        df.writeStream.outputMode(mode)
        .foreachBatch(noted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set()
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    note()
    return sum(dropped.values())


def count_late(spark: SparkSession, out: str, late: int) -> None:
    """Record the rows a run left out (unit: ``run_available``) in ``<out>_late``; a batch recompute closes the gap."""
    spark.createDataFrame([(late,)], "late_rows long").write.mode("append").parquet(f"{out}_late")


def append_log(out: str) -> Callable[[DataFrame, int], None]:
    """Sink: write the batch to its own ``batch_id`` folder, so a replay replaces its rows."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return sink


def current_state(spark: SparkSession, out: str, keys: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The latest row per key of an append log (the compacted view of update output)."""
    try:
        log = spark.read.parquet(out)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
    return latest_per_key(log, keys, ["batch_id"]).drop("batch_id")


# ------------------------------------------------------------------ sources
def event_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType,
                 max_files: int | None = None) -> DataFrame:
    """A Parquet file stream with ``ts`` as a zoned timestamp (watermarks need one)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


# ------------------------------------------------------------------ ST1 / ST2
def upsert_batch(path: str, staging_root: str, keys: Sequence[str], order: Sequence[str],
                 partition_col: str, dealt: bool = False) -> Callable[[DataFrame, int], None]:
    """ST2: ``foreachBatch`` sink merging each batch (``dealt`` by slice or not) into the table at ``path``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        staging = f"{staging_root}/batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        upsert_into(batch, path, keys, order, partition_col, staging, dealt=dealt)

    return sink


def stream_exports(spark: SparkSession, root: str, table: str, prefixes: DataFrame | None = None,
                   glob: str = "*.csv", max_files: int | None = None, run_id: str | None = None) -> str:
    """ST1: ingest export CSVs as they land; rows are upserted into the fact table.

    Returns the checkpoint folder.  Rows that fail to parse go to ``<table>_rejected``.
    """
    _out, ckpt = stream_dirs(spark, "exports", run_id)
    r = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    lines = scan_columns(r.text(root))
    run = hashlib.sha1(ckpt.encode()).hexdigest()[:12]  # a replay of the run has the same folder
    merge = upsert_batch(table, f"{ckpt}/staging", ["account_id", "dedup_key"], ["ingested_at"], "billing_cycle", dealt=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows, held = parse_export_lines(batch, prefixes, deal=True), f"{ckpt}/rows/batch-{batch_id}"
        # written, not persisted: cached rows of a large batch take the memory of its merge
        with short_shuffles(batch.sparkSession):
            packed(rows).mode("overwrite").parquet(held)
        rows = batch.sparkSession.read.schema(rows.schema).parquet(held)
        bad = rows.filter(F.col("parse_error").isNotNull())
        bad.write.mode("overwrite").parquet(f"{table}_rejected/run={run}/batch_id={batch_id}")
        merge(rows.filter(F.col("parse_error").isNull()).drop("parse_error"), batch_id)
        delete_folder(batch.sparkSession, held)

    run_available(lines, sink, ckpt, mode="append")
    return ckpt


# ------------------------------------------------------------------ ST3
def correct_slices(items: str, daily: str, monthly: str, overview: Callable[[DataFrame], DataFrame],
                   staging_root: str) -> Callable[[DataFrame, int], None]:
    """ST3: ``foreachBatch`` sink of line items (with a cycle and a booking date).

    The batch is merged into the table ``items``, partitioned by ``slice`` (cycle and
    booking month).  The slices written, which are those of the batch and those its records
    lay in before, name the booking months of ``daily`` and the cycles of ``monthly`` that
    are recomputed, each from its partitions of ``items`` alone; all others keep their
    files.  A replayed batch writes the same slices again.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placed = with_month(batch)
        placed = placed.withColumn("slice", F.concat_ws("_", "billing_cycle", "bill_month")).drop("bill_month")
        touched = upsert_into(
            placed, items, ["record_id"], ["synced_at"], "slice", f"{staging_root}/batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        )
        if not touched:
            return
        cycles, months = ({t.split("_")[k] for t in touched} for k in (0, 1))
        stored = spark.read.parquet(items)
        parts = F.split(F.col("slice").cast("string"), "_")
        # predicates on the partition column: no other partition is opened
        of_months = with_month(daily_rollup(stored.filter(parts[1].isin(sorted(months)))))
        of_cycles = monthly_rollup(overview(stored.filter(parts[0].isin(sorted(cycles)))))
        for table, rows, column, values in ((daily, of_months, "bill_month", months), (monthly, of_cycles, "billing_cycle", cycles)):
            slices = spark.createDataFrame([(v,) for v in sorted(values)], f"{column} string")
            replace_slices(rows, table, [column], slices)

    return sink


def stream_corrections(source: DataFrame, items: str, daily: str, monthly: str,
                       overview: Callable[[DataFrame], DataFrame], checkpoint: str) -> None:
    """ST3: run ``correct_slices`` over the line items that have arrived since the last run."""
    run_available(source, correct_slices(items, daily, monthly, overview, f"{checkpoint}/staging"), checkpoint, mode="append")


# ------------------------------------------------------------------ ST4 / ST5 / ST6
WATERMARK = "10 minutes"  # the default delay of the three jobs


def stream_workload(samples: DataFrame, out: str, checkpoint: str, delay: str = WATERMARK) -> None:
    """ST4: hourly tumbling CPU metrics per workload (max, p95, avg, samples)."""
    agg = (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 hour").alias("w"), "namespace", "workload_name")
        .agg(
            F.max("cpu_usage").alias("max_cpu_usage"),
            om.percentile("cpu_usage", 0.95, "decimal(10,4)").alias("p95_cpu_usage"),
            F.sum("cpu_usage").alias("_sum"),
            F.count(F.lit(1)).alias("samples"),
        )
        .select(
            F.col("w.start").alias("time_bucket"), "namespace", "workload_name", "max_cpu_usage", "p95_cpu_usage",
            (F.col("_sum").cast("double") / F.col("samples")).alias("avg_cpu_usage"), "samples",
        )
    )
    count_late(agg.sparkSession, out, run_available(agg, append_log(out), checkpoint, mode="update"))


def stream_errors(logs: DataFrame, out: str, checkpoint: str, bucket: str = "1 hour", delay: str = WATERMARK) -> None:
    """ST5: error counts per tumbling bucket and service."""
    agg = (
        logs.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", bucket).alias("w"), "service")
        .agg(F.count(F.lit(1)).alias("errors"))
        .select(F.col("w.start").alias("bucket_start"), "service", "errors")
    )
    count_late(agg.sparkSession, out, run_available(agg, append_log(out), checkpoint, mode="update"))


def stream_dedup(events: DataFrame, keys: Sequence[str], out: str, checkpoint: str,
                 delay: str = WATERMARK) -> None:
    """ST6: drop re-delivered events (same key within the watermark delay)."""
    d = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
    count_late(d.sparkSession, out, run_available(d, append_log(out), checkpoint, mode="append"))
