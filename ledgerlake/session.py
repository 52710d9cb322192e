"""Session settings and the shared staging folder.

Every job in the package runs with the session time zone pinned to UTC and ANSI
mode on (Spark 4 default), so decimal overflow raises instead of wrapping and date
arithmetic matches the reference's timestamp-without-zone columns.

Staging: derived tables that several queries read (the billing line items built from
the driver tables, for instance) are written once to the folder named by the
session's ``spark.checkpoint.dir`` and read back.  A written table survives executor
loss, cuts lineage, and gives later queries partition pruning on ``billing_cycle``.
Only when that setting is unset (tests, local runs) do we create a folder of our own.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app: str = "ledgerlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package's settings.

    ``shuffle_partitions`` defaults to 8 for local masters; on a cluster leave it to
    the deployment (AQE coalesces small partitions at runtime either way).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is None and (master or "local").startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_settings(spark)
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on an existing session (idempotent)."""
    for k in (
        "spark.sql.session.timeZone",
        "spark.sql.ansi.enabled",
        "spark.sql.adaptive.enabled",
        "spark.sql.sources.partitionOverwriteMode",
    ):
        spark.conf.set(k, _BASE_CONF[k])


#: Partitions a shuffle is cut into before AQE merges the small ones; with more of them a
#: map task would hold its output in memory and sort it (``spark.shuffle.sort.bypassMergeThreshold``).
SHUFFLE_PARTITIONS = 200


def size_tasks(spark: SparkSession) -> None:
    """Let AQE size the tasks behind a shuffle by their bytes, whatever the session's default.

    With a default of few shuffle partitions a task's rows grow with the input.  A shuffle
    starts from ``SHUFFLE_PARTITIONS`` or more, and AQE merges them up to its advisory size.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(SHUFFLE_PARTITIONS, parts)))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a write's shuffle files are deleted when the write ends.

    They would stay until the driver's garbage collector meets them.  For jobs that write:
    their plans run once.
    """
    prev = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, prev)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Kept as a URI (``file:`` too: a mount that driver and executors share).  When unset we
    only make our own on a local master; a cluster must name a shared folder, since a
    machine-local one is lost with its executor.
    """
    sc = spark.sparkContext
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup errors on odd sessions
        root = None
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if not root:
        if not local:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for staged tables"
            )
        root = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir="/tmp")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A hash of the inputs' files (path, length, modification time), on any file system.

    Fails when an input cannot be listed: a stale staged copy is never used unseen.
    """
    h = hashlib.sha1()
    for path in sorted(paths):
        p, fs = _path(spark, path)
        h.update(path.encode())
        files = fs.listFiles(p, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("|".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists; any error but absence is raised."""
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens where there is none."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows dealt by ``columns`` for a partitioned write, in tasks of a bounded size.

    A rebalance: rows of one value come together, values of few rows share a task, and one
    of many (a cycle that holds a third of all rows) is cut into as many tasks as its bytes
    need (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), at any size of the table.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def packed(df: DataFrame) -> DataFrameWriter:
    """A writer that packs Parquet as zstd, whatever the session's codec.

    For what is stored or staged: a hex key takes half of the room that snappy leaves it.
    """
    return df.write.option("compression", _BASE_CONF["spark.sql.parquet.compression.codec"])


_DONE: set[str] = set()
_LOCK = threading.RLock()  # one builder per process for a staged path


def _staged_path(spark: SparkSession, name: str, inputs: Sequence[str]) -> str:
    return f"{checkpoint_root(spark)}/staged/{name}-{_fingerprint(spark, inputs)}"


def is_staged(spark: SparkSession, name: str, inputs: Sequence[str]) -> bool:
    """Whether ``stage`` has written ``name`` of these inputs already."""
    return path_exists(spark, f"{_staged_path(spark, name, inputs)}.done")


def stage(
    spark: SparkSession,
    name: str,
    inputs: Sequence[str],
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    dealt: bool = False,
) -> DataFrame:
    """Write ``build()`` once per input fingerprint under the checkpoint root, read it back.

    The written table replaces the lineage of the joins that built it.  A finished
    write is followed by a marker folder ``<path>.done``; without it (a lost job) the
    folder is simply rewritten.  Finished paths are remembered for the process.

    Rows are dealt by the partition columns, and a partition value of many rows is cut into
    tasks by its bytes (``spread_by``); the input is evaluated once (range partitioning
    would sample it first).  ``dealt``: ``build()`` has dealt them already.
    """
    path = _staged_path(spark, name, inputs)
    marker = f"{path}.done"
    with _LOCK:
        if path not in _DONE and not path_exists(spark, marker):
            with short_shuffles(spark):
                _build_staged(spark, path, marker, build, () if dealt else partition_by, partition_by, sort_within)
        _DONE.add(path)
    return spark.read.parquet(path)


def _build_staged(spark, path, marker, build, deal_by, partition_by, sort_within) -> None:
    df = build()
    if deal_by:
        df = spread_by(df, deal_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = packed(df).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    spark.range(1).selectExpr("'ok' AS value").write.mode("overwrite").text(marker)


def land(spark: SparkSession, name: str, inputs: Sequence[str], write: Callable[[str], None]) -> str:
    """Run ``write(path)`` once per input fingerprint under the checkpoint root.

    For derived files in other formats than Parquet (CSV exports, JSON feeds, log
    folders); same marker rule as ``stage``.  Returns the folder.
    """
    path = f"{checkpoint_root(spark)}/landed/{name}-{_fingerprint(spark, inputs)}"
    marker = f"{path}.done"
    with _LOCK:
        if path not in _DONE and not path_exists(spark, marker):
            with short_shuffles(spark):
                write(path)
            spark.range(1).selectExpr("'ok' AS value").write.mode("overwrite").text(marker)
        _DONE.add(path)
    return path
