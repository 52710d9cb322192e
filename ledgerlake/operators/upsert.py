"""Idempotent writes without MERGE (SNK1-SNK12, WIN3, WIN4).

Plain Parquet has no ``MERGE INTO``, so every upsert is expressed as a DataFrame:
union or full outer join of old and new, then one row per key.  The logical merge
(``upsert_*``) is separate from the physical write (``replace_slices``), which
overwrites only the touched partitions (dynamic partition overwrite) and never
writes over a path the same plan is reading.

Skew: "latest row per key" is a ``max_by`` aggregate, not a window.  Spark runs it
as partial + final aggregation, so even a key that holds a third of all rows (a
re-delivered feed) is pre-combined in every map task and never gathered into one
task.  Ties on the order columns are broken by the remaining columns, so the
result is deterministic.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import STATUS_FINALIZED
from ..functions.keys import dedup_key
from ..session import delete_folder, packed, path_exists, short_shuffles, spread_by

#: Buckets of a table's key index: the tasks among which a batch's keys are looked up.
KEY_BUCKETS = 64

#: A text key longer than this is held in the key index as a digest of it.
KEY_LENGTH = 24

#: A merge of more rows than this is done in turns, each of a share of the keys, so that a
#: share of the table is shuffled at a time; and the most turns, since each reads the slices.
TURN_ROWS, TURNS = 1 << 20, 8

#: Keys that come more than once in a first write: up to so many are broadcast.
REPEATED_KEYS = 100_000

#: Bytes of a file that a task reads of rows which are written as they lie: it sorts them by slice.
DEALT_BYTES = 16 << 20


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Columns usable as a tie-break (maps are not comparable in Spark)."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN4: the row with the greatest ``order`` per ``keys`` (full-row replacement).

    ``order`` is compared left to right (e.g. ``synced_at`` then a version); remaining
    comparable columns break ties.  NULL sorts lowest, so a row without ``synced_at``
    loses to one with it.
    """
    # the rank holds the row itself, so the greatest one is the row: carried once
    rank = [c for c in order if c not in keys] + _orderable(df, [*keys, *order])
    maps = [c for c in df.columns if c not in keys and c not in rank]
    if not rank and not maps:
        return df.distinct()
    best = F.struct(*rank) if rank else F.lit(True)
    made = [F.max(best).alias("_row"), *([F.max_by(F.struct(*maps), best).alias("_maps")] if maps else [])]
    rows = df.groupBy(*keys).agg(*made)
    of = {**{c: F.col(f"_row.{c}").alias(c) for c in rank}, **{c: F.col(f"_maps.{c}").alias(c) for c in maps}}
    return rows.select(*[of.get(c, F.col(c)) for c in df.columns])


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SNK5/SNK6: union old and new, keep the latest row per key.

    Re-running the same batch changes nothing (union with an identical row, same
    winner).  Duplicate keys inside ``new`` are resolved the same way, where a
    PostgreSQL multi-row upsert would reject the batch.
    """
    return latest_per_key(old.unionByName(new, allowMissingColumns=True), keys, order)


def upsert_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """SNK1/SNK2: on key match replace only ``update`` columns; keep the others; else insert.

    Per column: an updated column takes the new value whenever the key is in ``new``
    (a NULL overwrites — this is not ``coalesce``); a kept column takes the old value
    whenever the key is in ``old``.  ``new`` must be unique per key (dedup it first).
    """
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c not in keys], F.lit(True).alias("_in_o"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys], F.lit(True).alias("_in_n"))
    j = o.join(n, list(keys), "full_outer")
    out: list[Column] = [F.col(k) for k in keys]
    for c in [c for c in old.columns if c not in keys]:
        has_new = f"_n_{c}" in n.columns
        if c in update and has_new:
            out.append(F.when(F.col("_in_n").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        elif has_new:
            out.append(F.when(F.col("_in_o").isNotNull(), F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c))
        else:
            out.append(F.col(f"_o_{c}").alias(c))
    return j.select(*out)


def upsert_add(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    amounts: Sequence[str],
    maps: Sequence[str] = (),
) -> DataFrame:
    """SNK3: on conflict ``amount = old + new``; an absent key is inserted.

    The reference adds only the total and leaves the breakdown as it was; ours also
    merges the breakdown maps entry-wise (documented deviation), so Σ map = total
    still holds after a calibration row.  Order-free: add(add(o, a), b) = add(add(o, b), a).

    Other columns of ``old`` keep the old row's value, or the new row's for an inserted
    key.  A map is NULL only where it is in every row of the key; an empty one stays
    empty.  ``old`` is unique by the keys, as a stored table is, and is read once; rows of
    ``new`` that share a key are added up before.
    """
    rest = [c for c in old.columns if c not in {*keys, *amounts, *maps}]
    has = [c for c in rest if c in new.columns]
    given = _added(new, keys, amounts, maps, has).withColumn("_in_new", F.lit(True))
    given = given.select(*keys, "_in_new", *[F.col(c).alias(f"_n_{c}") for c in (*amounts, *maps, *has)])
    held = old.withColumn("_in_old", F.lit(True))
    j = held.join(given, list(keys), "full_outer")
    zero = F.lit(0).cast("decimal(38,6)")

    def both(m: str) -> Column:
        added = F.map_zip_with(
            F.col(m), F.col(f"_n_{m}"),
            lambda _k, a, b: (F.coalesce(a.cast("decimal(38,6)"), zero) + F.coalesce(b, zero)).cast("decimal(38,6)"),
        )
        entries = F.array_sort(F.map_entries(F.coalesce(added, F.col(m).cast("map<string,decimal(38,6)>"), F.col(f"_n_{m}"))))
        return F.map_from_entries(entries)

    made: dict[str, Column] = {}
    for c in amounts:
        total = F.when(F.col(c).isNotNull() | F.col(f"_n_{c}").isNotNull(), F.coalesce(c, F.lit(0)) + F.coalesce(f"_n_{c}", F.lit(0)))
        made[c] = total.cast(old.schema[c].dataType).alias(c)
    for c in maps:
        made[c] = both(c).alias(c)
    for c in has:
        made[c] = F.when(F.col("_in_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c)
    return j.select(*[made.get(c, F.col(c)) for c in old.columns])


def _added(new: DataFrame, keys: Sequence[str], amounts: Sequence[str], maps: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """``new`` with one row for each key: amounts and map entries added up."""
    tag = F.lit("")  # the row's amounts; a map's entries carry its name
    line = F.array(F.struct(tag.alias("_m"), F.lit(None).cast("string").alias("_k"), F.lit(None).cast("decimal(38,6)").alias("_v")))

    def entries(m: str) -> Column:
        each = F.transform(
            F.map_entries(m), lambda e: F.struct(F.lit(m).alias("_m"), e["key"].alias("_k"), e["value"].cast("decimal(38,6)").alias("_v"))
        )
        return F.coalesce(each, F.slice(line, 1, 0))

    every = F.concat(line, *[entries(m) for m in maps])
    first = F.col("_e._m") == ""  # amounts count on one of a row's lines
    kept = [c for c in _orderable(new, [*keys, *maps]) if c in (*amounts, *rest)]
    rank = F.struct(*[F.col(c) for c in kept] or [F.lit(True)])
    lines = new.select(
        *keys, *amounts, *[F.col(m).isNotNull().alias(f"_has_{m}") for m in maps],
        F.struct(*[F.col(c) for c in rest] or [F.lit(True).alias("_none")]).alias("_rest"), rank.alias("_rank"),
        F.explode(every).alias("_e"),
    )
    per_entry = lines.groupBy(*keys, F.col("_e._m").alias("_m"), F.col("_e._k").alias("_k")).agg(
        F.sum("_e._v").cast("decimal(38,6)").alias("_v"),
        *[F.sum(F.when(first, F.col(c))).alias(c) for c in amounts],
        *[F.max(f"_has_{m}").alias(f"_has_{m}") for m in maps],
        F.max_by("_rest", "_rank").alias("_rest"), F.max("_rank").alias("_rank"),
    )
    # at most one line per product and map
    pair = F.struct(F.col("_k").alias("key"), F.col("_v").alias("value"))
    rows = per_entry.groupBy(*keys).agg(
        *[F.sum(c).cast(new.schema[c].dataType).alias(c) for c in amounts],
        *[
            F.when(F.max(f"_has_{m}"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_m") == m, pair))))).alias(m)
            for m in maps
        ],
        F.max_by("_rest", "_rank").alias("_rest"),
    )
    return rows.select(*keys, *amounts, *maps, *[F.col(f"_rest.{c}").alias(c) for c in rest])


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK4: ``INSERT .. ON CONFLICT DO NOTHING`` — new rows whose key is absent, plus old.

    Duplicate keys inside ``new`` keep one row chosen deterministically (greatest row
    by value, via ``latest_per_key``), so a retried task picks the same one.
    """
    fresh = latest_per_key(new, list(keys), []).join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def replace_slices_logical(old: DataFrame, new: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """SNK7 (logical): delete every slice present in ``new``, then insert ``new``."""
    touched = new.select(*slice_keys).distinct()
    return old.join(touched, list(slice_keys), "left_anti").unionByName(new.select(*old.columns))


def _folders(slices: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The distinct slices as text, as folder names tell them apart (NULL and '' are one)."""
    return slices.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in parts]).distinct()


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    prev = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, prev)


def _slice_folder(spark: SparkSession, path: str, parts: Sequence[str], values: Sequence) -> str:
    hive = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *(hive.getPartitionPathString(c, v) for c, v in zip(parts, values))])


def replace_slices(new: DataFrame, path: str, parts: Sequence[str], slices: DataFrame | None = None, dealt: bool = False) -> None:
    """SNK7 (physical): dynamic partition overwrite of the slices ``new`` touches.

    Only partitions present in ``new`` are rewritten; the others are not read or
    touched.  ``slices`` (the partition columns) names slices to be replaced whether or
    not ``new`` has rows for them: a slice without new rows has its folder removed, after
    the write, so a job lost on the way leaves a slice old or new and a re-run ends it.
    A value is written as Hive writes it (escaped; NULL and '' share one folder, and read
    back as NULL).  Slices are cut into tasks by their size.  ``new`` must not read ``path``.
    ``dealt``: the files that ``new`` is read from hold few slices each, so it is written as
    it lies, without a shuffle.
    """
    spark = new.sparkSession
    read = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if dealt:
        read = min(DEALT_BYTES, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(read))
    with (
        _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"),
        _setting(spark, "spark.sql.files.maxPartitionBytes", str(read)),
        short_shuffles(spark),
    ):
        packed(new if dealt else spread_by(new, parts)).mode("overwrite").partitionBy(*parts).parquet(path)
    if slices is not None:
        there = _folders(new, parts).select(*[F.col(c).alias(f"_{c}") for c in parts])
        same = F.lit(True)
        for c in parts:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        for r in _folders(slices, parts).join(there, same, "left_anti").toLocalIterator():  # one for each emptied slice
            delete_folder(spark, _slice_folder(spark, path, parts, [r[c] for c in parts]))


def reset_status(status: DataFrame, keep_finalized: bool = False) -> DataFrame:
    """SNK8: the month-status table after a reset — empty, or only FINALIZED rows kept."""
    if keep_finalized:
        return status.filter(F.col("data_status") == STATUS_FINALIZED)
    return status.limit(0)


def expire(df: DataFrame, column: str, as_of: dt.date | str, days: int | None = None,
           months: int | None = None) -> tuple[DataFrame, DataFrame]:
    """SNK11: split into (kept, expired) by a retention period ending at ``as_of``.

    ``column`` is a date/timestamp (``days``) or a ``YYYY-MM`` cycle (``months``).  On a
    day- or cycle-partitioned table the predicate prunes partitions, so dropping the
    expired ones never reads the kept data.
    """
    a = F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
    if days is not None:
        limit = F.date_sub(a, days)
        keep = F.to_date(F.col(column)) >= limit
    elif months is not None:
        keep = F.col(column) >= F.date_format(F.add_months(a, -months), "yyyy-MM")
    else:
        raise ValueError("give days or months")
    return df.filter(keep), df.filter(~keep)


def advance_checkpoint(checkpoint: DataFrame, processed: DataFrame) -> DataFrame:
    """SNK12: per account the new high-water mark = greatest(old, max processed).

    The mark never moves back; an account seen for the first time is inserted.
    """
    ts_type = checkpoint.schema["max_object_last_modified"].dataType
    epoch = F.lit("1970-01-01 00:00:00").cast(ts_type)
    seen = processed.groupBy("account_id").agg(F.max("last_modified").cast(ts_type).alias("_new"))
    j = checkpoint.join(seen, "account_id", "full_outer")
    return j.select(
        "account_id",
        F.greatest(
            F.coalesce(F.col("max_object_last_modified"), epoch),
            F.coalesce(F.col("_new"), epoch),
        ).alias("max_object_last_modified"),
    )


def latest_balance(snapshots: DataFrame) -> DataFrame:
    """WIN3: latest snapshot per account (``max_by`` over the snapshot date)."""
    return snapshots.groupBy("account_id").agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.max_by("available_amount", "snapshot_date").alias("available_amount"),
    )


def _short_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with its keys as the key index holds them: of a long text a digest of 64 bits."""

    def short(c: str) -> Column:
        eight = F.unhex(F.lpad(F.hex(F.xxhash64(c)), 16, "0"))
        return F.when(F.length(c) > KEY_LENGTH, F.substring(F.base64(eight), 1, 11)).otherwise(F.col(c))

    return rows.withColumns({k: short(k) for k in keys if isinstance(rows.schema[k].dataType, T.StringType)})


def key_index(spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, buckets: int = KEY_BUCKETS) -> str:
    """The name of the key index of the table at ``path``: (keys, partition), bucketed by the keys.

    It lies at ``<path>_keys`` and says in which partitions a key lies or has lain since the
    index was made; a key found in too many costs a slice rewritten, never a copy.  So long
    texts are held as digests, which few keys share.  It is made from the table's rows where
    it is missing.  Bucketed, so a join on the keys reads it in place: only the batch is shuffled.
    """
    where = f"{path}_keys/short/buckets={buckets}"
    name = f"keys_{hashlib.sha1(where.encode()).hexdigest()[:20]}"
    others = [k for k in keys if k != partition_col]
    fresh = not path_exists(spark, where)
    stored = None
    if fresh and path_exists(spark, path):
        stored = spark.read.parquet(path).select(*others, F.col(partition_col).cast("string").alias("_slice"))
        kinds = {f.name: f.dataType.simpleString() for f in stored.schema}
    elif fresh:
        return ""
    else:
        kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(where).schema}
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in [*others, "_slice"])
        by = ", ".join(f"`{k}`" for k in others)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'"
        )
    if stored is not None:
        _append_keys(stored, name, others, buckets)
    return name


def _append_keys(rows: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Add the distinct ``rows`` to the index: dealt to a task for each bucket, made distinct there."""
    with short_shuffles(rows.sparkSession):
        _short_keys(rows, keys).repartition(buckets, *keys).distinct().write.insertInto(name)
    rows.sparkSession.catalog.refreshTable(name)


def key_slices(new: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, slice) of the index for the keys of ``new``; the index is not shuffled.

    The keys of ``new`` are not made distinct: an aggregation of more parts than the index
    has buckets would have the index dealt into as many.
    """
    wanted = _short_keys(new.select(*keys), keys)
    return index.join(wanted.hint("shuffle_merge"), list(keys), "left_semi")


def compact_keys(spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, buckets: int = KEY_BUCKETS) -> None:
    """Make the key index anew from the table's rows (after many moved keys)."""
    name = key_index(spark, path, keys, partition_col, buckets)
    if name:
        spark.sql(f"DROP TABLE {name}")
        delete_folder(spark, f"{path}_keys")
        key_index(spark, path, keys, partition_col, buckets)


def _turns(rows: int) -> int:
    """The turns in which a merge of so many rows is done."""
    return max(1, min(TURNS, math.ceil(rows / TURN_ROWS)))


_HEX, _TEXT = bytearray(b"\1"), bytearray(b"\0")  # the first byte of a packed text


def _pack(c: str) -> Column:
    """A text as bytes, one of (lower case) hex digits at half its length."""
    raw = F.unhex(c)
    return F.when(F.lower(F.hex(raw)) == F.col(c), F.concat(F.lit(_HEX), raw)).otherwise(F.concat(F.lit(_TEXT), F.col(c).cast("binary")))


def _unpack(c: str) -> Column:
    rest = F.substr(c, F.lit(2))
    return F.when(F.substring(c, 1, 1) == F.lit(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _merged(rows: DataFrame, keys: Sequence[str], order: Sequence[str], partition_col: str, staging: str, turns: int) -> DataFrame:
    """The latest row per key of ``rows``, staged by slice.

    Each turn takes a share of the keys by their hash, so what is shuffled at a time is a
    share of ``rows`` and all rows of a key are in one turn.  Text keys are shuffled packed.
    """
    spark = rows.sparkSession
    turn = F.pmod(F.xxhash64(*keys), F.lit(turns))
    texts = [k for k in keys if k != partition_col and rows.schema[k].dataType == T.StringType()]
    for t in range(turns):
        some = (rows.filter(turn == t) if turns > 1 else rows).withColumns({k: _pack(k) for k in texts})
        with short_shuffles(spark):
            latest = spread_by(latest_per_key(some, keys, order), [partition_col])
            packed(latest.withColumns({k: _unpack(k) for k in texts})).mode("append").partitionBy(partition_col).parquet(staging)
    return spark.read.schema(rows.schema).parquet(staging).select(*rows.columns)


def _replace_in_turns(merged: DataFrame, path: str, staging: str, partition_col: str, values: Sequence, turns: int) -> None:
    """Replace the slices ``values`` by what is staged of them; what is replaced is deleted."""
    spark = merged.sparkSession
    kind = T.StructType([merged.schema[partition_col]])
    for t in range(min(turns, len(values))):
        some = values[t::turns]
        new = merged.filter(_in_slices(partition_col, some)) if turns > 1 else merged
        replace_slices(new, path, [partition_col], spark.createDataFrame([(v,) for v in some], kind), dealt=True)
        for v in some:
            delete_folder(spark, _slice_folder(spark, staging, [partition_col], [None if v is None else str(v)]))


def _in_slices(partition_col: str, values: Sequence) -> Column:
    """Whether a row lies in one of the slices (literals, so that no other one is opened)."""
    at = F.col(partition_col).isin([v for v in values if v is not None])
    return at | F.col(partition_col).isNull() if None in values else at


def _first_write(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition_col: str,
                 staging: str, dealt: bool) -> None:
    """Write the latest row per key of ``new`` where no table is yet.

    The hashes of the keys tell which ones come more than once.  Where these are few, all
    other rows are written without being brought together by their keys.
    """
    spark = new.sparkSession
    hashed = new.withColumn("_hash", F.xxhash64(*keys))
    counted = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    with short_shuffles(spark):
        packed(counted.filter("n > 1")).mode("overwrite").parquet(f"{staging}-repeated")
    repeated = spark.read.schema(counted.schema).parquet(f"{staging}-repeated")
    n, rows = repeated.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n:
        replace_slices(new, path, [partition_col], dealt=dealt)
    elif n <= REPEATED_KEYS:
        few = F.broadcast(repeated.select("_hash"))
        once = hashed.join(few, "_hash", "left_anti").drop("_hash")
        more = latest_per_key(hashed.join(few, "_hash", "left_semi").drop("_hash"), keys, order)
        if dealt:
            more = spread_by(more, [partition_col])
        replace_slices(once.unionByName(more), path, [partition_col], dealt=dealt)
    else:
        replace_slices(_merged(new, keys, order, partition_col, staging, _turns(rows)), path, [partition_col], dealt=True)
    for name in ("", "-repeated"):
        delete_folder(spark, f"{staging}{name}")


def upsert_into(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition_col: str,
                staging: str, buckets: int = KEY_BUCKETS, dealt: bool = False) -> list[str | None]:
    """SNK5/SNK6 physically: merge ``new`` into the Parquet table at ``path``.

    Returns the values (as text) of the partitions written.  ``dealt``: the files that
    ``new`` is read from hold few partitions each.

    The partitions rewritten are those of ``new`` and those in which one of its keys
    lies now, so a record that moved to another partition leaves no second copy.  These
    come from the table's key index (``key_index``), so neither rows nor keys of other
    slices are shuffled.  The batch's own keys are added to the index before the table is
    written: a job lost in between leaves a key with a slice too many, not one too few.
    The merged slices are first written to ``staging`` (a fresh folder in the shared
    checkpoint area), then copied over the touched partitions by dynamic overwrite, so
    no plan ever overwrites a path it is reading, and re-running a lost job gives the
    same result.  A large merge is done in turns (``TURN_ROWS``): by shares of the keys into
    ``staging``, by shares of the slices from there.  What was staged is deleted once it is
    copied, and shuffle files with the write that made them.  A first write reads no table,
    and goes to its place at once.
    """
    spark = new.sparkSession
    others = [k for k in keys if k != partition_col]
    index = key_index(spark, path, keys, partition_col, buckets)
    if not index:  # first write: no table yet
        _first_write(new, path, keys, order, partition_col, staging, dealt)
        key_index(spark, path, keys, partition_col, buckets)
        written = spark.read.schema(new.schema).parquet(path)  # its folders: no row is read
        return [r[0] for r in written.select(F.col(partition_col).cast("string")).distinct().collect()]

    def staged(rows: DataFrame, name: str) -> DataFrame:
        with short_shuffles(spark):
            packed(rows).mode("overwrite").parquet(f"{staging}{name}")
        return spark.read.schema(rows.schema).parquet(f"{staging}{name}")

    given = new.select(*others, F.col(partition_col).cast("string").alias("_slice"))
    batch = staged(_short_keys(given, others).distinct(), "-keys")
    held = staged(key_slices(batch, spark.table(index), others), "-held")
    _append_keys(batch.join(held, [*others, "_slice"], "left_anti"), index, others, buckets)
    # '' lies in the folder of NULL, and is read back as NULL
    touched = batch.select("_slice").union(held.select("_slice")).select(F.nullif("_slice", F.lit("")).alias("_slice"))
    # one value for each touched partition
    values = [r[0] for r in touched.distinct().select(F.col("_slice").cast(new.schema[partition_col].dataType)).collect()]
    old = spark.read.parquet(path)
    old = old.withColumn(partition_col, F.col(partition_col).cast(new.schema[partition_col].dataType))
    old_slices = old.filter(_in_slices(partition_col, values))
    turns = _turns(old_slices.count() + batch.count())
    rows = old_slices.select(*new.columns).unionByName(new, allowMissingColumns=True)
    for name in ("-keys", "-held"):
        delete_folder(spark, f"{staging}{name}")
    _replace_in_turns(_merged(rows, keys, order, partition_col, staging, turns), path, staging, partition_col, values, turns)
    delete_folder(spark, staging)
    return [None if v is None else str(v) for v in values]


def rekey(fact: DataFrame, key_cols: Sequence[str], keys: Sequence[str] = ("account_id", "dedup_key"),
          order: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """SNK9: recompute ``dedup_key`` with a new column list, then keep one row per key.

    After a key-algorithm change the whole fact is re-keyed and reloaded (truncate +
    reload in the reference): rows that now collide collapse to the latest one.
    """
    return latest_per_key(fact.withColumn("dedup_key", dedup_key(*key_cols)), list(keys), list(order))
