"""Benchmark decontamination by Wu-Manber multi-pattern search.

Each benchmark item gives its windows of ten consecutive words (an item of fewer words
is one window); a window is searched as its words between single spaces, in the text
written the same way.  Windows of like length form one table: the last block under
the search position gives a shift that skips positions where no window can end its
first ``shortest`` bytes; where the shift is zero, the block's bucket holds the windows
to test, and comparison with the text confirms an occurrence.

The windows are broadcast in parts of at most ``part_bytes`` bytes; more parts mean
more passes over the texts, whose hit words are then merged by document.

Defined results: a null text or item has no words; repeated items count by their ids; a
repeated document is searched again; a document with a null id is reported with it;
empty tables give an empty or a clean result; other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import UID, free_name, numbered, written

WINDOW = 10
PART_BYTES = 16 << 20
#: Windows are put in tables by length, from each of these up to the next.
LENGTHS = (1, 8, 24)
BLOCK = 9

#: A-Z to lower case; every byte outside words to a space (bytes from 0x80 are words').
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    w = words(text)
    return [b" " + b" ".join(w[k : k + size]) + b" " for k in range(max(1, len(w) - size + 1))] if w else []


class Table:
    """Shift table and suffix buckets for windows of like length."""

    def __init__(self, patterns: list[bytes]):
        self.shortest = m = min(map(len, patterns))
        self.block = b = min(BLOCK, m)
        self.far = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[bytes, int]]] = defaultdict(list)
        for k, p in enumerate(patterns):
            for end in range(b, m + 1):
                part, left = p[end - b : end], m - end
                if left < self.shift.get(part, self.far):
                    self.shift[part] = left
            self.bucket[p[m - b : m]].append((p, k))

    def find(self, text: bytes):
        """(start, pattern number) of each occurrence."""
        m, b, far, shift, bucket = self.shortest, self.block, self.far, self.shift.get, self.bucket
        at, n = m, len(text)
        while at <= n:
            part = text[at - b : at]
            left = shift(part, far)
            if left:
                at += left
                continue
            start = at - m
            for p, k in bucket[part]:
                if text.startswith(p, start):
                    yield start, k
            at += 1


class Searcher:
    """All tables over the windows of some items."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.n_words = [p.count(b" ") - 1 for p in patterns]
        self.tables = []
        for low, high in zip(LENGTHS, (*LENGTHS[1:], 1 << 62)):
            own = [k for k, p in enumerate(patterns) if low <= len(p) < high]
            if own:
                self.tables.append((own, Table([patterns[k] for k in own])))

    def search(self, doc: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged [start, end) word ranges that are hit, and the patterns that occur."""
        text = b" " + b" ".join(doc) + b" "
        found = [(at, own[k]) for own, t in self.tables for at, k in t.find(text)]
        if not found:
            return [], set()
        starts = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0x20)
        spans: list[list[int]] = []
        firsts = np.searchsorted(starts, [at for at, _ in found])
        for lo, hi in sorted((int(f), int(f) + self.n_words[k]) for f, (_, k) in zip(firsts, found)):
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], hi)
            else:
                spans.append([lo, hi])
        return [(a, b) for a, b in spans], {k for _, k in found}


def _window_parts(benchmark: DataFrame, text: str, item_id: str, size: int, part_bytes: int):
    """Lists of (window, item ids), each list within ``part_bytes``, one at a time."""

    def cut(batches):
        for batch in batches:
            for item, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                own = list(dict.fromkeys(windows(t, size)))
                for k in range(0, len(own), 2000):
                    some = own[k : k + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(some), pa.string()), pa.array(some, pa.binary())], ["item", "window"]
                    )

    made = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(
        cut, "item string, window binary"
    )
    each = made.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    cost = F.octet_length("window") + F.lit(64) + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 16)
    total = each.agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))
    for k in range(parts):
        part = each if parts == 1 else each.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == k)
        yield [(bytes(r["window"]), tuple(r["items"])) for r in part.sort("window").toLocalIterator()]


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    size: int = WINDOW,
    part_bytes: int = PART_BYTES,
    row: str | None = None,
) -> DataFrame:
    """Return doc_id, n_words, spans (hit [start, end) word ranges), items (ids that occur).

    With ``row``, the column of ``docs`` that numbers its rows, ``row`` is returned too.

    Items with a null id have no name and are not listed, but their windows are hit.
    """
    spark = docs.sparkSession
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, row {UID}, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    number = row or free_name(docs, "__row")
    base = docs if row else numbered(docs, number)
    base = base.select(F.col(doc_id).alias("doc_id"), F.col(number).alias("row"), F.col(text).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    passes: list[tuple[DataFrame, Broadcast]] = []
    for part in _window_parts(benchmark, item_text, item_id, size, part_bytes):
        if passes:  # only the last part of the windows is held: the others' passes are written
            done, old = passes[-1]
            passes[-1] = written(done, "window-hits"), old
            old.unpersist()
        sent = spark.sparkContext.broadcast(part)

        def run(batches, sent=sent):
            searcher = Searcher([p for p, _ in sent.value])
            items = [i for _, i in sent.value]
            for batch in batches:
                n, spans, names = [], [], []
                for t in batch.column("text"):
                    w = words(t.as_py())
                    hit, which = searcher.search(w) if w else ([], set())
                    n.append(len(w))
                    spans.append([{"start": a, "end": b} for a, b in hit])
                    names.append(sorted({i for k in which for i in items[k]}))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("row"),
                        pa.array(n, pa.int64()),
                        pa.array(spans, span),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    ["doc_id", "row", "n_words", "spans", "items"],
                )

        passes.append((base.mapInArrow(run, schema), sent))
    extra = ["row"] if row else []
    if len(passes) == 1:
        return passes[0][0].select("doc_id", *extra, "n_words", "spans", "items")
    every = passes[0][0]
    for p, _ in passes[1:]:
        every = every.unionByName(p)
    # one row for each document and part of the windows: as many as passes
    merged = every.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(a, 1, F.size(a) - 1),
                F.array(
                    F.struct(
                        F.element_at(a, -1)["start"].alias("start"),
                        F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(a, F.array(s))),
    )
    return merged.select("doc_id", *extra, "n_words", joined.alias("spans"), "items")


def contamination(found: DataFrame) -> DataFrame:
    """The report row of each document from ``find_windows``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )




def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns."""
    number = free_name(docs, "__row")
    own = numbered(docs, number)
    found = find_windows(own, benchmark, text, doc_id, row=number)
    hit = found.filter(F.size("spans") > 0).select(F.col("row").alias(number))
    return own.join(hit, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
