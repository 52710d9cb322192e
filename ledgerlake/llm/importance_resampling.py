"""Quality by importance resampling over hashed n-grams.

Words and word pairs are hashed to buckets.  A target model (labelled good texts) and a
raw model (all texts) are add-one bucket frequencies; a text's log weight is the sum of
its buckets' log ratios.  The classifier rejects a text whose mean log ratio lies below
a threshold set on labelled texts that the target model has not seen.  The sampler adds
Gumbel noise to the log weights and takes the ``k`` largest, which draws ``k`` texts
without replacement in proportion to their weights.

The raw model counts every text.  The labelled sample is bounded by ``LABELLED`` rows
(those with the smallest hashes of doc_id), a part of which sets the threshold.

Defined results: a null or empty text has no n-grams, log weight 0 and stays; of
repeated labels the worst counts; null labels are left out; without labelled good texts
nothing is rejected; rows that tie with the last sampled row are sampled too; an empty
table gives an empty result; other columns are left out by ``score`` and kept by
``accepted``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BUCKETS, PAIR_BUCKETS = 1 << 16, 1 << 14
#: Labelled rows that fit the target model and the threshold, at most.
LABELLED = 20_000
#: Of those, one in so many sets the threshold.
HELD = 4
#: Part of the good held-out texts that may fall below the threshold, and a margin below.
GOOD_LOSS, MARGIN = 0.002, 0.05
SAMPLE_SHARE = 0.5
SEED = 20

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Buckets(dict):
    """Hashes of tokens, kept for tokens that come again."""

    most = 500_000

    def __missing__(self, token: str) -> int:
        if len(self) > self.most:
            self.clear()
        self[token] = h = xxhash.xxh3_64_intdigest(token)
        return h


def features(text: str | None, hashes: Buckets) -> np.ndarray:
    """The buckets of a text's words and pairs of neighbouring words."""
    tokens = _TOKEN.findall(text.lower()) if text else []
    if not tokens:
        return np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(3)) >> np.uint64(20)
    return np.concatenate([h % np.uint64(WORD_BUCKETS), pair % np.uint64(PAIR_BUCKETS) + np.uint64(WORD_BUCKETS)]).astype(
        np.int64
    )


@dataclass(frozen=True)
class Model:
    log_ratio: np.ndarray
    threshold: float

    def weigh(self, text: str | None, hashes: Buckets) -> tuple[int, float]:
        f = features(text, hashes)
        return len(f), float(self.log_ratio[f].sum()) if len(f) else 0.0


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", quality: str = "quality") -> Model:
    """Count all texts, and the labelled good ones, in one pass; then set the threshold."""
    spark = docs.sparkSession
    sample = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("q"))
        .filter("doc_id IS NOT NULL AND q IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("q").alias("q"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(LABELLED)
        .collect()
    )
    good = {r["doc_id"] for r in sample if r["q"] == 1 and r["h"] % HELD}
    held = {r["doc_id"]: r["q"] for r in sample if r["h"] % HELD == 0}
    size = WORD_BUCKETS + PAIR_BUCKETS
    sent = spark.sparkContext.broadcast(good)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(batches):
        hashes, good = Buckets(), sent.value
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for key, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                f = features(t.as_py(), hashes)
                np.add.at(raw, f, 1)
                if key in good:
                    np.add.at(target, f, 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    # as many rows as buckets, whatever the number of texts
    rows = (
        chosen.mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.ones(size), np.ones(size)
    at = rows["bucket"].to_numpy(dtype=np.int64)
    raw[at] += rows["raw"].to_numpy(dtype=float)
    target[at] += rows["target"].to_numpy(dtype=float)
    model = Model(np.log(target / target.sum()) - np.log(raw / raw.sum()), float("-inf"))
    if not good or not held:
        return model
    # one row for each held-out id, however often the table has it
    scored = score(chosen.filter(F.col("doc_id").isin(list(held))), model).filter("n_grams > 0")
    scored = scored.groupBy("doc_id").agg(F.min("mean_log_ratio").alias("mean_log_ratio")).collect()
    means = sorted(r["mean_log_ratio"] for r in scored if held[r["doc_id"]] == 1)
    if not means:
        return model
    return Model(model.log_ratio, means[int(GOOD_LOSS * len(means))] - MARGIN)


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, n_grams, log_weight, mean_log_ratio, kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()

    def run(batches):
        hashes, m = Buckets(), sent.value
        for batch in batches:
            got = [m.weigh(t.as_py(), hashes) for t in batch.column("text")]
            mean = [w / n if n else 0.0 for n, w in got]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in got], pa.int64()),
                    pa.array([w for _, w in got], pa.float64()),
                    pa.array(mean, pa.float64()),
                    pa.array([not n or x >= m.threshold for (n, _), x in zip(got, mean)], pa.bool_()),
                ],
                ["doc_id", "n_grams", "log_weight", "mean_log_ratio", "kept"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_grams long, log_weight double, mean_log_ratio double, kept boolean"
    )


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        hashes, m = Buckets(), sent.value
        for batch in batches:
            keep = []
            for t in batch.column(at):
                n, w = m.weigh(t.as_py(), hashes)
                keep.append(not n or w / n >= m.threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _kth_largest(keys: DataFrame, k: int, ways: int = 1 << 14) -> int:
    """The k-th largest of the long column ``key``, by counting ever narrower ranges."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        step = -(-(high - low + 1) // ways)
        counts = (
            keys.filter(F.col("key").between(low, high))
            .groupBy(F.floor((F.col("key") - F.lit(low)) / F.lit(step)).alias("cell"))
            .count()
            .collect()
        )
        for r in sorted(counts, key=lambda r: -r["cell"]):
            if r["count"] >= k:
                low, high = low + r["cell"] * step, min(high, low + (r["cell"] + 1) * step - 1)
                break
            k -= r["count"]
    return low


def gumbel_top(scored: DataFrame, share: float = SAMPLE_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``gumbel_key`` and ``sampled``: the ``share`` of rows with the largest keys.

    ``scored`` is read several times and should be a written table.
    """
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    keyed = scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(unit)))
    keyed = keyed.withColumn("key", F.floor(F.col("gumbel_key") * 1e6).cast("long"))
    k = int(share * keyed.count())
    if not k:
        return keyed.drop("key").withColumn("sampled", F.lit(False))
    return keyed.withColumn("sampled", F.col("key") >= F.lit(_kth_largest(keyed, k))).drop("key")
