"""Scoring whole texts with a gated recurrent language model trained on the corpus.

Words are counted over all training texts.  The ``HEAD`` most frequent words at most are
broadcast; other words meet their counts in a join.  Of the head, the first
``CLASSES * SIZE`` words are modelled one by one in the class-factored softmax, the others
as groups by rank; words beyond the head are one more group, with add-one frequencies
and one place for unseen words.  A word's probability is its group's, by the network,
times its share of the group.

The network starts with the base score's frequencies and is trained in ``ROUNDS`` rounds.
Each takes another part of the training texts, whole, so that after the last one every text
has been learned from once.  A round's texts are dealt by a hash of doc_id and text to as
many copies of the network as their tokens ask for (``TOKENS_A_COPY``); a copy learns from
its texts in the order of the hash, long ones first, and the copies are averaged by their
tokens.  So the result hangs on the rows alone, not on how the table is cut or on the
cluster.  What is trained on, counted and scored grows with the corpus; the network and the
head do not.

Defined results: a null text counts as empty (one token, the end); a null doc_id counts
as the empty text for the split; repeated rows are scored each; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gated_rnn
from .shared import written

HEAD = 1 << 18
CLASSES, SIZE, HIDDEN = 64, 64, 24
#: Ranks at which the groups of the head's other words begin.
GROUP_RANKS = (CLASSES * SIZE, 1 << 14, 1 << 16)
ROUNDS, RATE = 3, 0.02
#: Training tokens of a round from which one copy of the network learns, about.
TOKENS_A_COPY = 4_000_000
#: Tokens from which a text is long: such texts begin first in training and are scored
#: together, so that no window runs for the rest of one long text alone.
LONG = 2048
#: Copies' weights are averaged in pieces of so many numbers, and so many copies at a time
#: on each of the levels before the last.
PIECE, FAN, LEVELS = 1 << 15, 64, 2
#: Tokens scored together, texts, and tokens of long texts.
SCORED_TOKENS, SCORED_TEXTS, SCORED_LONG = 400_000, 1024, 1_000_000
#: Words whose counts leave a task together; Spark adds up those of a task.
COUNTED_WORDS = 50_000
#: Bytes of text encoded together; the head is hashed anew for each such part.
ENCODED_BYTES = 1 << 23

SHAPE = gated_rnn.Shape(CLASSES, SIZE, len(GROUP_RANKS) + 1, HIDDEN)
END = b""
#: How a stored text holds the network's ids: as bytes, which Spark moves as a whole.
ID = np.dtype("<u2" if SHAPE.ids < 1 << 16 else "<u4")


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs without white space, then the end."""
    return [*(text or "").encode().lower().split(), END]


def count_words(texts: DataFrame) -> DataFrame:
    """word (the end is the empty one) and n over the column ``text``."""

    def run(batches):
        for batch in batches:
            column = pc.fill_null(batch.column("text"), "")
            found = pc.ascii_split_whitespace(pc.ascii_lower(column)).flatten().value_counts()
            words, counts = found.field("values").cast(pa.binary()), found.field("counts")
            own = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty part
            rows = pa.RecordBatch.from_arrays([words.filter(own), counts.filter(own)], ["word", "n"])
            for k in range(0, rows.num_rows, COUNTED_WORDS):
                yield rows.slice(k, COUNTED_WORDS)
            ends = [pa.array([END], pa.binary()), pa.array([batch.num_rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(ends, ["word", "n"])

    counted = texts.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def reached(counts: DataFrame, steps: list[float]) -> list[int]:
    """How many words have each of ``steps`` (ascending) or more; there are far fewer counts than
    words, so the steps are compared with each count once, not with each word."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    passed = F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: F.col("n") >= s))
    words = np.zeros(len(steps) + 1, np.int64)
    for r in sizes.groupBy(passed.alias("steps")).agg(F.sum("words").alias("words")).collect():
        words[r["steps"]] = r["words"]
    return words[::-1].cumsum()[::-1][1:].tolist()


def _head(counts: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``: all above a count that few enough reach.

    Words seen once are never among them: they teach the network what unseen words are like.
    """
    steps = [2 ** (k / 8) for k in range(8, 8 * 50)]
    reach = reached(counts, steps)
    at = next((s for s, n in zip(steps, reach) if n <= most), steps[-1])
    rows = counts.filter(F.col("n") >= F.lit(at)).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


class Lexicon:
    """What the head's words give: id, base score and share of the group (log10)."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int):
        n = np.array([c for _, c in head], dtype=np.float64)
        rank = np.arange(len(head))
        group = np.searchsorted(GROUP_RANKS, rank, side="right") - 1
        self.ids = np.where(group < 0, rank, SHAPE.words + group).astype(np.int32)
        # frequencies as in the base score: one is added to each word's, and one word is unseen
        sums = np.array([(n + 1.0)[group == g].sum() for g in range(len(GROUP_RANKS))])
        self.base = np.log10((n + 1.0) / (total + distinct + 1.0))
        self.share = np.where(group < 0, 0.0, np.log10((n + 1.0) / np.where(group < 0, 1.0, sums[group])))
        self.words = {w: k for k, (w, _) in enumerate(head)}
        self.keys, self.other = pa.array([w for w, _ in head], pa.binary()), SHAPE.ids - 1
        rest = total - float(n.sum()) + distinct - len(head) + 1.0
        self.rest_norm = float(np.log10(rest))
        self.base_norm = float(np.log10(total + distinct + 1.0))
        modelled = np.zeros(SHAPE.words)
        modelled[: min(len(n), SHAPE.words)] = n[: SHAPE.words] + 1.0
        self.counts = np.concatenate([modelled, sums, [rest]])


def _slices(text: pa.Array, most: int = ENCODED_BYTES):
    """(first row, rows) of parts of about ``most`` bytes of text; a longer text alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(text):
        stop = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right"))
        yield at, max(stop - at, 1)
        at += max(stop - at, 1)


def all_tokens(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts in a row, each text's end after it, and where each text begins (and the last ends)."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat = pc.cast(parts.flatten(), pa.binary())
    own = np.flatnonzero(pc.binary_length(flat).to_numpy() > 0)  # white space at either end leaves an empty part
    cuts = parts.offsets.to_numpy().astype(np.int64)
    many = np.diff(np.searchsorted(own, cuts - cuts[0]))
    begins = np.concatenate([[0], np.cumsum(many + 1)])
    place = np.full(int(begins[-1]), len(flat))  # the end, unless a word is put there
    place[np.arange(len(own)) + np.repeat(np.arange(len(many)), many)] = own
    return pa.concat_arrays([flat, pa.array([END], pa.binary())]).take(pa.array(place)), begins


def encode_texts(text: pa.Array, lex: "Lexicon") -> list[pa.Array]:
    """n_tokens, head_known, head_base, share, ids (bytes) and tail of each text."""
    words, begins = all_tokens(text)
    starts, rows = begins[:-1], len(text)
    rank = pc.fill_null(pc.index_in(words, value_set=lex.keys), -1).to_numpy().astype(np.int64)
    known = rank >= 0
    at = np.where(known, rank, 0)
    sums = [
        np.add.reduceat(np.where(known, of[at], 0.0) if len(of) else np.zeros(len(rank)), starts)
        for of in (np.ones(len(lex.base)), lex.base, lex.share)
    ]
    ids = np.where(known, lex.ids[at] if len(lex.ids) else 0, lex.other).astype(ID)
    # the other words of a text, each with its number
    missing = np.flatnonzero(~known)
    coded = words.take(pa.array(missing)).dictionary_encode()
    wide = max(len(coded.dictionary), 1)
    key = (np.searchsorted(starts, missing, side="right") - 1) * wide + coded.indices.to_numpy()
    key, times = np.unique(key, return_counts=True)
    tail = pa.StructArray.from_arrays(
        [coded.dictionary.take(pa.array(key % wide)), pa.array(times.astype(np.int64))], ["word", "n"]
    )
    return [
        pa.array(np.diff(begins), pa.int64()),
        pa.array(sums[0].astype(np.int64)),
        pa.array(sums[1]),
        pa.array(sums[2]),
        pa.Array.from_buffers(
            pa.binary(), rows, [None, pa.py_buffer((begins * ID.itemsize).astype(np.int32)), pa.py_buffer(ids)]
        ),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(key // wide, np.arange(rows + 1)), pa.int32()), tail),
    ]


def _encoded(docs: DataFrame, lexicon) -> DataFrame:
    """Each text's ids, the head's part of the sums, and its other words with counts."""
    carried = ["doc_id", "uid", "part", "held_out"]

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            for at, n in _slices(text):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, n) for c in carried] + encode_texts(text.slice(at, n), lexicon.value),
                    [*carried, "n_tokens", "head_known", "head_base", "share", "ids", "tail"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {kind}, uid long, part long, held_out boolean, n_tokens long, head_known long, head_base double, "
        "share double, ids binary, tail array<struct<word:binary,n:long>>",
    )


def _texts(batches):
    """The ids of each text, held as bytes or as an array of numbers."""
    for batch in batches:
        for ids in batch.column("ids"):
            own = ids.values.to_numpy() if isinstance(ids, pa.ListScalar) else np.frombuffer(ids.as_buffer(), ID)
            yield own.astype(np.int64)


def _total(rows: pa.Table) -> tuple[np.ndarray, int]:
    """The sum of the pieces, in the order of their copies, and of the tokens."""
    rows = rows.sort_by("copy")
    total = sum(np.frombuffer(piece, np.float64) for piece in rows.column("piece").to_pylist())
    return total, pc.sum(rows.column("tokens")).as_py()


def summed_copies(pieces: DataFrame, fan: int = FAN) -> DataFrame:
    """Weighted sums of the pieces (double) at the same place of every ``fan`` copies."""

    def run(key, rows):
        total, tokens_ = _total(rows)
        columns = [[key[0].as_py()], [key[1].as_py()], [tokens_]]
        return pa.table(
            [*(pa.array(c, pa.int64()) for c in columns), pa.array([total.tobytes()], pa.binary())],
            ["at", "copy", "tokens", "piece"],
        )

    some = pieces.withColumn("group", F.floor(F.col("copy") / fan).cast("long"))
    return some.groupBy("at", "group").applyInArrow(run, "at long, copy long, tokens long, piece binary")


def _dealt(batches) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        yield from zip(batch.column("copy").to_pylist(), _texts([batch]))


def train(encoded: DataFrame, weights: np.ndarray, total: int, rounds: int = ROUNDS, rate: float = RATE,
          tokens_a_copy: int = TOKENS_A_COPY):
    """The averaged weights after ``rounds`` rounds over all of ``encoded`` (part, n_tokens, ids).

    ``total`` is the number of its tokens.  A table stored by ``round`` (``part`` modulo the
    rounds) is read a round at a time.
    """
    sc = encoded.sparkSession.sparkContext
    copies_ = max(1, -(-total // (rounds * tokens_a_copy)))
    copy = F.pmod(F.floor(F.col("part") / F.lit(rounds)), F.lit(copies_)).cast("long")
    for k in range(rounds):
        sent = sc.broadcast(weights)
        pace = rate / (1 + k)

        def run(batches, sent=sent, pace=pace):
            for number, texts in groupby(_dealt(batches), key=itemgetter(0)):
                trainer = gated_rnn.Trainer(SHAPE, sent.value, pace)
                trainer.fit(ids for _, ids in texts)
                for at in range(0, len(trainer.flat), PIECE):
                    piece = trainer.flat[at : at + PIECE].astype(np.float64) * trainer.tokens
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([at], pa.int64()),
                            pa.array([number], pa.int64()),
                            pa.array([trainer.tokens], pa.int64()),
                            pa.array([piece.tobytes()], pa.binary()),
                        ],
                        ["at", "copy", "tokens", "piece"],
                    )

        def mean(key, rows):
            sums, tokens_ = _total(rows)
            piece = (sums / tokens_).astype(np.float32).tobytes()
            return pa.table({"at": pa.array([key[0].as_py()], pa.int64()), "piece": pa.array([piece], pa.binary())})

        mine = F.col("round") == k if "round" in encoded.columns else F.pmod("part", F.lit(rounds)) == k
        own = encoded.filter(mine).select(copy.alias("copy"), "part", "n_tokens", "ids")
        # a copy's texts lie in one task, in an order that hangs on the rows alone
        own = own.repartition(copies_, "copy").sortWithinPartitions("copy", F.col("n_tokens") < LONG, "part", "n_tokens")
        copies = own.select("copy", "ids").mapInArrow(run, "at long, copy long, tokens long, piece binary")
        for _ in range(LEVELS):
            copies = summed_copies(copies)
        pieces = copies.groupBy("at").applyInArrow(mean, "at long, piece binary").collect()
        if pieces:
            weights = np.concatenate([np.frombuffer(r["piece"], np.float32) for r in sorted(pieces, key=lambda r: r["at"])])
        sent.unpersist()
    return weights


def _network_scores(encoded: DataFrame, weights) -> DataFrame:
    names = ["doc_id", "uid", "held_out", "n_tokens", "head_known", "head_base", "share"]

    def scored(rows: pa.RecordBatch) -> pa.RecordBatch:
        got = gated_rnn.score_texts(SHAPE, weights.value, list(_texts([rows])))
        return pa.RecordBatch.from_arrays([rows.column(c) for c in names] + [pa.array(got, pa.float64())], [*names, "network"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            size = batch.column("n_tokens").to_numpy()
            order = np.argsort(size, kind="stable")  # texts of near lengths run side by side
            short = order[size[order] < LONG]
            upto = np.cumsum(size[short])
            at = 0
            while at < len(short):
                most = (upto[at - 1] if at else 0) + SCORED_TOKENS
                stop = min(max(int(np.searchsorted(upto, most, side="right")), at + 1), at + SCORED_TEXTS)
                yield scored(batch.take(pa.array(short[at:stop])))
                at = stop
            if len(short) < len(order):
                held.append(batch.take(pa.array(order[len(short) :])))
            if sum(pc.sum(b.column("n_tokens")).as_py() for b in held) > SCORED_LONG:
                yield from map(scored, pa.Table.from_batches(held).combine_chunks().to_batches())
                held = []
        if held:
            yield from map(scored, pa.Table.from_batches(held).combine_chunks().to_batches())

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.drop("part", "tail", "round").mapInArrow(
        run,
        f"doc_id {kind}, uid long, held_out boolean, n_tokens long, head_known long, head_base double, "
        "share double, network double",
    )


def score_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("uid"),
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text).cast("string")), F.lit(1 << 40)).alias("part"),
        (F.pmod(crc, F.lit(7)) == 2).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    counts = written(count_words(base.filter("NOT held_out")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    lexicon = Lexicon(_head(counts), total, distinct)
    encoded = _encoded(base, spark.sparkContext.broadcast(lexicon)).withColumn("round", F.pmod("part", F.lit(ROUNDS)))
    encoded = written(encoded, "lm-encoded", ("round",))

    tail = encoded.select("uid", F.explode("tail").alias("w")).select("uid", "w.word", F.col("w.n").alias("times"))
    tail = (
        tail.join(counts.hint("merge"), "word", "left")
        .groupBy("uid")
        .agg(
            F.sum("times").alias("tail_tokens"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("tail_log"),
        )
    )
    weights = train(encoded.filter("NOT held_out"), gated_rnn.start(SHAPE, lexicon.counts), total)
    scored = _network_scores(encoded, spark.sparkContext.broadcast(weights))
    joined = scored.join(tail.hint("merge"), "uid", "left").fillna(0, ["tail_tokens", "tail_known", "tail_log"])
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.col("tail_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.col("tail_log") - F.col("tail_tokens") * F.lit(lexicon.base_norm)).alias("base_score"),
        (
            F.col("network") + F.col("share") + F.col("tail_log") - F.col("tail_tokens") * F.lit(lexicon.rest_norm)
        ).alias("score"),
    )
