"""Near duplicates by BagMinHash over multisets of word shingles.

A document is the multiset of its five-word shingles.  For every shingle and each dyadic
range of weights ([0,1), [1,2), [2,4), ...) below its count, a Poisson process seeded by
both gives points in time; a point falls on one component and on one unit of weight of
its range, and counts where that unit is below the shingle's count.  A component of the
signature is its earliest point, so two components agree with the probability of the
weighted Jaccard similarity.  Points are made in order of time up to the last component's
time, so most shingles need one draw, whatever their number.

Documents with equal bags are one node.  Nodes with an equal band of the signature share
a bucket.  A node is alone if too little of it occurs in any other candidate (that is
exact).  The others are compared with their bucket's centre, the node with the smallest
part of its own.  Nodes not linked to their centre are then compared with all others of
the bucket, block by block, so no pair that shares a band is left open.  The links'
components are the classes.

Defined results: words are lower-cased letters, digits and characters from U+0080; fewer
than five words are one shingle; texts without words are classes of equal texts; null
counts as empty; repeated rows share a class; the class id is the smallest doc_id of the
class (null where all are); an empty table gives an empty result; other columns are left
out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import UID, free_name, numbered, written
from .wu_manber import words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Nodes of a bucket that are compared with as many others in one group.
BLOCK = 256
#: Shingles of the bags that one block holds, about (one larger bag alone).
BLOCK_WEIGHT = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept for words that come again."""

    most = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(z: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_bag(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes and their counts; fewer words than ``size`` are one shingle."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ids = np.fromiter(map(hashes.__getitem__, w), dtype=np.uint64, count=len(w))
    n = max(1, len(ids) - size + 1)
    total = np.full(n, min(len(ids), size), dtype=np.uint64)
    for k in range(min(size, len(ids))):
        total += _mix(ids[k : k + n] + np.uint64(k * 0x632BE59BD9B4E019 % 2**64))
    return np.unique(_mix(total), return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """A row for each bag: the earliest point of each component, as the bits of its time.

    The points of all bags are made together, one for each range in a step.  A bag
    without shingles has zeros.
    """
    out = np.zeros((len(bags), m), np.uint64)
    todo = np.array([k for k, (keys, _) in enumerate(bags) if len(keys)], dtype=np.intp)
    until = np.array([(np.log(m) + 3.0) / float(bags[k][1].sum()) for k in todo])
    while len(todo):
        sizes = [len(bags[k][0]) for k in todo]
        keys = np.concatenate([bags[k][0] for k in todo])
        counts = np.concatenate([bags[k][1] for k in todo])
        owner = np.repeat(np.arange(len(todo)), sizes)
        state, need, who = [keys], [counts], [owner]
        low, width, edge = [np.zeros(len(keys))], [np.ones(len(keys))], 1
        while True:  # the ranges [edge, 2 edge) that reach into a count
            more = counts > edge
            if not more.any():
                break
            state.append(_mix(keys[more] + np.uint64(edge * int(_GOLDEN) % 2**64)))
            need.append(counts[more])
            who.append(owner[more])
            low.append(np.full(len(need[-1]), float(edge)))
            width.append(low[-1])
            edge *= 2
        state, need, who = np.concatenate(state), np.concatenate(need), np.concatenate(who)
        low, width = np.concatenate(low), np.concatenate(width)
        rate, time, stop = width * m, np.zeros(len(state)), until[who]
        best = np.full(len(todo) * m, np.inf)
        while len(state):
            state = state + _GOLDEN
            bits = _mix(state)
            time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
            alive = np.flatnonzero(time <= stop)
            state, need, who, low = state[alive], need[alive], who[alive], low[alive]
            width, rate, time, stop = width[alive], rate[alive], time[alive], stop[alive]
            place = _mix(bits[alive] ^ _GOLDEN)
            unit = low + np.floor((place >> np.uint64(32)).astype(np.float64) * 2.0**-32 * width)
            hit = unit < need
            component = ((place[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.intp)
            np.minimum.at(best, who[hit] * m + component, time[hit])
        best = best.reshape(len(todo), m)
        full = np.isfinite(best).all(axis=1)
        out[todo[full]] = best[full].view(np.uint64)
        todo, until = todo[~full], until[~full] * 2
    return out


def signature(keys: np.ndarray, counts: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    return signatures([(keys, counts)], m)[0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags: sum of minima over sum of maxima."""
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    every = int(a[1].sum() + b[1].sum()) - common
    return common / every if every else 0.0


def _batches(texts: list[str | None], hashes: WordHashes, most: int = 100_000):
    """The bags of the texts, in order, in lists of about ``most`` shingles."""
    part, size = [], 0
    for t in texts:
        part.append(shingle_bag(t, hashes))
        size += len(part[-1][0])
        if size > most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _bands(signs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash for each band of each signature."""
    grouped = signs.reshape(len(signs), -1, rows)
    out = np.zeros(grouped.shape[:2], np.uint64)
    for k in range(rows):
        out = _mix(out + grouped[:, :, k] + np.uint64(k + 1))
    return out


def _node(bag: tuple[np.ndarray, np.ndarray], text: str | None) -> bytes:
    if not len(bag[0]):
        return xxhash.xxh3_128_digest(b"text " + (text or "").encode())
    return xxhash.xxh3_128_digest(bag[0].tobytes() + bag[1].astype("<i8").tobytes())


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, uid, node, bands (empty where there are no words) of each row."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            texts, done = batch.column("text").to_pylist(), 0
            for bags in _batches(texts, hashes):
                n = len(bags)
                bands = _bands(signatures(bags)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, n),
                        batch.column("uid").slice(done, n),
                        pa.array([_node(b, t) for b, t in zip(bags, texts[done : done + n])], pa.binary()),
                        pa.array([s if len(b[0]) else [] for s, b in zip(bands, bags)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "uid", "node", "bands"],
                )
                done += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, uid {UID}, node binary, bands array<long>")


def _bagged(docs: DataFrame) -> DataFrame:
    """node, weight, bands, keys and counts of each row's bag."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            done = 0
            for bags in _batches(batch.column("text").to_pylist(), hashes):
                bands = _bands(signatures(bags)).view(np.int64)
                n = len(bags)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(done, n),
                        pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                        pa.array(list(bands), pa.list_(pa.int64())),
                        pa.array([k.view(np.int64) for k, _ in bags], pa.list_(pa.int64())),
                        pa.array([c for _, c in bags], pa.list_(pa.int64())),
                    ],
                    ["node", "weight", "bands", "keys", "counts"],
                )
                done += n

    return docs.mapInArrow(
        run, "node binary, weight long, bands array<long>, keys array<long>, counts array<long>"
    )


def _bag_at(batch: pa.RecordBatch, keys: str, counts: str, row: int):
    k, c = batch.column(keys)[row].values, batch.column(counts)[row].values
    return k.to_numpy(zero_copy_only=False).view(np.uint64), c.to_numpy(zero_copy_only=False)


def _linked(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs of bags (a, b) that are similar."""

    def run(batches):
        for batch in batches:
            good = [
                similarity(_bag_at(batch, "keys", "counts", i), _bag_at(batch, "keys2", "counts2", i)) >= least
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "keys", "counts", "keys2", "counts2").mapInArrow(run, "a binary, b binary")


def _possible(s1: Column, w1: Column, s2: Column, w2: Column, least: float) -> Column:
    """Whether bags of these weights and shareable parts can be similar at all."""
    most = F.least(s1, s2)
    return most >= least * (w1 + w2 - most)


def _compare_blocks(least: float):
    """For one group of a bucket's strays and others: the links between components."""

    def run(key, left, right):
        out_a, out_b = [], []
        band = key[0].as_py()
        left, right = left.combine_chunks().to_batches(), right.combine_chunks().to_batches()
        if left and right:
            x, y = left[0], right[0].rename_columns([c.removesuffix("_") for c in right[0].schema.names])

            def numbers(t, name):
                return t.column(name).to_numpy(zero_copy_only=False)

            by = np.array([b.values.to_numpy() for b in y.column("bands")])
            wy, sy = numbers(y, "weight"), numbers(y, "shareable")
            roots, nodes = np.array(y.column("root").to_pylist(), object), y.column("node").to_pylist()
            for i in range(x.num_rows):
                own = x.column("bands")[i].values.to_numpy()
                same = by == own[None, :]
                first = same.any(axis=1) & (np.argmax(same, axis=1) == band)  # a pair is met in many bands
                w, s = x.column("weight")[i].as_py(), x.column("shareable")[i].as_py()
                most = np.minimum(sy, s)
                first &= (most >= least * (wy + w - most)) & (roots != x.column("root")[i].as_py())
                bag = _bag_at(x, "keys", "counts", i) if first.any() else None
                node = x.column("node")[i].as_py()
                for j in np.flatnonzero(first):
                    if similarity(bag, _bag_at(y, "keys", "counts", int(j))) >= least:
                        out_a.append(node)
                        out_b.append(nodes[j])
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    return run


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least: float = SIMILARITY,
    block: int = BLOCK,
    uid: str | None = None,
) -> DataFrame:
    """Return doc_id, uid, class_id, class_size, kept (one row of each class: its largest doc_id).

    ``uid`` is the row's number, from that column of ``docs`` or as ``numbered`` gives it.
    """
    number = uid or free_name(docs, "__uid")
    base = docs if uid else numbered(docs, number)
    base = base.select(
        F.col(doc_id).alias("doc_id"), F.col(number).alias("uid"), F.col(text).alias("text")
    )
    signed = written(_signed(base), "bag-signed")
    # buckets of two nodes or more; of bands with the same nodes the first one serves for all
    rows = signed.select("node", F.posexplode("bands").alias("band", "hash")).distinct()
    sizes = rows.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("set1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("set2"),
    )
    sizes = sizes.filter("n > 1").groupBy("n", "set1", "set2").agg(F.min(F.struct("band", "hash")).alias("first"))
    sizes = written(sizes.select("first.band", "first.hash"), "bag-buckets")
    met = written(rows.join(sizes.hint("merge"), ["band", "hash"]), "bag-met")
    # the bags of the nodes in buckets, read from one document of each
    one = signed.groupBy("node").agg(F.min("uid").alias("uid")).join(met.select("node").distinct(), "node")
    bags = written(_bagged(base.join(one.hint("merge"), "uid").select("node", "text")), "bag-bags")
    own = (
        bags.select("node", F.explode(F.arrays_zip("keys", "counts")).alias("e"))
        .groupBy("e.keys")
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("e.counts").alias("c"))
        .filter("n = 1")
        .groupBy("node")
        .agg(F.sum("c").alias("own"))
    )
    facts = bags.select("node", "weight").join(own, "node", "left")
    facts = facts.select("node", "weight", (F.col("weight") - F.coalesce("own", F.lit(0))).alias("shareable"))
    facts = facts.filter(F.col("shareable") >= least * F.col("weight"))
    live = written(met.join(facts.hint("merge"), "node"), "bag-live")

    # every node with its buckets' centres
    quality = F.struct((F.col("shareable") / F.col("weight")).alias("q"), "weight", "shareable", "node")
    centres = written(live.groupBy("band", "hash").agg(F.max(quality).alias("top")), "bag-centres")
    round_centre = live.join(centres.hint("merge"), ["band", "hash"]).filter(F.col("node") != F.col("top.node"))
    pairs = (
        round_centre.filter(
            _possible(F.col("shareable"), F.col("weight"), F.col("top.shareable"), F.col("top.weight"), least)
        )
        .select(F.col("node").alias("a"), F.col("top.node").alias("b"))
        .distinct()
    )
    first = bags.select(F.col("node").alias("a"), "keys", "counts")
    second = bags.select(F.col("node").alias("b"), F.col("keys").alias("keys2"), F.col("counts").alias("counts2"))
    links = written(
        _linked(pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b"), least), "bag-links"
    )

    # what is still open: strays, the nodes that their bucket's centre is not linked to
    joined = links.withColumn("linked", F.lit(True))
    placed = round_centre.select(
        "band", "hash", "weight", "shareable", F.col("node").alias("a"), F.col("top.node").alias("b")
    ).join(joined.hint("merge"), ["a", "b"], "left")
    placed = placed.select(
        "band",
        "hash",
        "weight",
        "shareable",
        F.col("a").alias("node"),
        F.col("linked").isNull().alias("stray"),
        F.when(F.col("linked"), F.col("b")).otherwise(F.col("a")).alias("root"),
    )
    placed = written(placed, "bag-placed")
    homes = placed.groupBy("band", "hash").agg(
        F.count_if("stray").alias("strays"),
        F.count(F.lit(1)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("stray"), F.col("weight"))), F.lit(0)).alias("stray_weight"),
        F.sum("weight").alias("weight"),
    )
    # blocks hold so many bags and so many shingles at most, about
    cut = lambda n, w: F.greatest(F.ceil(F.col(n) / block), F.ceil(F.col(w) / BLOCK_WEIGHT)).cast("int")
    homes = homes.filter("strays > 0 AND all > 1").select(
        "band", "hash", cut("strays", "stray_weight").alias("stray_blocks"), cut("all", "weight").alias("blocks")
    )
    homes = written(homes, "bag-homes")
    open_ = placed.join(homes.hint("merge"), ["band", "hash"]).withColumn("h", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["band", "hash", "node", "root", "weight", "shareable"]
    strays = open_.filter("stray").select(
        *kept, F.pmod("h", F.col("stray_blocks")).cast("int").alias("i"), every("blocks").alias("j")
    )
    others = open_.select(*kept, every("stray_blocks").alias("i"), F.pmod("h", F.col("blocks")).cast("int").alias("j"))
    groups = ["band", "hash", "i", "j"]
    strays = strays.join(bags.select("node", "bands", "keys", "counts").hint("merge"), "node")
    others = others.join(bags.select("node", "bands", "keys", "counts").hint("merge"), "node")
    others = others.select(*[F.col(c).alias(f"{c}_") for c in others.columns])
    rest = (
        strays.groupBy(*groups)
        .cogroup(others.groupBy(*[f"{c}_" for c in groups]))
        .applyInArrow(_compare_blocks(least), "a binary, b binary")
    )
    more = written(rest, "bag-rest")
    roots = connected_components(links.union(more))

    classes = signed.select("doc_id", "uid", "node").join(roots.hint("merge"), "node", "left")
    classes = written(classes.select("doc_id", "uid", F.coalesce("root", "node").alias("root")), "bag-classes")
    about = classes.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("class_size"),
        F.max(F.struct("doc_id", "uid")).alias("top"),
    )
    return classes.join(written(about, "bag-about").hint("merge"), "root").select(
        "doc_id", "uid", "class_id", "class_size", (F.col("uid") == F.col("top.uid")).alias("kept")
    )


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, all columns."""
    number = free_name(docs, "__uid")
    own = numbered(docs, number)
    kept = near_duplicates(own, text, doc_id, uid=number).filter("kept").select(F.col("uid").alias(number))
    return own.join(kept.hint("merge"), number).select(*[F.col(f"`{c}`") for c in docs.columns])
