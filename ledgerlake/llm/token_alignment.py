"""Alignment of two tokenizers' tokens over the same bytes by coalescing intervals.

Tokenizer A is a byte-level BPE of the tokenizers library and encodes a space and the
text; B is a sentencepiece model, which adds the space itself.  Each token covers the
bytes it stands for.  All tokens of both are sorted by start, the running maximum of
their ends tells where a start reaches it, and there one group of tokens ends and the
next begins.  Within groups overlapping tokens are expanded to pairs; those that end
together are links.

Links are counted over the corpus.  A pair is linked only if the bytes of one token end
with those of the other, so there are no more pairs than the lengths of all tokens of
both vocabularies sum to (some 700,000), however large the corpus; the table of counts is
broadcast on that ground.

Defined results: a text that is null, empty, or whose tokens of A or of B do not join to
a space and the text (B rewrites some characters) has no tokens; special tokens' strings
inside texts are plain text; a text of any length is aligned whole; repeated rows count
each; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .byte_bpe import CACHED_PIECES, PieceIds, byte_to_char, calls
from .shared import written

BYTE_MODEL, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links of texts that are written as one Arrow batch, about.
BATCH_TOKENS = 400_000


class ByteModel(PieceIds):
    """Ids of each pattern match by the model of a ``tokenizers`` file, and their bytes."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, most: int = CACHED_PIECES):
        whole = Tokenizer.from_file(path)
        self.model, self.chars = whole.model, byte_to_char()
        self.find, self.most = regex.compile(pattern).findall, most
        self.known: dict[str, bytes] = {}
        back = {c: b for b, c in self.chars.items()}
        names = (whole.id_to_token(i) for i in range(whole.get_vocab_size()))
        self.bytes = [bytes(back[c] for c in name) for name in names]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(packed, "<u4").tolist() for packed in self.encode(texts)]


class PieceModel:
    """Ids by a ``sentencepiece`` model, and their bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(
                bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            )
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def load_models(byte_path: str, piece_path: str) -> tuple[ByteModel, PieceModel]:
    return ByteModel(byte_path), PieceModel(piece_path)


@dataclass
class Aligned:
    """The tokens of some texts, side by side: the texts' bytes form one row of bytes.

    ``a`` and ``b`` are ids, ``a_group`` and ``b_group`` the group of each token (numbered
    through), ``a_text`` and ``b_text`` how many tokens each text has.
    """

    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_span: tuple[np.ndarray, np.ndarray]
    b_span: tuple[np.ndarray, np.ndarray]
    a_group: np.ndarray
    b_group: np.ndarray

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``a`` and in ``b`` of all pairs that share bytes, and whether they end together."""
        (a_start, a_end), (b_start, b_end) = self.a_span, self.b_span
        low = np.searchsorted(b_end, a_start, side="right")
        many = np.searchsorted(b_start, a_end, side="left") - low
        at_a = np.repeat(np.arange(len(self.a)), many)
        at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        return at_a, at_b, a_end[at_a] == b_end[at_b]


def coalesced(starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The number of each interval's group: a group ends where a start reaches all ends so far."""
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.concatenate([[0], starts[order][1:] >= reach[:-1]])) if len(order) else 0
    return group


def align(texts: list[str], first: ByteModel, second: PieceModel) -> Aligned:
    """Tokens and groups of ``texts``; texts without tokens have none of either."""
    a_ids, b_ids = first.ids([" " + t for t in texts]), second.ids(texts)
    for k, t in enumerate(texts):
        whole = b" " + t.encode()
        if not t or any(
            b"".join(map(m.bytes.__getitem__, ids[k])) != whole for m, ids in ((first, a_ids), (second, b_ids))
        ):
            a_ids[k], b_ids[k] = [], []
    sides = []
    for model, ids in ((first, a_ids), (second, b_ids)):
        many = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for some in ids for i in some), np.int64, int(many.sum()))
        ends = np.cumsum(model.sizes[flat])
        sides.append((flat, many, (ends - model.sizes[flat], ends)))
    (a, a_text, a_span), (b, b_text, b_span) = sides
    kind = np.repeat([0, 1], [len(a), len(b)])
    group = coalesced(np.concatenate([a_span[0], b_span[0]]), np.concatenate([a_span[1], b_span[1]]), kind)
    return Aligned(a, b, a_text, b_text, a_span, b_span, group[: len(a)], group[len(a) :])


def _from(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


@lru_cache(maxsize=2)
def _written_ids(n: int) -> np.ndarray:
    """Decimal ids with what may follow them: row 0 a comma, 1 a bar, 2 a semicolon, 3 nothing."""
    return np.array([[f"{i}{after}" for i in range(n)] for after in (",", "|", ";", "")], dtype=object)


def group_texts(x: Aligned, n_ids: int) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text: the groups' ids of A, then of B."""
    forms = _written_ids(n_ids)
    out = np.empty(len(x.a) + len(x.b), dtype=object)
    after_a = np.ones(len(x.a), np.int64)
    after_a[:-1] -= x.a_group[1:] == x.a_group[:-1]
    after_b = np.full(len(x.b), 2)
    after_b[:-1] -= 2 * (x.b_group[1:] == x.b_group[:-1])
    after_b[_from(x.b_text)[1:][x.b_text > 0] - 1] = 3
    out[np.arange(len(x.a)) + np.searchsorted(x.b_group, x.a_group, side="left")] = forms[after_a, x.a]
    out[np.arange(len(x.b)) + np.searchsorted(x.a_group, x.b_group, side="right")] = forms[after_b, x.b]
    ends = _from(x.a_text + x.b_text)
    pieces = out.tolist()
    for k in range(len(x.a_text)):
        yield "".join(pieces[ends[k] : ends[k + 1]])


def groups_of_texts(x: Aligned) -> np.ndarray:
    """How many groups each text has."""
    ends = _from(x.a_text)
    new = np.concatenate([[0], np.cumsum(np.concatenate([[1], np.diff(x.a_group)]))]) if len(x.a) else np.zeros(1, np.int64)
    return new[ends[1:]] - new[ends[:-1]]


def _batches(batches, paths: tuple[str, str]) -> Iterator[tuple[pa.RecordBatch, int, Aligned]]:
    """Each batch's texts in parts of bounded size, aligned: (batch, first row, tokens)."""
    models = load_models(*paths)
    for batch in batches:
        done = 0
        for part in calls(["" if t is None else t for t in batch.column("text").to_pylist()], BATCH_TOKENS):
            yield batch, done, align(part, *models)
            done += len(part)


def align_documents(docs: DataFrame, paths: tuple[str, str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, the ids and groups of both, and overlapping pairs of each document.

    ``a_groups`` and ``b_groups`` number each token's group from 0.  ``pairs`` holds the
    places of two overlapping tokens and whether they end together.
    """

    def run(batches):
        ints = pa.list_(pa.int32())
        for batch, done, x in _batches(batches, paths):
            a_at, b_at = _from(x.a_text), _from(x.b_text)
            at_a, at_b, together = x.overlaps()
            p_at = np.searchsorted(at_a, a_at)
            for k in range(len(x.a_text)):
                a, b, p = (slice(e[k], e[k + 1]) for e in (a_at, b_at, p_at))
                zero = x.a_group[a_at[k]] if x.a_text[k] else 0
                cells = [x.a[a], x.b[b], x.a_group[a] - zero, x.b_group[b] - zero]
                pairs = pa.StructArray.from_arrays(
                    [pa.array((at_a[p] - a_at[k]).astype(np.int32)), pa.array((at_b[p] - b_at[k]).astype(np.int32)), pa.array(together[p])],
                    ["a", "b", "together"],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done + k, 1)]
                    + [pa.array([c.astype(np.int32)], ints) for c in cells]
                    + [pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)],
                    ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "pairs"],
                )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run,
        f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>, "
        "pairs array<struct<a:int,b:int,together:boolean>>",
    )


def _linked(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Each document's counts, digest of groups, and its linked id pairs with their number."""

    def run(batches):
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
        n_ids = max(len(m.bytes) for m in load_models(*paths))
        for batch, done, x in _batches(batches, paths):
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in group_texts(x, n_ids)]
            at_a, at_b, together = x.overlaps()
            at_a, at_b = at_a[together], at_b[together]
            row = np.searchsorted(_from(x.a_text), at_a, side="right") - 1
            # a document's links of equal ids as one with their number
            key = (row * n_ids + x.a[at_a]) * n_ids + x.b[at_b]
            key, n = np.unique(key, return_counts=True)
            row, pair = np.divmod(key, n_ids * n_ids)
            links = pa.StructArray.from_arrays(
                [pa.array(v.astype(np.int32)) for v in (pair // n_ids, pair % n_ids, n)], ["a", "b", "n"]
            )
            ends = np.searchsorted(row, np.arange(len(x.a_text) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(done, len(x.a_text))]
                + [pa.array(v, pa.int64()) for v in (x.a_text, x.b_text, groups_of_texts(x))]
                + [pa.array(groups, pa.string()), pa.ListArray.from_arrays(pa.array(ends), links)],
                names,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<struct<a:int,b:int,n:int>>",
    )


def link_counts(linked: DataFrame) -> DataFrame:
    """a, b, n: how many links of the corpus hold the id pair."""
    each = linked.select(F.explode("links").alias("link")).select("link.a", "link.b", F.col("link.n").alias("n"))
    return each.groupBy("a", "b").agg(F.sum("n").alias("n"))


class PairCounts:
    """The counts of all linked pairs, looked up by arrays; ``best`` where no other A id has more."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n: np.ndarray):
        self.width = int(b.max(initial=0)) + 1
        key = a.astype(np.int64) * self.width + b
        order = np.argsort(key)
        self.key, self.n = key[order], n[order].astype(np.int64)
        most = np.zeros(self.width, np.int64)
        np.maximum.at(most, b, n)
        self.best = self.n == most[self.key % self.width]

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, a.astype(np.int64) * self.width + b)
        return self.n[at], self.best[at]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = _from(values)
    return total[ends[1:]] - total[ends[:-1]]


def alignment_counts(docs: DataFrame, paths: tuple[str, str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts links whose pair is, of those with its id of B, the most frequent in
    the corpus; ``count_sum`` sums the corpus counts of a document's links.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    linked = written(_linked(chosen, paths), "alignment-links")
    counts = link_counts(linked).toPandas()  # bounded by the vocabularies, see above
    sent = docs.sparkSession.sparkContext.broadcast(
        PairCounts(*(counts[c].to_numpy(dtype=np.int64) for c in ("a", "b", "n")))
    )

    def run(batches):
        for batch in batches:
            column = batch.column("links")
            ends = column.offsets.to_numpy().astype(np.int64)
            link = column.flatten()
            a, b, n = (link.field(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
            count, best = sent.value.find(a, b)
            sums = [_sums(v, ends - ends[0]) for v in (n, n * best, n * count)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
                + [pa.array(v, pa.int64()) for v in sums]
                + [batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return linked.mapInArrow(
        run,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
