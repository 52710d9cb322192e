"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file becomes a ``tokenizers`` BPE model: each byte is written as one printable
character, a token's merges are all its splits into two tokens, in rank order, and a
piece that is itself a token is taken whole.  Decoding reverses the byte table, so a
character whose bytes were split over tokens comes back whole.

Defined results: a null text counts as empty (no ids); a text of any length is encoded
whole; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of text handed to the library in one call; bounds a task's memory.
CALL_CHARS = 1 << 18
#: Pieces whose ids a task keeps.
CACHED_PIECES = 800_000


def byte_to_char() -> dict[int, str]:
    """Each byte's printable character: itself where printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


@lru_cache(maxsize=4)
def load_tokenizer(path: str, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    """The ``tokenizers`` model that encodes as the ranks in ``path`` do."""
    ranks, chars = load_ranks(path), byte_to_char()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for t in sorted(ranks, key=ranks.__getitem__):
        for k in range(1, len(t)):
            if t[:k] in ranks and t[k:] in ranks:
                merges.append((name[t[:k]], name[t[k:]]))
    tok = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tok


@lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id, read back through the character mapping."""
    back = {c: b for b, c in byte_to_char().items()}
    tok = load_tokenizer(path)
    n = max(load_ranks(path).values()) + 1
    return [bytes(back[c] for c in (tok.id_to_token(i) or "")) for i in range(n)]


def decode(ids, path: str) -> bytes:
    return b"".join(map(byte_table(path).__getitem__, ids))


def calls(texts: list[str], most: int = CALL_CHARS) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``most`` characters (a longer text alone)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encode_many(texts: list[str], path: str) -> Iterator:
    """The library's encoding (ids, character offsets and all) of each whole text."""
    tok = load_tokenizer(path)
    for part in calls(texts):
        yield from tok.encode_batch(part, add_special_tokens=False)


class PieceIds:
    """Packed ids of each pattern match, kept for matches that come again.

    The pattern splits a text into pieces that are encoded separately, so the ids of a
    text are those of its pieces.  Only new pieces go through the library's model; at
    ``most`` pieces the table starts anew, which bounds a task's memory.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, most: int = CACHED_PIECES):
        self.model, self.chars = load_tokenizer(path, pattern).model, byte_to_char()
        self.find, self.most = regex.compile(pattern).findall, most
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for part in calls(texts):
            found = [self.find(t) for t in part]
            if len(self.known) > self.most:
                self.known = {}
            known = self.known
            new = [p for p in set(chain.from_iterable(found)) if p not in known]
            for p in new:
                ids = [t.id for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.chars))]
                known[p] = struct.pack(f"<{len(ids)}I", *ids)
            for pieces in found:
                yield b"".join(map(known.__getitem__, pieces))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def bpe_encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Return doc_id, ids, starts and ends (character offsets of each token)."""

    def run(batches):
        for batch in batches:
            keys = batch.column("doc_id")
            for k, e in enumerate(encode_many(_texts(batch), path)):
                row = [keys.slice(k, 1), [e.ids], [[a for a, _ in e.offsets]], [[b for _, b in e.offsets]]]
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [row[0], *(pa.array(x, type=ints) for x in row[1:])], ["doc_id", "ids", "starts", "ends"]
                )

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>"
    )


def bpe_round_trip(
    docs: DataFrame,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Encode, then decode the ids: doc_id, n_tokens, ids_sha256, decoded_sha256 (, ids).

    ``carry`` names further columns to keep.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), *carry, F.col(text).alias("text"))

    def run(batches):
        pieces = PieceIds(path)
        for batch in batches:
            keys, done = [batch.column(c) for c in ("doc_id", *carry)], 0
            out: list[list] = [[], [], [], []]
            size = 0
            for packed in pieces.encode(_texts(batch)):
                ids = np.frombuffer(packed, dtype="<u4")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(packed).hexdigest())
                out[2].append(hashlib.sha256(decode(ids.tolist(), path)).hexdigest())
                if with_ids:
                    out[3].append(ids.astype(np.int32))
                size += len(ids)
                if size > CALL_CHARS:
                    yield made(keys, done, out)
                    done, out, size = done + len(out[0]), [[], [], [], []], 0
            if out[0]:
                yield made(keys, done, out)

    def made(keys, done, out):
        cols = [k.slice(done, len(out[0])) for k in keys]
        cols += [pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2])]
        names = ["doc_id", *carry, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            cols.append(pa.array(out[3], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(cols, names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "text")
    schema = f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return chosen.mapInArrow(run, schema)
