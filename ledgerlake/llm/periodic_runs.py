"""Periodic runs of words by an enhanced suffix array, and texts with repeats collapsed.

The words of a batch of documents form one row of symbols, no symbol shared between two
documents.  Suffixes are sorted by prefix doubling; the classes of each level give LCP
values and compare stretches of any length.  A square of two words' stretches of length
``d`` that cannot be moved one word to the right (a branching tandem) is a pair of
suffixes ``i`` and ``i + d`` whose common prefix is exactly ``d``: they lie on the two
sides of a split of an LCP interval of that value.  So for every split the suffixes of
the smaller side look up ``ISA[i + d]`` and ``ISA[i - d]`` in the other side.  Each square
found is rotated to the left as far as it goes, which gives its run; squares of a multiple
of the period give the same run and are merged into it.  Intervals come from a stack over
the LCP values; no tree nodes are kept.

A word of a run of exponent ``e`` or more occurs in it ``e`` times at least, so rarer words
need no suffix: they are symbols that equal none.

Defined results: words are runs of bytes that are no ASCII white space; a null text counts
as empty (no runs, the empty text); a text of any length is treated whole; rows are
independent, so repeated ones come out alike; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so many times as long as its period, and so long.
EXPONENT, LENGTH = 4, 6
#: Words of documents that are sorted together (a longer document alone), and suffixes of
#: smaller sides that are looked up together.
BATCH_WORDS, LOOKED_UP = 200_000, 1_000_000


class SuffixLevels:
    """Sorted suffixes of ``symbols`` (a symbol below 0 equals no other), and their classes.

    ``level[k][i]`` is the class of the ``2**k`` symbols from ``i`` on: equal where these
    are equal.  ``isa`` is the place of a suffix in ``sa``; suffixes that begin with a
    symbol below 0 are not in ``sa`` and have places beyond it, and so has the end.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        found = np.flatnonzero(symbols >= 0)
        self.sa = found[np.argsort(symbols[found], kind="stable")]
        places = np.arange(len(self.sa))
        rank = np.arange(len(self.sa), len(self.sa) + n + 1)
        head = self._heads(places, symbols[self.sa])
        rank[self.sa] = head
        self.level = [rank]
        width = 1
        open_ = self._shared(places, head)
        while len(open_):
            rank = self.level[-1]
            some = self.sa[open_]
            key = rank[some] * np.int64(2 * (n + 1)) + rank[np.minimum(some + width, n)]
            order = np.argsort(key, kind="stable")
            self.sa[open_] = some = some[order]
            head = self._heads(open_, key[order])
            rank = rank.copy()
            rank[some] = head
            self.level.append(rank)
            open_ = self._shared(open_, head)
            width *= 2
        self.isa = self.level[-1]

    @staticmethod
    def _heads(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """For each of ``places`` in order the first place with the same key."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        return places[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else places

    @staticmethod
    def _shared(places: np.ndarray, head: np.ndarray) -> np.ndarray:
        """The places whose class is not theirs alone."""
        same = head[1:] == head[:-1]
        return places[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(places) else places

    def lcp(self) -> np.ndarray:
        """Common symbols of each suffix in ``sa`` with the one before it (the first: 0)."""
        out = np.zeros(len(self.sa), np.int64)
        first = self.level[0][self.sa]
        at = np.flatnonzero(first[1:] == first[:-1]) + 1
        i, j = self.sa[at - 1], self.sa[at]
        out[at] = self._common(i, j, 1)
        return out

    def _common(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """Equal symbols from ``i`` and ``j`` on (step 1), or before them (step -1)."""
        got = np.zeros(len(i), np.int64)
        last = len(self.isa) - 1
        for k in range(len(self.level) - 1, -1, -1):
            width, rank = 1 << k, self.level[k]
            x, y = (i + got, j + got) if step > 0 else (i - got - width, j - got - width)
            inside = np.minimum(x, y) >= 0
            x, y = (np.where(inside, np.minimum(v, last), v_out) for v, v_out in ((x, last), (y, 0)))
            got += np.where(inside & (rank[x] == rank[y]), width, 0)
        return got

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols just before ``i`` and just before ``j``."""
        return self._common(i, j, -1)


def splits(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place ``j``: where its interval begins, and where its right side ends.

    The suffixes from the one to ``j - 1`` and from ``j`` to before the other share exactly
    ``lcp[j]`` symbols; every pair of suffixes lies on the two sides of one ``j``.
    """
    values = lcp.tolist()
    left, right = [0] * len(values), [len(values)] * len(values)
    stack: list[int] = []
    for j, v in enumerate(values):
        while stack and values[stack[-1]] >= v:
            right[stack.pop()] = j
        left[j] = stack[-1] if stack else 0
        if v:
            stack.append(j)
        else:  # nothing is shared across j
            stack = [j]
    return np.array(left, np.int64), np.array(right, np.int64)


def branching_tandems(x: SuffixLevels, longest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of squares that cannot be moved to the right, in parts.

    ``longest[i]`` bounds the periods wanted at ``i``.
    """
    lcp = x.lcp()
    left, right = splits(lcp)
    j = np.flatnonzero(lcp > 0)
    j = j[lcp[j] <= longest[x.sa[j]]]
    small_left = j - left[j] <= right[j] - j
    low = np.where(small_left, left[j], j)
    many = np.where(small_left, j - left[j], right[j] - j)
    # the other side
    begin, end = np.where(small_left, j, left[j]), np.where(small_left, right[j], j)
    total = np.cumsum(many)
    cut = np.searchsorted(total, np.arange(LOOKED_UP, (total[-1] if len(total) else 0) + LOOKED_UP, LOOKED_UP))
    at = 0
    for stop in np.minimum(cut + 1, len(j)).tolist():
        if stop <= at:
            continue
        part = slice(at, stop)
        n = many[part]
        which = np.repeat(np.arange(at, stop), n)
        i = x.sa[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]]
        d = lcp[j[which]]
        ends = len(x.isa) - 1
        for start, partner in ((i, np.minimum(i + d, ends)), (i - d, np.where(i >= d, i - d, ends))):
            place = x.isa[partner]
            hit = (place >= begin[which]) & (place < end[which])
            yield start[hit], d[hit]
        at = stop


def runs_of(documents: list[list[bytes]], exponent: int = EXPONENT, length: int = LENGTH) -> list[np.ndarray]:
    """For each document's words the rows (start, length, period) of its runs, by start, then period."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])  # a place after each document parts it from the next
    symbols = np.full(int(begins[-1]), -1, np.int64)
    longest = np.repeat(sizes // exponent, sizes + 1)
    known = 0
    for words, at in zip(documents, begins.tolist()):
        if len(words) < length:
            continue
        ids: dict[bytes, int] = {}
        number = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        often = np.bincount(number, minlength=len(ids)) >= exponent
        if often.any():
            symbols[at : at + len(words)] = np.where(often[number], number + known, -1)
            known += len(ids)
    x = SuffixLevels(symbols)
    starts, ends, periods = [], [], []
    for i, d in branching_tandems(x, longest):
        before = x.back(i, i + d)
        run = before + 2 * d
        kept = run >= np.maximum(exponent * d, length)
        starts.append((i - before)[kept])
        ends.append((i + 2 * d)[kept])
        periods.append(d[kept])
    if not starts:
        return [np.empty((0, 3), np.int64)] * len(documents)
    start, end, period = map(np.concatenate, (starts, ends, periods))
    # squares of the same stretch: its smallest period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    cut = np.searchsorted(start, begins)
    return [
        np.stack([start[a:b] - base, end[a:b] - start[a:b], period[a:b]], axis=1)
        for a, b, base in zip(cut[:-1], cut[1:], begins)
    ]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, of every run only the first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(change[:-1]) > 0
    return b" ".join(words[k] for k in np.flatnonzero(~dropped).tolist())


def _parts(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for t in texts:
        words = (t or "").encode().split()
        if part and size + len(words) > BATCH_WORDS:
            yield part
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield part


def periodic_runs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", exponent: int = EXPONENT, length: int = LENGTH
) -> DataFrame:
    """Return doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text."""

    def run(batches):
        for batch in batches:
            done = 0
            for part in _parts(batch.column("text").to_pylist()):
                found = runs_of(part, exponent, length)
                flat = np.concatenate(found)
                runs = pa.StructArray.from_arrays(
                    [pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]
                )
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, len(part)),
                        pa.array([len(w) for w in part], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                        pa.array([collapsed(w, r).decode() for w, r in zip(part, found)], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                done += len(part)

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
