"""Periodic runs, token alignment and source mixing, against brute force and by cases."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import byte_bpe, periodic_runs, source_mixing, token_alignment
from ledgerlake.llm.queries import QUERIES
from ledgerlake.llm.shared import table

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, source string, runs string, n_words string, links string, size string, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """Rows of (doc_id, text, source), with columns named like those the operators make."""
    return spark.createDataFrame([(*r, "r", "w", "l", "s", "p") for r in rows], DOCS)


# --- periodic runs ------------------------------------------------------------------


def brute_runs(words, exponent=4, length=6):
    """All runs by trying every period: (start, length, period), smallest periods only."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        k = 0
        while k + q < len(words):
            if words[k] != words[k + q]:
                k += 1
                continue
            begin = k
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            size = k + q - begin
            if size >= max(length, exponent * q):
                found.setdefault((begin, size), q)
    return sorted((s, n, q) for (s, n), q in found.items())


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5),
    st.integers(2, 4),
    st.integers(2, 6),
)
def test_runs_equal_brute_force(texts, exponent, length):
    got = periodic_runs.runs_of(texts, exponent, length)
    assert [list(map(tuple, g.tolist())) for g in got] == [brute_runs(t, exponent, length) for t in texts]


def test_runs_of_periodic_texts():
    rng = random.Random(5)
    texts = []
    for _ in range(300):
        root = [b"%d" % rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 12))]
        words = [b"%d" % rng.randrange(4) for _ in range(rng.randint(0, 8))]
        words += (root * 9)[: rng.randint(1, 9 * len(root))] + words[:3] + root * rng.randint(0, 6)
        texts.append(words)
    got = periodic_runs.runs_of(texts)
    assert [list(map(tuple, g.tolist())) for g in got] == [brute_runs(t) for t in texts]


def test_one_word_and_long_texts():
    many = [b"x"] * 30_000
    assert periodic_runs.runs_of([many])[0].tolist() == [[0, 30_000, 1]]
    pair = [b"x", b"y"] * 9_000 + [b"x"] * 7
    assert periodic_runs.runs_of([pair, pair])[1].tolist() == [[0, 18_001, 2], [18_000, 7, 1]]


def test_lookups_in_parts(monkeypatch):
    rng = random.Random(7)
    texts = [[b"%d" % rng.randrange(2) for _ in range(200)] for _ in range(5)]
    whole = [r.tolist() for r in periodic_runs.runs_of(texts, 3, 3)]
    monkeypatch.setattr(periodic_runs, "LOOKED_UP", 7)
    assert [r.tolist() for r in periodic_runs.runs_of(texts, 3, 3)] == whole


def test_periodic_runs_of_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "no no no no no no yes", None), (3, "a b a b\ta b a b c", "b")]
    rows += [rows[3], (4, "w " * 5, "b")]
    frame = docs(spark, rows)
    got = periodic_runs.periodic_runs(frame)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    found = Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in got.collect())
    assert found == {
        (1, 0, (), ""): 1,
        (2, 0, (), ""): 1,
        (None, 7, ((0, 6, 1),), "no yes"): 1,
        (3, 9, ((0, 8, 2),), "a b c"): 2,
        (4, 5, (), "w w w w w"): 1,  # four times its period, but too short
    }
    assert periodic_runs.periodic_runs(docs(spark, [])).count() == 0


def planted(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_op11_equals_brute_force(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()}
    texts = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        words = planted(doc_id, text)
        if len(words) > 3_000:
            continue  # brute force tries every period
        runs, r = brute_runs([w.encode() for w in words]), rows[doc_id]
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


# --- token alignment ----------------------------------------------------------------


@pytest.fixture(scope="module")
def paths():
    return tuple(map(public_tokenizers.path, (token_alignment.BYTE_MODEL, token_alignment.PIECE_MODEL)))


@pytest.fixture(scope="module")
def libraries(paths):
    first = Tokenizer.from_file(paths[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=paths[1])


def brute_tokens(text, libraries):
    """(id, end) of the tokens of both, by the libraries' own calls; none where bytes differ."""
    first, second = libraries
    if not text:
        return [], []
    back = {c: b for b, c in byte_bpe.byte_to_char().items()}
    a = [(i, bytes(back[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    out = []
    for side in (a, b):
        if b"".join(t for _, t in side) != (" " + text).encode():
            return [], []
        ends, at = [], 0
        for i, t in side:
            at += len(t)
            ends.append((i, at))
        out.append(ends)
    return out


def brute_alignment(texts, libraries):
    sides = [brute_tokens(t, libraries) for t in texts]
    links, groups = [], []
    for a, b in sides:
        b_at = {e: i for i, e in b}
        links.append([(i, b_at[e]) for i, e in a if e in b_at])
        cuts, low, said = [e for _, e in a if e in b_at], 0, []
        for e in cuts:
            said.append("|".join(",".join(str(i) for i, x in side if low < x <= e) for side in (a, b)))
            low = e
        groups.append(said)
    count = Counter(p for some in links for p in some)
    best = defaultdict(int)
    for (_, i), n in count.items():
        best[i] = max(best[i], n)
    return [
        (
            len(a),
            len(b),
            len(g),
            len(some),
            sum(count[p] == best[p[1]] for p in some),
            sum(count[p] for p in some),
            hashlib.sha256(";".join(g).encode()).hexdigest() if g else "",
        )
        for (a, b), g, some in zip(sides, groups, links)
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello  world, it's 1234567 <|endoftext|> </s> <unk>\n\n\tÜber naïve",
    "日本語 🙂🙂 ﬁ ñ",
    "two\r\nlines ",
    "x▁y",
    "é",
    " leading",
    "internationalization " * 400,
    "".join(chr(0x250 + k % 700) for k in range(3_000)),
]


def test_alignment_equals_brute_force(spark, paths, libraries):
    frame = docs(spark, [(k, t, "s") for k, t in enumerate(TEXTS + TEXTS[4:6])])
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_alignment.alignment_counts(frame, paths).collect()}
    assert [got[k] for k in range(len(got))] == brute_alignment(TEXTS + TEXTS[4:6], libraries)
    assert token_alignment.alignment_counts(docs(spark, []), paths).count() == 0


def test_op12_equals_brute_force(spark, libraries):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_token_alignment"](spark, SF_SMALL).collect()}
    rows = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want = brute_alignment([t for _, t in rows], libraries)
    assert got == dict(zip([d for d, _ in rows], want))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_alignment_of_any_texts(paths, libraries, texts):
    x = token_alignment.align(texts, *token_alignment.load_models(*paths))
    for k, (a, b) in enumerate(brute_tokens(t, libraries) for t in texts):
        cut = [slice(*np.concatenate([[0], np.cumsum(n)])[k : k + 2]) for n in (x.a_text, x.b_text)]
        assert x.a[cut[0]].tolist() == [i for i, _ in a]
        assert x.b[cut[1]].tolist() == [i for i, _ in b]


def test_alignment_pairs_and_groups(spark, paths):
    frame = docs(spark, [(1, "internationally naïve", "s"), (2, None, "s")])
    rows = {r["doc_id"]: r for r in token_alignment.align_documents(frame, paths).collect()}
    models = token_alignment.load_models(*paths)
    r = rows[1]
    spans = []
    for ids, model in zip((r["a_ids"], r["b_ids"]), models):
        ends = np.cumsum(model.sizes[ids])
        spans.append(list(zip((ends - model.sizes[ids]).tolist(), ends.tolist())))
    want = [
        (i, j, x[1] == y[1]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]
    ]
    assert [tuple(p) for p in r["pairs"]] == want
    assert all(r["a_groups"][i] == r["b_groups"][j] for i, j, _ in want)
    assert r["a_groups"][0] == 0 and r["a_groups"][-1] == r["b_groups"][-1]
    assert rows[2]["a_ids"] == [] and rows[2]["pairs"] == []


def test_pairs_are_bounded_by_the_vocabularies(paths):
    """A linked pair's shorter token ends the longer one: the stated bound of the counts."""
    first, second = token_alignment.load_models(*paths)
    by_bytes = [Counter(m.bytes) for m in (first, second)]
    pairs = sum(
        sum(by_bytes[1][t[k:]] for k in range(len(t))) for t in first.bytes
    ) + sum(sum(by_bytes[0][t[k:]] for k in range(1, len(t))) for t in second.bytes)
    assert pairs <= sum(map(len, first.bytes)) * 2 + sum(map(len, second.bytes)) < 1_000_000


def test_byte_model_keeps_its_files_order(paths):
    """The ids are those of the file, and the pattern that of its own pre-tokenizer."""
    made = json.loads(open(paths[0], encoding="utf-8").read())
    first = token_alignment.load_models(*paths)[0]
    assert len(first.bytes) >= len(made["model"]["vocab"])
    assert made["pre_tokenizer"]["type"] == "ByteLevel" and made["pre_tokenizer"]["use_regex"]


# --- source mixing ------------------------------------------------------------------


def brute_targets(sizes, share=1.5, weights=(3, 1, 2), most=2):
    """Exact targets: share, cap, share the excess among the others, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), Fraction(sum(sizes.values())) * Fraction(share)
    while True:
        left = total - sum(most * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * left >= most * sizes[s] * w}
        if not over:
            return {s: float(most * sizes[s] if s in full else left * weight[s] / w) for s in names}
        full |= over


def check_mix(rows, got):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets(sizes) if rows else {}
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["epochs"] * r["size"] <= r["taken"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, _ in rows)


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "B", "é", "zz", "a\u0000b", "🙂"][: rng.randint(1, 8)]
    rows = [
        (rng.choice([None, k]), rng.choice([None, "", "w \t v"]) if k % 9 == 0 else "w " * rng.randint(0, 40), rng.choice(names))
        for k in range(rng.randint(1, 150))
    ]
    rows += [(7, "same text here", names[0])] * 60  # a hot source of rows alike
    got = source_mixing.mix_sources(docs(spark, rows), rows_a_part=20).collect()
    check_mix(rows, got)
    again = source_mixing.mix_sources(docs(spark, rows[::-1]).repartition(3), rows_a_part=11).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_without_words_or_rows(spark):
    assert source_mixing.mix_sources(docs(spark, [])).count() == 0
    rows = [(1, None, "a"), (2, " ", None)]
    check_mix(rows, source_mixing.mix_sources(docs(spark, rows)).collect())


def test_mix_cuts_at_the_budget(spark):
    rows = [(k, "w " * 10, "a") for k in range(50)] + [(99, "w " * 1_000, "b")]
    got = source_mixing.mix_sources(docs(spark, rows)).collect()
    check_mix(rows, got)
    whole = [r for r in got if r["source"] == "a" and r["taken"] not in (10, 20)]
    assert len(whole) <= 1  # the document at the cut


def test_op13_runs_without_python(spark):
    plan = QUERIES["op13_source_mixing"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_op13_keeps_every_row(spark):
    rows = table(spark, SF_SMALL, "documents").select("doc_id", "text", "source").collect()
    check_mix([tuple(r) for r in rows], QUERIES["op13_source_mixing"](spark, SF_SMALL).collect())


def test_shared_words_do_not_cross_documents(spark):
    frame = docs(spark, [(k, "again again again", "s") for k in range(4)]).withColumn("text", F.concat("text", F.lit(" x")))
    assert all(r["runs"] == [] for r in periodic_runs.periodic_runs(frame).collect())
