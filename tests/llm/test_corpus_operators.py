"""Operators over the whole corpus: dedup, shards, near duplicates, classifier, language model."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlake.llm import bagminhash, gated_rnn, importance_resampling, minimax_shards, radix_dedup, recurrent_lm, wu_manber
from ledgerlake.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, uid string, gid string, size string, node string, root string, block string"


def docs(spark, pairs, tmp=None):
    df = spark.createDataFrame([(i, t, "u", "g", "s", "n", "r", "b") for i, t in pairs], SCHEMA).repartition(3)
    if tmp is None:
        return df
    df.write.mode("overwrite").parquet(f"{tmp}/docs")
    return spark.read.schema(df.schema).parquet(f"{tmp}/docs")


@pytest.mark.parametrize("first,growth", [(1, 1), (2, 2), (64, 16)])
def test_radix_groups(spark, tmp, first, growth):
    long = "x" * 300
    texts = [None, "", "a", "ab", "abc", "abd", "ab", "ñ", "ñ", "n", long, long + "y", long] + ["same"] * 9
    pairs = [(k, t) for k, t in enumerate(texts)] + [(3, "ab"), (None, "ab"), (None, "lone")]
    got = radix_dedup.radix_groups(docs(spark, pairs, tmp), first_run=first, growth=growth).collect()
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    want = sorted((str(i), str(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""])) for i, t in pairs)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_radix_dedup_keeps_columns(spark, tmp):
    d = docs(spark, [(1, "a"), (2, "a"), (2, "a"), (3, None)], tmp)
    out = radix_dedup.radix_dedup(d)
    assert out.columns == d.columns and out.schema["text"].dataType == d.schema["text"].dataType
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(2, "a"), (3, None)]
    assert radix_dedup.radix_dedup(docs(spark, [], tmp)).count() == 0


def brute_minimax(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)

    def fits(c):
        n, room = 1, c
        for s in sizes:
            if s > room:
                n, room = n + 1, c
            room -= s
        return n <= shards

    return next(c for c in range(low, high + 1) if fits(c))


@pytest.mark.parametrize("shards,block", [(3, 2), (8, 5), (4, 1000)])
def test_shards_are_minimax(spark, shards, block):
    rng = random.Random(shards)
    texts = ["t" * rng.randint(0, 60) + str(rng.randint(0, 3)) for _ in range(80)] + [None, "", "big" * 50, "big" * 50]
    pairs = [(k, t) for k, t in enumerate(texts)]
    got = minimax_shards.minimax_shards(docs(spark, pairs), shards, groups_a_block=block).collect()
    assert len(got) == len(pairs)
    text = dict(pairs)
    first, size = {}, Counter()
    for i, t in pairs:
        first.setdefault(t or "", i)
        size[t or ""] += len((t or "").encode()) + 1
    ordered = [size[t] for t in sorted(first, key=first.get)]
    loads, homes, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in got:
        t = text[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        loads[r["shard"]] += r["size"]
        homes[t].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(h) == 1 for h in homes.values())
    assert max(loads.values()) == brute_minimax(ordered, shards) and max(loads) < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    in_order = [next(iter(homes[t])) for t in sorted(first, key=first.get)]
    assert in_order == sorted(in_order)


def test_shards_of_nothing_and_of_repeats(spark):
    assert minimax_shards.minimax_shards(docs(spark, [])).count() == 0
    got = minimax_shards.minimax_shards(docs(spark, [(None, "a"), (1, "a"), (1, "a")])).collect()
    assert sorted(r["slot"] for r in got) == [0, 1, 2]


def test_components(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("e", "f"), ("z", "z")] + [(f"n{k}", f"n{k + 1}") for k in range(20)]
    df = spark.createDataFrame(links, "a string, b string")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert {got[x] for x in "bcd"} == {"a"} and got["f"] == "e" and "z" not in got
    assert {got[f"n{k}"] for k in range(1, 21)} == {"n0"}
    assert connected_components(df.limit(0)).count() == 0


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    for _ in range(4):
        keys = np.sort(rng.integers(0, 2**63, 30).astype(np.uint64))
        a, b = rng.integers(1, 20, 30), rng.integers(1, 20, 30)
        want = bagminhash.similarity((keys, a), (keys, b))
        s = bagminhash.signatures([(keys, a), (keys, b)], 4096)
        assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / 4096) ** 0.5


def brute_classes(pairs):
    hashes = bagminhash.WordHashes()
    bags = [bagminhash.shingle_bag(t, hashes) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            same = (pairs[i][1] or "") == (pairs[j][1] or "")
            if same or bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    out = defaultdict(set)
    for k in range(len(pairs)):
        out[find(k)].add(k)
    return {frozenset(v) for v in out.values()}


def near_family(rng, n):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"v{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [3, 256])
def test_near_duplicates_match_brute_force(spark, tmp, block):
    rng = random.Random(11)
    texts = near_family(rng, 40) + near_family(rng, 6) + ["one two", "One, two!", "", None, "!!", "??", "!!", "solo text here"]
    texts += [" ".join(["again"] * 50), " ".join(["again"] * 48), " ".join(["again"] * 20)]
    pairs = [(k, t) for k, t in enumerate(texts)]
    got = bagminhash.near_duplicates(docs(spark, pairs, tmp), block=block).collect()
    classes = defaultdict(set)
    for r in got:
        classes[r["class_id"]].add(r["doc_id"])
    assert {frozenset(v) for v in classes.values()} == brute_classes(pairs)
    assert all(r["class_id"] == min(classes[r["class_id"]]) and r["class_size"] == len(classes[r["class_id"]]) for r in got)
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(max(c) for c in classes.values())


def test_near_duplicates_of_the_small_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    classes = defaultdict(set)
    for r in bagminhash.near_duplicates(df).collect():
        classes[r["class_id"]].add(r["doc_id"])
    assert {frozenset(v) for v in classes.values()} == {frozenset(pairs[k][0] for k in c) for c in brute_classes(pairs)}


def test_near_dedup_edge_rows(spark, tmp):
    d = docs(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (None, None)], tmp)
    out = bagminhash.near_dedup(d)
    assert out.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == [(5, "a b c d e f"), (None, None)]
    assert bagminhash.near_dedup(docs(spark, [], tmp)).count() == 0


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    model = importance_resampling.fit(df, half)
    held = labels.filter("doc_id % 2 = 1").join(importance_resampling.score(df, model), "doc_id").collect()
    good = [r["kept"] for r in held if r["quality"] == 1]
    bad = [r["kept"] for r in held if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2
    kept = importance_resampling.accepted(df, model)
    assert kept.columns == df.columns
    assert kept.count() == importance_resampling.score(df, model).filter("kept").count()


def test_classifier_counts_and_sampling(spark, tmp):
    d = docs(spark, [(1, "good words here"), (2, "bad $$$ $$$"), (3, None), (3, ""), (None, "good words")], tmp)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, quality int")
    model = importance_resampling.fit(d, labels)
    hashes = importance_resampling.Buckets()
    raw = Counter()
    for t in ("good words here", "bad $$$ $$$", "good words"):
        raw.update(importance_resampling.features(t, hashes).tolist())
    size = importance_resampling.WORD_BUCKETS + importance_resampling.PAIR_BUCKETS
    b = int(importance_resampling.features("$$$", hashes)[0])
    total = size + sum(raw.values())
    assert raw[b] == 2
    assert model.log_ratio[b] <= np.log(1 / size) - np.log((raw[b] + 1) / total) + 1e-9
    got = importance_resampling.gumbel_top(importance_resampling.score(d, model), share=0.4).collect()
    keys = sorted((r["gumbel_key"] for r in got), reverse=True)
    assert len(got) == 5 and all(r["sampled"] == (r["gumbel_key"] >= keys[1] - 1e-6) for r in got)
    empty = importance_resampling.score(docs(spark, [], tmp), model)
    assert importance_resampling.gumbel_top(empty).count() == 0
    assert importance_resampling.fit(docs(spark, [], tmp), labels.limit(0)).threshold == float("-inf")


def test_kth_largest(spark):
    rng = random.Random(2)
    values = [rng.randint(-(10**12), 10**12) for _ in range(300)] + [7] * 30
    df = spark.createDataFrame([(v,) for v in values], "key long")
    for k in (1, 5, 150, 330):
        assert importance_resampling._kth_largest(df, k, ways=16) == sorted(values, reverse=True)[k - 1]


def test_gradients_match_differences():
    shape = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5)
    rng = np.random.default_rng(0)
    flat = gated_rnn.start(shape, np.ones(shape.ids)).astype(np.float64)
    flat += rng.standard_normal(len(flat)) * 0.3
    texts = [rng.integers(0, shape.ids, n) for n in (9, 4, 1)]

    def loss(w):
        return -gated_rnn.score_texts(shape, w, texts).sum() * np.log(10.0)

    class Probe(gated_rnn.Trainer):
        def _step(self, *window):
            self.rate = 0.0
            return super()._step(*window)

    t = Probe(shape, flat, 0.0)
    t.fit(texts, rows=3, window=16)
    grad = t.first / 0.1 * sum(map(len, texts))
    assert len(grad) == shape.trained == len(flat) - sum(shape.views(flat)[name].size for name in ("cb", "wb"))
    for k in rng.choice(shape.trained, 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-3
        down[k] -= 1e-3
        assert abs((loss(up) - loss(down)) / 2e-3 - grad[k]) < 2e-2 * max(1.0, abs(grad[k]))


def test_texts_in_a_row_train_as_apart():
    """A text that begins within a window has the gradient that it has in a window of its own."""
    shape = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5)
    rng = np.random.default_rng(4)
    flat = gated_rnn.start(shape, np.ones(shape.ids)).astype(np.float64) + rng.standard_normal(shape.floats) * 0.3
    texts = [rng.integers(0, shape.ids, n) for n in (9, 4, 1, 6)]
    grads = []
    for rows in (1, 4):
        t = gated_rnn.Trainer(shape, flat, 0.0)
        t.fit(texts, rows=rows, window=32)
        grads.append(t.first)
    assert np.allclose(grads[0], grads[1])


def test_windows_carry_the_state():
    shape = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5)
    rng = np.random.default_rng(3)
    flat = (rng.standard_normal(shape.floats) * 0.5).astype(np.float32)
    texts = [rng.integers(0, shape.ids, n) for n in (50, 1, 33, 32, 7)]
    whole = gated_rnn.score_texts(shape, flat, texts, window=64)
    assert np.allclose(gated_rnn.score_texts(shape, flat, texts, window=8), whole, atol=1e-3)
    alone = [gated_rnn.score_texts(shape, flat, [t], window=5)[0] for t in texts]
    assert np.allclose(alone, whole, atol=1e-3)
    p = shape.views(flat)
    states = rng.standard_normal((1, 5)).astype(np.float32)
    buf = gated_rnn.Buffers()
    every = [gated_rnn.token_scores(shape, p, states, np.array([i]), buf)[0][0] for i in range(shape.ids)]
    assert abs(np.exp(every).sum() - 1.0) < 1e-5


def test_training_carries_the_state_over_whole_texts():
    shape = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5)
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, shape.ids, n) for n in (600, 40)]
    starts, carried = [], []

    class Probe(gated_rnn.Trainer):
        def _step(self, inputs, ids, kept, h0):
            starts.append(int((inputs[ids >= 0] == shape.ids).sum()))
            assert starts[-1] == int((kept[ids >= 0] == 0).sum())  # a text begins with a state of zeros
            carried.append(bool(np.abs(h0[:, 0]).max() > 0))
            return super()._step(inputs, ids, kept, h0)

    t = Probe(shape, gated_rnn.start(shape, np.ones(shape.ids)), 0.01)
    t.fit(texts, rows=2, window=32)
    assert t.tokens == 640 and t.pending == 0
    assert starts[0] == 2 and not any(starts[1:])  # one start for each text
    assert len(carried) == 19 and not carried[0] and all(carried[1:])


def test_every_training_text_reaches_the_network(spark):
    n, last = 24, recurrent_lm.SHAPE.ids - 1
    encoded = spark.createDataFrame([(k, 2, [k, last]) for k in range(n)], "part long, n_tokens long, ids array<int>")
    before = gated_rnn.start(recurrent_lm.SHAPE, np.ones(recurrent_lm.SHAPE.ids))
    after = recurrent_lm.train(encoded, before, 2 * n, tokens_a_copy=4)
    moved = np.abs(recurrent_lm.SHAPE.views(after)["x"] - recurrent_lm.SHAPE.views(before)["x"]).max(axis=1)
    assert (moved[:n] > 0).all()  # text k alone has id k
    assert not moved[n:last].any()


def test_copies_are_summed_a_few_at_a_time(spark):
    rng = np.random.default_rng(6)
    rows = [(at, k, k + 1, rng.standard_normal(3).tobytes()) for at in (0, 3) for k in range(10)]
    pieces = spark.createDataFrame(rows, "at long, copy long, tokens long, piece binary")
    once = recurrent_lm.summed_copies(pieces, fan=4)
    assert sorted((r["at"], r["copy"], r["tokens"]) for r in once.collect()) == [
        (at, c, n) for at in (0, 3) for c, n in enumerate((10, 26, 19))
    ]
    for r in recurrent_lm.summed_copies(once, fan=4).collect():
        want = sum(np.frombuffer(p) for at, _, _, p in rows if at == r["at"])
        assert r["tokens"] == 55 and np.allclose(np.frombuffer(r["piece"]), want)


def test_tokens_of_a_batch_equal_those_of_each_text():
    import pyarrow as pa

    texts = [None, "", " A\tb\x0bB c ", "\n", "é\u00a0x\u2003y \x1c z", "one", "x " * 500]
    words, begins = recurrent_lm.all_tokens(pa.array(texts, pa.string()).slice(0))
    whole = words.to_pylist()
    assert [whole[a:b] for a, b in zip(begins[:-1], begins[1:])] == [recurrent_lm.tokens(t) for t in texts]
    words, begins = recurrent_lm.all_tokens(pa.array(texts, pa.string()).slice(2, 3))
    assert [words.to_pylist()[a:b] for a, b in zip(begins[:-1], begins[1:])] == [recurrent_lm.tokens(t) for t in texts[2:5]]
    assert [n for _, n in recurrent_lm._slices(pa.array(texts, pa.string()), most=9)] == [3, 1, 1, 1, 1]


def test_base_scores_match_brute_force(spark, tmp):
    rng = random.Random(4)
    pairs = [(k, " ".join(f"w{min(rng.randint(0, 40), rng.randint(0, 40))}" for _ in range(rng.randint(0, 60)))) for k in range(60)]
    pairs += [(100, None), (101, " A\tb\x0bB c "), (102, "w1 " * 3000), (None, "w1 w2"), (5, "twice"), (5, "twice")]
    got = recurrent_lm.score_documents(docs(spark, pairs, tmp)).collect()
    split = [("" if i is None else str(i), [*(t or "").encode().lower().split(), b""]) for i, t in pairs]
    held = [zlib.crc32(i.encode()) % 7 == 2 for i, _ in split]
    c = Counter(w for (_, ws), h in zip(split, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4))
        for (i, ws), h in zip(split, held)
    )
    have = sorted(
        ("" if r["doc_id"] is None else str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
        for r in got
    )
    assert have == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def brute_score(shape, flat, text):
    """The log10 probability of one text's ids, a token at a time in double precision."""
    p = {k: v.astype(np.float64) for k, v in shape.views(flat).items()}
    k, h, last, total = shape.hidden, np.zeros(shape.hidden), shape.ids, 0.0

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    for i in text:
        a, b = p["x"][last], p["u"] @ h
        z, r = (1 / (1 + np.exp(-(a[s] + b[s]))) for s in (slice(0, k), slice(k, 2 * k)))
        n = np.tanh(a[2 * k :] + r * b[2 * k :])
        h = (1 - z) * n + z * h
        cls = i // shape.size if i < shape.words else shape.classes + i - shape.words
        total += log_softmax(h @ p["c"] + p["cb"])[cls]
        if i < shape.words:
            total += log_softmax(h @ p["w"][cls] + p["wb"][cls])[i % shape.size]
        last = i
    return total / np.log(10.0)


def test_scores_equal_a_token_by_token_sum():
    shape = gated_rnn.Shape(classes=5, size=4, groups=3, hidden=6)
    rng = np.random.default_rng(12)
    counts = rng.integers(0, 9, shape.ids) * rng.integers(0, 2, shape.ids)
    counts[-1] += 1
    seen = np.flatnonzero(counts)
    texts = [rng.choice(seen, n) for n in (3, 1, 70, 33, 200, 64)]
    t = gated_rnn.Trainer(shape, gated_rnn.start(shape, counts), 0.05)
    t.fit(texts * 4, rows=5)
    want = [brute_score(shape, t.flat, x) for x in texts]
    assert np.allclose(gated_rnn.score_texts(shape, t.flat, texts), want, atol=2e-3)
    # ids that no word has have no probability, after training too
    p, buf = shape.views(t.flat), gated_rnn.Buffers()
    states = rng.standard_normal((1, 6)).astype(np.float32)
    every = np.array([np.exp(gated_rnn.token_scores(shape, p, states, np.array([i]), buf)[0][0]) for i in range(shape.ids)])
    assert abs(every[seen].sum() - 1.0) < 1e-4 and every[counts == 0].max(initial=0.0) < 1e-6


def test_score_is_the_sum_over_the_network_groups_and_tails(spark, tmp, monkeypatch):
    """Whole scores from the trained weights, word by word, with words of every kind."""
    monkeypatch.setattr(recurrent_lm, "GROUP_RANKS", (8, 12))
    monkeypatch.setattr(recurrent_lm, "SHAPE", gated_rnn.Shape(2, 4, 3, 6))
    rng = random.Random(9)
    pairs = [(k, " ".join(f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(rng.randint(0, 90)))) for k in range(80)]
    pairs += [(200, "rare unseen w1"), (201, ""), (202, "w2 " * 3500)]
    made = {}
    real = recurrent_lm.train

    def kept(*a, **b):
        made["weights"] = real(*a, **b)
        return made["weights"]

    monkeypatch.setattr(recurrent_lm, "train", kept)
    df = docs(spark, pairs, tmp)
    got = {r["doc_id"]: r["score"] for r in recurrent_lm.score_documents(df).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs}
    words = {i: [*(t or "").encode().split(), b""] for i, t in pairs}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    head = sorted(((w, n) for w, n in c.items() if n > 1), key=lambda x: (-x[1], x[0]))
    lexicon = recurrent_lm.Lexicon(head, sum(c.values()), len(c))
    rest = sum(n + 1 for w, n in c.items() if w not in lexicon.words) + 1
    for i, ws in words.items():
        ids = [int(lexicon.ids[lexicon.words[w]]) if w in lexicon.words else recurrent_lm.SHAPE.ids - 1 for w in ws]
        want = brute_score(recurrent_lm.SHAPE, made["weights"], ids)
        for w in ws:
            want += lexicon.share[lexicon.words[w]] if w in lexicon.words else np.log10((c[w] + 1) / rest)
        assert got[i] == pytest.approx(want, abs=5e-3, rel=1e-5)


def test_score_does_not_hang_on_the_partitions(spark, tmp):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    scores = []
    for n in (1, 8):
        some = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        scores.append({r["doc_id"]: r["score"] for r in recurrent_lm.score_documents(some).collect()})
    assert all(scores[0][i] == pytest.approx(scores[1][i], rel=1e-5, abs=1e-3) for i, _ in rows)


def test_untrained_scores_are_the_base_scores():
    head = [(b"a", 9), (b"", 5), (b"b", 2)]
    lexicon = recurrent_lm.Lexicon(head, 19, 6)  # three more words, seen once
    flat = gated_rnn.start(recurrent_lm.SHAPE, lexicon.counts)
    for part in ("x", "u", "c", "w"):
        recurrent_lm.SHAPE.views(flat)[part][...] = 0.0
    ids = [int(lexicon.ids[lexicon.words[w]]) for w in (b"a", b"b", b"")] + [recurrent_lm.SHAPE.ids - 1] * 2
    score = gated_rnn.score_texts(recurrent_lm.SHAPE, flat, [np.array(ids)])[0] + np.log10(2) + 0.0 - 2 * lexicon.rest_norm
    base = lexicon.base[[lexicon.words[w] for w in (b"a", b"b", b"")]].sum() + np.log10(2) - 2 * lexicon.base_norm
    assert score == pytest.approx(base, abs=1e-4)


def test_language_model_beats_the_base(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = recurrent_lm.score_documents(df).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert recurrent_lm.score_documents(df.limit(0)).count() == 0


def test_columns_of_any_name_are_kept(spark, tmp):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(k, t, f"u{k}", f"r{k}", f"n{k}") for k, t in enumerate([text, text, text + " more", "other words here", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, __uid string, __ROW string, __uid_ string")
    df.write.parquet(f"{tmp}/named")
    df = spark.read.schema(df.schema).parquet(f"{tmp}/named")
    items = spark.createDataFrame([(1, "other words here")], "item_id long, text string")
    for kept, ids in (
        (radix_dedup.radix_dedup(df), {1, 2, 3, 4}),
        (bagminhash.near_dedup(df), {2, 3, 4}),
        (wu_manber.clean_documents(df, items), {0, 1, 2, 4}),
    ):
        assert kept.columns == df.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[0] in ids), key=str)


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    df = spark.read.parquet(f"{SF}/documents.parquet")
    kept = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == df.columns, name
    from ledgerlake.llm.shared import written

    kept = written(kept, "test-kept")
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == len(set(texts)) and 0 < len(texts) < df.count()
    done = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in done) == sorted(r["doc_id"] for r in kept.collect())


def test_words_that_reach_a_count(spark):
    """Steps are compared with each count once: the same numbers as over the words."""
    n = [1, 1, 2, 2, 2, 3, 8, 9, 1 << 40]
    counts = spark.createDataFrame([(str(k), c) for k, c in enumerate(n)], "word string, n long")
    steps = [2 ** (k / 8) for k in range(8, 400)]
    assert recurrent_lm.reached(counts, steps) == [sum(c >= s for c in n) for s in steps]
    assert recurrent_lm.reached(counts.limit(0), steps) == [0] * len(steps)


def test_scoring_keeps_the_gates_of_one_step():
    shape = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5)
    flat = gated_rnn.start(shape, np.ones(shape.ids))
    inputs, buf = np.random.default_rng(5).integers(0, shape.ids, (32, 7)), gated_rnn.Buffers()
    states = gated_rnn.run_window(shape, shape.views(flat), inputs, np.zeros((5, 7), np.float32), buf)[0]
    assert states.shape == (32, 5, 7)
    assert all(buf.held[name].size == 3 * 5 * 7 for name in ("gates", "inner", "read"))
    # the states are those of training, which keeps all steps
    carried = np.ones((32, 7), np.float32)
    kept = gated_rnn.run_window(shape, shape.views(flat), inputs, np.zeros((5, 7), np.float32), gated_rnn.Buffers(), carried)
    assert np.array_equal(kept[0], states) and kept[2].shape == (32, 15, 7)


def test_ids_are_stored_as_bytes(spark):
    """Two bytes an id, as a whole; arrays of numbers are read too."""
    import pyarrow as pa

    lexicon = recurrent_lm.Lexicon([(b"", 5), (b"b", 4), (b"a", 3)], 19, 6)
    text = pa.array(["x", None, "a b zz", "", "B " * 9]).slice(1)
    rows = pa.table(recurrent_lm.encode_texts(text, lexicon), ["n_tokens", "head_known", "head_base", "share", "ids", "tail"])
    other = recurrent_lm.SHAPE.ids - 1
    want = [[0], [2, 1, other, 0], [0], [1] * 9 + [0]]
    assert [len(b) for b in rows["ids"].to_pylist()] == [2 * len(w) for w in want]
    assert [t.tolist() for t in recurrent_lm._texts(rows.to_batches())] == want
    assert [t.tolist() for t in recurrent_lm._texts(rows.slice(1, 2).to_batches())] == want[1:3]
    arrays = pa.table({"ids": pa.array(want, pa.list_(pa.int32()))})
    assert [t.tolist() for t in recurrent_lm._texts(arrays.to_batches())] == want


def test_windows_of_training_hold_each_slots_texts():
    """Slots filled a step at a time: the same ids, reads and beginnings, whatever the lengths."""
    shape, rng = gated_rnn.Shape(classes=3, size=4, groups=2, hidden=5), random.Random(2)
    texts = [np.array([rng.randrange(shape.ids) for _ in range(rng.choice((1, 2, 7, 8, 9, 16, 40)))]) for _ in range(60)]
    seen = []

    class Probe(gated_rnn.Trainer):
        def _step(self, inputs, ids, carried, h0):
            seen.append((inputs.T.tolist(), ids.T.tolist(), carried.T.tolist()))
            return super()._step(inputs, ids, carried, h0)

    t = Probe(shape, gated_rnn.start(shape, np.ones(shape.ids)), 0.01)
    t.fit(iter(texts), rows=4, window=8)
    assert t.tokens == sum(map(len, texts))
    left, slots, want = iter(texts), [[] for _ in range(4)], []
    while True:
        window = []
        for s in range(len(slots)):
            row = []
            while len(row) < 8:
                if not slots[s]:
                    text = next(left, np.empty(0, int)).tolist()
                    slots[s] = list(zip([shape.ids, *text[:-1]], text, [0.0] + [1.0] * len(text)))
                    if not slots[s]:
                        break
                row.append(slots[s].pop(0))
            window.append(row + [(shape.ids, -1, 1.0)] * (8 - len(row)))
        busy = [s for s, row in enumerate(window) if row[0][1] >= 0]
        if not busy:
            break
        slots = [slots[s] for s in busy]
        want.append(tuple([[x[j] for x in window[s]] for s in busy] for j in range(3)))
    assert seen == want


def test_counts_add_up_over_batches(spark):
    texts = [None, "", " a A b", "b\tc ", "a", "\n"] * 7
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = {bytes(r["word"]): r["n"] for r in recurrent_lm.count_words(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {b"": 42, b"a": 21, b"b": 14, b"c": 7}
