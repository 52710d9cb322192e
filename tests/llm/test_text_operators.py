"""Operators that work on one text at a time: BPE, separator scan, HTML, decontamination, chat."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import byte_bpe, line_blocks, perspective_chat, separator_scan, wu_manber
from ledgerlake.llm.queries import QUERIES, rank_file

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, ids string, row string, spans string, bytes string"
LONG = " ".join(f"w{k % 97}x{k}" for k in range(40_000))


def docs(spark, texts, first=1):
    rows = [(k + first, t, "x", "y", "z", "b") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers

    ranks = byte_bpe.load_ranks(rank_file())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "a", "a\n\n b\t", "Straße über  alles 🙂🙂 ñandú", "it's we'll 123 !!", "İ  x", LONG]


def test_bpe_matches_tiktoken(spark, reference):
    got = {r["doc_id"]: r for r in byte_bpe.bpe_round_trip(docs(spark, TEXTS), rank_file()).collect()}
    assert len(got) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        ids = reference.encode_ordinary(t or "")
        r = got[k + 1]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_offsets_and_empty_table(spark, reference):
    texts = ["naïve 🙂 text", None]
    got = sorted(byte_bpe.bpe_encode(docs(spark, texts), rank_file()).collect())
    assert got[0]["ids"] == reference.encode_ordinary(texts[0])
    assert got[0]["starts"][0] == 0 and got[0]["ends"][-1] == len(texts[0])
    assert got[1]["ids"] == []
    assert byte_bpe.bpe_round_trip(docs(spark, []), rank_file()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_bpe_any_text(reference, text):
    (packed,) = byte_bpe.PieceIds(rank_file()).encode([text])
    ids = np.frombuffer(packed, "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert byte_bpe.decode(ids, rank_file()) == text.encode()


def test_piece_table_starts_anew():
    full, small = byte_bpe.PieceIds(rank_file()), byte_bpe.PieceIds(rank_file(), most=3)
    texts = ["one two three four five", "five six seven", "one two"] * 3
    assert list(full.encode(texts)) == list(x for t in texts for x in small.encode([t]))


def test_token_counts(spark, reference):
    got = {r["doc_id"]: r for r in separator_scan.count_tokens(docs(spark, TEXTS), rank_file()).collect()}
    assert {k: r["n_tokens"] for k, r in got.items()} == {
        k + 1: len(reference.encode_ordinary(t or "")) for k, t in enumerate(TEXTS)
    }
    assert all(r["ended"] for r in got.values())
    assert separator_scan.count_tokens(docs(spark, []), rank_file()).count() == 0


@pytest.mark.parametrize("block,stretch", [(1, 1), (2, 2), (7, 3), (1000, 4)])
def test_scan_stitches_blocks(spark, tmp, block, stretch):
    rng = random.Random(block)
    want = []
    for f in range(4):
        ids = [rng.choice([9, 1, 2, 3, 4]) for _ in range(rng.choice([0, 1, 30, 61]))]
        np.array(ids, dtype="<u2").tofile(f"{tmp}/{f}.bin")
        at = 0
        for k, x in enumerate([*ids, None]):
            if x == 9 or x is None and k > at:
                want.append((f"{tmp}/{f}.bin", at, k - at, x == 9))
                at = k + 1
    files = spark.createDataFrame([(f"{tmp}/{f}.bin",) for f in range(4)], "file string")
    got = separator_scan.scan_token_files(spark, files, separator=9, block_ids=block, stretch=stretch).collect()
    assert sorted((r["file"], r["start"], r["n_tokens"], r["ended"]) for r in got) == sorted(want)
    by_file = {}
    for r in sorted(got, key=lambda r: (r["file"], r["start"])):
        assert r["ordinal"] == by_file.get(r["file"], 0)
        by_file[r["file"]] = r["ordinal"] + 1


def test_scan_refuses_half_an_id(spark, tmp):
    with open(f"{tmp}/odd.bin", "wb") as f:
        f.write(b"\x01\x02\x03")
    files = spark.createDataFrame([(f"{tmp}/odd.bin",)], "file string")
    with pytest.raises(Exception, match="not a multiple"):
        separator_scan.scan_token_files(spark, files).count()


PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href=/a>menu</a></li></ul></nav><div class='cookie notice'>We use cookies</div>"
    "<article><h1>Head &amp; line</h1><p>First  \n para&nbsp;graph<br>more</p><div class=ad>Buy<div>now</div></div>"
    "<p>x &lt; y &#233;<p>short</p><form>mail <input></form><aside>see also</aside></article>"
    "<section id=comments><article><p>Nice post, thank you all so much for it</p></article></section>"
    "<footer>&copy; us</footer></body></html>"
)


@pytest.mark.parametrize(
    "html,want",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        (PAGE, "Head & line\nFirst para graph more\nx < y é\nshort"),
        (PAGE[: PAGE.index("</article>")] + "</ar", "Head & line\nFirst para graph more\nx < y é\nshort"),
        ("<body><nav>menu</nav><p>" + "long text " * 20 + "</p><footer>f</footer>", ("long text " * 20).strip()),
        ("<body><p>tiny</p></body>", "tiny"),
        ("<div class=ad>never closed<article><p>Text kept</p></article>", "Text kept"),
        ("<article><header><h1>Own head</h1></header><p>a<b>b</b>c</p></article>", "Own head\nabc"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
    ],
)
def test_main_text(html, want):
    assert line_blocks.main_text(html) == want


LINE = "Main text that is long enough to stand for itself, and that no marker of the page covers at all."


def test_text_outside_article_markers_stays():
    teasers = "".join(f"<article><h3>Teaser {k}</h3><p>short</p></article>" for k in range(3))
    got = line_blocks.main_text(f"<div class=content><p>{LINE}</p><p>{LINE}</p></div><div>{teasers}</div>").split("\n")
    assert got[:2] == [LINE, LINE]


LINKS = "<ul>" + "<li><a href=/x>other page</a></li>" * 4 + "</ul>"


@pytest.mark.parametrize(
    "html,want",
    [
        ("<div><div><p>A paragraph of forty characters, or so.</p></div><div><p>Another of the same size, in a div.</p></div>"
         "<div><p>A third, and they are one text.</p></div></div>",
         "A paragraph of forty characters, or so.\nAnother of the same size, in a div.\nA third, and they are one text."),
        ("<table>" + "<tr><td>cell one</td><td>2</td></tr>" * 12 + "</table>", "\n".join(["cell one", "2"] * 12)),
        (f"<p>{LINE}</p><p><a href=/s>Source</a></p><p>x</p><p>{LINE}</p>", f"{LINE}\nSource\nx\n{LINE}"),
        (f"<a name=top><p>{LINE}</p><p>{LINE}</p>", f"{LINE}\n{LINE}"),
        (f"<p><a href=/x>left open</p><p>{LINE}</p>", f"left open\n{LINE}"),
        (f"{LINKS}<p>{LINE}</p>{LINKS}<p>{LINE}</p>{LINKS}<p>label</p>{LINKS}", f"{LINE}\n{LINE}"),
    ],
)
def test_short_lines_and_links_stay_in_a_run(html, want):
    assert line_blocks.main_text(html) == want


@pytest.mark.parametrize(
    "html,want",
    [
        ("<article><p style='overflow:hidden'>a<p title='class=ad'>b<p data-hidden=false>c</article>", "a\nb\nc"),
        ("<article><div><a href='/hidden-gems'>Gems</a></div><div hidden>x</div><div aria-hidden=true>y</div></article>", "Gems"),
        ("<article class='post has-sidebar'><h2 id=related-work>Related work</h2><p>a <b class=notice>b</b></p></article>",
         "Related work\na b"),
        ("<article><section id=search><p>On search</p></section><div role=search>box</div></article>", "On search"),
        ("<article><div class=site-footer>f</div><div class=ad-banner-2>x</div><div class=no-comments>kept</div></article>", "kept"),
        ("<article><p>a<p class=ad>buy<p>b<p>c</article>", "a\nb\nc"),
        ("<article><div><p>a<p class=ad>buy</div>b</article>", "a\nb"),
        ("<article><ul><li>a<li class=share>s<ul><li>s1</ul><li>b</ul><p>c</article>", "a\nb\nc"),
        ("<article><ul><li class=share>s</ul><p>c</article>", "c"),
        ("<article><table><tr><td>a<td class=ad>x<td>b<tr class=promo><td>y<tr><td>c</table><p>d</article>", "a\nb\nc\nd"),
        ("<article>one<span hidden> two</span> three</article>", "one three"),
    ],
)
def test_hints_and_implied_ends(html, want):
    assert line_blocks.main_text(html) == want


def paragraphs(n, size=40):
    """``n`` paragraphs of ``size`` words, each its own."""
    return [" ".join(f"word{k}x{j}" for j in range(size)) + "." for k in range(n)]


def wrapped(texts, before="<p>", after="</p>"):
    return "".join(before + t + after for t in texts)


BODY = paragraphs(4)
MARKED = f"<article>{wrapped(BODY)}</article>"
NOTICE = "Copyright 2024 Acme Inc. All rights reserved."
LETTER = "Subscribe to our newsletter for weekly updates from the team."
REMARK = "Great article, thank you so much for writing it down!"


@pytest.mark.parametrize(
    "html,want",
    [
        ("<div id=content><p>Office closed today.</p></div>", ["Office closed today."]),
        (f"<p>All the news since 1901</p>{MARKED}<p>{NOTICE}</p>", BODY),
        (f"{MARKED}<div><p>{LETTER}</p></div><div><p>{REMARK}</p></div>", BODY),
        (f"<body><div>{wrapped(BODY)}</div><div><p>{LETTER}</p></div><div><p>{REMARK}</p></div></body>", BODY),
        (f"<div>{wrapped(BODY)}</div><h3>3 responses</h3><ol class=replies><li>{REMARK}<li>{REMARK}</ol>", BODY),
        (f"<div>{wrapped(BODY)}<h3>3 responses</h3><ol><li>{REMARK}<li>{REMARK}</ol></div><p>x</p>", BODY),
        (f"<body><header><p>Tagline of the site<div>{wrapped(BODY)}</div></body>", BODY),
        (f"<body><header><h1>Head</h1>{wrapped(BODY)}</body>", ["Head", *BODY]),  # nothing says where the header ends
        (f"<body><nav><a href=/>Home</a><main>{wrapped(BODY)}</main></body>", BODY),
        (f"<div><article>Teaser</article></div><div>{wrapped(BODY)}</div>", BODY),
        (MARKED + "<aside>more</aside>" + "<p>" + " ".join(BODY) + "</p>", [*BODY, " ".join(BODY)]),
    ],
)
def test_bodies_by_the_distribution_of_the_page(html, want):
    assert line_blocks.main_text(html).split("\n") == (want or [""])


SHORT = ["A short one.", "Two words."]


@pytest.mark.parametrize(
    "html,want",
    [
        # body in one element
        (f"<div id=main-text>{wrapped(BODY)}</div>", BODY),
        (f"<div><h1>Title</h1><div>{wrapped(BODY)}</div></div>", ["Title", *BODY]),
        (f"<section><h2>One</h2>{wrapped(BODY[:2])}<h2>Two</h2>{wrapped(BODY[2:])}</section>", ["One", *BODY[:2], "Two", *BODY[2:]]),
        (f"<div>{wrapped(BODY)}{wrapped(SHORT)}</div><div><p>{LETTER}</p></div>", BODY + SHORT),
        (f"<div>{wrapped(SHORT)}{wrapped(BODY)}<ul><li>a<li>b</ul></div>", [*SHORT, *BODY, "a", "b"]),
        (f"<div>{wrapped(BODY)}<p><a href=/s>All sources of this text</a></p></div>", [*BODY, "All sources of this text"]),
        # body in sections of one element
        ("<div>" + wrapped(BODY, "<section><p>", "</p></section>") + f"</div><div><p>{LETTER}</p></div>", BODY),
        ("<div>" + wrapped([*BODY, *SHORT], "<div><p>", "</p></div>") + f"</div><p>{NOTICE}</p>", BODY + SHORT),
        # no element holds the body
        (wrapped(BODY), BODY),
        (wrapped([BODY[0], *SHORT, BODY[1]]), [BODY[0], *SHORT, BODY[1]]),
        (wrapped([*BODY, NOTICE]), BODY),
        (wrapped([BODY[0], SHORT[0], *BODY[1:]], "<div><p>", "</p></div>"), [BODY[0], SHORT[0], *BODY[1:]]),
        (wrapped([SHORT[0], *BODY, SHORT[1]], "<div><p>", "</p></div>"), BODY),
        ("<br>".join(BODY), [" ".join(BODY)]),
        (f"<pre>{BODY[0]}\n{BODY[1]}</pre>", [" ".join(BODY[:2])]),
        # tables
        (f"<table><tr><td><a href=/>menu</a></td><td>{wrapped(BODY)}</td><td>Buy now!</td></tr></table>", BODY),
        ("<table>" + "".join(f"<tr><th>row {k}</th><td>{k}</td></tr>" for k in range(9)) + "</table>",
         [x for k in range(9) for x in (f"row {k}", str(k))]),
        # links around and within
        (f"{LINKS}<div>{wrapped(BODY)}</div>{LINKS}", BODY),
        (LINKS + wrapped(BODY[:2]) + LINKS + wrapped(BODY[2:]) + LINKS, BODY),
        (f"<div>{wrapped(BODY[:2])}{LINKS}{wrapped(BODY[2:])}</div>", [*BODY[:2], *["other page"] * 4, *BODY[2:]]),
        # skipped elements, open and closed
        (f"<div class=cookie>We use cookies</div><div>{wrapped(BODY)}<div class='share-bar'>Share</div></div>", BODY),
        (f"<div class=sidebar><p>{BODY[0]}</p><div>{wrapped(BODY)}</div>", BODY),
        (f"<form><p>{LETTER}</p></form>{wrapped(BODY)}<footer><p>{BODY[0]}</p></footer>", BODY),
        (LINKS, []),
    ],
)
def test_pages_without_article(html, want):
    assert line_blocks.main_text(f"<!DOCTYPE html><html><body>{html}</body></html>").split("\n") == (want or [""])


def test_open_elements_in_number_take_no_time():
    import time

    begin = time.process_time()
    line_blocks.main_text("<div class=ad>x<nav>" * 20_000 + "<p>text</p>")
    line_blocks.main_text("<div><p>a" * 20_000)
    assert time.process_time() - begin < 10


def test_pages_query_matches_article_markup(spark):
    import re
    from html import unescape

    got = {r["page_id"]: r for r in QUERIES["op4_line_blocks"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", p["html"], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in (" ".join(unescape(b).split()) for b in blocks) if b)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)


def test_pages_edge_rows(spark):
    rows = [(1, None, None, "t"), (1, "u", "<article>a</article>", "t"), (None, "u", "<article>b</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["text"] for r in line_blocks.extract_main_text(pages).collect()))
    assert got == ["", "a", "b"]
    assert line_blocks.extract_main_text(pages.limit(0)).count() == 0


def brute_windows(text, items):
    w = wu_manber.words(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = wu_manber.words(t)
        size = min(10, len(iw))
        for a in range(len(iw) - size + 1 if iw else 0):
            for k in range(len(w) - size + 1):
                if w[k : k + size] == iw[a : a + size]:
                    hit |= set(range(k, k + size))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("part_bytes", [1 << 20, 400])
def test_decontamination_matches_brute_force(spark, part_bytes):
    rng = random.Random(5)
    vocab = ["a", "b", "cc", "é", "Ab", "x1"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(k, say(n)) for k, n in enumerate([1, 2, 3, 9, 10, 11, 14, 25])] + [(8, None), (9, "!!"), (9, "zz qq")]
    texts = [None, "", "?!", *(say(n) for n in (1, 5, 40, 200)), items[6][1].upper() + "." + items[7][1], "ZZ--qq", LONG]
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, window int")
    found = wu_manber.find_windows(docs(spark, texts), bench, part_bytes=part_bytes)
    got = {r["doc_id"]: r for r in wu_manber.contamination(found).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        n, hit, ids = brute_windows(t, items)
        r = got[k + 1]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(ids), hit > 0), t
        assert r["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_decontamination_empty_sides(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    d = docs(spark, ["a b", None])
    assert [r["contaminated"] for r in wu_manber.contamination(wu_manber.find_windows(d, none)).collect()] == [False] * 2
    assert wu_manber.find_windows(d.limit(0), none).count() == 0
    item = spark.createDataFrame([(1, "A b")], "item_id long, text string")
    kept = wu_manber.clean_documents(d, item).collect()
    assert [r["doc_id"] for r in kept] == [2] and kept[0].asDict().keys() == {f.name for f in d.schema}


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "rules"),
        (1, 1, "ann", "hi"),
        (1, 2, "bob", None),
        (1, 2, "bob", None),
        (1, 70, "cy", "late"),
        (1, None, None, "first"),
        (2, 0, "system", "alone"),
        (None, 1, "ann", "no id"),
    ]
    turns = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = perspective_chat.rotate_perspectives(turns).withColumn("spans", perspective_chat.mask_text()).collect()
    by = {(r["conv_id"], r["speaker"], r["part"]): r for r in got}
    assert {(c, s) for c, s, _ in by} == {(1, "ann"), (1, "bob"), (1, "cy"), (1, "unknown"), (None, "ann")}
    assert {p for c, s, p in by if s == "ann" and c == 1} == {-1, 0, 2}
    main = by[(1, "bob", 0)]
    one = "<|im_start|>assistant\n<|im_end|>\n"
    assert main["text"] == "<|im_start|>system\nrules<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n" + one * 2
    assert [main["text"][m["start"] : m["end"]] for m in main["mask"]] == ["", ""]
    ann = by[(1, "ann", 0)]
    assert [ann["text"][m["start"] : m["end"]] for m in ann["mask"]] == ["hi"]
    assert perspective_chat.rotate_perspectives(turns.limit(0)).count() == 0
