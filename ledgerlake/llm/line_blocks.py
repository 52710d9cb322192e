"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped to one line for each block element with text.  A line's weight is its
text outside links (``<a href>``, to the end of the line at most); menus, footers, adverts
and the like give no lines.  Weights are summed over sliding windows of ``WINDOW`` lines,
and what counts as much or little text is taken from the page's own distribution:

* The body of the text is where most of the page's weight lies: the lines of marked
  articles (``<article>``, ``<main>``; these weigh their links too) if they hold at least
  half of it, else those of the smallest element within ``<body>`` that does, with a heading
  right before it.  All of it is text.
* Other lines form runs, which end at windows without any weight (links alone) and where two
  or more elements begin or end.  A run surges where a window sum reaches ``BESIDE`` of the
  greatest one within the body, and then is text from where it rises to where it dives.
* On a page without such a body a run surges at ``WITHIN`` of the greatest window sum, and
  all runs between the first and the last that do are text too, short ones as well.

All lines of these are the text, short ones and links too, each white space run one space,
joined by a line feed.  No size is absolute: a page of a few words is these words.

An element is skipped by its name, or by what its attributes say.  One that is not closed
(an open ``<header>``) ends where the next section or division begins within its parent; if
none does, it is not skipped, so it takes no page with it.  Comments also begin at a heading that says so
(``3 responses``) outside marked articles, up to the end of its element; a copyright line at
the end of a page without marks is left out.

Defined results: a null or empty page, and one without text outside links, give the empty
text; markup cut off at the end of a page is dropped; character references are decoded, also
those without a semicolon; rows are independent, so repeated ones come out alike; an
empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: The share of the greatest window sum at which a run beside the body of the text, and one
#: on a page without such a body, is text.
BESIDE, WITHIN = 0.5, 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
_SKIPPED = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disqus footer header menu menus modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted related replies reply responses share sharing sidebar social sponsor sponsored subscribe "
    "toolbar widget".split()
)
_SKIPPED_ROLES = _SKIPPED_WORDS | {"contentinfo", "complementary", "search"}
#: Parts of names that say where or in what shape: `site-footer` is a footer, `has-sidebar` no sidebar.
_PLACES = frozenset(
    "area aside bar block bottom box column container fixed global inner item items left link links list main "
    "mobile outer page primary right row secondary section side site slot sticky top unit wrap wrapper".split()
)
_MAIN = frozenset(("article", "main"))
#: Elements that a name in ``class``, ``id`` or ``role`` does not make an advert or the like.
_UNNAMED = _INLINE | _MAIN | frozenset("html body h1 h2 h3 h4 h5 h6".split())

_ROWS = frozenset("tr tbody thead tfoot".split())
_CELLS = frozenset("td th".split())
_BLOCKS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
#: Of elements whose end tag may be left out: the start tags that end them.
_IMPLIED = {
    "p": _BLOCKS,
    "li": frozenset(("li",)),
    "tr": _ROWS,
    **dict.fromkeys(("dt", "dd"), frozenset(("dt", "dd"))),
    **dict.fromkeys(_CELLS, _CELLS | _ROWS),
}
#: Elements that may hold the body of the text, and those that end an element left open.
_BOXES = frozenset("article blockquote center div main section td".split())
_SECTIONS = frozenset("article aside div footer header main nav section table".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_COMMENTS = re.compile(r"(?:\d+ (?:comments?|responses?|replies)|comments?(?: ?\(\d+\))?|leave a (?:comment|reply)):?", re.I)
_NOTICE = re.compile(r"(?:©|\(c\) ?\d|copyright\b)", re.I)


def _named_away(value: str, words: frozenset[str]) -> bool:
    for word in value.lower().split():
        parts = [p for p in re.split(r"[_\-]+", word) if p and not p.isdigit()]
        if not words.isdisjoint(parts) and all(p in words or p in _PLACES for p in parts):
            return True
    return False


def _hinted_away(rest: str, named: bool = True) -> bool:
    """Whether the attributes hide the element or, with ``named``, name it an advert or the like."""
    for m in _ATTRIBUTE.finditer(rest):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
            return True
        if named and (
            kind in ("class", "id") and _named_away(value, _SKIPPED_WORDS)
            or kind == "role" and _named_away(value, _SKIPPED_ROLES)
        ):
            return True
    return False


@dataclass
class Line:
    """One line of a page: its text, the characters of it in links, whether it is in a marked
    article, the tags of boxes since the line before, and the heading it is (or '')."""

    text: str
    linked: int
    marked: bool
    gap: int
    heading: str

    @property
    def weight(self) -> int:
        return max(0, len(self.text) - self.linked)


def _element_ends(tokens: list[re.Match], names: list[str]) -> dict[int, tuple[int, bool]]:
    """For each start tag the tag that ends its element, and whether that is its own end tag."""
    ends: dict[int, tuple[int, bool]] = {}
    stack: list[tuple[str, int]] = []
    held: Counter = Counter()

    def pop(at: int, own: bool) -> str:
        name, k = stack.pop()
        held[name] -= 1
        ends[k] = (at, own)
        return name

    for i, (m, name) in enumerate(zip(tokens, names)):
        if not name or name in _VOID:
            continue
        if m["end"]:
            if held[name]:
                while stack[-1][0] != name:
                    pop(i, False)
                pop(i, True)
            continue
        while stack and name in _IMPLIED.get(stack[-1][0], ()):
            pop(i, False)
        if not m["rest"].endswith("/"):
            stack.append((name, i))
            held[name] += 1
    while stack:
        pop(len(tokens), False)
    return ends


def lines_of(html: str) -> tuple[list[Line], list[range]]:
    """The lines with text, skipped elements left out, and the lines of each box within the body."""
    tokens = list(_TOKEN.finditer(html))
    names = [(m["name"] or "").lower() for m in tokens]
    ends = _element_ends(tokens, names)
    out: list[Line] = []
    boxes: list[range] = []
    open_: list[tuple[int, int, str]] = []  # (end, first line, name) of boxes
    buffer: list[str] = []
    linked = anchor = gap = inside = 0
    heading = ""

    def close() -> None:
        nonlocal linked, anchor, gap, heading
        text = " ".join("".join(buffer).split())
        if text:
            out.append(Line(text, linked, inside > 0, gap, heading))
            gap = 0
        buffer.clear()
        linked = anchor = 0  # a link left open weighs no more than its line
        heading = ""

    def put(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw)
            buffer.append(text)
            if anchor:
                linked += len(text)

    def skip(i: int) -> tuple[int, int]:
        """The first tag after the element that begins at tag ``i``, and where its text begins."""
        end, own = ends.get(i, (i, True))
        if own:
            return end + 1, tokens[end].end()
        if names[i] not in _IMPLIED:
            sections = (k for k in range(i + 1, end) if names[k] in _SECTIONS and not tokens[k]["end"])
            end = next(sections, None)
            if end is None:  # nothing says where it ends
                return i + 1, tokens[i].end()
        return end, tokens[end].start() if end < len(tokens) else len(html)

    i = at = 0
    while i < len(tokens):
        m, name = tokens[i], names[i]
        put(html[at : m.start()])
        at = m.end()
        while open_ and open_[-1][0] <= i:
            close()
            _, first, box = open_.pop()
            boxes.append(range(first, len(out)))
            inside -= box in _MAIN
            gap += box not in _CELLS  # the cells of a table stay together
        if not name:
            i += 1
            continue
        ending = bool(m["end"])
        kept = name in ("html", "body") or name == "header" and inside  # an article's own heading
        if not ending and not kept and name not in _VOID and (
            name in _SKIPPED or _hinted_away(m["rest"], name not in _UNNAMED)
        ):
            if name not in _INLINE:
                close()
            i, at = skip(i)
            continue
        if name == "a":
            anchor = 0 if ending or not _HREF.search(m["rest"]) else 1
        elif name == "br":
            buffer.append(" ")
        elif name not in _INLINE:
            if ending and name in _HEADINGS and open_ and not inside:
                text = " ".join("".join(buffer).split())
                if _COMMENTS.fullmatch(text):  # up to the end of its box
                    buffer.clear()
                    close()
                    i = max(i + 1, open_[-1][0])
                    at = tokens[i].start() if i < len(tokens) else len(html)
                    continue
            close()
            if not ending and name in _HEADINGS:
                heading = name
            if not ending and name in _BOXES and i in ends:
                open_.append((ends[i][0], len(out), name))
                inside += name in _MAIN
                gap += name not in _CELLS
        i += 1
    put(html[at:])
    close()
    boxes.extend(range(first, len(out)) for _, first, _ in open_)
    return out, boxes


def _peak(weights: list[int], run: range, window: int) -> int:
    """The greatest sum of ``window`` lines within the run."""
    total = best = 0
    for k in run:
        total += weights[k] - (weights[k - window] if k - window >= run.start else 0)
        best = max(best, total)
    return best


def _runs(lines: list[Line], weights: list[int], apart: list[bool], window: int) -> list[range]:
    """The stretches of lines outside ``apart``, cut at empty windows and between elements."""
    out: list[range] = []
    begin, empty = 0, 0

    def cut(stop: int) -> None:
        if any(weights[k] for k in range(begin, stop)):
            out.append(range(begin, stop))

    for k, line in enumerate(lines):
        if apart[k]:
            cut(k)
            begin, empty = k + 1, 0
            continue
        if line.gap > 1 and k > begin:
            cut(k)
            begin, empty = k, 0
        empty = 0 if weights[k] else empty + 1
        if empty >= window:
            cut(k - empty + 1)
            begin = k + 1
            empty = window  # the lines that follow without weight are left out too
    cut(len(lines))
    return out


def main_text(html: str | None, window: int = WINDOW, beside: float = BESIDE, within: float = WITHIN) -> str:
    """The main text of one page."""
    lines, boxes = lines_of(html or "")
    weights = [len(x.text) if x.marked else x.weight for x in lines]
    total = sum(weights)
    body = [x.marked for x in lines]
    marked = 2 * sum(w for w, x in zip(weights, lines) if x.marked) >= total > 0
    if not marked:
        weights = [x.weight for x in lines]
        upto = [0]
        for w in weights:
            upto.append(upto[-1] + w)
        holding = [b for b in boxes if b and 2 * (upto[b.stop] - upto[b.start]) >= upto[-1] > 0]
        best = min(holding, key=len, default=range(0))
        if best and best.start and lines[best.start - 1].heading == "h1":
            best = range(best.start - 1, best.stop)
        body = [k in best for k in range(len(lines))]
    kept = body[:]
    runs = _runs(lines, weights, body, window)
    if any(body):
        inner = [w if b else 0 for w, b in zip(weights, body)]
        surge = beside * _peak(inner, range(len(lines)), window)
        chosen = [r for r in runs if _peak(weights, r, window) >= surge]
    else:
        peaks = [_peak(weights, r, window) for r in runs]
        high = [k for k, x in enumerate(peaks) if x >= within * max(peaks, default=0)]
        chosen = runs[high[0] : high[-1] + 1] if high else []
    for r in chosen:
        for k in r:
            kept[k] = True
    text = [x.text for x, keep in zip(lines, kept) if keep]
    while not marked and len(text) > 1 and _NOTICE.match(text[-1]):
        text.pop()
    return "\n".join(text)


def extract_main_text(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Return the key columns and ``text`` of every page."""
    chosen = pages.select(*[F.col(k) for k in keys], F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            # a page's text is no longer than its html, but free each once it is done
            texts = pa.array([main_text(h.as_py()) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), texts], [*keys, "text"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name in keys]
    return chosen.mapInArrow(run, ", ".join([*kinds, "text string"]))
