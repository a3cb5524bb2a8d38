"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut at block-level tags into flat blocks.  Each block is described by
its own words and link density, those of its two neighbours, and where it
stands: inside an article or main element, inside page furniture, and how surely
a class or id around it names furniture (1: surely; 0.5: a part of the name of an
element of running text, or one of several names).  A decision tree, grown here
by Gini impurity on the blocks of a few labelled pages, tells text from
furniture; the text blocks are joined in page order.  Furniture in an article
(an advert, a comment) may be prose like any other, so there the tree follows the
containers; it goes by words, links and neighbours where they don't decide: on
pages without an article and under doubtful names.

Null or empty html has the empty text.  Repeated rows give repeated results and
further columns are ignored.  Unclosed, crossed and unknown tags are tolerated;
scripts, styles, comments, hidden fields and the document head are never text;
an unclosed head ends where its content does.  Reading takes time in proportion
to the page, whatever it holds: what was looked for in vain isn't looked for again.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements whose content is never text.  Of the first, unclosed ones reach to the end of the page; of the second, to the next tag; others don't count.
RAW = frozenset("script style iframe noscript template textarea title svg object select datalist canvas audio video".split())
TO_END, TO_TAG = frozenset("script style".split()), frozenset("title textarea".split())
#: Elements that don't end a document head.
HEAD = frozenset("head html title meta link base basefont bgsound script style noscript template object".split())
#: A tag, as it should be and with quotes taken as any other character.
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in RAW}
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("br img input wbr td th".split()) - {"wbr"}
MAIN = frozenset("article main".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset label".split())
#: Whole words of a class or id that name page furniture.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer header masthead topbar toolbar comment comments respond replies reply disqus "
    "share sharing social follow related recommended newsletter subscribe signup login search widget pagination pager copyright legal skip".split()
)
WORD = re.compile(r"[a-z]+")
#: Elements that hold running text themselves.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
#: Before a furniture name these say that the element is something else.
ABSENT = frozenset("no not has with without".split())
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Block(NamedTuple):
    text: str
    words: int
    linked: int  # words inside links
    main: bool
    furniture: bool
    named: float


def tokens(page: str):
    """(text, None, None) and (None, tag, attributes) of a page in order; the name of a closing tag begins with a slash."""
    at, n, tag_re, lost = 0, len(page), TAG, set()
    last = page.rfind(">")
    while at < n:
        start = page.find("<", at)
        if start < 0 or start > last:  # no further tag can end
            yield page[at:], None, None
            return
        if start > at:
            yield page[at:start], None, None
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            at = page.index(">", start) + 1
            continue
        m = tag_re.match(page, start)
        if m is None and tag_re is TAG and (m := PLAIN_TAG.match(page, start)):
            tag_re = PLAIN_TAG  # the quotes reach to the end of the page
        if m is None:
            yield "<", None, None
            at = start + 1
            continue
        tag, at = m[2].lower(), m.end()
        if tag not in RAW or m[1]:
            yield None, m[1] + tag, m[3]
            continue
        end = None if tag in lost else RAW_END[tag].search(page, at)
        if end:
            at = end.end()
            continue
        lost.add(tag)
        if tag in TO_END:
            return
        if tag in TO_TAG:
            end = page.find("<", at)
            at = n if end < 0 else end


def _named(tag: str, value: str) -> float:
    """How surely the class or id of an element names page furniture."""
    found = [WORD.findall(x) for x in value.split()]
    named = [bool(p) and p[0] not in ABSENT and (p[0] in NAMED or p[-1] in NAMED) for p in found]
    if not any(named):
        return 0.0
    sure = all(named) and (tag not in TEXTUAL or all(w in NAMED for p in found for w in p))
    return 1.0 if sure or (tag not in TEXTUAL and len(found[named.index(True)]) == 1 and named[0]) else 0.5


def _marks(tag: str, attr: str) -> tuple[bool, float]:
    """(furniture, named) of an element."""
    furniture, named = tag in FURNITURE, 0.0
    if attr:
        for name, value in ATTR.findall(attr):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                named = max(named, _named(tag, value))
            elif name == "role":
                furniture = furniture or value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "menu")
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                furniture = True
    return furniture, named


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, float]] = []  # tag, main, furniture, named: of it and all around it
    depth: dict[str, int] = {}  # open elements by tag
    state = outside = (False, False, 0.0)
    text: list[str] = []
    linked: list[str] = []
    link, head = False, False

    def close() -> None:
        nonlocal text, linked
        body = " ".join(html.unescape("".join(text)).split())
        if body:
            inside = html.unescape(" ".join(linked))
            out.append(Block(body, len(body.split()), len(inside.split()), *state))
        text, linked = [], []

    def pop() -> None:
        depth[stack.pop()[0]] -= 1

    for piece, tag, attr in tokens(page):
        if piece is not None:
            if head and not piece.isspace():
                head = False
            if not head:
                text.append(piece)
                if link:
                    linked.append(piece)
            continue
        ends = tag[0] == "/"
        tag = tag[1:] if ends else tag
        if tag == "head":
            head = not ends
        elif head and not ends and tag not in HEAD:
            head = False
        if tag == "a":
            link = not ends
        elif tag in SPACED and tag not in BLOCK:
            text.append(" ")
        if tag not in BLOCK:
            continue
        close()
        if ends:
            if depth.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif tag not in ("hr", "body", "html"):
            while tag == "p" and stack and stack[-1][0] == "p":
                pop()
            furniture, named = _marks(tag, attr)
            if tag != "p":
                link = False
            if tag != "p" or attr:
                up = stack[-1][1:] if stack else outside
                stack.append((tag, up[0] or tag in MAIN, up[1] or furniture, max(up[2], named)))
                depth[tag] = depth.get(tag, 0) + 1
        state = stack[-1][1:] if stack else outside
    close()
    return out


FEATURES = ("words", "density", "before_words", "before_density", "after_words", "after_density", "main", "furniture", "named")


def features(page: list[Block]) -> list[tuple[float, ...]]:
    """One row of FEATURES per block; beyond the ends there is nothing (0 words, density 0)."""
    own = [(float(b.words), min(1.0, b.linked / b.words)) for b in page]
    near = [(0.0, 0.0), *own, (0.0, 0.0)]
    return [(*near[i + 1], *near[i], *near[i + 2], float(b.main), float(b.furniture), b.named) for i, b in enumerate(page)]


#: Labelled pages: a block begins with + if it is text and with - if it is furniture; [n] stands for n words, (n) for n words in a link.
PAGES = (
    "<header>-[3]</header><nav><ul><li>-(1)<li>-(2)<li>-(1)</ul></nav><article><h1>+[7]</h1><p>+[55]<p>+[90] (3) [20]<aside>-[30]</aside><h2>+[3]</h2><p>+[120]<div class=ad>-[18]</div>"
    "<p>+[12]<ul><li>+[5]<li>+[2]<li>+(3)</ul><p>+(4) [3]<div id=comments><p>-[25]<p>-[60]<p>-[1]</div></article><footer>-[9]<p>-(2) (2)</footer>",
    "<div class=cookie-notice>-[22]</div><main><h1>+[1]</h1><p>+[33]<p>+(9) [1]<section class=related><h3>-[2]</h3><ul><li>-(6)<li>-(5)</ul></section><p>+[250]<form>-[14] <p>-[40]</form><p>+[1]<p>+[16]</main><div id=sidebar><p>-[45]<p>-[110]</div>",
    "<article><p>+[6]<div class=advert>-[48]</div><p>+[2]<nav>-(3)</nav><p>+[11]<div class=sponsored>-[1]</div><p>+[70]<footer>-[90]</footer></article><div class='comments'><h4>-[2]</h4><p>-[65]<p>-[10]</div>",
    "<article><h1>+[9]</h1><p class='social studies'>+[40]<p class=widget-text>+[7]<h2 class=footer-notes>+[4]</h2><p>+[80]<p class='share more'>-(2) [1]<p class=related-links>-(5)<p class='follow us'>-[2]<p>+[30]<p class='legal basis'>+[22] (2)<p class=menu-top>-[1]<p class='comment section'>+[95]</article>",
    "<div>-(1)</div><div>-(2)</div><div>-(1)</div><h1>+[8]</h1><p>+[60]<h3>+[3]</h3><p>+[45]<p>+[9]<p>+[75]<h3>+[2]</h3><p>+[130]<div>-(4)</div><div>-[6]</div><div>-(2)</div>",
    "<div>-(2)</div><div>-[3]</div><div>-(3) [1]</div><p>+[26]<p>+[4]<p>+[38]<p>+[14] (2)<p>+[150]<div>-(12) [8]</div><div>-[4]</div><div>-[2]</div><div>-[5]</div>",
    "<div>-[2]</div><div>-[5]</div><h1>+[6]</h1><p>+[210]<p>+[18]<p>+[33]<p>+[1]<p>+[50]<div>-(18) [12]</div><div>-(1)</div><div>-[7]</div><div>-[3]</div>",
    "<article><p>+(8)<p>+[80]<p>+(14)<p>+[33]<p>+(2)<p>+[200]<p>+[10]<p>+(30)<p>+(12)<p>+(1)</article>",
    "<article><h1>+(5)</h1><p>+(20) [10]<p>+[18]<ul><li>+(4)<li>+(7)<li>+(3)</ul><p>+[64]<p>+(9)<p>+[25]<p>+(40)</article><footer><p>-(8)<p>-(3)</footer>",
    "<main><h2>+[4]</h2><p>+(6)<p>+[5]<p>+(16)<p>+[15]<aside><p>-(8)<p>-[44]<p>-(2)</aside><p>+[3]<div class=promo><p>-(12)<p>-[30]</div><p>+[100]<p>+(3)</main>",
    "<p>+[140]",
    "<p>+[16]",
    "<div>-(5) [1]</div><p>+[35]<div>-(30) [20]</div><p>+[28]<div>-[3]</div><div>-(2)</div><div>-[8]</div><div>-[4]</div>",
    "<div class='ad wide'>-[70]</div><div class='top menu'><p>-[3]<p>-(1)</div><div class='page legal'><p>-[2]<p>-(4)<p>+[85]</div><p class='search tips'>+[60]<p class='side note'>+[44]<div>-(2)</div>",
    "<aside><p>-[75]<p>-[4]<p>-(1)</aside><header><p>-[20]<p>-[55]</header><footer><p>-[60]<p>-(7) [2]</footer><form><label>-[2]</label><p>-[12]</form><div class=newsletter><p>-[50]<p>-[95]</div>",
)
_FILL = re.compile(r"\[(\d+)\]|\((\d+)\)")


class Node(NamedTuple):
    feature: int  # -1: a leaf
    at: float
    low: "Node | None"
    high: "Node | None"
    label: int


def labelled() -> list[tuple[tuple[float, ...], int]]:
    """The features of every block of the labelled pages, and 1 for text."""
    rows = []
    for page in PAGES:
        found = blocks(_FILL.sub(lambda m: " ".join(["w"] * int(m[1])) if m[1] else f"<a>{' '.join(['w'] * int(m[2]))}</a>", page))
        rows += [(x, int(b.text[0] == "+")) for b, x in zip(found, features(found), strict=True)]
    return rows


def grow(rows: list[tuple[tuple[float, ...], int]], depth: int = 8, least: int = 1) -> Node:
    """A decision tree by Gini impurity; ties go to the earlier feature and the lower cut."""
    ones = sum(y for _, y in rows)
    label = int(2 * ones > len(rows))
    if depth == 0 or ones in (0, len(rows)):
        return Node(-1, 0.0, None, None, label)
    best = None
    for f in range(len(rows[0][0])):
        ordered = sorted((x[f], y) for x, y in rows)
        left = 0
        for i in range(1, len(ordered)):
            left += ordered[i - 1][1]
            if ordered[i][0] == ordered[i - 1][0] or i < least or len(ordered) - i < least:
                continue
            right, n, m = ones - left, i, len(ordered) - i
            impurity = left * (n - left) / n + right * (m - right) / m
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, (ordered[i][0] + ordered[i - 1][0]) / 2)
    if best is None:
        return Node(-1, 0.0, None, None, label)
    _, f, at = best
    return Node(f, at, grow([r for r in rows if r[0][f] <= at], depth - 1, least), grow([r for r in rows if r[0][f] > at], depth - 1, least), label)


def classify(tree: Node, row: tuple[float, ...]) -> int:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.at else tree.high
    return tree.label


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if classify(tree, x))


def extract(pages: DataFrame, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars``, its code points."""
    rows = pages.select(*[pages[k] for k in keep], pages[column].cast("string").alias("_html"))
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])
    tree = grow(labelled())

    def run(batches):
        for batch in batches:
            out, start, size = [], 0, 0
            for i, x in enumerate(batch.column("_html")):
                out.append(main_text(x.as_py(), tree))
                size += len(out[-1])
                if size > 4_000_000 or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], schema.names)
                    out, start, size = [], i + 1, 0

    return rows.mapInArrow(run, schema)
