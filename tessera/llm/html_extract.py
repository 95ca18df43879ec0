"""Main text of web pages by tree scoring.

A page becomes a tree of elements with blocks of text.  Each block passes points
for its length and commas to the container around it, half of them to the next
container, and less further up; a container's score is discounted by the share
of its text that stands in links.  The best container is kept, widened to the
article or main element around it, else joined by those siblings that score well
or read like text.  Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments take no part, by element or by the words of
their class, id and role; neither do lists that consist of links.

Unclosed and misnested tags are read as browsers do: a block closes an open
paragraph, an item the item before it, an end tag without its element is left out.
Character references are decoded, white space inside a block becomes one space,
blocks are joined in page order by a line feed; ``br`` is white space.

Each page is read on its own, so there is no shuffle and one page is the largest
thing in memory; the work is linear in its length.

Defined cases: null or empty html, and a page without text outside the parts
above, give an empty text; null ids and urls stay; text without markup is one
block; a page cut off inside a tag, comment or script ends there; repeated rows
give repeated rows; an empty table gives an empty table; of several containers
with one score the first in the page is taken; only the three named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_rows, steps

# ------------------------------------------------------------------ fixed values
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead
    tr ul""".split())
#: Elements that never hold main text.
DROP = frozenset("""head script style textarea title xmp iframe noembed noframes noscript template svg math canvas object audio video map
    nav menu footer aside button select datalist output dialog search""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag closes the open elements named with it, up to one of the borders.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}
#: A start tag other than these ends an open head.
IN_HEAD = frozenset("html head title meta link base style script noscript template".split())
#: Text right inside these is a paragraph of the element around them.
PARAGRAPH = frozenset("p pre li dt dd td th h1 h2 h3 h4 h5 h6 blockquote figcaption caption summary address".split())
#: Words of class, id and role: always noise, noise unless the article lies inside, wrappers of text.
NOISE = frozenset("""ad ads adbox adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar
    subnav topnav sidenav menu menubar dropdown breadcrumb breadcrumbs sidebar aside footer cookie cookies cookiebar consent gdpr newsletter
    related recommended recommendations teaser teasers comment comments commentlist disqus respond reply replies discussion complementary
    contentinfo outbrain taboola""".split())
WEAK = frozenset("""banner header masthead widget notice modal overlay popup share sharing social subscribe subscription signup login
    search toolbar pagination pager skip copyright legal disclaimer alert topbar trending popular cta""".split())
TEXTUAL = frozenset("article body content main entry post story text page hentry blog column".split())
MODIFIERS = frozenset("has with no without is js hide show".split())
TAG_POINTS = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3,
              "dd": -3, "dt": -3, "li": -3, "address": -3, "form": -3, "th": -5}
#: Share of the best container's points from which a sibling joins it.
SIBLING = 0.2
COMMAS = re.compile("[,،、，]")

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|</?([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def _kind(attrs: str) -> int:
    """2 for noise, 1 for noise unless the article lies inside, -1 for a wrapper of text, else 0.

    A name like ``main sidebar-right`` is a wrapper's; ``content comment`` is a comment's.
    """
    kind, textual, pure = 0, False, False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDDEN.search(value)):
            return 2
        if name not in ("class", "id", "role"):
            continue
        for token in value.split():
            words = [w.lower() for w in WORDS.findall(token)]
            if not words or words[0] in MODIFIERS:
                continue
            if all(w in TEXTUAL for w in words):
                textual = True
            elif any(w in NOISE for w in words):
                kind, pure = 2, pure or all(w in NOISE for w in words)
            elif any(w in WEAK for w in words):
                kind = max(kind, 1)
    return -1 if textual and not pure else kind


class Page:
    """The elements of a page in page order (parents first) and its blocks of text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.kind, self.in_link = ["html"], [-1], [0], [False]
        self.blocks: list[tuple[int, list[tuple[int, str]]]] = []
        self._open = [0]
        self._count: dict[str, int] = {}
        self._run: list[tuple[int, str]] = []
        self._read(source)

    def _push(self, tag: str, attrs: str) -> None:
        up = self._open[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.kind.append(_kind(attrs) if attrs else 0)
        self.in_link.append(self.in_link[up] or tag == "a")
        if tag not in VOID:
            self._open.append(len(self.tag) - 1)
            self._count[tag] = self._count.get(tag, 0) + 1

    def _pop(self) -> None:
        self._count[self.tag[self._open.pop()]] -= 1

    def _flush(self) -> None:
        if self._run:
            k = len(self._open) - 1
            while self.tag[self._open[k]] not in BLOCK:
                k -= 1
            self.blocks.append((self._open[k], self._run))
            self._run = []

    def _close(self, names: tuple[str, ...], borders: tuple[str, ...]) -> None:
        """Pop up to the outermost open element of ``names`` above the nearest border."""
        if not any(self._count.get(x) for x in names):
            return
        deepest = None
        for k in range(len(self._open) - 1, 0, -1):
            t = self.tag[self._open[k]]
            if t in borders:
                break
            if t in names:
                deepest = k
                if len(names) == 1:
                    break
        while deepest is not None and len(self._open) > deepest:
            self._pop()

    def _start(self, tag: str, attrs: str) -> None:
        if tag not in IN_HEAD and self._count.get("head"):
            self._run = []
            while self._count["head"]:
                self._pop()
        if tag in BLOCK or tag in ("hr", "option"):
            self._flush()
            if tag in BLOCK or tag == "hr":
                self._close(("p",), ("table", "td", "th", "button", "object"))
            if tag in HEADINGS and self.tag[self._open[-1]] in HEADINGS:
                self._pop()
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        elif tag == "br":
            self._run.append((self._open[-1], " "))
        elif tag == "a":
            self._close(("a",), ("table", "td", "th", "div", "li", "p"))
        if not (tag in ("html", "body") and len(self.tag) > 1 and self._count.get(tag)):
            self._push(tag, attrs)

    def _end(self, tag: str) -> None:
        block = tag in BLOCK
        if block:
            self._flush()
        if not self._count.get(tag):
            return
        for k in range(len(self._open) - 1, 0, -1):
            t = self.tag[self._open[k]]
            if t == tag:
                while len(self._open) > k:
                    self._pop()
                return
            if (not block and t in BLOCK) or (t in ("td", "th", "table") and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table", "body", "html")):
                return                                           # an inline element, or a cell, bounds what may be closed

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = TOKEN.search(source, at)
            stop = m.start() if m else len(source)
            if stop > at:
                self._run.append((self._open[-1], html.unescape(source[at:stop])))
            if not m:
                break
            at = m.end()
            name = m[1] or m[3]                                  # the second: a quote is never closed
            if name is None or not m[0].endswith(">"):
                continue                                         # a comment, a declaration, or the page ends here
            tag = name.lower()
            if m[0][1] == "/":
                self._end(tag)
                continue
            attrs = m[2] or ""
            if tag in ("svg", "math") and attrs.endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            self._start(tag, attrs)
        self._flush()


def _noise(page: Page) -> tuple[list[bool], list[bool], list[bool]]:
    """Whether each element is left out, by its own element or words or by those around
    it; whether it is in a header of an article, of which headings stay; and whether
    it holds an article, main or h1."""
    n = len(page.tag)
    holds = [False] * n                                          # an article, main or h1 that is not noise itself
    for k in range(n - 1, 0, -1):
        if page.kind[k] <= 0 and (page.tag[k] in ("article", "main", "h1") or holds[k]):
            holds[page.parent[k]] = True
    out, article, header = [False] * n, [False] * n, [False] * n
    for k in range(1, n):
        up, tag, kind = page.parent[k], page.tag[k], page.kind[k]
        article[k] = article[up] or tag in ("article", "main")
        header[k] = tag == "header" or (header[up] and tag not in ("article", "main"))
        if tag in ("html", "body", "main"):
            kind = 0
        if tag == "form" or (tag == "header" and not article[up]):
            kind = max(kind, 1)
        elif tag == "header" and kind == 1:
            kind = 0
        out[k] = out[up] or tag in DROP or kind == 2 or (kind == 1 and not holds[k])
    return out, header, holds


def main_blocks(source: str) -> list[str]:
    """The blocks of a page's main text in page order."""
    page = Page(source)
    noise, header, holds = _noise(page)
    n = len(page.tag)
    blocks = []                                                  # (owner, text, length in links)
    for owner, run in page.blocks:
        if noise[owner] or (header[owner] and page.tag[owner] not in HEADINGS):
            continue
        text = " ".join("".join(s for k, s in run if not noise[k]).split())
        if text:
            linked = len(" ".join("".join(s for k, s in run if page.in_link[k] and not noise[k]).split()))
            blocks.append((owner, text, min(linked, len(text))))
    if not blocks:
        return []

    # text, linked text and number of links inside each element, children before parents
    total, linked, links, lists = [0] * n, [0] * n, [0] * n, [False] * n
    for owner, text, k in blocks:
        total[owner] += len(text)
        linked[owner] += k
    for k in range(n - 1, 0, -1):
        if page.tag[k] == "a" and not noise[k]:
            links[k] += 1
        up = page.parent[k]
        total[up] += total[k]
        linked[up] += linked[k]
        links[up] += links[k]
    density = [linked[k] / total[k] if total[k] else 0.0 for k in range(n)]

    # lists of links are menus wherever they stand
    for k in range(1, n):
        least = 0.6 if page.tag[k] in ("ul", "ol", "dl", "table", "p") else 0.8
        lists[k] = lists[page.parent[k]] or (links[k] >= 3 and density[k] > least and not holds[k]
                                             and page.tag[k] in ("ul", "ol", "dl", "table", "p", "div", "section"))
    kept = [b for b in blocks if not lists[b[0]]]
    if not kept:
        return []

    points: dict[int, float] = {}
    for owner, text, _ in kept:
        p = len(COMMAS.findall(text)) + min(len(text) / 100, 3) + (1 if len(text) >= 25 else 0)
        k = page.parent[owner] if page.tag[owner] in PARAGRAPH else owner
        for share in (1, 2, 6, 9, 12):
            if k < 0:
                break
            points[k] = points.get(k, 0.0) + p / share
            k = page.parent[k]
    score = {k: (p + TAG_POINTS.get(page.tag[k], 0) + (25 if page.kind[k] < 0 else 0)) * (1 - density[k]) for k, p in points.items()}
    best = min(score, key=lambda k: (-score[k], k))
    for wanted in ("article", "main"):
        k = best
        while k > 0 and page.tag[k] != wanted:
            k = page.parent[k]
        if k > 0:
            best = k
            break

    roots = {best}
    if page.tag[best] not in ("article", "main", "body", "html"):
        around = page.parent[best]
        worth = {k: p * (1 - density[k]) for k, p in points.items()}
        for k in range(1, n):
            if page.parent[k] != around or k == best or noise[k] or lists[k] or not total[k]:
                continue
            good = worth.get(k, 0.0) >= SIBLING * worth[best]
            reads = page.tag[k] in PARAGRAPH and (total[k] > 80 and density[k] < 0.25 or total[k] <= 80 and density[k] == 0 and page.tag[k] == "p")
            if good or reads or (page.tag[k] in HEADINGS and k < best):
                roots.add(k)
        roots |= {-1 - i for i, (owner, text, k) in enumerate(kept) if owner == around and len(text) > 80 and k < len(text) / 4}
    inside = [False] * n
    for k in range(n):
        inside[k] = k in roots or (k > 0 and inside[page.parent[k]])
    return [text for i, (owner, text, _) in enumerate(kept) if inside[owner] or -1 - i in roots]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    def run(batches):
        for batch in batches:
            raw, off = byte_rows(batch.column(2))
            for i, j in steps(off):
                texts = ["\n".join(main_blocks(raw[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace"))) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                    pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ], names=["page_id", "url", "text", "n_chars"])
    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(run, SCHEMA)
