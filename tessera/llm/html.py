"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A page is cut into block-level nodes and text blocks.  Each node gets features of
its own and of its place: attribute words, depth, share of text and link text in
its subtree, density, siblings, ancestors.  Boosted trees give the chance that a
node holds main text.  The decoder picks the most likely set of nodes in which a
node is kept only if all its ancestors are, so a paragraph of a comment cannot
stay when the comments go.

Training.  A bounded number of pages (smallest hash of their id) that mark their
main text by ``article`` or ``main`` is taken as is, and in variants in which the
landmarks are renamed to plain containers with common class words and further
menus, notices, adverts, forms, sidebars and comments are put around and into
the text, filled from other pages.  A small built-in page makes sure that there
is always something to learn from.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line end, in page order.  ``br`` is
white space.  Defined cases: a null or empty page has empty text; cut-off tags
and unclosed elements end with the page; contents of scripts, styles, templates,
text areas, selects and the head are never text; repeated rows get one text; an
empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.gbt import Trees

#: Pages that training reads at most, and variants made of each.
PAGES, VARIANTS = 200, 3
#: Pages of so many characters or more are not sampled, and so many texts of the sample fill the variants.
LONGEST, FILLERS = 100_000, 4_000
#: Class words of containers.  Fixed values.
AWAY = ("nav menu navbar navigation breadcrumb breadcrumbs header masthead banner topbar footer foot bottom copyright sidebar side aside "
        "widget rail ad ads advert advertisement sponsor sponsored promo promotion notice cookie cookies consent gdpr popup modal overlay newsletter "
        "subscribe signup login form search share sharing social related recommended more comment comments reply replies "
        "disqus discussion respond pagination pager tags meta skip toolbar alert warning disclaimer legal").split()
HERE = "article content main post entry story body text page-content main-content post-content entry-content article-body".split()
_AWAY, _HERE = frozenset(AWAY), frozenset(w for x in HERE for w in x.split("-"))
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr input embed area link meta base source track col picture".split())
_VOID = frozenset("br img input hr meta link base area col embed source track wbr param".split())
_RAW = frozenset("script style noscript template textarea select svg math iframe object video audio canvas title".split())
_CLOSE_P = frozenset("address article aside blockquote details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                     "nav ol p pre section table ul".split())
_SELF = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option",
         "thead": "tr td th", "tbody": "thead tr td th", "tfoot": "tbody tr td th"}
_SELF = {k: frozenset(v.split()) for k, v in _SELF.items()}
_WALL = frozenset("ul ol dl table body html div section article main aside nav header footer form td th".split())
_MAIN_TAGS, _AWAY_TAGS = frozenset(("article", "main")), frozenset("nav header footer aside form menu dialog button fieldset".split())
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>"
    r"|</?[a-zA-Z][^>]*\Z|<[!?][^>]*\Z|<//?[^>]*>", re.S)
_ATTR = re.compile(r"\b(class|id|role|aria-label|itemprop|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_FIELDS = 27


class Page:
    """Nodes in page order; a node is a block-level element or a text block (tag ``#``)."""

    __slots__ = ("tag", "up", "depth", "away", "here", "label", "text", "link", "blocks")

    def __init__(self, source: str):
        self.tag, self.up, self.depth, self.away, self.here = ["#root"], [-1], [0], [0], [0]
        self.label, self.text, self.link = [0], [""], [0]
        stack, links, part, linked = [0], 0, [], 0

        opened = {}  # tags on the stack, counted

        def pop():
            name = self.tag[stack.pop()]
            opened[name] -= 1
            return name

        def add(tag, away, here, label, text="", link=0):
            p = stack[-1]
            self.tag.append(tag), self.up.append(p), self.depth.append(self.depth[p] + 1)
            self.away.append(away), self.here.append(here), self.label.append(self.label[p] if label is None else label)
            self.text.append(text), self.link.append(link)

        def flush():
            nonlocal part, linked
            if part:
                text = " ".join(_html.unescape("".join(part)).split())
                if text:
                    add("#", 0, 0, None, text, min(linked, len(text)))
                part, linked = [], 0

        at, size, lower = 0, len(source), None
        while at < size:
            m = _MARK.search(source, at)
            lo = m.start() if m else size
            if lo > at:
                part.append(source[at:lo])
                if links:
                    linked += lo - at
            if not m:
                break
            at = m.end()
            close, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if name in _INLINE:
                if name == "a":
                    links = 0 if close else 1
                elif name == "br":
                    part.append(" ")
                continue
            if name in _RAW:
                if not close and not attrs.rstrip().endswith("/"):
                    if lower is None:
                        lower = source.lower() if source.isascii() else source.translate(_ASCII_LOWER)
                    end = lower.find(f"</{name}", at)
                    stop = source.find(">", end) if end >= 0 else -1
                    at = stop + 1 if stop >= 0 else size
                    if name not in ("svg", "math", "title"):
                        part.append(" ")
                continue
            flush()
            if close:
                if opened.get(name):
                    while pop() != name:
                        pass
                    links = 0
                continue
            if name in _CLOSE_P and self.tag[stack[-1]] == "p":
                pop()
            ends = _SELF.get(name)
            if ends:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in ends:
                        while len(stack) > i:
                            pop()
                        break
                    if self.tag[stack[i]] in _WALL and not (name[0] == "t" and self.tag[stack[i]] in ("td", "th")):
                        break
            away = here = 0
            label = None
            if "=" in attrs:
                for key, a, b, c in _ATTR.findall(attrs):
                    value = a or b or c
                    if key.lower() == "data-label":
                        label = int(value == "1")
                        continue
                    for w in _WORD.findall(value):
                        w = w.lower()
                        away += w in _AWAY
                        here += w in _HERE
            add(name, away, here, label)
            if name not in _VOID and not attrs.rstrip().endswith("/"):
                stack.append(len(self.tag) - 1)
                opened[name] = opened.get(name, 0) + 1
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        up = self.up
        chars, link, blocks, nodes, commas = [0] * n, [0] * n, [0] * n, [1] * n, [0] * n
        kids = [0] * n
        for i in range(n - 1, -1, -1):
            if self.tag[i] == "#":
                t = self.text[i]
                chars[i], link[i], blocks[i] = len(t), self.link[i], 1
                commas[i] = t.count(",") + t.count(".")
            p = up[i]
            if p >= 0:
                chars[p] += chars[i]
                link[p] += link[i]
                blocks[p] += blocks[i]
                nodes[p] += nodes[i]
                commas[p] += commas[i]
                kids[p] += 1
        total = chars[0] + 1.0
        x = np.zeros((n, _FIELDS))
        above = [(0, 0, 0, 0)] * n  # away words, here words, away tags, main tags among ancestors
        seen = [0] * n
        has_main = float(any(t in _MAIN_TAGS for t in self.tag))
        for i in range(n):
            p, tag = up[i], self.tag[i]
            a = above[p] if p >= 0 else (0, 0, 0, 0)
            order = seen[p] if p >= 0 else 0
            if p >= 0:
                seen[p] += 1
            mine = (a[0] + self.away[i], a[1] + self.here[i], a[2] + (tag in _AWAY_TAGS), a[3] + (tag in _MAIN_TAGS))
            above[i] = mine
            c = chars[i]
            parent = self.tag[p] if p >= 0 else ""
            x[i] = (self.away[i], self.here[i], tag in _AWAY_TAGS, tag in _MAIN_TAGS, *a, *mine[2:],
                    self.depth[i], c, c / total, link[i] / (c + 1.0), c / nodes[i], commas[i] / (c + 1.0), blocks[i],
                    c / (blocks[i] + 1e-9) if blocks[i] else 0, kids[i], kids[p] if p >= 0 else 0, order / (kids[p] if p >= 0 else 1),
                    tag == "#", tag in ("p", "h1", "h2", "h3", "blockquote", "pre") or parent in ("p", "h1", "h2", "h3", "blockquote", "pre"),
                    tag in ("li", "ul", "ol") or parent == "li", has_main, mine[3] > 0, (mine[0] > 0) + (mine[2] > 0))
        return x

    def targets(self) -> np.ndarray:
        """1 for nodes with labelled text below them."""
        y = np.zeros(len(self.tag))
        for i in range(len(self.tag) - 1, -1, -1):
            if self.tag[i] == "#" and self.label[i]:
                y[i] = 1
            if y[i] and self.up[i] >= 0:
                y[self.up[i]] = 1
        return y

    def decode(self, chance: np.ndarray) -> str:
        """Most likely consistent choice: a node is kept only under kept ancestors."""
        n = len(self.tag)
        p = np.clip(chance, 1e-6, 1 - 1e-6)
        yes, no = np.log(p).tolist(), np.log1p(-p).tolist()
        keep, drop = yes[:], no[:]
        for i in range(n - 1, 0, -1):
            keep[self.up[i]] += max(keep[i], drop[i])
            drop[self.up[i]] += drop[i]
        kept = [True] * n
        out = []
        for i in range(1, n):
            kept[i] = kept[self.up[i]] and keep[i] > drop[i]
            if kept[i] and self.tag[i] == "#":
                out.append(self.text[i])
        return "\n".join(out)


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}

_BUILT_IN = ("<html><head><title>a</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>"
             "<article><h1>A walk by the river</h1><p>We set out early, before the mist had gone, and followed the bank north.</p>"
             "<p>By noon the path had narrowed. Nobody spoke much, and that was well.</p><ul><li>Bring water.</li><li>Bring a map.</li></ul>"
             "</article><footer>&copy; example.org</footer></body></html>")


def _variant(source: str, fillers: list[str], rng: random.Random, plain: bool) -> str:
    """A labelled page: the main text's element carries ``data-label=1``, what is put in carries 0."""
    tag = "article" if re.search(r"<article\b", source, re.I) else "main"
    page = re.sub(rf"<{tag}\b([^>]*)>", rf'<{tag}\1 data-label="1">', source, flags=re.I)
    if plain:
        return page

    def fill() -> str:
        return _html.escape(rng.choice(fillers)) if fillers else "Sign up for our letter today"

    def extra() -> str:
        word = rng.choice(AWAY)
        kind = rng.randrange(6)
        if kind == 0:
            inner = "".join(f'<div class="comment"><p>{fill()}</p></div>' for _ in range(rng.randint(1, 4)))
            return f'<section id="comments" data-label="0">{inner}</section>'
        if kind == 1:
            return f'<form class="{rng.choice(("search", "newsletter", "login", "signup"))}" data-label="0"><label>{fill()[:60]}</label><input type="text"><p>{fill()[:120]}</p></form>'
        if kind == 2:
            return f'<aside data-label="0"><h3>{fill()[:40]}</h3><p>{fill()}</p></aside>'
        if kind == 3:
            items = "".join(f'<li><a href="/{i}">{fill()[:30]}</a></li>' for i in range(rng.randint(2, 8)))
            return f'<div class="{word}" data-label="0"><ul>{items}</ul></div>'
        if kind == 4:
            return f'<header data-label="0"><p>{fill()[:80]}</p></header>'
        return f'<div {rng.choice(("class", "id"))}="{rng.choice(("", "site-", "page-", "block-"))}{word}" data-label="0"><p>{fill()}</p></div>'

    if rng.random() < 0.6:  # landmarks become plain containers
        word = rng.choice(HERE)
        new = rng.choice(("div", "section"))
        page = re.sub(rf"<{tag}\b([^>]*)>", rf'<{new} class="{word}"\1>', page, flags=re.I)
        page = re.sub(rf"</{tag}>", f"</{new}>", page, flags=re.I)
        for old, words in (("nav", ("menu", "navbar", "navigation")), ("footer", ("footer", "site-footer", "bottom")),
                           ("header", ("header", "masthead")), ("aside", ("sidebar", "widget"))):
            if rng.random() < 0.7:
                page = re.sub(rf"<{old}\b([^>]*)>", f'<div class="{rng.choice(words)}"\\1>', page, flags=re.I)
                page = re.sub(rf"</{old}>", "</div>", page, flags=re.I)
    ends = [m.end() for m in re.finditer(r"</(?:p|h1|nav|ul)>", page)]
    spots = [m.start() for m in re.finditer(r'<(?:article|main|div|section)\b[^>]*data-label="1"', page)][:1]
    spots += rng.sample(ends, min(len(ends), rng.randint(0, 3)))
    close = page.rfind("<footer") if "<footer" in page else len(page)
    spots += [close] * rng.randint(0, 2)
    for at in sorted(spots, reverse=True):
        page = page[:at] + extra() + page[at:]
    return page


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", limit: int = PAGES,
          variants: int = VARIANTS, longest: int = LONGEST, fillers: int = FILLERS) -> Trees:
    """Trees fitted on at most ``limit`` pages that mark their main text, and their variants.

    The sample is that of the smallest hashes of id and page among pages of fewer than
    ``longest`` characters; only hashes are sorted, and ``limit`` pages reach the driver.
    ``fillers`` bounds the texts that variants take their additions from.
    """
    marked = (pages.where(F.col(html_col).rlike("(?i)<(article|main)[\\s>]") & (F.length(html_col) < longest))
              .select(F.xxhash64(id_col, html_col).alias("at"), F.col(html_col).alias("page")))
    first = [r[0] for r in marked.select("at").distinct().orderBy("at").limit(limit).collect()]
    taken = [r[1] for r in sorted(marked.where(F.col("at").isin(first)).groupBy("at").agg(F.min("page")).collect())]
    rng = random.Random(11)
    fillers = [t for s in taken for t in Page(s).text if 20 < len(t)][:fillers]
    xs, ys = [], []
    for source in [*taken, _BUILT_IN, _BUILT_IN]:
        for k in range(variants + 1):
            page = Page(_variant(source, fillers, rng, k == 0))
            xs.append(page.features())
            ys.append(page.targets())
    return Trees(rounds=40, depth=4, rate=0.3).fit(np.concatenate(xs), np.concatenate(ys))


def extract(pages: DataFrame, model: Trees, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text`` (a column of that name is replaced); no shuffle."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in pages.columns if c not in (html_col, "text")]

    def run(batches):
        for b in batches:
            sources = b.column(html_col).to_pylist()
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                parsed = [Page(s or "") for s in sources[lo:lo + 128]]
                x = [p.features() for p in parsed]
                chance = shared.value.probability(np.concatenate(x))
                ends = np.cumsum([len(v) for v in x])
                text = [p.decode(c) for p, c in zip(parsed, np.split(chance, ends[:-1]))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], pa.array(text, pa.string())],
                                                 names=[*rest, "text"])

    return pages.select(*rest, html_col).mapInArrow(
        run, pages.select(*rest, F.lit(None).cast("string").alias("text")).schema)
