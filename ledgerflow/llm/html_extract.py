"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed to a tree; every node gets features (its tag, tokens of its
class, id and role, depth, siblings, text and link density of its subtree, and
those of its ancestors), and boosted trees give the log-odds that it belongs to
the article. Decoding is hierarchical: a node is kept only if its parent is, and
the kept set maximises the summed log-odds, so an ancestor and a descendant
never contradict each other. The model is fitted on pages that ``training``
generates from a fixed seed, with menus, headers, footers, sidebars, notices,
adverts, forms and comments in many spellings.

The article's text comes out in blocks: character references decoded, white
space inside a block one space, trimmed, blocks in page order joined by an empty
line. Null and empty pages, and pages without article text, give an empty string.
Repeated rows are extracted each, alike; sets of equal log-odds keep the smaller
one. Whole pages are parsed, whatever their length, in time that grows with it. An
empty table gives no rows; columns besides page_id, url and html are not read, so
their names cannot clash.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosted_trees
from .shared import records, small_batches

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
#: One attribute with its name and value, so that no name is looked for inside another name or a value.
_ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea select xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: What a start tag closes when it is open, up to the nearest of SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("article aside body div section table ul ol dl td th blockquote main nav header footer form html".split())
KINDS = ["html", "body", "head", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "p", "h1", "h2", "h3", "ul", "ol", "li", "a", "span", "table", "td", "figure", "figcaption", "blockquote", "pre", "button", "label", "b"]
_KIND = {k: i for i, k in enumerate(KINDS)} | {"h4": 15, "h5": 15, "h6": 15, "tr": 21, "tbody": 21, "th": 22, "strong": 29, "em": 29, "i": 29, "menu": 16}
BAD = frozenset("nav navbar navigation menu header masthead footer foot sidebar side aside ad ads advert advertisement adsbygoogle sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice alert popup modal overlay dialog comment comments reply replies disqus respond discussion share sharing social related recommended recommendation recommendations more newsletter subscribe subscription signup login search form breadcrumb breadcrumbs widget widgets toolbar pagination pager tags tag copyright legal skip hidden contentinfo complementary".split())
GOOD = frozenset("article content post entry main body story text articlebody page prose".split())


class Page:
    """Nodes as parallel lists, and runs of text as (node, block, text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.tokens, self.hidden = ["#root"], [-1], [()], [False]
        self.runs: list[tuple[int, int, str]] = []
        self.block = 0
        self._parse(source)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        tokens, hidden = (), False
        if attributes:
            found = []
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name == "style":
                    hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
                elif name == "hidden" or name == "aria-hidden":
                    hidden |= name == "hidden" or value.lower() == "true"
                elif name in ("class", "id", "role", "itemprop"):
                    found += [x.lower() for x in _TOKEN.findall(value)]
            tokens = tuple(found)
        self.tag.append(tag)
        self.parent.append(parent)
        self.tokens.append(tokens)
        self.hidden.append(hidden)
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        open_: dict[str, int] = {}  # how many of each tag are on the stack
        while at < n:
            m = _TAG.search(source, at)
            start = m.start() if m else n
            if start > at:
                self.runs.append((stack[-1], self.block, source[at:start]))
            if not m:
                break
            at = m.end()
            end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if m[0].startswith("<![CDATA["):
                self.runs.append((stack[-1], self.block, html.escape(m[0][9:].removesuffix("]]>"))))
            if tag is None:
                continue
            tag = tag.lower()
            if end:
                if open_.get(tag):
                    while self._pop(stack, open_) != tag:
                        pass
                if tag in BLOCK:
                    self.block += 1
                continue
            if tag in BLOCK:
                self.block += 1
                self._close(stack, open_, {"p"}, within=SCOPE)
            if tag in CLOSES:
                self._close(stack, open_, CLOSES[tag], within=SCOPE - CLOSES[tag])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                if not attributes.endswith("/") or tag in ("script", "style"):
                    inside, at = source[at : close.start() if close else n], close.end() if close else n
                    if tag == "xmp":  # text that shows as it stands
                        self.runs.append((stack[-1], self.block, html.escape(inside)))
                self.runs.append((stack[-1], self.block, " "))
            elif tag in VOID:
                self.runs.append((stack[-1], self.block, " "))
            elif not attributes.endswith("/"):
                stack.append(self._open(tag, attributes, stack[-1]))
                open_[tag] = open_.get(tag, 0) + 1

    def _pop(self, stack: list[int], open_: dict[str, int]) -> str:
        tag = self.tag[stack.pop()]
        open_[tag] -= 1
        return tag

    def _close(self, stack: list[int], open_: dict[str, int], tags: set[str], within: frozenset[str]) -> None:
        if not any(open_.get(t) for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] in tags:
                while len(stack) > k:
                    self._pop(stack, open_)
                return
            if self.tag[stack[k]] in within:
                return

    def features(self) -> np.ndarray:
        n = len(self.tag)
        own, links, stops, digits, runs = (np.zeros(n) for _ in range(5))
        for node, _, text in self.runs:
            length = len(text) - text.count(" ")
            own[node] += length
            if length:
                runs[node] += 1
                stops[node] += text.count(".") + text.count(",")
                digits[node] += sum(map(text.count, "0123456789"))
        parent = np.array(self.parent)
        kind = np.array([_KIND.get(t, 30) for t in self.tag])
        bad = np.array([sum(t in BAD for t in x) for x in self.tokens], float)
        good = np.array([sum(t in GOOD for t in x) for x in self.tokens], float)
        depth, children, index = np.zeros(n), np.zeros(n), np.zeros(n)
        alike = np.zeros(n)
        bad_up, good_up, in_article, in_bad_tag, last_at = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), {}
        frame = {_KIND[t] for t in ("nav", "header", "footer", "aside", "form")}
        for i in range(1, n):
            p = self.parent[i]
            depth[i] = depth[p] + 1
            index[i] = children[p]
            children[p] += 1
            alike[i] = last_at.get((p, self.tag[i]), 0)
            last_at[p, self.tag[i]] = alike[i] + 1
            bad_up[i] = bad_up[p] + (bad[p] > 0)
            good_up[i] = good_up[p] + (good[p] > 0)
            in_article[i] = max(in_article[p], kind[p] in (3, 4))
            in_bad_tag[i] = in_bad_tag[p] + (kind[p] in frame)
        text, nodes, blocks = own.copy(), np.ones(n), runs.copy()
        links[kind == 19] = own[kind == 19]
        stop, paragraphs, inputs = stops.copy(), (kind == 12).astype(float) * own, np.isin(kind, (11, 27, 28)).astype(float)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            for x in (text, nodes, blocks, stop, paragraphs, inputs):
                x[p] += x[i]
            links[i] = max(links[i], text[i] if kind[i] == 19 else 0.0)
            links[p] += links[i]
        much = np.maximum(text, 1)
        page = max(text[0], 1)
        siblings = children[parent]
        up = np.maximum(parent, 0)
        flat = np.column_stack([
            depth, index, siblings, index / np.maximum(siblings, 1), alike, children, np.log1p(text), text / page, text / np.maximum(text[up], 1), np.log1p(own), links / much, nodes / much * 100, text / np.maximum(blocks, 1),
            stop / much * 100, paragraphs / much, inputs, np.array([len(x) for x in self.tokens], float), bad, good, bad_up, good_up, in_article, in_bad_tag, links[up] / np.maximum(text[up], 1), np.arange(n) / n, np.array(self.hidden, float), digits / much, bad[up], good[up],
        ])
        tags = np.zeros((n, len(KINDS) + 1))
        tags[np.arange(n), kind] = 1
        return np.hstack([flat, tags, tags[up][:, [_KIND[t] for t in ("nav", "header", "footer", "aside", "form", "article", "main", "ul", "div")]]])

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Which nodes are kept: the set closed under parents of the largest summed log-odds."""
        n = len(self.tag)
        gain = np.where([t == "head" for t in self.tag] | np.array(self.hidden), -np.inf, odds)
        gain[0] = 0.0
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[self.parent[i]] += gain[i]
        keep = np.zeros(n, bool)
        keep[0] = True
        for i in range(1, n):
            keep[i] = keep[self.parent[i]] and gain[i] > 0
        return keep

    def text(self, keep: np.ndarray) -> str:
        out: list[str] = []
        parts: list[str] = []
        at = -1
        for node, block, text in [*self.runs, (0, -2, "")]:
            if block != at:
                if parts and (joined := _SPACE.sub(" ", html.unescape("".join(parts))).strip()):
                    out.append(joined)
                parts, at = [], block
            if keep[node]:
                parts.append(text)
        return "\n\n".join(out)


# -- training ---------------------------------------------------------------------


def training(pages: int = 240, seed: int = 7) -> list[tuple[str, set[str]]]:
    """Generated pages, and for each the words of its article."""
    rng = np.random.Generator(np.random.PCG64(seed))
    count = [0]
    pick = lambda *x: x[int(rng.integers(len(x)))]
    chance = lambda p: rng.random() < p

    def words(lo: int, hi: int) -> str:
        out = []
        for _ in range(int(rng.integers(lo, hi + 1))):
            count[0] += 1
            out.append("".join(pick("ka", "te", "mi", "so", "é", "ran", "ü", "tion", "st", "o") for _ in range(int(rng.integers(1, 4)))) + f"q{count[0]}")
            if chance(0.12):
                out[-1] += pick(",", ".", ".", ";")
        return " ".join(out)

    def attribute(*names: str) -> str:
        if not names or chance(0.25):
            return "" if chance(0.6) else f' class="{pick("x1", "col", "css-9f", "wrap", "inner", "box")}"'
        name = pick(*names)
        return pick(f' class="{name}"', f' id="{name}"', f' class="{pick("c-", "site-", "js-", "page-")}{name}"', f' class="{name} {pick("box", "wide", "dark", "col-2")}"')

    def link(lo: int = 1, hi: int = 3) -> str:
        return f'<a href="/{pick("a", "b", "c")}">{words(lo, hi)}</a>'

    def links() -> str:
        n = int(rng.integers(2, 9))
        return pick("<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>", " ".join(link() for _ in range(n)), "".join(f"<div>{link()}</div>" for _ in range(n)))

    def bad(kind: str) -> str:
        prose = lambda a=4, b=25: pick(f"<p>{words(a, b)}</p>", words(a, b), f"<p>{words(a, b)}</p><p>{words(a, b)}</p>")
        box = lambda tag, inside, *names: f"<{tag}{attribute(*names)}>{inside}</{tag}>"
        strong = lambda inside, *names: f'<{pick("div", "section", "div", "aside")} {pick("class", "id")}="{pick(*names)}">{inside}</div>'.replace("</div>", "") + "</div>"
        if kind == "nav":
            return pick(box("nav", links(), "nav", "menu"), f'<div class="{pick("menu", "navbar", "navigation", "breadcrumbs")}">{links()}</div>', f'<div role="navigation">{links()}</div>', f"<nav>{links()}</nav>")
        if kind == "header":
            inside = pick(f"<h1>{words(1, 4)}</h1>", words(1, 4), link(), f"<p>{words(2, 8)}</p>") + (links() if chance(0.5) else "")
            return pick(box("header", inside, "header", "masthead"), f'<div class="{pick("header", "masthead", "site-header")}">{inside}</div>', f'<div id="header">{inside}</div>')
        if kind == "footer":
            inside = pick("&copy; ", "", "") + words(2, 20) + (links() if chance(0.4) else "")
            return pick(box("footer", inside, "footer"), f'<div class="{pick("footer", "site-footer", "copyright")}">{inside}</div>', f'<div id="footer"><p>{inside}</p></div>', f"<footer>{inside}</footer>")
        if kind == "aside":
            inside = f"<h3>{words(1, 4)}</h3>" * int(chance(0.5)) + pick(links(), prose(), prose())
            return pick(box("aside", inside, "sidebar", "widget", "related"), f'<div class="{pick("sidebar", "related", "widget", "recommended", "side-bar")}">{inside}</div>', f'<section class="{pick("related-posts", "recommendations", "more-stories")}">{inside}</section>', f"<aside>{inside}</aside>")
        if kind == "ad":
            tag = pick("div", "div", "section", "aside", "p", "span")
            return f'<{tag} {pick("class", "class", "id")}="{pick("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot", "sponsor")}">{pick(words(2, 25), link(2, 8), prose())}</{tag}>'
        if kind == "notice":
            return f'<div {pick("class", "id")}="{pick("cookie-notice", "cookie", "consent", "notice", "gdpr-banner", "alert", "popup", "modal")}"{pick("", " role=dialog")}>{prose(4, 30)}{pick("<button>" + words(1, 2) + "</button>", link(), "")}</div>'
        if kind == "form":
            inside = f"<label>{words(1, 4)}</label><input type=text><button>{words(1, 2)}</button>" + (f"<p>{words(3, 12)}</p>" if chance(0.4) else "")
            form = f"<form{attribute('newsletter', 'signup', 'search')}>{inside}</form>"
            return form if chance(0.6) else f'<div class="{pick("newsletter", "subscribe", "search", "login")}">{"<h3>" + words(1, 4) + "</h3>" if chance(0.5) else ""}{form}</div>'
        comment = lambda: pick(f'<div class="comment"><p>{words(5, 60)}</p></div>', f'<li class="comment"><span>{words(1, 2)}</span><p>{words(5, 60)}</p></li>', f'<article class="comment"><p>{words(5, 60)}</p></article>')
        inside = f"<h2>{words(1, 3)}</h2>" * int(chance(0.6)) + "".join(comment() for _ in range(int(rng.integers(1, 6))))
        return f'<{(t := pick("section", "div", "ol", "aside"))} {pick("class", "id")}="{pick("comments", "comment-list", "replies", "respond", "disqus", "reader-comments", "discussion")}">{inside}</{t}>'

    out = []
    for _ in range(pages):
        good: set[str] = set()

        def told(text: str, good: set[str] = good) -> str:
            good.update(re.findall(r"q\d+", text))
            return text

        blocks = [f"<h1>{told(words(3, 14))}</h1>"] if chance(0.9) else []
        if blocks and chance(0.2):
            blocks = [f'<header{attribute("entry-header", "post-title")}>{blocks[0]}</header>']
        for _ in range(int(rng.integers(1, 12))):
            size = (1, 8) if chance(0.25) else (8, 120)
            text = told(words(*size))
            blocks.append(pick(*[f"<p>{text}</p>"] * 6, f"<p><b>{text}<br>", f"<p>{text}", f"<h2>{text}</h2>", f"<ul><li>{text}</li><li>{told(words(2, 15))}</li></ul>", f"<blockquote><p>{text}</p></blockquote>", f"<div>{text}</div>", f"<p>{text} <a href=x>{told(words(1, 4))}</a> {told(words(1, 9))}</p>", f"<figure><img src=x><figcaption>{text}</figcaption></figure>", f"<pre>{text}</pre>", f"<table><tr><td>{text}</td><td>{told(words(1, 4))}</td></tr></table>", f"<p><span>{text}</span></p>"))
            if chance(0.12):
                blocks.append(bad(pick("ad", "ad", "aside", "form", "notice")))
        body = "".join(blocks)
        holder = pick("article", "article", "article", "main", "div", "section")
        tokens = "" if holder in ("article", "main") and chance(0.5) else pick(' class="content"', ' id="content"', ' class="post-body"', ' class="entry-content"', ' class="article-text"', ' id="main"', ' class="story"', ' class="prose"', ' itemprop="articleBody"', ' class="col-8"')
        body = f"<{holder}{tokens}>{body}</{holder}>"
        if chance(0.3):
            body = f"<{(t := pick('div', 'main', 'section'))}{attribute('main', 'content', 'page')}>{body}{bad('comments') if chance(0.3) else ''}</{t}>"
        top = [bad(k) for k in ("header", "nav", "ad", "notice", "form", "aside") if chance(0.45)]
        end = [bad(k) for k in ("comments", "aside", "ad", "form", "nav", "notice") if chance(0.4)] + ([bad("footer")] if chance(0.8) else [])
        page = "".join(top) + body + "".join(end)
        if chance(0.25):
            page = f'<div{attribute("wrapper", "page", "container")}>{page}</div>'
        out.append((f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{words(3, 9)}</title></head><body>{page}{'</body></html>' if chance(0.8) else ''}", good))
    return out


@lru_cache(maxsize=1)
def model() -> boosted_trees.Boosted:
    """Trees fitted on the generated pages: a node is of the article if some of its text is."""
    xs, ys = [], []
    for source, good in training():
        page = Page(source)
        y = np.zeros(len(page.tag))
        for node, _, text in page.runs:
            if any(w in good for w in re.findall(r"q\d+", text)):
                y[node] = 1
        for i in range(len(y) - 1, 0, -1):
            y[page.parent[i]] = max(y[page.parent[i]], y[i])
        xs.append(page.features()[1:])
        ys.append(y[1:])
    return boosted_trees.fit(np.vstack(xs), np.concatenate(ys), trees=30, bins=24)


def extract_texts(sources: list[str | None], trees: boosted_trees.Boosted) -> list[str]:
    pages = [Page(s or "") for s in sources]
    if not pages:
        return []
    sizes = [len(p.tag) for p in pages]
    odds = trees(np.vstack([p.features() for p in pages]))
    cuts = np.cumsum([0, *sizes])
    return [p.text(p.decode(odds[a:b])) for p, a, b in zip(pages, cuts, cuts[1:], strict=False)]


def _extract(batches: Iterator[pa.RecordBatch], trees: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            part = batch.slice(lo, 128)
            text = extract_texts(part.column("html").to_pylist(), trees.value)
            yield records(page_id=part.column("page_id"), url=part.column("url"), text=pa.array(text, pa.string()), n_chars=pa.array(list(map(len, text)), pa.int64()))


def html_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession)
    trees = pages.sparkSession.sparkContext.broadcast(model())
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(lambda b: _extract(b, trees), "page_id long, url string, text string, n_chars long")
