"""Main text of web pages by scoring the tag tree.

Every paragraph gives points for its length and its commas, less its share of link text, to the elements
around it: all to the nearest, half to the next, a third of that share further up.  The container with the
most points, discounted by its link density, holds the article; siblings with a fair share of the points, and
long plain paragraphs beside it, belong to it.  What no article consists of (menus, forms, comments, ...) is
left out before, by element and by the names in its class, id and role; not so where such a name is
beside one for content, or where the element holds most of the page and its heading.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.rows import Columns, map_columns

_RAW = frozenset("script style template noscript textarea title iframe svg math object".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# Most tags: no `<` or `>` within, so a match never reads beyond the next tag.
_PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*+)((?:[^"'<>]++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_SPECIAL = re.compile(r"[\"'>]")
_LONG_REFERENCE = re.compile(r"&#(?:[0-9]{20,}|[xX][0-9a-fA-F]{20,});?")  # beyond any code point
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_LEFT_OUT = frozenset("nav footer aside button select option input dialog menu head".split())
_LEFT_OUT_WORDS = frozenset(
    """ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup
    promo promotion recommended related reply respond share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription toc toolbar tracking warning widget complementary contentinfo search alert""".split()
)
_CONTENT_WORDS = frozenset("article content main post entry story body text".split())
# A name with one of these first says what a page has or lacks, not what the element is.
_ABOUT_WORDS = frozenset("has have no not with without is show hide".split())
# Beside a left-out word these do not change what an element is; any other word does ("social-history").
_HELPER_WORDS = frozenset(
    """area bar block body bottom box button buttons card cell col column container content desktop element entry fixed form global
    grid group header heading hero holder icon icons inline inner item items label layer left link links list main mobile module
    outer page panel part post posts primary right row secondary section site slot sticky story table text thread title top
    unit user view wrap wrapper zone""".split()
)
_PAGE_HEAD_WORDS = frozenset("header head topbar site-header banner".split())
_ARTICLE = frozenset({"article", "main"})
_PARAGRAPH = frozenset("p li h1 h2 h3 h4 h5 h6 td th pre blockquote dd dt figcaption caption".split())
# A start tag of the set closes an open element named by the key, if no element of `_SCOPE` is between.
_CLOSED_BY = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
}
_SCOPE = frozenset("ul ol table dl div section article main body html".split())
_LEVELS = 6  # how far up a paragraph's points go


class _Tree:
    """Elements in page order as parallel lists, and the blocks of text in them."""

    def __init__(self) -> None:
        self.tag, self.parent, self.inside_article = ["#root"], [-1], [False]
        self.out = [False]  # never part of an article, nor what is below
        self.doubtful = [False]  # left out, unless it turns out to hold the article
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of links

    def add(self, tag: str, parent: int, rest: str) -> int:
        within = self.inside_article[parent]
        out = self.out[parent] or tag in _LEFT_OUT or (tag == "header" and not within)
        doubtful = tag == "form"
        if rest and not out and tag not in ("html", "body"):
            names = [n for m in _NAMED.finditer(rest) for n in (m[1] or m[2] or m[3] or "").lower().split()]
            words = [[w for w in re.split(r"[^a-z]+", n) if w] for n in names]
            flat = {w for n in words for w in n}
            marked = tag in _ARTICLE or any(n and set(n) <= _CONTENT_WORDS for n in words)
            main = tag in _ARTICLE or flat & {"article", "content", "main", "post", "entry"}
            head = bool(flat & _PAGE_HEAD_WORDS) and not within and not main
            doubtful = doubtful or head or (not marked and any(map(_left_out, words)))
            out = bool(_HIDDEN.search(rest))
            within = within or "main" in flat and tag in ("div", "section")
        self.tag.append(tag)
        self.parent.append(parent)
        self.out.append(out)
        self.doubtful.append(doubtful)
        self.inside_article.append(within or tag in _ARTICLE)
        return len(self.tag) - 1

    def settle(self) -> None:
        """Leave the doubtful elements out, but for those that hold most of the page's points and its first heading
        or its marked article: a page wrapped in a form, or whose content has an unlucky class."""
        n = len(self.tag)
        points = [0.0] * n
        heads = [tag == "h1" or tag == "main" or (tag == "article" and not d) for tag, d in zip(self.tag, self.doubtful)]
        for element, block, linked in self.blocks:
            points[element] += _points(block, linked)
        for i in range(n - 1, 0, -1):
            points[self.parent[i]] += points[i]
            heads[self.parent[i]] = heads[self.parent[i]] or heads[i]
        for i in range(1, n):
            kept = not self.doubtful[i] or (heads[i] and 2 * points[i] > points[0])
            self.out[i] = self.out[i] or not kept or self.out[self.parent[i]]
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]


def _left_out(name: list[str]) -> bool:
    """Whether a class, id or role, as its words, names a part that no article consists of."""
    if not name or name[0] in _ABOUT_WORDS:
        return False
    hit = [w in _LEFT_OUT_WORDS for w in name]
    return hit[-1] or (any(hit) and all(h or w in _HELPER_WORDS for h, w in zip(hit, name)))


def _points(block: str, linked: int) -> float:
    return (1 + block.count(",") + min(len(block) / 100, 3)) * (1 - min(linked / len(block), 1))


class _Tokens:
    """Tags of a page in order, as (start, end, tag or empty, closing, attributes): one pass, whatever the page.

    A tag ends at the first `>` outside quotes.  One whose quotes do not close before the end of the page has
    no name and ends at the next `<` or `>`.  What a search found, or that it found nothing, holds for later
    searches too, so no part of a page is searched again and again.
    """

    def __init__(self, html: str):
        self.html = html
        self.special = (0, -1)  # the first special sign at or after any place from here to there
        self.last = {sign: html.rfind(sign) for sign in "\"'>"}
        self.failed: set[int] = set()  # quotes from which no tag ends

    def _special(self, at: int) -> int:
        low, found = self.special
        if not low <= at <= found:
            m = _SPECIAL.search(self.html, at)
            found = m.start() if m else len(self.html)
            self.special = (at, found)
        return found

    def _tag_end(self, at: int) -> int:
        """The place of the `>` that ends a tag whose attributes begin at `at`; -1 without one."""
        html, opened = self.html, []
        while at <= self.last[">"]:
            at = self._special(at)
            if at >= len(html):
                break
            sign = html[at]
            if sign == ">":
                return at
            if at in self.failed or self.last[sign] <= at:
                opened.append(at)
                break
            opened.append(at)
            at = html.index(sign, at + 1) + 1
        self.failed.update(opened)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        html, n, at = self.html, len(self.html), 0
        while (at := html.find("<", at)) >= 0:
            start = at
            plain = _PLAIN_TAG.match(html, at)
            if plain:
                at, tag = plain.end(), plain[2].lower()
                if tag in _RAW and not plain[1]:
                    at = self._raw_end(tag, at)
                    yield start, at, "", False, ""
                else:
                    yield start, at, tag, bool(plain[1]), plain[3]
            elif html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = n if end < 0 else end + 3
                yield start, at, "", False, ""
            elif html[at + 1 : at + 2] in ("!", "?"):
                end = html.find(">", at)
                at = n if end < 0 else end + 1
                yield start, at, "", False, ""
            else:
                closing = html.startswith("/", at + 1)
                name = _NAME.match(html, at + 1 + closing)
                if not name:
                    at += 1
                    continue
                tag, end = name[0].lower(), self._tag_end(name.end())
                if end < 0:
                    stops = [i for i in (html.find("<", name.end()), html.find(">", name.end()) if name.end() <= self.last[">"] else -1) if i >= 0]
                    stop = min(stops, default=n)
                    at = stop + 1 if html.startswith(">", stop) else stop
                    yield start, at, "", False, ""
                elif tag in _RAW and not closing:
                    at = self._raw_end(tag, end + 1)
                    yield start, at, "", False, ""
                else:
                    at = end + 1
                    yield start, at, tag, closing, html[name.end() : end]

    def _raw_end(self, tag: str, at: int) -> int:
        """After the end tag of an element whose content is no markup; the page's end without one."""
        m = _RAW_END[tag].search(self.html, at)
        return m.end() if m else len(self.html)


_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}


def _parse(html: str) -> _Tree:
    tree = _Tree()
    stack, holders = [0], [0]
    open_tags: dict[str, int] = {}  # how many elements of a tag are open
    texts: list[str] = []
    linked: list[str] = []
    holder = 0

    def flush() -> None:
        text = " ".join("".join(texts).split())
        if text:
            tree.blocks.append((holder, text, len(" ".join("".join(linked).split()))))
        texts.clear()
        linked.clear()

    def close(tag: str) -> None:
        while True:
            name = tree.tag[stack.pop()]
            open_tags[name] -= 1
            if name not in _INLINE:
                flush()
                holders.pop()
            if name == tag:
                return

    def text(raw: str) -> None:
        nonlocal holder
        if not raw or tree.out[stack[-1]]:
            return
        if not texts:
            holder = holders[-1]
        raw = unescape(_LONG_REFERENCE.sub("\ufffd", raw)) if "&" in raw else raw
        texts.append(raw)
        if open_tags.get("a"):
            linked.append(raw)

    at = 0
    for start, end, tag, closing, rest in _Tokens(html):
        if start > at:
            text(html[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if open_tags.get(tag):
                close(tag)
            continue
        for opened, closers in _CLOSED_BY.items():
            if tag in closers and open_tags.get(opened):
                for i in reversed(stack):
                    name = tree.tag[i]
                    if name == opened:
                        close(opened)
                        break
                    if name in _SCOPE and not (opened == "p" and name in closers):
                        break
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            texts.append(" ")
        if tag in _VOID:
            continue
        stack.append(tree.add(tag, stack[-1], rest))
        if tag not in _INLINE:
            holders.append(stack[-1])
        open_tags[tag] = open_tags.get(tag, 0) + 1
    text(html[at:])
    flush()
    tree.settle()
    return tree


def main_text(html: str) -> str:
    """The article's blocks in page order, joined by newlines; without any text, an empty string."""
    tree = _parse(html)
    n = len(tree.tag)
    score, chars, links = [0.0] * n, [0] * n, [0] * n
    for element, block, linked in tree.blocks:
        chars[element] += len(block)
        links[element] += min(linked, len(block))
        points = _points(block, linked)
        at = tree.parent[element] if tree.tag[element] in _PARAGRAPH else element
        share = 1.0
        for level in range(_LEVELS):
            if at < 0:
                break
            score[at] += points * share
            at, share = tree.parent[at], 1 / 2 if level == 0 else 1 / (3 * (level + 1))
    for i in range(n - 1, 0, -1):
        chars[tree.parent[i]] += chars[i]
        links[tree.parent[i]] += links[i]
    density = [min(l / c, 1) if c else 0.0 for c, l in zip(chars, links)]
    final = [s * (1 - d) for s, d in zip(score, density)]
    best = max(range(n), key=lambda i: (final[i], -i))
    at = best
    while at > 0:  # the whole article around it, if the page marks one
        if tree.tag[at] in _ARTICLE:
            best = at
            break
        at = tree.parent[at]
    up = tree.parent[best]
    kept = [False] * n
    kept[best] = True
    if up > 0 and tree.tag[best] not in _ARTICLE:
        for i in range(up + 1, n):
            if tree.parent[i] == up and i != best:
                plain = tree.tag[i] in _PARAGRAPH and density[i] < 0.25 and (chars[i] > 80 or tree.tag[i][0] == "h")
                kept[i] = plain or final[i] >= 0.2 * final[best] > 0
    menu = [False] * n  # lists of nothing but links
    for i in range(1, n):
        kept[i] = kept[i] or kept[tree.parent[i]]
        menu[i] = menu[tree.parent[i]] or (tree.tag[i] in ("ul", "ol") and density[i] > 0.8)
    return "\n".join(block for element, block, _ in tree.blocks if kept[element] and not menu[element])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row; NULL html is an empty page."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for b in batches:
            texts = [main_text(h) for h in b["html"]]
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_columns(own, kernel, "page_id long, url string, text string, n_chars long")
