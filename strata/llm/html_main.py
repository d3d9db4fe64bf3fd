"""Main text of web pages by consensus of a host's pages on where it stands.

Every page proposes its best container: the lowest one that holds nearly all
text outside menus, adverts and the like; lists and quotes are none, and an
article is not divided. The container's path is generalised to tags and classes
without digits. Spark adds up the proposals by host; pages are then extracted
again from the elements at their host's winning path if these hold a comparable
share of the page's text or about as much as on the pages that voted for them,
else from their own proposal.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import plain_key, restore_key, sent_if_small, staged

#: Share of the page's text outside links that a container must hold to be entered.
ENTER = 0.85
#: Least text at the host's path, as a share of the page's own proposal or of the mean on the pages that voted for it.
COMPARABLE = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:/>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# HTML element kinds, and names that sites give to what is not the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr".split())
_CONTAINER = frozenset("html body main article section div center table tbody tr td dl ul ol blockquote".split())
#: Containers that may be entered, and those that may be entered from a main or inside it; nothing is from an article.
_ENTERED = frozenset("html body main article section div center table tbody tr td".split())
_ENTERED_IN_MAIN = frozenset("main article div center".split())
_CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_NOT_MAIN = frozenset("head nav header footer aside form menu button select option dialog object canvas audio video map".split())
_NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert".split())
_NOT_MAIN_NAMES = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|menus?|nav|navbar|navigation|breadcrumbs?|sidebars?|aside|widgets?|"
    r"footers?|headers?|masthead|cookies?|consent|gdpr|notices?|popups?|modals?|overlay|newsletters?|subscribe|signup|login|share|sharing|social|related|recommended|"
    r"comments?|commentlist|disqus|replies|respond|pagination|pager|toolbar|skip)[\d_-]*",
    re.I,
)
_REPLIES = re.compile(r"(?:comments?|commentlist|disqus|replies|respond)[\d_-]*", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DIGITS = re.compile(r"\d+")


class _Element:
    __slots__ = ("tag", "path", "main", "text", "link", "children", "begin", "end", "at", "order", "last", "named", "replies", "marked")

    def __init__(self, tag: str, path: str, main: bool, begin: int, at: int = 0, order: int = 0):
        self.tag, self.path, self.main, self.begin, self.end = tag, path, main, begin, -1
        self.at, self.order, self.last = at, order, -1
        self.text = self.link = 0
        self.children: list[_Element] = []
        #: The element that is left out for its name and holds this one; of such an element: named like replies, holds an article or main.
        self.named: _Element | None = None
        self.replies = self.marked = False

    @property
    def plain(self) -> int:
        """Characters of text outside links."""
        return self.text - self.link

    def holds(self, other: _Element) -> bool:
        return self.order <= other.order < self.last


def parse(html: str) -> tuple[_Element, list[tuple[int, str]]]:
    """The tree of containers, and the main-text pieces (piece number, text) with "" where a block ends.

    An element's pieces are those from its ``begin`` to before its ``end``.
    Elements named like what is not the article are left out, unless they hold
    the page's largest article or main, or most of its text where no article or
    main stands outside them (replies: only if there is no other text).
    """
    root, pieces, named, _ = _parse(html, frozenset())
    total = root.plain + sum(x.plain for x in named)
    if not any(x.marked or 2 * x.plain > total for x in named):
        return root, pieces
    root, pieces, named, articles = _parse(html, None)
    spared = set()
    for x in named:
        inside = max((y.plain for y in articles if x.holds(y)), default=0)
        outside = max((y.plain - (x.plain if y.holds(x) else 0) for y in articles if not x.holds(y)), default=0)
        rest = root.plain - x.plain
        if inside > outside or outside <= 0 and (x.plain > 0 >= rest if x.replies else x.plain > rest):
            spared.add(x.at)
    return _parse(html, frozenset(spared))[:2]


def _parse(html: str, spared: frozenset[int] | None) -> tuple[_Element, list[tuple[int, str]], list[_Element], list[_Element]]:
    """Tree and pieces, the elements named like what is not the article, and the article and main elements.

    ``spared``: where in the page such elements begin that are not left out; None: all.
    """
    root = _Element("", "", True, 0)
    stack, pieces, links, at, order = [root], [], 0, 0, 0
    by_name: list[_Element] = []
    articles: list[_Element] = []

    def add(raw: str) -> None:
        top = stack[-1]
        if raw and (top.main or top.named):
            text = unescape(raw) if "&" in raw else raw
            n = len(text) - text.count(" ")
            if top.main:
                pieces.append(text)
            else:
                top = top.named
            top.text += n
            top.link += n if links else 0

    def close(k: int) -> None:
        nonlocal links
        while len(stack) > k:
            done = stack.pop()
            done.end, done.last = len(pieces), order + 1
            links -= done.tag == "a"
            if done.main:
                stack[-1].text += done.text
                stack[-1].link += done.link

    def brk() -> None:
        if pieces and pieces[-1] != "":
            pieces.append("")

    for token in _TOKEN.finditer(html):
        add(html[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _INLINE:
            brk()
        if token["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "body", "html"):
                    break
            continue
        if tag in _VOID:
            continue
        if tag in _CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option", "body"):
            for k in range(len(stack) - 1, 0, -1):  # what the new element closes without an end tag
                own = stack[k].tag
                if own == "p" and tag in _CLOSES_P or own == tag and tag in ("li", "tr", "option") or own in ("dt", "dd") and tag in ("dt", "dd") or own in ("td", "th") and tag in ("td", "th", "tr") or own == "head" and tag == "body":
                    close(k)
                    break
                if own not in _INLINE and own != "p" and not (own in ("td", "th") and tag == "tr"):
                    break
        rest, names = token["rest"], ""
        hidden = by_class = replies = False
        if rest:
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                value, name = a or b or c, name.lower()
                if name == "role":
                    hidden |= value.strip().lower() in _NOT_MAIN_ROLES
                elif name != "hidden":
                    own = value.split() if name == "class" else [] if tag in _INLINE or tag == "p" else [value.strip()]
                    if tag not in ("html", "body") and tag not in _HEADINGS:  # whole names only: has-sidebar is none
                        by_class |= any(_NOT_MAIN_NAMES.fullmatch(x) for x in own)
                        replies |= any(_REPLIES.fullmatch(x) for x in own)
                    if name == "class":
                        names = ".".join(sorted(_DIGITS.sub("", value).lower().split()))
        parent = stack[-1]
        kept = tag not in _NOT_MAIN and not hidden
        out = by_class and kept and spared is not None and token.start() not in spared
        main = parent.main and kept and not out
        if rest.endswith("/") and tag not in _CONTAINER:
            continue
        element = _Element(tag, f"{parent.path}>{tag}{'.' + names if names else ''}" if tag in _CONTAINER else parent.path, main, len(pieces), token.start(), order := order + 1)
        if parent.main and kept and by_class:
            element.replies = replies
            by_name.append(element)
        if kept and not main:
            element.named = element if parent.main else parent.named
        if tag in ("article", "main"):
            if main:
                articles.append(element)
            elif element.named:
                element.named.marked = True
        if main and tag in _CONTAINER:
            for near in reversed(stack):
                if near.tag in _CONTAINER or near is root:
                    near.children.append(element)
                    break
        links += tag == "a"
        stack.append(element)
    rest = html[at:]
    cut = re.search(r"<(?:[a-zA-Z/!?].*)?\Z", rest, re.S)  # a tag that the page's end cuts off
    add(rest[: cut.start()] if cut else rest)
    close(1)
    root.end, root.last = len(pieces), order + 1
    return root, pieces, by_name, articles


def best_container(root: _Element) -> _Element:
    """From the root down: the lowest container that holds nearly all text outside links."""
    here, allowed, least = root, _ENTERED, max(1.0, ENTER * root.plain)
    while here.tag != "article":
        if here.tag == "main":
            allowed = _ENTERED_IN_MAIN
        child = max((x for x in here.children if x.tag in allowed), key=lambda x: x.plain, default=None)
        if child is None or child.plain < least:
            break
        here = child
    return here


def at_path(root: _Element, path: str) -> list[_Element]:
    """The elements at ``path``, in page order."""
    found, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.path == path:
            found.append(x)
        elif path.startswith(x.path):
            todo.extend(reversed(x.children))
    return found


def text_of(element: _Element, pieces: list[str]) -> str:
    """Its main text: white space in a block is one space, blocks are joined by one space."""
    return " ".join("".join(x or " " for x in pieces[element.begin : element.end]).split())


def host_of(url: Column) -> Column:
    """The host of a URL with one (after `//`, without user and port), in lower case; else ''."""
    return F.coalesce(F.lower(F.regexp_extract(F.regexp_replace(url, r"^\s*([a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]*@)?", "//"), r"^//([^/?#:\s]*)", 1)), F.lit(""))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; ``pages``: page_id, url, html.

    A null html counts as empty and has the text ""; pages without a host share
    one; repeated rows are extracted each; other columns are ignored. A host's
    votes are added up before the shuffle, so a host with a third of all
    pages is no heavier than another one; the paths reach the pages by
    broadcast while they are few, else by a join whose hot hosts Spark splits.
    """

    def vote(batches):
        for batch in batches:
            votes, chars = Counter(), Counter()
            for host, html in zip(batch["host"], batch["html"]):
                if html:
                    best = best_container(parse(html)[0])
                    if best.path and best.text:
                        votes[host, best.path] += 1
                        chars[host, best.path] += best.plain
            if votes:
                yield pd.DataFrame([(*k, n, chars[k]) for k, n in votes.items()], columns=["host", "path", "votes", "chars"])

    def extract(batches):
        for batch in batches:
            texts = []
            for html, path, mean in zip(batch["html"], batch["path"], batch["mean"]):
                root, pieces = parse(html or "")
                found, own = at_path(root, path) if path else [], best_container(root)
                held = sum(x.plain for x in found)
                if not found or held < COMPARABLE * own.plain and held < COMPARABLE * mean:
                    found = [own]
                texts.append(" ".join(filter(None, (text_of(x, pieces) for x in found))))
            yield batch[["page_id", "no_key", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("host", host_of(F.col("url")))
    votes = pages.select("host", "html").mapInPandas(vote, "host string, path string, votes long, chars long").groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("chars").alias("chars"))
    best = votes.groupBy("host").agg(F.max(F.struct("votes", "path", (F.col("chars") / F.col("votes")).alias("mean"))).alias("b"))
    paths = staged(best.select("host", "b.path", "b.mean"), "host-paths")
    paths = sent_if_small(paths, F.octet_length("host") + F.octet_length("path"))
    pages = plain_key(pages.join(paths, "host", "left"), "page_id", "url", "html", "path", "mean")
    return restore_key(pages.mapInPandas(extract, "page_id long, no_key boolean, url string, text string, n_chars long"), "page_id")
