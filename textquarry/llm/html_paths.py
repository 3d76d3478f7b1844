"""Main text of web pages by consensus host paths.

Every page scores its containers: text outside links counts for its own container and,
less, for those around it. From the best container the page climbs to those around it as
long as they add running text, so titles, introductions and the paragraphs around a long list
stay. The path of tags and classes to where it ends, with digits generalised, is the page's
vote. Spark counts the votes of each host, and every page is extracted again with the path
that won on its host. The page's own path is used where the host's holds little text, or
lies inside the page's own and leaves out more than a tenth of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import materialize, slices, text_of

# Elements whose content is not text.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "title", "textarea", "select", "button", "object"}
# Elements that hold other blocks and make up paths.
CONTAINERS = {
    "body", "div", "section", "article", "main", "aside", "nav", "header", "footer", "form", "table", "ul", "ol",
    "dl", "figure", "details", "fieldset", "center", "td", "dialog", "menu",
}
# Elements that end a block without holding others.
BREAKS = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "th", "blockquote", "pre", "hr", "address",
    "figcaption", "caption", "summary", "html", "head", "thead", "tbody", "tfoot", "option", "legend",
}
NEVER_MAIN = {"nav", "aside", "footer", "form", "dialog", "menu"}
# Words in a class or an id that tell what is not the article.
NEVER_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "skip",
    "header", "masthead", "topbar", "footer", "copyright", "sidebar", "widget", "related", "recommended",
    "notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "subscribe",
    "subscription", "newsletter", "signup", "login", "comment", "comments", "disqus", "respond", "replies",
    "reply", "share", "sharing", "social", "tags",
}
ALWAYS_TRUSTED = {"body", "main", "article"}

# Containers that are parts of a text, never the whole of it.
PARTS = {"ul", "ol", "dl", "table", "td", "figure", "details", "fieldset", "center"}
# The climb from the best container ends here.
WHOLE = {"article", "main"}

# A share of a container's text also counts for the container around it.
UPWARD = 0.5
# What a container adds to the one inside it is running text if links hold at most this share.
MOST_LINKED = 0.3
# The host's path must hold this share of what the page's own path holds, where the two hold
# different text, and the second share where it lies inside the page's own path.
LEAST_SHARE = 0.25
NEARLY_ALL = 0.9

# Containers nested deeper than this count for the one at this depth.
DEEPEST = 100

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Block:
    path: int
    text: str
    link_chars: int


@dataclass
class Page:
    """The blocks of a page in order, and the container paths they lie in."""

    paths: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """A container's step in the path, and whether it can't be main text."""
    names: list[str] = []
    never = tag in NEVER_MAIN
    for name, *values in _NAMES.findall(attributes) if attributes.strip() else ():
        value = "".join(values).lower()
        if name.lower() == "hidden" or name.lower() == "aria-hidden" and value == "true":
            never = True
        elif name.lower() == "role":
            never |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
        else:
            if name.lower() == "class":
                names += sorted(_DIGITS.sub("#", value).split())
            if tag not in ALWAYS_TRUSTED:
                never |= not NEVER_WORDS.isdisjoint(_WORDS.findall(value))
    return ".".join([tag, *names]), never


def parse(html: str) -> Page:
    """Split a page into blocks of decoded text with single blanks, excluded parts left out.

    The text of unclosed, crossed and cut-off elements is kept; a tag cut off by the end
    of the page is dropped.
    """
    page = Page()
    known: dict[str, int] = {}
    # Tag, path number, excluded or not, inside an article or not.
    stack: list[tuple[str, int, bool, bool]] = []
    pieces: list[str] = []
    links, in_link = 0, False

    def path_of(label: str) -> int:
        above = stack[-1][1] if stack else -1
        if len(stack) > DEEPEST:
            return above
        full = f"{page.paths[above]}>{label}" if above >= 0 else label
        if full not in known:
            known[full] = len(page.paths)
            page.paths.append(full)
            page.parents.append(above)
        return known[full]

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not (stack and stack[-1][2]):
                where = stack[-1][1] if stack else path_of("body")
                page.blocks.append(Block(where, text, links))
            pieces.clear()
        links = 0

    at, end = 0, len(html)
    while at < end:
        tag_at = html.find("<", at)
        if tag_at < 0:
            tag_at = end
        if tag_at > at:
            text = unescape(html[at:tag_at])
            pieces.append(text)
            if in_link:
                links += len(text)
        if tag_at == end:
            break
        if html.startswith("<!--", tag_at):
            close = html.find("-->", tag_at + 4)
            at = end if close < 0 else close + 3
            continue
        following = html[tag_at + 1 : tag_at + 2]
        if following in ("!", "?"):
            close = html.find(">", tag_at)
            at = end if close < 0 else close + 1
            continue
        if not (following == "/" or following.isascii() and following.isalpha()):
            pieces.append("<")
            at = tag_at + 1
            continue
        if html.find(">", tag_at) < 0:  # cut off
            break
        m = _TAG.match(html, tag_at) or _LOOSE_TAG.match(html, tag_at)
        if m is None:
            at = html.find(">", tag_at) + 1
            continue
        at = m.end()
        closing, tag, attributes = m[1] == "/", m[2].lower(), m[3]
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        elif tag in BREAKS:
            flush()
        elif tag in CONTAINERS:
            flush()
            in_link = False
            if not closing:
                label, never = _label(tag, attributes)
                in_article = bool(stack) and stack[-1][3]
                # A header inside the article holds its title.
                never |= tag == "header" and not in_article
                never |= bool(stack) and stack[-1][2]
                stack.append((tag, path_of(label), never, in_article or tag in ("article", "main")))
            else:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        del stack[depth:]
                        break
    flush()
    return page


def _up(page: Page, own: list[float], share: float = 1.0) -> list[float]:
    """What each path holds with a share of what lies below it."""
    total = own[:]
    for path in range(len(own) - 1, -1, -1):  # a path comes after those it lies in
        if page.parents[path] >= 0:
            total[page.parents[path]] += share * total[path]
    return total


def _climb(page: Page, start: int, chars: list[float], linked: list[float]) -> int:
    """The last path around ``start`` that adds running text, at most an article or main part.

    The whole body is taken only for a list or table that lies in it directly.
    """
    tags = [path.rsplit(">", 1)[-1].split(".", 1)[0] for path in page.paths]
    found = at = start
    while page.parents[at] >= 0 and tags[at] not in WHOLE:
        up = page.parents[at]
        if tags[up] == "body" and tags[at] not in PARTS:
            break
        added = chars[up] - chars[at]
        if linked[up] - linked[at] > MOST_LINKED * added:
            break
        if added:
            found = up
        at = up
    return found


def best_path(page: Page) -> int:
    """The number of the container path of the article; -1 for a page without text.

    Of equal scores the deeper, then the earlier path wins.
    """
    if not page.blocks:
        return -1
    chars, linked = [0.0] * len(page.paths), [0.0] * len(page.paths)
    for block in page.blocks:
        chars[block.path] += len(block.text)
        linked[block.path] += min(block.link_chars, len(block.text))
    score = _up(page, [c - k for c, k in zip(chars, linked)], UPWARD)
    best = max(range(len(score)), key=lambda p: (score[p], page.paths[p].count(">"), -p))
    return _climb(page, best, _up(page, chars), _up(page, linked))


def text_below(page: Page, path: str | None) -> list[str]:
    if path is None:
        return []
    below = [p == path or p.startswith(path + ">") for p in page.paths]
    return [b.text for b in page.blocks if below[b.path]]


def article_of(page: Page, agreed: str | None) -> list[str]:
    """The blocks of a page's article, given the path its host agreed on."""
    best = best_path(page)
    if best < 0:
        return []
    own, by_host = text_below(page, page.paths[best]), text_below(page, agreed)
    inside = agreed is not None and agreed.startswith(page.paths[best] + ">")
    share = NEARLY_ALL if inside else LEAST_SHARE
    return by_host if by_host and sum(map(len, by_host)) >= share * sum(map(len, own)) else own


def host_of(url: str) -> Column:
    """The lower-case host of a URL column; NULL if it has none."""
    host = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, path``: the container path with the most votes on each host (ties: by name)."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            paths = []
            for html in part.column(1).to_pylist():
                page = parse(html)
                best = best_path(page)
                paths.append(page.paths[best] if best >= 0 else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(paths, pa.string())], names=["host", "path"]
            )

    votes = (
        pages.select(host_of(url_col).alias("host"), text_of(html_col).alias("html"))
        .where(F.col("host").isNotNull())
        .mapInArrow(vote, "host string, path string")
        .where(F.col("path").isNotNull())
        .groupBy("host", "path")
        .count()
    )
    return votes.groupBy("host").agg(F.max_by("path", F.struct("count", "path")).alias("path"))


def extract_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    broadcast_hosts: int = 200_000,
) -> DataFrame:
    """``page_id, url, text`` for every row; the text is empty if the page has none.

    A page without a host, or with a NULL or empty html, goes by its own best path. Repeated
    rows vote and are returned as often as they occur; an empty table gives no rows.
    """
    winners = materialize(host_paths(pages, url_col, html_col).withColumnRenamed("host", "_host"), "host-paths")
    if winners.count() <= broadcast_hosts:
        winners = F.broadcast(winners)
    source = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        text_of(html_col).alias("html"),
        host_of(url_col).alias("_key"),
    ).join(winners, F.col("_key") == F.col("_host"), "left")
    schema = T.StructType(
        [source.schema["page_id"], source.schema["url"], T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = []
            for html, path in zip(part.column("html").to_pylist(), part.column("path").to_pylist()):
                texts.append("\n\n".join(article_of(parse(html), path)))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=schema.names
            )

    return source.select("page_id", "url", "html", "path").mapInArrow(run, schema)
