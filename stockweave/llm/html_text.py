"""Main text of web pages by consensus of host paths.

Each page's containers are scored, and the page votes for the generalised tag-class path of
its best one, widened until it holds all running text of the page.  Votes are summed per host
in Spark; pages are then read again and cut at the path of their host that has most votes and
holds all running text of the page.

Parts around an article are known by their element and by the words of their class, id and
role, judged after the whole page is read: none that holds the article, or that is all the
page has, is left out.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.store import stored

# Elements by their role in HTML, and words in class, id and role attributes
# that mark parts around an article.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
CONTAINERS = {
    "html", "body", "div", "article", "section", "main", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "ul", "ol", "dl",
    "nav", "header", "footer", "aside", "form", "fieldset", "center", "details", "dialog", "menu", "figure", "svg", "select",
    "button", "object", "hgroup", "search",
}
LEAVES = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "address", "figcaption", "caption", "summary",
    "legend", "option", "label", "hr",
}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "object", "search"}
NEVER_SHOWN = {"svg", "select", "button", "head"}
ASIDE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "comment",
    "comments", "commentlist", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "outbrain", "pager",
    "pagination", "popup", "promo", "promotion", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "taboola", "toolbar", "topbar", "widget", "complementary",
    "skyscraper", "adsense",
}
# words that are also met in the names of an article's own parts
ASIDE_ALONE = {"banner", "dialog", "header", "notice", "overlay", "related", "replies", "reply", "respond", "search", "alert", "teaser"}
NEGATED = {"with", "has", "no", "not", "without"}
PAGE_TAGS = {"html", "body", "main"}
RUNNING = {"p", "blockquote", "pre"}
LONG_TEXT = 60
#: Steps of a path; containers nested deeper share the path of the one at this depth.
DEEPEST = 200

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"""|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>"""
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>|</?[A-Za-z][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
DIGITS = re.compile(r"\d+")
NAMED = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
MAY_HIDE = re.compile(r"hidden|none", re.I)


@dataclass
class Element:
    """``size`` counts all text, ``good`` that which is no link list and not left out."""

    parent: int
    tag: str
    path: str
    aside: int = 0
    depth: int = 0
    size: int = 0
    good: int = 0
    title: bool = False
    heading: bool = False
    running: bool = False
    holds_article: bool = False
    dropped: bool = False


@dataclass
class Block:
    where: int
    text: str
    title: bool
    heading: bool
    worth: int
    running: bool


def _attributes(rest: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)} if "=" in rest else {}


def _hidden(rest: str) -> bool:
    """Whether a part has the hidden attribute, is hidden from readers, or its own style hides
    it; names in classes and other properties do not count."""
    if not MAY_HIDE.search(rest):
        return False
    values: dict[str, str] = {}
    for name, value in NAMED.findall(rest):
        values.setdefault(name.lower(), value.strip("\"'").strip().lower())
    if values.get("hidden", "until-found") != "until-found" or values.get("aria-hidden") == "true":
        return True
    style = {}
    for part in values.get("style", "").split(";"):
        name, _, value = part.partition(":")
        style[name.strip()] = value.replace("!important", "").strip()
    return style.get("display") == "none" or style.get("visibility") == "hidden"


def _aside(tag: str, rest: str, attributes: dict[str, str]) -> int:
    """3: never shown; 2: a part around an article by its element or by a word; 1: a name that
    such a word is a part of but that may also be the article's."""
    if tag in NEVER_SHOWN or (tag not in PAGE_TAGS and _hidden(rest)):
        return 3
    if tag in PAGE_TAGS:
        return 0
    level = 2 if tag in ASIDE_TAGS else 0
    for key in ("class", "id", "role"):
        for name in attributes.get(key, "").split():
            parts = {p.lower() for p in PART.findall(name)}
            if parts & NEGATED:
                continue
            if parts & ASIDE_WORDS or (len(parts) == 1 and parts & ASIDE_ALONE):
                level = 2
            elif parts & ASIDE_ALONE:
                level = max(level, 1)
    return level


def step_name(tag: str, attributes: dict[str, str]) -> str:
    """A step of a generalised path: tag and sorted classes, digits as #."""
    classes = sorted(set(DIGITS.sub("#", attributes.get("class", "").lower()).split()))
    return ".".join([tag, *classes])


class Page:
    """Blocks of text outside of the parts around an article, and the containers around them."""

    def __init__(self, text: str):
        self.elements = [Element(-1, "", "")]
        self.blocks: list[Block] = []
        stack, names = [0], [""]  # open containers
        buffer: list[str] = []
        leaf, linked, in_link = "", 0, False
        unseen = 0  # open containers that are never shown
        at, size = 0, len(text)

        def flush():
            nonlocal linked
            joined = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if joined:
                # link lists do not speak for a container
                links = linked * 2 > len(joined)
                running = not links and (leaf in RUNNING or len(joined) >= LONG_TEXT)
                self.blocks.append(Block(stack[-1], joined, leaf == "h1", leaf in ("h1", "h2"), 0 if links else len(joined), running))
            linked = 0

        while at < size:
            found = TAG.search(text, at)
            end = found.start() if found else size
            if end > at and not unseen:
                buffer.append(text[at:end])
                linked += (end - at) * in_link
            if not found:
                break
            at = found.end()
            name = found["name"] or found["name2"]
            if not name:
                continue
            tag, closing = name.lower(), bool(found["close"] or found["close2"])
            rest = found["rest"] or found["rest2"] or ""
            if tag in RAW:
                if not closing:
                    stop = re.compile(f"</{tag}\\b[^>]*>", re.I).search(text, at)
                    at = stop.end() if stop else size
                continue
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                buffer.append(" ")
            elif tag in LEAVES:
                flush()
                leaf = "" if closing else tag
            elif tag in CONTAINERS or tag == "head":
                flush()
                leaf = ""
                if not closing and not rest.endswith("/"):
                    attributes = _attributes(rest)
                    parent, level = stack[-1], _aside(tag, rest, attributes)
                    depth, path = self.elements[parent].depth + 1, self.elements[parent].path
                    if depth <= DEEPEST:
                        path = f"{path}/{step_name(tag, attributes)}"
                    self.elements.append(Element(parent, tag, path, level, depth))
                    names.append(tag)
                    stack.append(len(self.elements) - 1)
                    unseen += level == 3
                elif closing and tag in names:
                    while True:
                        unseen -= self.elements[stack.pop()].aside == 3
                        if names.pop() == tag:
                            break
        flush()
        self._judge()

    def _up(self, where: int) -> Iterator[int]:
        while where >= 0:
            yield where
            where = self.elements[where].parent

    def _judge(self) -> None:
        """Which containers are left out, and the text of the others."""
        elements = self.elements
        for block in self.blocks:
            e = elements[block.where]
            e.size += block.worth
            e.heading |= block.heading
            e.running |= block.running
        apart = [False] * len(elements)
        for k, e in enumerate(elements[1:], 1):  # children come after their parents
            apart[k] = apart[e.parent] or e.aside > 1
        plain = sum(b.worth for b in self.blocks if not apart[b.where])
        rest = sum(b.worth for b in self.blocks if b.running and not apart[b.where])
        for e in reversed(elements[1:]):
            over = elements[e.parent]
            over.size += e.size
            over.heading |= e.heading
            over.running |= e.running
            over.holds_article |= e.holds_article or (e.tag in ("article", "main") and not e.aside and e.size > 0)
        inside = [False] * len(elements)
        for k, e in enumerate(elements[1:], 1):
            inside[k] = inside[e.parent] or elements[e.parent].tag in ("article", "main")
            e.dropped = elements[e.parent].dropped or self._leave_out(e, inside[k], rest, plain)
        self.blocks = [b for b in self.blocks if not elements[b.where].dropped]
        for block in self.blocks:
            elements[block.where].good += block.worth
            elements[block.where].title |= block.title
        for e in reversed(elements[1:]):
            elements[e.parent].good += e.good
            elements[e.parent].title |= e.title

    def _leave_out(self, e: Element, inside: bool, rest: int, plain: int) -> bool:
        """``rest`` is the running text, and ``plain`` all text, outside of parts of level 2."""
        if e.aside in (0, 3) or e.holds_article:
            return e.aside == 3
        if e.aside == 1:
            return not e.running or not (inside or 2 * e.size >= plain)
        if e.tag == "header" and inside:
            return not e.heading
        # all running text of the page is in parts like this one: the largest is the article
        return inside or rest > 0 or 2 * e.size < self.elements[0].size

    def best(self) -> int:
        """The page's own best container: an article or main part with half of the text, else
        the innermost container with four fifths of it and with the heading, if one has both;
        widened to hold the first-level headings before it, and all running text if it is not
        an article."""
        total = self.elements[0].good
        where = None
        for tag in ("article", "main"):
            found = [i for i, e in enumerate(self.elements) if e.tag == tag and not e.dropped]
            if found and where is None:
                most = max(found, key=lambda i: (self.elements[i].good, -i))
                if 2 * self.elements[most].good >= total:
                    where = most
        if where is not None:
            own = [b for b in self.blocks if b.title and not self.elements[where].title]
        else:
            large = [i for i, e in enumerate(self.elements) if 5 * e.good >= 4 * total and not e.dropped]
            titled = [i for i in large if self.elements[i].title and self.elements[i].tag not in ("", "html", "body")]
            where = max(titled or large, key=lambda i: (self.elements[i].depth, i))
            own = [b for b in self.blocks if b.running or b.title]
        held = [0] * len(self.elements)
        for block in own:
            held[block.where] += 1
        for k in range(len(held) - 1, 0, -1):
            held[self.elements[k].parent] += held[k]
        return next(k for k in self._up(where) if held[k] == len(own))

    def under(self, chosen: set[int]) -> str:
        below = [k in chosen for k in range(len(self.elements))]
        for k, e in enumerate(self.elements[1:], 1):
            below[k] |= below[e.parent]
        return " ".join(b.text for b in self.blocks if below[b.where])

    def extract(self, paths: list[str]) -> str:
        """Text under the first of the paths that holds the page's own best container, else
        under that one."""
        best = self.best()
        around = set(self._up(best))
        for path in paths:
            chosen = {i for i in around if self.elements[i].path == path}
            if chosen:
                return self.under(chosen)
        return self.under({best})


def read_page(text: str) -> Page:
    return Page(text)


def host(url: Column) -> Column:
    """Lower-case host of a URL column, empty for none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, weight): each page's best path with the length of the text under it, summed
    per host; pages come as (host, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], int] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = read_page(text.as_py())
                best = page.elements[page.best()]
                if best.good:
                    seen[name, best.path] = seen.get((name, best.path), 0) + best.good
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                ["host", "path", "weight"],
            )

    counted = pages.select("host", "html").mapInArrow(run, "host string, path string, weight long")
    return counted.groupBy("host", "path").agg(F.sum("weight").alias("weight"))


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    most_paths: int = 8,
    broadcast_hosts: int = 50_000,
) -> DataFrame:
    """(id, url, text): the main text of every page; empty if there is none.

    A host's ``most_paths`` paths with most votes are tried in that order; a page that none
    of them holds the running text of uses its own best container.  The winners have one row a host; up to
    ``broadcast_hosts`` they are broadcast, beyond it they are joined by host, where the
    adaptive skew join splits a host with very many pages.  A null html counts as empty, a
    null url as the empty host; repeated rows give repeated results.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    order = Window.partitionBy("host").orderBy(F.desc("weight"), "path")
    ranked = votes(rows).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_paths)
    winners = stored(
        ranked.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths")), "paths"
    )
    small = winners.count() <= broadcast_hosts
    joined = rows.join(F.broadcast(winners) if small else winners, "host", "left").select("id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [read_page(t).extract(p or []) for t, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    kinds = dict(rows.dtypes)
    out = joined.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
