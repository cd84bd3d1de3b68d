"""Main text of web pages by consensus paths of hosts.

1. *Score.*  Every page is read into its tree of elements and the text blocks
   in it.  A container (article, section, div, td, ...) gets the characters of
   the blocks that it owns, links left out, and half of what its child
   containers get; an article or main element counts threefold.  The page's
   best container, or the article or main element around it, is its candidate.
2. *Vote.*  A candidate's generalised path (tags, and classes without their
   digits, below the body) gets the page's vote.  Spark adds the votes up by
   host; a path with at least ``share`` of its host's votes wins, most first.
3. *Re-extract.*  Every page is read again.  Its own candidate stands where its
   path has won; else the most voted winning path that has text in the page is
   taken, and only without one the page's own candidate.  All containers of
   that path give their blocks, in page order.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments of readers are found by tag, role, class and id, and belong to no
block.  Character references are decoded, white space inside a block becomes
one space, blocks are joined by one space.

Votes are combined in the mappers, so a host of any size costs a few rows a
task; the winners (some paths a host) meet the pages by a broadcast when they
are small, else by a join whose large partitions Spark splits.

Defined results: null, empty and text-free pages give an empty text; a null or
hostless url votes with the host ''; repeated pages vote each for itself; equal
votes go by the path; unclosed, misnested and cut-off tags are closed as
browsers do it, a cut-off tag, comment or script ends the page; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices, stored
from .linking import small

# --- Fixed values: elements by their part in a page ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag; none of it is an article's.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD = frozenset("base link meta noscript script style template title".split())
CONTAINERS = frozenset("article main section div td th center dd li blockquote figure details".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside body caption dialog dir dl dt fieldset figcaption footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "menu nav ol optgroup option p pre search select summary table tbody tfoot thead tr ul".split())
LEFT_OUT_TAGS = RAW | frozenset(
    "nav header footer aside form search template object svg canvas audio video button select option input head menu dialog".split())
LEFT_OUT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Words of a class or id that mark something beside the article, and words that mark it as a part of another word too.
LEFT_OUT_WORDS = frozenset(
    "ad ads adv adsense banner copyright consent disqus footer gdpr hidden login masthead menu menubar modal nav navbar "
    "navigation notice notices overlay pager pagination popup promo promoted promotion recommended related replies reply "
    "respond share sharing signup social sponsor sponsored subscribe toolbar widget widgets".split())
LEFT_OUT_STEMS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar")
LEFT_OUT_NAMES = frozenset("header siteheader pageheader topheader mainheader globalheader".split())
#: Classes that only tell what else the page has.
TELLING = ("has-", "with-", "without-", "no-", "has_", "with_", "without_", "no_")
#: The open elements that a start tag ends, and those beyond which it does not look.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"})}
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
# ------------------------------------------------------

TAG = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: A longer path is named by its digest.
LONG_PATH = 400


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """("text", raw text, None), ("start", tag, attributes) and ("end", tag, None) in page order.

    Comments, declarations and the content of raw elements are passed over.  A
    tag, comment or raw element that the page cuts off ends it.
    """
    at = 0
    while (open_ := page.find("<", at)) >= 0:
        if open_ > at:
            yield "text", page[at:open_], None
        after = page[open_ + 1:open_ + 2]
        tag = TAG.match(page, open_ + (2 if after == "/" else 1))
        if page.startswith("<!--", open_):
            end = page.find("-->", open_ + 2)
            at = end + 3
        elif tag is None and after not in ("!", "?", "/"):
            yield "text", "<", None
            at = open_ + 1
            continue
        elif tag is None or after == "/":
            end = page.find(">", open_)
            at = end + 1
            if tag is not None and end >= 0:
                yield "end", tag.group().lower(), None
        else:
            name, attributes, end = tag.group().lower(), {}, tag.end()
            while (a := ATTRIBUTE.match(page, end)) is not None:
                value = a.group(2) or ""
                quoted = len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]
                attributes.setdefault(a.group(1).lower(), html.unescape(value[1:-1] if quoted else value))
                end = a.end()
            end = page.find(">", end)
            at = end + 1
            if end >= 0:
                yield "start", name, attributes
                if name in RAW:
                    close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                    end = page.find(">", close.end()) if close else -1
                    at = end + 1
                    if end >= 0:
                        yield "end", name, None
        if end < 0:
            return
    if at < len(page):
        yield "text", page[at:], None


def left_out(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element stands beside the article: by tag, role, class or id."""
    if tag in LEFT_OUT_TAGS:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "").lower()):
        return True
    if attributes.get("role", "").strip().lower() in LEFT_OUT_ROLES:
        return True
    whole = tag in ("article", "main")  # only where a class says nothing else
    for name in attributes.get("class", "").split() + attributes.get("id", "").split():
        if name.lower().startswith(TELLING):
            continue
        words = [w.lower() for w in WORD.findall(name)]
        joined = "".join(words)
        if joined in LEFT_OUT_NAMES or joined in LEFT_OUT_WORDS or joined.startswith(LEFT_OUT_STEMS):
            return True
        if not whole and any(w in LEFT_OUT_WORDS for w in words):
            return True
        if not whole and any(s in joined for s in LEFT_OUT_STEMS):
            return True
    return False


def label(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes, without digits."""
    classes = {re.sub(r"[0-9]+", "", c).strip("-_") for c in attributes.get("class", "").split()}
    return ".".join([tag, *sorted(c for c in classes if c)])


@dataclass
class Container:
    tag: str
    path: str
    parent: int
    chars: int = 0  # of its own blocks, links left out


@dataclass
class Page:
    """Containers (the first is the body; parents come before children) and blocks (container, text) in page order."""

    containers: list[Container] = field(default_factory=lambda: [Container("body", "", -1)])
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def totals(self) -> tuple[list[int], list[float]]:
        """Characters within each container, and its score."""
        inside = [c.chars for c in self.containers]
        score = [float(c.chars) for c in self.containers]
        for i in range(len(self.containers) - 1, 0, -1):
            up = self.containers[i].parent
            inside[up] += inside[i]
            score[up] += 0.5 * score[i]
        return inside, [s * (3 if c.tag in ("article", "main") else 1) for s, c in zip(score, self.containers, strict=True)]

    def candidate(self) -> str | None:
        """The path of the best container, widened to the article around it; None in a page without text."""
        if not self.blocks:
            return None
        inside, score = self.totals()
        best = max(range(len(score)), key=lambda i: (score[i], -i))
        for kind in ("article", "main"):
            at = best
            while at > 0 and self.containers[at].tag != kind:
                at = self.containers[at].parent
            if at > 0:
                return self.containers[at].path
        # Without such an element: containers that add little (a heading, a date) belong to it.
        while (up := self.containers[best].parent) > 0 and inside[best] >= 0.8 * inside[up]:
            best = up
        return self.containers[best].path

    def text(self, path: str) -> str:
        """The blocks of all containers of that path."""
        within: list[bool] = []
        for c in self.containers:
            within.append(c.path == path or (c.parent >= 0 and within[c.parent]))
        return " ".join(text for owner, text in self.blocks if within[owner])


def read_page(source: str) -> Page:
    """One pass over the tags with a stack of the open elements: (tag, container, left out, link)."""
    page = Page()
    stack: list[tuple[str, int, bool, bool]] = [("body", 0, False, False)]
    opened: Counter[str] = Counter()
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            owner = stack[-1][1]
            page.blocks.append((owner, text))
            page.containers[owner].chars += max(0, len(text) - linked)
        held.clear()
        linked = 0

    def close(to: int) -> None:
        """End the open elements from place ``to`` on, each block with its own text."""
        while len(stack) > to:
            if stack[-1][0] in BLOCKS:
                flush()
            opened[stack.pop()[0]] -= 1

    def find(names, beyond) -> int:
        if not any(opened[n] for n in names):
            return 0
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in names:
                return at
            if stack[at][0] in beyond:
                return 0
        return 0

    for kind, what, attributes in tokens(source):
        if kind == "text":
            if stack[-1][0] == "head" and what.strip():
                close(len(stack) - 1)
            if not stack[-1][2]:
                text = html.unescape(what)
                held.append(text)
                if stack[-1][3]:
                    linked += len(text.strip())
        elif kind == "end":
            if what == "p":
                at = find(("p",), ())
            elif what in BLOCKS:
                at = find((what,), () if what in TABLE else ("td", "th", "table"))
            else:
                at = find((what,), BLOCKS)
            if what == "br":
                held.append(" ")
            elif at:
                close(at)
        elif what in ("html", "body"):
            if stack[-1][0] == "head":
                close(len(stack) - 1)
        elif what == "br":
            held.append(" ")
        elif what in VOID:
            if what == "hr":
                flush()
        else:
            if stack[-1][0] == "head" and what not in HEAD:
                close(len(stack) - 1)
            if what in BLOCKS:
                if at := find(("p",), ()):
                    close(at)
                names, beyond = ENDS.get(what, ((), ()))
                if names and (at := find(names, beyond)):
                    close(at)
                flush()
            _, owner, out, link = stack[-1]
            out = out or left_out(what, attributes)
            if what in CONTAINERS and not out:
                path = f"{page.containers[owner].path}/{label(what, attributes)}"
                if len(path) > LONG_PATH:
                    path = "#" + hashlib.sha256(path.encode("utf-8", "replace")).hexdigest()
                page.containers.append(Container(what, path, owner))
                owner = len(page.containers) - 1
            stack.append((what, owner, out, link or what == "a"))
            opened[what] += 1
    close(1)
    flush()
    return page


def main_text(source: str, winners: list[str]) -> str:
    """The text of the page's own candidate where it has won, else of the first winner with text, else of the candidate."""
    page = read_page(source)
    own = page.candidate()
    if own is None:
        return ""
    if own not in winners:
        for path in winners:
            if text := page.text(path):
                return text
    return page.text(own)


def host(url: str) -> Column:
    """The host of a url, in small letters; '' without one."""
    found = F.regexp_extract(F.lower(F.col(url).cast("string")), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 500):
        cast = [(h, read_page(s).candidate()) for h, s in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True)]
        cast = [(h, p) for h, p in cast if p is not None]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in cast], pa.string()),
                                          pa.array([p for _, p in cast], pa.string())], ["host", "path"])


def winning_paths(read: DataFrame, share: float) -> DataFrame:
    """(host, winners): the paths with at least ``share`` of the host's votes, most voted first."""
    cast = stored(read.select("host", "html").mapInArrow(votes, "host string, path string").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes")), "votes")
    total = cast.groupBy("host").agg(F.sum("votes").alias("total"))
    won = cast.join(total, "host").filter(F.col("votes") >= F.lit(share) * F.col("total"))
    best_first = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path")))  # 1 / share at most
    return stored(won.groupBy("host").agg(F.transform(best_first, lambda x: x["path"]).alias("winners")), "winners")


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                  share: float = 0.1) -> DataFrame:
    """One row a page: its id, url, main text and the text's length in code points."""
    ship_package(pages.sparkSession)
    read = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), host(url_column).alias("host"),
                        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in read.schema.fields}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            texts = [main_text(s, w or []) for s, w in zip(b.column("html").to_pylist(), b.column("winners").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    met = read.join(small(winning_paths(read, share)), "host", "left")
    found = met.select("id", "url", "html", "winners").mapInArrow(
        extract, f"id {kinds['id']}, url {kinds['url']}, text string")
    return found.select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text",
                        F.length("text").cast("long").alias("n_chars"))
