"""Main text of pages by host-wide consensus on the container that holds it (operator 9).

Each page scores its containers by the text of their blocks that is not linked;
the container that holds the best one's whole article votes for its path: tags
and classes from the body down, digits generalised. The path with most votes of
a host wins, and all pages of the host are read again through it. A page without
that path, or without text under it, is read through its own best container. What tags or class words mark as
something else has no text, unless words alone would drop the page's main part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored

# HTML's elements by what they mean for text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table "
    "tbody tfoot thead tr ul caption menu dialog".split())
CONTAINERS = frozenset("article body center div main section table td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head script style noscript template textarea select button svg iframe object canvas audio "
    "video nav footer aside form dialog menu map title".split())
# The only elements that a head holds; another one, or text, ends a head whose end tag is missing.
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
RAW = frozenset("script style noscript template textarea iframe title".split())
# Elements that end when one of their kind, or any block for p, begins.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th")}
SCOPE = frozenset("article aside body div main nav ol section table td th ul dl blockquote".split())
# Words of class names, ids and roles that mark other things than the article.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup sidebar rail "
    "widget menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus "
    "replies respond share sharing social related recommended pagination pager login search toolbar "
    "contentinfo complementary alert".split())
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
HEADER_WORDS = frozenset(("header", "topbar"))
EXEMPT = frozenset(("html", "body", "main"))

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
DIGITS = re.compile(r"\d+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass
class Element:
    """An open element."""

    name: str
    container: int
    other: bool
    link: bool
    article: int  # the innermost open article or main, -1 outside
    mark: int  # the innermost element around that class words mark, -1 outside


@dataclass
class Mark:
    """An element that class, id or role words mark as something else than the article."""

    parent: int
    comments: bool
    around: frozenset[int]
    chars: int = 0
    articles: int = 0


@dataclass
class Page:
    """Containers (path, parent, score, linked and all characters) and blocks of a page.

    ``content`` are the characters of blocks that are mostly not linked.
    """

    paths: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    scores: list[float] = field(default_factory=lambda: [0.0])
    linked: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])
    content: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def add_block(self, container: int, text: str, linked: int) -> None:
        """A block's unlinked text counts fully for its container, less further up."""
        self.blocks.append((container, text))
        own, share = max(0, len(text) - linked), 1.0
        content = len(text) if own > linked else 0
        while container >= 0:
            self.scores[container] += own * share
            self.chars[container] += len(text)
            self.linked[container] += linked
            self.content[container] += content
            share *= 0.5
            container = self.parents[container]

    def name(self, at: int) -> str:
        """Tag of a container."""
        return self.paths[at].rpartition(">")[2].partition(".")[0]

    def whole(self, at: int) -> int:
        """The container of the whole article of which ``at`` is a part.

        That is the outermost article or main around it. Without one it is the
        highest container that adds text outside links; the body adds only what
        lies in it directly and, to a section, other sections.
        """
        above = [at]
        while above[-1] > 0:
            above.append(self.parents[above[-1]])
        for i in reversed(above):
            if self.name(i) in ("article", "main"):
                return i
        for i, parent in zip(above, above[1:]):
            if parent:
                adds = self.content[parent] > self.content[i]
            else:
                adds = self.content[0] > sum(
                    self.content[j] for j in range(1, len(self.paths)) if not self.parents[j]
                    and not (self.name(i) == "section" == self.name(j) and i != j))
            if adds:
                at = parent
        return at

    def best(self) -> tuple[str, int]:
        """Path of the best container's whole article, and the container's score; of equals the first."""
        score, at = -1.0, 0
        for i, value in enumerate(self.scores):
            weight = 1.5 if self.name(i) in ("article", "main") else 1.0
            value *= weight * (1 - self.linked[i] / self.chars[i]) if self.chars[i] else 0
            if value > score:
                score, at = value, i
        return self.paths[self.whole(at)], round(score)

    def text(self, path: str) -> str:
        """Blocks of the whole articles of all containers of the path, in page order."""
        roots = {self.whole(i) for i, own in enumerate(self.paths) if own == path}
        inside: list[bool] = []
        for i, parent in enumerate(self.parents):
            inside.append(i in roots or parent >= 0 and inside[parent])
        return "\n".join(text for container, text in self.blocks if inside[container])


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name."""
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def is_other(name: str, given: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds something else than the article."""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not given or name in EXEMPT:
        return False
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get(
            "style", "").replace(" ", ""):
        return True
    return False


def marked_by(name: str, given: dict[str, str], in_article: bool) -> str:
    """The word of class, id or role that marks an element as something else, or ''."""
    if not given or name in EXEMPT:
        return ""
    for label in f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".split():
        words = [w.lower() for w in WORD.findall(label)]
        if not words or words[0] in ("has", "with", "no"):
            continue
        for word in (words[0], words[-1]):
            if word in OTHER_WORDS:
                return word
        if not in_article and len(words) < 3 and words[-1] in HEADER_WORDS and words[0] not in (
                "article", "entry", "post", "content"):
            return words[-1]
    return ""


Piece = tuple[str, bool, int]  # text, whether it is linked, its mark


def dropped_marks(marks: list[Mark], blocks: list[tuple[int, int, list[Piece]]]) -> list[bool]:
    """For each mark whether its text goes; the last value is that of no mark.

    Words do not decide over what the page is about: an element goes not if the
    page has no text in another article or main and the element holds one, or
    most of the unlinked text that is not comments. An element of comments stays
    only for one article or a main. If nothing were left, nothing goes.
    """
    total, texted = 0, set()
    for _, article, pieces in blocks:
        for piece, link, mark in pieces:
            size = 0 if link else len(piece.strip())
            if not size:
                continue
            comments = False
            if mark < 0 <= article:
                texted.add(article)
            while mark >= 0:
                comments |= marks[mark].comments
                marks[mark].chars += size if marks[mark].comments or not comments else 0
                mark = marks[mark].parent
            total += 0 if comments else size

    def going(stays: list[bool]) -> list[bool]:
        gone: list[bool] = []
        for mark, own in zip(marks, stays):
            gone.append(not own or mark.parent >= 0 and gone[mark.parent])
        return [*gone, False]

    holds = [mark.chars > 0 and not texted - mark.around and (
        mark.articles == 1 if mark.comments else mark.articles > 0) for mark in marks]
    gone = going(holds)
    texted |= {article for _, article, pieces in blocks if article >= 0 and any(
        not link and not gone[mark] and piece.strip() for piece, link, mark in pieces)}
    gone = going([own or not mark.comments and not texted - mark.around and 2 * mark.chars > total
                  for own, mark in zip(holds, marks)])
    if all(gone[mark] or not piece.strip() for _, _, pieces in blocks for piece, _, mark in pieces):
        gone = [False] * len(gone)
    return gone


def read_page(source: str) -> Page:
    """Containers and blocks of a page; unclosed and misplaced tags are tolerated."""
    page, stack = Page(), [Element("#", 0, False, False, -1, -1)]
    blocks: list[tuple[int, int, list[Piece]]] = []
    marks: list[Mark] = []
    parts: list[Piece] = []
    container, article, articles, at = 0, -1, 0, 0

    def flush() -> None:
        nonlocal parts
        if parts:
            blocks.append((container, article, parts))
            parts = []

    def close(names: tuple[str, ...], scope: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                del stack[i:]
                return
            if stack[i].name in scope:
                return

    end = len(source)
    while at < end:
        found = TAG.search(source, at)
        stop = found.start() if found else end
        if stop > at and stack[-1].name == "head" and not source[at:stop].isspace():
            stack.pop()
        if stop > at and not stack[-1].other:
            piece, top = source[at:stop], stack[-1]
            if "&" in piece:
                piece = html.unescape(piece)
            if not parts:
                container, article = top.container, top.article
            parts.append((piece, top.link, top.mark))
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA[") and not stack[-1].other:
                if not parts:
                    container, article = stack[-1].container, stack[-1].article
                parts.append((found[0][9:-3], False, stack[-1].mark))
            continue
        if name in BLOCKS:
            flush()
        elif parts and name in ("br", "td", "th"):
            parts.append((" ", False, stack[-1].mark))
        if found[1] or found[4]:
            close((name,), frozenset() if name in SCOPE else SCOPE)
            continue
        if stack[-1].name == "head" and name not in HEAD_ONLY:
            stack.pop()
        if name in VOID:
            continue
        if name in RAW:
            ending = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
            at = ending.end() if ending else end
            continue
        if name in BLOCKS:
            close(("p", "h1", "h2", "h3", "h4", "h5", "h6") if name != "p" else ("p",), SCOPE)
        if name in ENDS:
            close(ENDS[name], SCOPE - {"td", "th"})
        above = stack[-1]
        text = found[3] or found[6] or ""
        given = attributes(text) if text.strip(" /") else {}
        other = above.other or is_other(name, given, above.article >= 0)
        word = "" if other else marked_by(name, given, above.article >= 0)
        mark, within = above.mark, above.article
        if word:
            marks.append(Mark(mark, word in COMMENT_WORDS, frozenset(
                x.article for x in stack if x.article >= 0)))
            mark = len(marks) - 1
        if name in ("article", "main") and not other:
            within, articles = articles, articles + 1
            i = above.mark
            while i >= 0:
                marks[i].articles += 1
                i = marks[i].parent
        inside = above.container
        if name in CONTAINERS and not other and name != "body":
            classes = sorted(DIGITS.sub("#", given.get("class", "")).split())
            page.paths.append(".".join([f"{page.paths[inside]}>{name}", *classes]))
            page.parents.append(inside)
            page.scores.append(0.0)
            page.linked.append(0)
            page.chars.append(0)
            page.content.append(0)
            inside = len(page.paths) - 1
        stack.append(Element(name, inside, other, above.link or name == "a", within, mark))
    flush()
    gone = dropped_marks(marks, blocks) if marks else [False]
    for container, _, pieces in blocks:
        text = " ".join("".join([x for x, _, mark in pieces if not gone[mark]]).split())
        if text:
            linked = sum(len(x) for x, link, mark in pieces if link and not gone[mark])
            page.add_block(container, text, min(linked, len(text)))
    return page


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [read_page(x).best() if x else ("body", 0) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([f[0] for f in found], pa.string()),
            pa.array([f[1] for f in found], pa.int64())], ["host", "path", "score"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path most pages of a host vote for; ties to the larger score, then path."""
    votes = (pages.select("host", "html").mapInArrow(_votes, "host string, path string, score long")
             .where("score > 0").groupBy("host", "path")
             .agg(F.count("*").alias("votes"), F.sum("score").alias("score")))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("_best")).select(
        "host", F.col("_best.path").alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of (page_id, url, html).

    Null, empty or text-free html gives ''. Pages with a null or odd url share the
    host ''. Repeated rows stay; other columns are ignored; an empty table gives
    an empty one. Host votes combine map-side; hosts meet their pages in a join
    that adaptive execution broadcasts when the paths are few and splits when one
    host is large.
    """
    key = pages.schema["page_id"].dataType.simpleString()
    given = pages.select("page_id", "url", "html", F.lower(F.coalesce(
        F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))
    paths = stored(host_paths(given), "host-paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                page = read_page(source or "")
                texts.append((path and page.text(path)) or page.text(page.best()[0]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    return (given.join(paths, "host", "left").select("page_id", "url", "html", "path")
            .mapInArrow(run, f"page_id {key}, url string, text string"))


def page_texts(pages: DataFrame) -> DataFrame:
    """Contract columns of the extraction query."""
    return extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))
