"""Main text of web pages, by what the pages of a host have in common.

Each page scores its containers by the running text right below them. The best
of a page vote for their paths: tags and classes from the root, with digits
made equal, so that pages of one template vote alike. Spark sums the votes of
a host, and every page is extracted anew from the containers on its host's
winning path. A page without such a container falls back on its own best one.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written

# Hosts with their paths that go to every task; more are joined by a shuffle.
BROADCAST_HOSTS = 100_000
VOTES = 3  # containers a page votes for

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(noscript|template|iframe|svg|math|select|button|object|audio|video|canvas)(?=[\s/>])"
    r"(?:(?:[^<>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>"
    r"|<[!?/][^>]*>|<[a-zA-Z/!?][^<>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul caption head".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED = frozenset("head nav footer aside form menu dialog search fieldset label input".split())
# Open elements that a new one of the first kind ends.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|masthead|site-?header|page-?header|topbar|"
    r"footer|contentinfo|sidebar|side|aside|complementary|ad|ads|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|"
    r"comments?|commentlist|disqus|respond|replies|share|sharing|social|related|recommend\w*|newsletter|subscribe|"
    r"signup|login|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|pagination|pager|search|form|hidden)(?:$|[\s_-])",
    re.I,
)
# Names that speak of such a part without being one, as "no-sidebar", "has-comments" and "ad-free".
_SPOKEN_OF = re.compile(
    r"(?:^|[_-])(?:no|not|non|without|with|has|have|hide|hides|hidden-by|show|shows|is)(?:[_-]|$)"
    r"|[_-](?:free|open|opened|closed|enabled|disabled|on|off|allowed|less)$",
    re.I,
)
_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
_MAIN = re.compile(r"article|content|main|post|entry|story|body|text", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())


@dataclass
class Node:
    tag: str
    key: str
    parent: int
    noise: bool  # this element or one around it is not part of any article
    marks: str
    inside_header: bool
    by_name: bool = False  # noise by its own class or id alone
    checksum: int = 0  # of the path
    end: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links

    def path(self, node: int) -> str:
        keys = []
        while node > 0:
            keys.append(self.nodes[node].key)
            node = self.nodes[node].parent
        return "/".join(reversed(keys))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _named_noise(marks: str) -> bool:
    return any(_NOISE.search(name) and not _SPOKEN_OF.search(name) for name in marks.split())


def _node(tag: str, attributes: str, parent: int, around: Node, spared: bool) -> Node:
    """``spared``: the element is part of the page whatever its class and id say."""
    found = _attributes(attributes) if attributes and attributes.strip() else {}
    classes = found.get("class", "")
    marks = f"{classes} {found.get('id', '')}"
    noise = (
        around.noise
        or tag in _DROPPED
        or found.get("role", "").lower() in _ROLES
        or found.get("aria-hidden") == "true"
        or bool(found) and (re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes) is not None)
        or "display:none" in found.get("style", "").replace(" ", "").lower()
    )
    by_name = not noise and not spared and tag not in ("html", "body", "article", "main") and _named_noise(marks)
    header = around.inside_header or tag == "header" or tag not in _HEADINGS and _HEADER.search(marks) is not None
    names = sorted(re.sub(r"\d+", "#", html.unescape(classes)).split())
    key = ".".join([tag, *names])
    checksum = zlib.crc32(f"/{key}".encode(), around.checksum)
    return Node(tag, key, parent, noise or by_name, marks, header, by_name, checksum)


def parsed(source: str) -> Page:
    """Elements in page order, and the blocks of text that are part of no menu, advert and the like.

    Class names alone do not empty a page: if no text is left, those around an article are not believed.
    """
    page = _parsed(source, frozenset())
    if page.blocks or not any(node.by_name for node in page.nodes):
        return page
    around: set[int] = set()
    for i, node in enumerate(page.nodes):
        if node.tag in ("article", "main"):
            while i > 0 and i not in around:
                around.add(i)
                i = page.nodes[i].parent
    return _parsed(source, frozenset(around)) if around else page


def _parsed(source: str, spared: frozenset[int]) -> Page:
    page = Page([Node("", "", -1, False, "", False)])
    stack, pieces, links = [0], [], [0, 0]  # links: open ones, characters in them
    # Where in the stack elements of a tag are open, and blocks and headings of any tag.
    opened: dict[str, list[int]] = defaultdict(list)
    blocks, headings = [], []
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append((stack[-1], text, links[1]))
            pieces.clear()
            links[1] = 0

    def say(text: str) -> None:
        node = page.nodes[stack[-1]]
        if node.noise or not text:
            return
        if node.inside_header and not headings:
            return
        text = html.unescape(text) if "&" in text else text
        pieces.append(text)
        if links[0]:
            links[1] += len(text.strip())

    def push(node: int) -> None:
        tag = page.nodes[node].tag
        opened[tag].append(len(stack))
        if tag in _BLOCK:
            blocks.append(len(stack))
        if tag in _HEADINGS:
            headings.append(len(stack))
        stack.append(node)
        links[0] += tag == "a"

    def close(count: int) -> None:
        while len(stack) > max(count, 1):
            node = page.nodes[stack.pop()]
            node.end = len(page.nodes)
            opened[node.tag].pop()
            if node.tag in _BLOCK:
                blocks.pop()
            if node.tag in _HEADINGS:
                headings.pop()
            links[0] -= node.tag == "a"

    def open_tags(names: tuple[str, ...], until: tuple[str, ...]) -> int | None:
        """Place of the innermost open element of some tags, if none of others is open within it."""
        last = max((opened[name][-1] for name in names if opened[name]), default=None)
        if last is None or any(opened[name] and opened[name][-1] > last for name in until):
            return None
        return last

    def after(tag: str) -> int:
        """Where the element that begins before ``at`` ends: without an end it is empty."""
        if ends.get(tag, -1) < at:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            ends[tag] = end.end() if end else len(source) + 1
        return ends[tag] if ends[tag] <= len(source) else at

    ends: dict[str, int] = {}
    while token := _TOKEN.search(source, at):
        say(source[at : token.start()])
        at = token.end()
        if token[2]:
            say(" ")
            if not token[0].endswith("/>"):
                at = after(token[2].lower())
            continue
        tag = (token[4] or "").lower()
        if not tag:
            if token[1]:
                say(" ")
            continue
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            say(" ")
        if token[3]:
            count = open_tags((tag,), ())
            if count is not None:
                if tag not in _BLOCK and blocks and blocks[-1] >= count:
                    continue  # a stray end of an inline element ends no block
                close(count)
            continue
        if tag in _BLOCK:
            count = open_tags(("p",), ("table", "td", "div", "article", "section", "body"))
            if count is not None:
                close(count)
        if tag in _ENDS:
            count = open_tags(_ENDS[tag], ("ul", "ol", "dl", "table"))
            if count is not None:
                close(count)
        parent = stack[-1]
        page.nodes.append(_node(tag, token[5], parent, page.nodes[parent], len(page.nodes) in spared))
        if tag in _VOID or (token[5] or "").endswith("/"):
            page.nodes[-1].end = len(page.nodes)
        else:
            push(len(page.nodes) - 1)
    say(source[at:])
    flush()
    close(0)
    page.nodes[0].end = len(page.nodes)
    return page


def _bonus(node: Node) -> float:
    if node.tag in ("article", "main"):
        return 1.5
    if node.tag in ("", "html", "body"):
        return 0.8
    return 1.25 if _MAIN.search(node.marks) else 1.0


def container_scores(page: Page) -> dict[int, float]:
    """Running text right below each container, half as much for the one around it; links count against it."""
    scores: dict[int, float] = defaultdict(float)
    within: list[int] = []  # the container of each node; parents come first
    for i, node in enumerate(page.nodes):
        holds = i == 0 or node.tag in _BLOCK and node.tag not in ("p", "li", *_HEADINGS)
        within.append(i if holds else within[node.parent])
    for node, text, links in page.blocks:
        weight = (len(text) + 20 * text.count(",")) * max(0.0, 1 - 2 * links / len(text))
        node = within[node]
        scores[node] += weight
        if node > 0:
            scores[page.nodes[node].parent] += weight / 2
    return {node: score * _bonus(page.nodes[node]) for node, score in scores.items() if score > 0}


def best_containers(page: Page) -> list[tuple[int, float]]:
    """Containers with their scores, the best first; of equals the first in the page."""
    return sorted(container_scores(page).items(), key=lambda x: (-x[1], x[0]))


def text_of(page: Page, path: str | None) -> str:
    """Blocks of the containers on ``path``, or else of the page's best container."""
    checksum = zlib.crc32(f"/{path}".encode())
    alike = [i for i, node in enumerate(page.nodes) if path and node.checksum == checksum]
    chosen = [i for i in alike if page.path(i) == path]
    # Blocks before each node, to see whether a container has any.
    before = [0] * (len(page.nodes) + 1)
    for node, _, _ in page.blocks:
        before[node + 1] += 1
    before = list(accumulate(before))
    chosen = [i for i in chosen if before[page.nodes[i].end] > before[i]]
    if not chosen:
        best = best_containers(page)
        if not best:
            return ""
        chosen = [best[0][0]]
    inside = [0] * (len(page.nodes) + 1)
    for i in chosen:
        inside[i] += 1
        inside[page.nodes[i].end] -= 1
    inside = list(accumulate(inside))
    return "\n".join(text for node, text, _ in page.blocks if inside[node])


def _votes(batches) -> Iterator[pa.RecordBatch]:
    """Votes of the pages of a task, summed by host and path."""
    for batch in batches:
        sums: dict[tuple[str, str], float] = defaultdict(float)
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parsed(source or "")
            best = best_containers(page)[:VOTES]
            for node, score in best:
                if node:
                    sums[host, page.path(node)] += score / best[0][1]
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array([host for host, _ in sums], pa.string()),
                "path": pa.array([path for _, path in sums], pa.string()),
                "votes": pa.array(list(sums.values()), pa.float64()),
            }
        )


def _texts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            text_of(parsed(source or ""), path)
            for source, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(text) for text in texts], pa.int64()),
            }
        )


def host(url: str = "url") -> Column:
    """The host of a URL in lower case, empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host`` and ``path``: most votes, of equals the last in the alphabet."""
    votes = pages.mapInArrow(_votes, "host string, path string, votes double")
    # Rounded, as sums of floats depend on the order of the tasks.
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    return sums.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each page.

    Null and empty pages, and pages without running text, have an empty text. Pages
    without host vote among each other. Repeated rows vote and come out one by one.
    Other columns are not looked at.
    """
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    paths = written(winning_paths(rows.select("host", "html")), "host-paths")
    if paths.count() <= BROADCAST_HOSTS:
        paths = F.broadcast(paths)
    joined = rows.join(paths, "host", "left").select("page_id", "url", "html", "path")
    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))
