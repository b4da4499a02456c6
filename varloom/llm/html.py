"""Main text of web pages by consensus host paths.

First pass: every page's containers are scored alone, and the best one's path (tags with generalised classes, root first)
is the page's vote. Votes are counted per host in Spark, and a host's winning path is chosen. Second pass: a page's text
is taken from the containers on its host's winning path, or, where it has none, from its own best container.

Pages are parsed where they lie; only paths and counts are shuffled, and a hot host is counted in part on every task.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import broadcast_if_light, cut, read_table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page.
RAW = frozenset("script style noscript template textarea title svg math iframe object select option canvas audio video head".split())
#: Elements that are never part of an article.
ASIDE = frozenset("nav header footer aside form button dialog menu fieldset label input select".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article main section div body td blockquote html".split())
#: Words of classes, ids and roles that hint at what isn't main text, or is. Those of FAINT name wrappers and articles, too.
_EDGE, _END = r"(?:^|[-_\s])", r"(?:$|[-_\s\d])"
FAINT = (
    "side share sharing social tags meta notice header alert search login signup skip promo\\w* subscribe subscription widget\\w* toolbar byline banner popup modal reactions? sidebar"
).split()
PLAIN = (
    "ads? advert\\w* adsense breadcrumbs? comments? commentlist cookies? consent disqus footer foot gdpr masthead menu nav navbar navigation newsletter pagination pager "
    "recommend\\w* related replies reply respond sponsor\\w* outbrain taboola author-?bio"
).split()
BAD = re.compile(f"{_EDGE}(?:{'|'.join(PLAIN + FAINT)}){_END}", re.I)
SURE = re.compile(f"{_EDGE}(?:{'|'.join(PLAIN)}){_END}", re.I)
GOOD = re.compile(r"(?:^|[-_\s])(?:article|body|content|entry|main|page|post|story|text|hentry|blog)(?:$|[-_\s])", re.I)
#: What says how a page is shown, and names none of its parts: no-ads, with-menu, nav-open, footer-fixed.
STATE = re.compile(r"(?<![\w-])(?:(?:no|has|with|without|is|hide|show)[-_][\w-]+|[\w-]+[-_](?:open|opened|closed|enabled|disabled|given|accepted|fixed|on|off|active|visible|collapsed|expanded))(?![\w-])", re.I)
#: A subtree with more than this share of a page's prose isn't out for its name alone; nor, whatever its name, one that leaves less
#: than a share of REST to the others.
MASS, REST = 0.5, 0.2
#: Characters of prose, and share of its text within links at most, of what stands beside the main container and belongs to it.
BESIDE, LINKED = 40, 0.25

#: A comment, a declaration, or a tag. A quote after = opens a value, which is taken whole and may hold < and >; other quotes are
#: letters. Where that finds no tag, as after a quote that never closes, a tag ends at its first >.
_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s<>\"'][^\s<>]*+|(?=>)))*+)>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>",
    re.S,
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|=\s*(?:"[^"]*"|'[^']*')""", re.I)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


class Node:
    """An element. skip: it can't be main text; doubt: its name says so, but what it holds may say otherwise (see weigh)."""

    __slots__ = ("tag", "name", "parent", "skip", "doubt", "blocks", "good", "level", "crc", "inside")

    def __init__(self, tag: str, name: str, parent: "Node | None", skip: bool, good: bool, doubt: str = "") -> None:
        self.tag, self.name, self.parent, self.skip, self.good, self.doubt = tag, name, parent, skip, good, doubt
        self.level = 0 if parent is None else parent.level + 1
        self.inside = tag == "article" or parent is not None and parent.inside  # within an article
        self.crc = 0 if parent is None else zlib.crc32(f"{'>' if parent.tag else ''}{name}".encode("utf-8", "surrogatepass"), parent.crc)  # of its path
        self.blocks: list[tuple[int, str, int]] = []  # place in the page, text, characters within links


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


def _attributes(text: str) -> tuple[str, str, bool]:
    """Classes, ids and roles as written; the name that generalises them; hidden?"""
    classes = ids = ""
    hidden = False
    for key, value in _ATTR.findall(text):
        if not key:  # the value of another attribute
            continue
        key, value = key.lower(), entities.unescape(value.strip("\"'"))
        if key == "class":
            classes = value
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        else:
            ids += " " + value
    general = ".".join(sorted({_DIGITS.sub("N", c) for c in classes.lower().split()}))
    return f"{classes} {ids}", general, hidden


def parse(page: str | None) -> list[Node]:
    """The page's block elements in order, each with its own text blocks; tolerant of tags that are missing or cross."""
    page = page or ""
    root = Node("", "", None, False, False)
    nodes, at, stack = [root], root, [("", root)]  # stack: open elements and the node that is in force within them
    count = {"": 1}  # open elements by tag
    endless: set[str] = set()  # raw elements that end nowhere from here on
    text: list[str] = []
    links = [0, 0]  # open links, characters in them
    place = 0

    def close() -> None:
        nonlocal place
        if text:
            block = _SPACE.sub(" ", "".join(text)).strip()
            if block:
                at.blocks.append((place, block, links[1]))
                place += 1
            text.clear()
        links[1] = 0

    def say(raw: str) -> None:
        if raw:
            said = entities.unescape(raw) if "&" in raw else raw
            text.append(said)
            if links[0]:
                links[1] += len(said)

    end, pos, size = 0, 0, len(page)
    while pos < size:
        m = _PIECE.search(page, pos)
        if m is None:
            break
        say(page[end : m.start()])
        pos = end = m.end()
        slash, tag, rest = m.group(1, 2, 3) if m.group(2) is not None else m.group(4, 5, 6)
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(slash)
        if tag in RAW and not closing:
            if not rest.endswith("/") and tag != "head" and tag not in endless:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos)
                if not stop:
                    endless.add(tag)
                # a title or script that never ends would swallow the page; a select or svg may
                pos = end = stop.end() if stop else (size if tag in ("script", "style") else pos)
            continue
        if tag == "a":
            links[0] = 0 if closing else 1
            continue
        if tag not in BLOCK:
            continue
        close()
        if tag in ("br", "hr"):
            continue
        if closing:
            if count.get(tag, 0):
                left = ""
                while left != tag:
                    left = stack.pop()[0]
                    count[left] -= 1
                at = stack[-1][1]
                links[0] = 0
            continue
        if tag == "p" or tag in ("li", "td", "th", "tr", "dd", "dt"):  # these end their like
            if stack[-1][0] == tag:
                stack.pop()
                count[tag] -= 1
                at = stack[-1][1]
        else:
            while stack[-1][0] == "p":  # a paragraph holds no block
                stack.pop()
                count["p"] -= 1
                at = stack[-1][1]
        said, general, hidden = _attributes(rest) if rest.strip() else ("", "", False)
        good = tag in ("article", "main") or bool(GOOD.search(said))
        # a page's own frame may be called anything; an article's header is part of it only by its headings
        out = hidden or tag in ASIDE and tag != "form" and not (tag == "header" and at.inside)
        named = STATE.sub(" ", said) if "-" in said or "_" in said else said
        bad = tag not in ("html", "body", "article", "main") and BAD.search(named)
        # a form may be a page's frame, too
        doubt = "sure" if tag == "form" else "" if not bad else "sure" if SURE.search(named) else "faint"
        node = Node(tag, f"{tag}.{general}" if general else tag, at, out, good, doubt)
        nodes.append(node)
        stack.append((tag, node))
        count[tag] = count.get(tag, 0) + 1
        at = node
    say(page[end:])
    close()
    weigh(nodes)
    return nodes


def prose(node: Node) -> int:
    """Characters of a node's own blocks, less twice those within links."""
    return sum(max(0, len(b) - 2 * links) for _, b, links in node.blocks)


def weigh(nodes: list[Node]) -> None:
    """Settles skip: what is within a skipped element is skipped, and so is an element in doubt, unless it holds most of the
    page's prose and its name is faint, or it or something in it is named like an article and not like anything else, or there
    is hardly any prose but its own.
    """
    mass, likely = [], []
    index = {id(n): i for i, n in enumerate(nodes)}
    for node in nodes:  # parents come before children
        node.skip = node.skip or node.parent is not None and node.parent.skip
        mass.append(0 if node.skip else prose(node))
        likely.append(node.good and not node.doubt and not node.skip)
    for i in range(len(nodes) - 1, 0, -1):
        up = index[id(nodes[i].parent)]
        mass[up] += mass[i]
        likely[up] = likely[up] or likely[i] and mass[i] > 0
    for i, node in enumerate(nodes):
        if node.doubt and not node.skip:
            most = mass[i] > MASS * mass[0] and (node.doubt == "faint" or node.good or likely[i])
            node.skip = not (most or mass[i] > (1 - REST) * mass[0])
        node.skip = node.skip or node.parent is not None and node.parent.skip


def path_of(node: Node) -> str:
    parts = []
    while node is not None and node.tag:
        parts.append(node.name)
        node = node.parent
    return ">".join(reversed(parts))


def weights(nodes: list[Node]) -> dict[int, float]:
    """Score of each container that has text: the prose of its blocks, and of what it holds a share, less for each container between."""
    index = {id(n): i for i, n in enumerate(nodes)}
    held = [0.0] * len(nodes)
    some = [False] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if not node.skip and node.blocks:
            held[i] += prose(node)
            some[i] = True
        if node.parent is not None and some[i]:
            up = index[id(node.parent)]
            held[up] += held[i] * (1.0 if node.tag not in CONTAINER else 0.5 if node.tag in ("article", "main") else 0.9)
            some[up] = True
    return {i: held[i] * (1.5 if n.good else 1.0) for i, n in enumerate(nodes) if some[i] and n.tag in CONTAINER}


def best_container(nodes: list[Node]) -> Node | None:
    score = weights(nodes)
    if score:
        return nodes[max(score, key=lambda i: (score[i], nodes[i].level, -i))]
    return nodes[0] if any(n.blocks and not n.skip for n in nodes) else None  # text without any container: the page itself


def with_beside(nodes: list[Node], chosen: list[Node]) -> list[Node]:
    """The chosen containers and those beside them, in an element below the page's body, that hold prose and few links."""
    around = {id(n.parent) for n in chosen if n.parent is not None and n.parent.tag not in ("", "html", "body")}
    if not around:
        return chosen
    held = {id(n) for n in chosen}
    beside = {id(n): [0, 0] for n in nodes if n.parent is not None and id(n.parent) in around and id(n) not in held and not n.skip and n.tag in CONTAINER}
    if not beside:
        return chosen
    of: dict[int, int] = {}
    for node in nodes:  # parents come before children
        own = id(node) if id(node) in beside else of.get(id(node.parent))
        if own is not None:
            of[id(node)] = own
            if not node.skip:
                for _, block, links in node.blocks:
                    beside[own][0] += len(block)
                    beside[own][1] += links
    return chosen + [n for n in nodes if id(n) in beside and beside[id(n)][0] - beside[id(n)][1] >= BESIDE and beside[id(n)][1] <= LINKED * beside[id(n)][0]]


def text_in(nodes: list[Node], chosen: list[Node]) -> str:
    """Blocks within the chosen containers, in page order, joined by one space."""
    inside = {id(n) for n in chosen}
    blocks: list[tuple[int, str]] = []
    for node in nodes:  # parents come before children
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
        if not node.skip and id(node) in inside:
            blocks += [(place, b) for place, b, _ in node.blocks]
    return " ".join(b for _, b in sorted(blocks))


def vote_paths(pages: DataFrame) -> DataFrame:
    """host, path, pages, chars: how many of a host's pages have their best container on a path."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for url, page in zip(pdf["url"], pdf["html"], strict=True):
                nodes = parse(page)
                if (best := best_container(nodes)) is not None:
                    out.append((host_of(url), path_of(best), len(text_in(nodes, [best]))))
            yield pd.DataFrame(out, columns=["host", "path", "chars"])

    votes = pages.select("url", "html").mapInPandas(run, "host string, path string, chars long")
    return votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, path for every row of pages; path is null where a page's own container was used.

    Null, empty and markup-only pages give an empty text; null urls share the host ''. Repeated rows give equal rows; of
    paths with equal votes the one with more text counts, then the first by name. An empty table gives no rows; other columns
    are not read.
    """
    order = Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("chars"), "path")
    winners = cut(vote_paths(pages).withColumn("_r", F.row_number().over(order)).where(F.col("_r") == 1).select("host", "path"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            texts, used = [], []
            for page, path in zip(pdf["html"], pdf["path"], strict=True):
                nodes = parse(page)
                crc = zlib.crc32(path.encode("utf-8", "surrogatepass")) if path else 0
                on_path = [n for n in nodes if n.tag and not n.skip and n.crc == crc and path_of(n) == path] if path else []
                text = text_in(nodes, with_beside(nodes, on_path))
                if not text and (best := best_container(nodes)) is not None:
                    text, path = text_in(nodes, with_beside(nodes, [best])), None
                texts.append(text)
                used.append(path if text else None)
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "path": used})

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host")).join(broadcast_if_light(winners, 60 + F.octet_length("host") + F.octet_length("path")), "host", "left")
    return rows.select("page_id", "url", "html", "path").mapInPandas(run, "page_id long, url string, text string, path string")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract_pages(read_table(spark, sf_dir, "pages"))
    return done.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
