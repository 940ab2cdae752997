"""Main text of web pages with site style trees.

The pages of a host are merged into one tree. A node is an element below its parent's node, keyed by the parent's
presentation there (the kinds of its children in order, runs taken once) and by its own kind (element, classes and id,
digits made equal). Each page gives a node its presentation and, if it holds text, its contents. On a host of M pages, with
K more that share nothing with it or each other, a presentation or content seen on c pages has

    presentation importance  1 - sum c log c / ((M + K) log (M + K))  over a node's presentations (their entropy),
    content importance       1 - log c / log (M + K).

The K pages are the rule for small hosts: what few pages repeat stays. Importances are combined up each page's own tree: a node
has 0.1 of its presentation's and 0.9 of the mean, by length, of what it holds. A content or a branch, with all below it,
goes if that is low. Elements, roles, classes and ids that say that they are no article are removed besides.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch
from sparkeval.llm.textbits import chunks

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>?""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "select"}
DIGITS = re.compile(r"\d+")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that begins ends an open one of these kinds, up to the nearest of the containers.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "body": ("head",)}
HOLDS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote", "td", "th", "aside", "nav", "header", "footer", "form", "menu"}
#: Elements, and words of roles, classes and ids, that mark what is no article.
NO_ARTICLE = {"nav", "aside", "footer", "form", "dialog", "menu", "button", "head", "search"}
NO_ARTICLE_WORDS = set(
    "ad ads adv advert advertisement adverts advertising adbox banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie"
    " cookies copyright dialog disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination"
    " pager popup promo promoted promotion related replies respond search share sharing sidebar sidenav signup social sponsor sponsored subscribe"
    " subscription toolbar topbar widget".split()
)
#: Of these, what marks an element inside an article as a part of a longer name too; the others must be a whole class, id or role.
CLEAR_WORDS = set(
    "ad ads adv advert advertisement adverts advertising adbox breadcrumb breadcrumbs comment comments consent cookie cookies disqus navbar newsletter"
    " promo promoted sidebar sponsor sponsored".split()
)
#: These mark a page's head outside an article, and an article's own head inside one.
HEAD_WORDS = {"header", "hero"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Importance below which a node goes, outside and inside an article or main element.
LOW, LOW_INSIDE = 0.15, 0.06
#: Pages added to each host, and a presentation's share of a node's importance.
PRIOR, OWN = 8, 0.1
#: Presentations of this importance or more count as 1, and so do contents of LOW or more: a host keeps few others.
PLAIN = 0.5
#: A page that would keep less than this share of its text is a copy and stays whole (outside, inside).
STAYS = (0.2, 0.5)
SOFT, HARD = 1, 2  # marked by a word, marked by the element


class Node:
    """An open element: its name, its place among the page's block elements, and whether it is no article or inside one."""

    __slots__ = ("at", "gone", "inside", "name")

    def __init__(self, name: str, at: int, gone: int, inside: bool):
        self.name, self.at, self.gone, self.inside = name, at, gone, inside


class Page:
    """A page's block elements, parents before children, and its blocks of text in page order."""

    __slots__ = ("blocks", "fixed", "kinds", "name", "up")

    def __init__(self):
        self.up: list[int] = []
        self.name: list[tuple] = []  # element, class, id
        self.kinds: list[list] = []  # names of the children in order
        self.fixed: list[bool] = []  # holds an article or is one of its outermost elements
        self.blocks: list[tuple[int, str, int, bool, bool]] = []  # element, text, named no article, inside, heading

    def add(self, up: int, name: tuple, fixed: bool) -> int:
        self.up.append(up)
        self.name.append(name)
        self.kinds.append([])
        self.fixed.append(fixed)
        return len(self.up) - 1

    def keys(self) -> tuple[list[int], list[int]]:
        """Each element's node in the host's tree, and its presentation."""
        memo: dict[tuple, int] = {}

        def hashed(key: tuple) -> int:
            if key not in memo:
                memo[key] = _hash(*key)
            return memo[key]

        shapes = [hashed(tuple(k for k, _ in groupby(kinds))) for kinds in self.kinds]
        nodes: list[int] = []
        for up, name in zip(self.up, self.name):
            nodes.append(hashed((nodes[up], shapes[up], name)) if nodes else 0)
        return nodes, shapes


def _hash(*parts) -> int:
    data = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def parse(page: str) -> Page:
    """The page's elements and blocks. Inside is what an article or main element holds.

    Malformed markup is read as browsers do in the common cases: elements end with their container, an end tag without a
    start counts for nothing.
    """
    out = Page()
    words = []
    stack = [Node("", out.add(0, ("",), True), 0, False)]
    owner = stack[0]

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            out.blocks.append((owner.at, text, owner.gone, owner.inside, any(n.name in HEADINGS for n in stack[-4:])))

    at = 0
    size = len(page)
    while at < size:
        found = TAG.search(page, at)
        if found is None:
            words.append(html.unescape(page[at:]))
            break
        if found.start() > at and (owner.gone or not stack[-1].gone):  # not what is in a marked element within a block
            words.append(html.unescape(page[at : found.start()]))
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    if name in BLOCK:
                        flush()
                    del stack[depth:]
                    break
                if stack[depth].name in ("article", "main", "body") and name not in ("article", "main", "body", "html"):
                    break
            if name in BLOCK:
                owner = next(n for n in reversed(stack) if n.name in BLOCK or not n.name)
            continue
        if name in RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            words.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            words.append(" ")
            out.kinds[stack[-1].at].append(name)
            continue
        if name in BLOCK:
            flush()
            ends = ENDS.get(name) or (("p",) if name not in HOLDS or name in ("div", "ul", "ol", "table", "blockquote", "section", "article") else ())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in ends:
                    del stack[depth:]
                    break
                if stack[depth].name in HOLDS:
                    break
        up = stack[-1]
        marks = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(found[3])} if found[3] else {}
        whole = set(" ".join(marks.values()).lower().split()) if marks else ()
        said = set(re.split(r"[^a-z]+", " ".join(whole))) if marks else ()
        inside = up.inside or name in ("article", "main")
        gone = up.gone
        if name in ("article", "main"):
            # A marked wrapper around an article does not hide it; an article that is a comment, or in an aside, stays hidden.
            gone = HARD if up.gone == HARD or {"comment", "comments", "reply", "replies"}.intersection(said) else 0
        elif name in NO_ARTICLE or (name == "header" and not inside):
            gone = HARD
        elif name in ("html", "body"):
            pass
        elif inside and (NO_ARTICLE_WORDS.intersection(whole) or CLEAR_WORDS.intersection(said)):
            gone = max(gone, SOFT)
        elif not inside and (NO_ARTICLE_WORDS | HEAD_WORDS).intersection(said):
            gone = max(gone, SOFT)
        here = up.at
        if name in BLOCK:
            kind = (name, DIGITS.sub("0", marks.get("class", "")), DIGITS.sub("0", marks.get("id", ""))) if marks else (name,)
            out.kinds[up.at].append(kind)
            here = out.add(up.at, kind, name in ("article", "main", "html", "body"))
        stack.append(Node(name, here, gone, inside))
        if name in BLOCK:
            owner = stack[-1]
    flush()
    return out


def host_of(url: Column) -> Column:
    """Lower-cased host (with its port) of a URL; empty for null."""
    host = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), "^[a-z][a-z0-9+.-]*://", "")
    for mark in ("/", "?", "#"):
        host = F.substring_index(host, mark, 1)
    return F.substring_index(host, "@", -1)


SEEN = pa.schema([("host", pa.string()), ("node", pa.int64()), ("shape", pa.int64())])


def style_tree(pages: DataFrame, scratch: Scratch, least: float | None = None) -> DataFrame:
    """(host, node, content, importance) of the nodes of every host's tree.

    A content's node is the hash of its element's node and its text. With ``least`` only contents below it, and
    presentations below PLAIN: of a host of M pages with b blocks each these are at most b * (M + K) ** least and 4 * b.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html"):
            hosts, ids, kinds = [], [], []
            for host, html_ in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                page = parse(html_ or "")
                nodes, shapes = page.keys()
                seen: dict[int, set] = {}
                for node, shape in zip(nodes, shapes):
                    seen.setdefault(node, set()).add(shape)
                contents = {_hash(nodes[at], text) for at, text, gone, _, _ in page.blocks if not gone}
                # An element that recurs on a page has the set of its presentations there; node 0 counts the page.
                ids += [*seen, *contents]
                kinds += [next(iter(x)) if len(x) == 1 else _hash(*sorted(x)) for x in seen.values()] + [None] * len(contents)
                hosts += [host] * (len(seen) + len(contents))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(ids, pa.int64()), pa.array(kinds, pa.int64())], schema=SEEN)

    seen = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, node bigint, shape bigint")
    counts = seen.groupBy("host", "node", "shape").agg(F.count("*").alias("c"))
    content = F.col("shape").isNull()
    if least is not None:  # a host has at least the c pages: no importance is below that on a host of c pages
        counts = counts.where(F.when(content, 1 - F.log("c") / F.log(F.col("c") + PRIOR) < least).otherwise((F.col("c") > 1) | (F.col("node") == 0)))
    counts = scratch.write(counts, "style-counts")
    hosts = counts.where("node = 0").groupBy("host").agg((F.sum("c") + PRIOR).alias("all"))
    nodes = counts.groupBy("host", "node", content.alias("content")).agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.log("c")).alias("clogs"))
    shape = 1 - F.col("clogs") / (F.col("all") * F.log("all"))
    importance = F.when(F.col("content"), 1 - F.log("c") / F.log("all")).otherwise(shape)
    tree = nodes.join(hosts, "host").select("host", "node", "content", importance.alias("importance"))
    return tree if least is None else tree.where(F.col("importance") < F.when(F.col("content"), least).otherwise(PLAIN))


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    Character references are decoded, white space inside a block becomes one space, empty blocks vanish, and the blocks are
    joined by line feeds in page order. If a page has article or main elements with text, only what they hold counts, else its
    body. Null and empty html give an empty text; a null url is a host of its own; repeated rows give equal rows and
    count as pages; clashing columns are ignored; an empty table gives an empty one. Whole pages, whatever their size.
    """
    scratch = Scratch(pages.sparkSession)
    low_ones = style_tree(pages, scratch, low).groupBy("host").agg(F.collect_list(F.struct("node", "importance")).alias("low"))
    found = scratch.write(low_ones, "style-noise")
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url"))).join(found, "host", "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html"):
            texts = []
            for i, page in enumerate(part.column("html").to_pylist()):
                weak = part.column("low")[i].as_py() or ()
                texts.append(main_text(page or "", {x["node"]: x["importance"] for x in weak}, low))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(np.asarray([len(t) for t in texts], np.int64))], names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}["page_id"]
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def unimportant(page: Page, blocks: list[tuple], weak: dict[int, float], bound: float) -> set[int]:
    """Places in ``blocks`` of what the host's tree removes from this page: contents and whole branches below ``bound``."""
    nodes, _ = page.keys()
    own = [weak.get(_hash(nodes[at], text), 1.0) if not (heading and inside) else 1.0 for at, text, _, inside, heading in blocks]
    length, total = [0.0] * len(nodes), [0.0] * len(nodes)
    for (at, text, *_), x in zip(blocks, own):
        length[at] += len(text)
        total[at] += len(text) * x
    for at in range(len(nodes) - 1, 0, -1):  # children come after their parents
        if length[at]:
            total[at] = length[at] * (OWN * weak.get(nodes[at], 1.0) + (1 - OWN) * total[at] / length[at])
            length[page.up[at]] += length[at]
            total[page.up[at]] += total[at]
    gone = [False] * len(nodes)
    for at in range(1, len(nodes)):
        gone[at] = gone[page.up[at]] or (not page.fixed[at] and 0 < length[at] and total[at] < bound * length[at])
    return {i for i, (block, x) in enumerate(zip(blocks, own)) if x < bound or gone[block[0]]}


def main_text(html_: str, weak: dict[int, float] | None = None, low: float = LOW) -> str:
    """The text of one page; ``weak`` holds the importances of its host's nodes, those that are missing are 1."""
    page = parse(html_)
    blocks = [b for b in page.blocks if not b[2]]
    inside = any(b[3] for b in blocks)
    if inside:
        blocks = [b for b in blocks if b[3]]
    if weak:
        out = unimportant(page, blocks, weak, min(low, LOW_INSIDE) if inside else low)
        rest = sum(len(b[1]) for i, b in enumerate(blocks) if i not in out)
        if rest >= STAYS[inside] * sum(len(b[1]) for b in blocks):
            blocks = [b for i, b in enumerate(blocks) if i not in out]
    return "\n".join(b[1] for b in blocks).encode("utf-8", "replace").decode()
