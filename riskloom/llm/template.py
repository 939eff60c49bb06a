"""Main text of web pages: a template per host, deduced from equivalence classes.

A token is an element with its path from the root (tag names and classes). Its
occurrence vector counts it on each page of the host; tokens with the same vector
form an equivalence class. Classes that nest into each other make up the template.
What the template holds open are slots; slots of menus, adverts, notices and the like
go, the text of the remaining ones is the page's text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import store, text_or_empty

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|xmp)\b[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>|<(?P<open>[a-zA-Z][^>]*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# a start tag ends an open element of these kinds
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# what an implied end must not leave
SCOPE = frozenset("body div article main section nav aside header footer table ul ol dl form blockquote".split())
OUTSIDE = frozenset("head nav aside footer form button select dialog menu object audio video canvas map".split())
INSIDE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# parts of class and id names that mark something else than the article
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promoted nav navbar navigation menu menus breadcrumb "
    "breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar toolbar share sharing social cookie cookies consent gdpr notice notices alert newsletter "
    "subscribe subscription signup login popup modal overlay comment comments reply replies respond disqus related recommended recommendations pagination pager skip "
    "hidden copyright legal disclaimer search".split()
)
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
LINKS = 0.6  # share of a slot's characters in links from which it is a menu


class Element:
    __slots__ = ("tag", "path", "away", "inside", "link")

    def __init__(self, tag: str, path: str, away: bool, inside: bool, link: bool):
        self.tag, self.path, self.away, self.inside, self.link = tag, path, away, inside, link


def _child(parent: Element, tag: str, attributes: str) -> Element:
    names, away = "", parent.away or tag in OUTSIDE or (tag == "header" and not parent.inside)
    inside = parent.inside or tag in INSIDE
    if "=" in attributes or "hidden" in attributes.lower():
        for m in NAMES.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                marked = not MARKED.isdisjoint(re.split(r"[^a-z]+", value))
                away = away or (marked and tag not in ("html", "body", "article", "main"))
                if name == "class":
                    names = "." + ".".join(sorted(value.split()))
            elif name == "role":
                away, inside = away or value in ROLES, inside or value in INSIDE
            elif name == "hidden":
                away = True
            elif name == "aria-hidden":
                away = away or value == "true"
            elif re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                away = True
    return Element(tag, f"{parent.path}/{tag}{names}", away, inside, parent.link or tag == "a")


def parse(page: str) -> Iterator[tuple[str, Element, str]]:
    """Events of a page in order: ("open", element, ""), ("text", element, text) and
    ("break", element, "") where a block begins or ends. End tags may be missing."""
    stack = [Element("", "", False, False, False)]
    for m in PIECE.finditer(page):
        if m["text"] is not None:
            yield "text", stack[-1], m["text"]
            continue
        tag, attributes = m["tag"], m["attributes"]
        if tag is None and m["open"]:  # a quote in the tag is never closed
            tag, _, attributes = m["open"].partition(" ")
        if tag is None:
            if m["raw"] and m["raw"].lower() != "textarea":
                yield "open", _child(stack[-1], m["raw"].lower(), ""), ""
            continue
        tag = tag.lower()
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                del stack[at:]
            if tag not in INLINE:
                yield "break", stack[-1], ""
            continue
        ends = CLOSES.get(tag, ())
        if tag not in INLINE and tag not in VOID:
            ends = {*ends, "p"}
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        element = _child(stack[-1], tag, attributes or "")
        if tag not in INLINE:
            yield "break", element, ""
        yield "open", element, ""
        if tag not in VOID and not (attributes or "").endswith("/"):
            stack.append(element)


def occurrences(page: str) -> dict[str, list[int]]:
    """Per path of a page: elements, characters of text, characters of it in links."""
    found: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for kind, element, text in parse(page):
        if kind == "open":
            found[element.path][0] += 1
        elif kind == "text":
            n = len(text) - text.count(" ") - text.count("\n")
            if n:
                found[element.path][1] += n
                found[element.path][2] += n * element.link
    return found


def deduce(pages: int, tokens: list[tuple]) -> dict[str, bool]:
    """Template of a host: path -> whether its slot is a menu.

    ``tokens``: (path, pages with it, elements, two sums over the occurrence vector,
    characters, characters in links). Tokens with equal vectors form a class; classes
    are taken from the most to the least frequent, and a class is valid if each of
    its paths hangs on the template or on the class itself. One page, or a path on one
    page only, says nothing about the host.
    """
    if pages < 2:
        return {}
    classes: dict[tuple, list[tuple]] = defaultdict(list)
    for t in tokens:
        if t[1] > 1:
            classes[t[1:5]].append(t)
    template: dict[str, bool] = {"": False}
    for vector in sorted(classes, key=lambda v: (-v[0], v[1:])):
        members = classes[vector]
        paths = {t[0] for t in members}
        if all(p.rpartition("/")[0] in template or p.rpartition("/")[0] in paths for p in paths):
            # the whole class fills and empties together, so it is judged together
            chars, links = sum(t[5] for t in members), sum(t[6] for t in members)
            for p in paths:
                template[p] = links > LINKS * chars and vector[0] > 2
    return template


def extract(page: str, template: dict[str, bool]) -> str:
    """Text of the slots that remain; blocks in page order, joined by one space."""
    blocks: list[tuple[bool, str]] = []
    run: list[str] = []
    inside = False

    def close() -> None:
        words = html.unescape("".join(run)).split()
        if words:
            blocks.append((inside, " ".join(words)))
        run.clear()

    for kind, element, text in parse(page):
        if kind == "break":
            close()
            continue
        if kind == "open" or element.away:
            continue
        slot = element.path
        while slot and slot not in template:
            slot = slot.rpartition("/")[0]
        if template.get(slot, False) and not element.inside:
            continue
        if element.inside != inside:
            close()
            inside = element.inside
        run.append(text)
    close()
    if any(i for i, _ in blocks):  # the page says where its article is
        blocks = [b for b in blocks if b[0]]
    return " ".join(b for _, b in blocks)


TOKENS = "host string, path string, pages long, elements long, a long, b long, chars long, links long"


def templates(pages: DataFrame) -> DataFrame:
    """(host, pages, tokens): tokens of each host that occur on more than one page.

    ``pages`` has host, id (a hash of the row) and html. Counts are added up per
    batch before they are shuffled, so a host may own any share of the pages. The
    occurrence vector is kept as two sums of hashes of (page, count).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0] * 6)
            for host, ident, page in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                total = sums[host, ""]
                total[0] += 1
                for path, (n, chars, links) in occurrences(page).items():
                    h = xxhash.xxh64_intdigest(f"{ident} {n}")
                    s = sums[host, path]
                    for i, x in enumerate((1, n, h & 0x7FFFFFFF, h >> 33, chars, links)):
                        s[i] += x
            if sums:
                hosts, paths = zip(*sums, strict=True)
                columns = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *(pa.array(c, pa.int64()) for c in zip(*sums.values(), strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in TOKENS.split(", ")])

    tokens = pages.select("host", "id", "html").mapInArrow(run, TOKENS)
    counts = ("pages", "elements", "a", "b", "chars", "links")
    tokens = tokens.groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in counts)).where("pages > 1")
    return tokens.groupBy("host").agg(
        F.max(F.when(F.col("path") == "", F.col("pages"))).alias("n"),
        F.collect_list(F.when(F.col("path") != "", F.struct("path", *counts))).alias("tokens"),
    )


def main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of pages: key, url, text (empty if none), n_chars (code points).

    Null html gives empty text; a null url or one without host belongs to the host
    "". A host with one page has no template, its page is judged by its own elements.
    Repeated rows count as further pages of the host. An empty table gives an empty
    table; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1)).alias("host")
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), host, text_or_empty(page).alias("html"))
    known = store(templates(rows.withColumn("id", F.xxhash64("k", "html"))), "templates")
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("k", "u")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, bool]] = {}
        for b in batches:
            hosts, texts = b.column(2).to_pylist(), []
            for i, p in enumerate(b.column(3).to_pylist()):
                if hosts[i] not in held:
                    if len(held) > 200:
                        held.clear()
                    n, tokens = b.column(4)[i].as_py(), b.column(5)[i].as_py()
                    held[hosts[i]] = deduce(n or 0, [tuple(t.values()) for t in tokens or ()])
                texts.append(extract(p, held[hosts[i]]))
            columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "u", "text", "n_chars"])

    joined = rows.join(known, "host", "left").select("k", "u", "host", "html", "n", "tokens")
    return joined.mapInArrow(run, f"{', '.join(kinds)}, text string, n_chars long").withColumnsRenamed({"k": key, "u": url})
