"""Main text of web pages, found by consensus of the pages of a host.

Each page's containers are scored by the text they hold outside links, menus and the like. The
pages of a host vote with these scores on generalised paths (tags and classes without digits),
added up in Spark, and each page is read again at the winning path of its host, or at its own
best path if it has no text there.

A null page or one without text gives the empty text. Broken markup is read as far as it goes:
tags left open end with their parent or the page, a tag cut off at the end is no text.
"""

from __future__ import annotations

import html as markup
import re
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import stored
from millrace.llm.urls import url_host

# Elements of HTML by how they are read.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noembed xmp".split())
OUTSIDE = frozenset(
    "nav header footer aside form script style noscript template iframe svg canvas button select"
    " textarea object dialog menu head title math map video audio".split()
)
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar"
    " toolbar form".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored sponsors"
    " promo promotion cookie cookies consent notice notices gdpr popup modal overlay newsletter"
    " subscribe subscription signup login nav navbar navigation menu menus breadcrumb breadcrumbs"
    " sidebar aside widget widgets footer header masthead topbar toolbar comment comments reply"
    " replies discussion disqus respond related recommended recommendations share sharing social"
    " pagination pager search".split()
)
TEXT_WORDS = frozenset("article content entry story post main text body".split())
LAYOUT_WORDS = frozenset(  # a name with one of these says what is beside the text, or isn't
    "no not non without with has have enabled disabled none".split()
)
CONTAINERS = frozenset("article main div section td body blockquote center".split())
ENDS_BEFORE = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "td"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"(?<![-\w])(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.IGNORECASE,
)
WORD = re.compile(r"[a-z]+")
LONGEST_PATH = 200
FEW_HOSTS = 100_000  # whose paths are broadcast, some 40 MB at most
SALTS = 32  # tasks that the pages of a host are dealt over if there are more hosts


@dataclass
class Element:
    tag: str
    path: str
    outside: bool
    weight: int = 0
    inside: int = 0  # open elements at the wanted path, this one included
    chars: int = 0
    linked: int = 0


@dataclass
class Reading:
    """What one pass over a page finds."""

    scores: dict[str, int] = field(default_factory=dict)
    blocks: list[str] = field(default_factory=list)


def generalised(tag: str, classes: str) -> str:
    names = sorted({re.sub(r"\d+", "", c) for c in classes.split()} - {""})
    return ".".join([tag, *names])


def _child_path(parent: str, name: str) -> str:
    path = f"{parent}/{name}"
    if len(path) > LONGEST_PATH:
        path = blake2b(path.encode(), digest_size=16).hexdigest()
    return path


def is_aside(names: list[str]) -> bool:
    """Whether these classes and ids mark something beside the main text.

    A name of one word always does, if that word does. A compound one does not if it only tells
    of the layout (no-sidebar, share-enabled), nor if another name is all words of a main text.
    """
    words = [set(WORD.findall(name)) for name in names]
    marks = [w for w in words if w & OUTSIDE_WORDS and not w & LAYOUT_WORDS]
    named_text = any(w and w <= TEXT_WORDS for w in words)
    return any(len(w) == 1 or not named_text for w in marks)


def _element(tag: str, rest: str, parent: Element, wanted: str | None) -> Element:
    found: dict[str, str] = {}
    if rest and not rest.isspace():
        for name, *values in ATTRIBUTE.findall(rest):
            found.setdefault(name.lower(), next((v for v in values if v), "").lower())
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    words = {word for name in names for word in WORD.findall(name)}
    outside = parent.outside or tag in OUTSIDE
    if tag not in ("article", "main", "body", "html"):
        outside = outside or is_aside(names) or "hidden" in found
        outside = outside or found.get("role", "") in OUTSIDE_ROLES
    path, weight = parent.path, 0
    if tag in CONTAINERS and tag != "body":
        path = _child_path(parent.path, generalised(tag, found.get("class", "")))
        weight = {"article": 6, "main": 5}.get(tag, 4)
        if weight == 4 and (not words.isdisjoint(TEXT_WORDS) or "articlebody" in found.get("itemprop", "")):
            weight = 5
    return Element(tag, path, outside, weight, parent.inside + (weight > 0 and path == wanted))


def read_page(html: str, wanted: str | None = None) -> Reading:
    """Scores of the page's containers, and the text blocks inside those at the wanted path."""
    out = Reading()
    root = Element("", "", False, 2, int(wanted == ""))
    stack, pieces, links, end_of_raw = [root], [], 0, 0

    def flush() -> None:
        if pieces:
            top = stack[-1]
            text = " ".join(markup.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                if top.inside:
                    out.blocks.append(text)

    def close() -> None:
        gone = stack.pop()
        score = gone.weight * max(0, gone.chars - 2 * gone.linked)
        if gone.weight and score:
            out.scores[gone.path] = out.scores.get(gone.path, 0) + score
        if stack:
            stack[-1].chars += gone.chars
            stack[-1].linked += gone.linked

    def close_at(depth: int) -> None:
        while len(stack) > depth:
            close()

    def depth_of(tags: tuple[str, ...], stop: frozenset[str]) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return depth
            if stack[depth].tag in stop:
                return 0
        return 0

    for token in TOKEN.finditer(html):
        if token.start() < end_of_raw:
            continue
        tag = token["tag"] or token["tag2"]
        if tag is None:
            text = token[0]
            if text[0] == "<" and len(text) > 1:
                continue
            top = stack[-1]
            if not top.outside:
                pieces.append(text)
                n = len(text) if not text.isspace() else 0
                top.chars += n
                top.linked += n if links else 0
            continue
        if not token[0].endswith(">"):  # cut off at the end of the page
            continue
        tag = tag.lower()
        ends, rest = bool(token["end"] or token["end2"]), token["rest"] or token["rest2"] or ""
        if tag == "a":
            links = 0 if ends else 1
            continue
        if tag in INLINE:
            if ends:
                depth = depth_of((tag,), CONTAINERS)
                if depth and tag == "span":
                    close_at(depth)
            elif tag == "span" and rest:
                inner = _element(tag, rest, stack[-1], wanted)
                stack.append(inner)
            elif tag == "span":
                stack.append(Element(tag, stack[-1].path, stack[-1].outside, 0, stack[-1].inside))
            continue
        flush()
        if ends:
            depth = depth_of((tag,), frozenset())
            if depth:
                close_at(depth)
            continue
        if tag in VOID:
            continue
        depth = depth_of(("p", "h1", "h2", "h3", "h4", "h5", "h6"), CONTAINERS | OUTSIDE)
        if depth:
            close_at(depth)
        if tag in ENDS_BEFORE:
            depth = depth_of((tag, ENDS_BEFORE[tag]), frozenset(("ul", "ol", "dl", "table", "div")))
            if depth:
                close_at(depth)
        if tag == "body":
            depth = depth_of(("head",), frozenset())
            if depth:
                close_at(depth)
        links = 0
        if not rest.endswith("/") or tag in CONTAINERS:
            stack.append(_element(tag, rest, stack[-1], wanted))
        if tag in RAW:
            found = re.compile(f"</{tag}", re.IGNORECASE).search(html, token.end())
            end_of_raw = found.start() if found else len(html)
    flush()
    close_at(0)
    return out


def best_path(scores: dict[str, int]) -> str:
    """The path with the highest score; the longer, then the greater one if several have it."""
    return max(scores, key=lambda p: (scores[p], len(p), p), default="")


def main_text(html: str, path: str | None) -> str:
    """The page's text at a path, or at its own best path if it has none there."""
    if path is not None:
        blocks = read_page(html, path).blocks
        if blocks:
            return " ".join(blocks)
    return " ".join(read_page(html, best_path(read_page(html).scores)).blocks)


def winning_paths(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """One row (host, path) per host: the path with the most votes."""

    @F.arrow_udf("array<struct<path:string,score:bigint>>")
    def votes(htmls: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("path", pa.string()), ("score", pa.int64())]))
        found = [read_page(h or "").scores for h in htmls.to_pylist()]
        return pa.array(
            [[{"path": p, "score": n} for p, n in scores.items()] for scores in found], kind
        )

    cast = pages.select(host.alias("host"), F.explode(votes(F.col(html))).alias("vote"))
    sums = cast.groupBy("host", F.col("vote.path").alias("path")).agg(
        F.sum("vote.score").alias("score")
    )
    rank = F.struct("score", F.length("path").alias("n"), "path")
    return sums.groupBy("host").agg(F.max(rank).getField("path").alias("path"))


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every row with its main text in ``text``; a column of that name is replaced."""
    winners = winning_paths(pages, url_host(F.col(url)), html).select(
        F.col("host").alias("__host"), F.col("path").alias("__path")
    )
    winners = stored(winners)
    keyed = pages.withColumn("__of", url_host(F.col(url)))
    matched = F.col("__of") == F.col("__host")
    if winners.count() <= FEW_HOSTS:  # pages stay where they are
        winners = F.broadcast(winners)
    else:
        salt = F.pmod(F.xxhash64(F.col(url), F.col(html)), F.lit(SALTS)).cast("int")
        keyed = keyed.withColumn("__turn", salt)
        turns = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        winners = winners.withColumn("__salt", turns)
        matched &= F.col("__turn") == F.col("__salt")

    @F.arrow_udf("string")
    def text(htmls: pa.Array, paths: pa.Array) -> pa.Array:
        both = zip(htmls.to_pylist(), paths.to_pylist())
        return pa.array([main_text(h or "", p) for h, p in both], pa.string())

    joined = keyed.join(winners, matched, "left")
    found = joined.withColumn("text", text(F.col(html), F.col("__path")))
    return found.drop("__host", "__path", "__of", "__turn", "__salt")
