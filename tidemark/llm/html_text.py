"""HTML extraction by tag-path ratios.

A page is read into blocks: the text between two starts or ends of block elements, with the path of tags from the root.
For every path the text length and the punctuation of its blocks are added up and divided by their number; the product
is the path's ratio. Ratios are smoothed along the page, over blocks next to each other, and fused by container (the
nearest article, main, section, division or body), so that a short heading or a single-word paragraph shares the
weight of the text around it. Containers whose weight is under one standard deviation of all go. What an element says
of itself comes first: menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles never
take part. A marked part (the outermost article or main) competes as a whole, with a bonus; inside it containers
compete by their mean ratio, with the same bonus, so that a short section of the article stays beside a long one.

Defined results: a null or empty page has the empty text; markup that is cut off or not closed ends with the page;
rows may repeat and page_id may be null; extra columns are kept, but text and n_chars are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Kinds of elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_UNSEEN = frozenset("script style noscript template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CONTAINER = frozenset("article main section div body".split())
_NEVER = frozenset(
    "head nav footer aside form script style noscript template iframe svg math button select option textarea dialog menu object embed canvas audio video map xmp noembed noframes title input".split()
)
_PARAGRAPH = frozenset({"p"})
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("table ul ol dl td th div section article main body html nav aside footer header form blockquote".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
    header masthead topbar footer copyright legal sidebar aside widget widgets rail cookie cookies consent gdpr notice notices alert popup modal overlay toast
    comment comments respond replies discussion disqus share sharing social related recommended recommendations newsletter subscribe subscription signup
    login search pagination pager toolbar form""".split()
)
#: What may stand beside such a word in a name of several parts; a name with any other part ("no-sidebar", "related-work") says nothing.
_BESIDE = frozenset(
    """site page global main primary secondary top bottom left right upper lower mobile desktop sticky fixed inline post entry article blog user reader the
    box block bar container wrapper wrap inner outer area zone slot unit section list group item items links link button buttons icons panel row column col
    content text body bg large small posts articles stories""".split()
)
_STOPS = frozenset(".,;:!?…。，、！？")
#: What the weight of a marked part is multiplied by.
_BONUS = 2.0


@lru_cache(maxsize=10_000)
def _speaks(name: str, inside: bool) -> bool:
    """Whether a class or id names a part that is no main text; the header of an article is part of it."""
    words = [w for w in re.split(r"[_-]+", name) if w]
    own = [w for w in words if w in _WORDS and not (inside and w == "header")]
    return bool(own) and all(w in _WORDS or w in _BESIDE for w in words)


def _label(tag: str, attrs: str, inside: bool) -> bool:
    """Whether the element says that it is no part of the main text. ``inside``: it is in an article or main."""
    if tag in _NEVER:
        return True
    if tag == "header":
        return not inside
    if tag in ("html", "body", "main") or not attrs.strip():
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = html.unescape(a or b or c).lower(), name.lower()
        if name in ("class", "id"):
            if any(_speaks(x[:100], inside) for x in value.split()):
                return True
        elif (name == "role" and value in _ROLES) or (name == "hidden") or (name == "aria-hidden" and value == "true"):
            return True
    return False


class Frame(NamedTuple):
    """An open element."""

    tag: str
    path: int
    container: int
    dropped: bool
    part: int


class Block(NamedTuple):
    """A block of text: the number of its tag path, its container, its marked part (0: none), its text."""

    path: int
    container: int
    part: int
    text: str


def blocks_of(page: str) -> list[Block]:
    """Every block of text that takes part."""
    out: list[Block] = []
    top = Frame("", 0, 0, False, 0)
    stack: list[Frame] = []
    opened: Counter[str] = Counter()  # so that no search goes down the stack for what isn't there
    paths: dict[tuple[int, str], int] = {}
    text: list[str] = []
    containers = at = 0
    end = len(page)

    def last() -> Frame:
        return stack[-1] if stack else top

    def flush() -> None:
        got = " ".join("".join(text).split())
        text.clear()
        if got:
            f = last()
            out.append(Block(f.path, f.container, f.part, got))

    def close(to: int) -> None:
        while len(stack) > to:
            if stack[-1].tag not in _INLINE and not stack[-1].dropped:
                flush()
            opened[stack.pop().tag] -= 1

    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at and not last().dropped:
            text.append(html.unescape(page[at:start]))
        if start == end:
            break
        m = _TOKEN.match(page, start)
        if not m:  # a lone sign
            if not last().dropped:
                text.append("<")
            at = start + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3] or ""
        block = tag not in _INLINE
        if m[1]:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            elif block and not last().dropped:
                flush()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in _UNSEEN:  # no part of the page's flow, so it doesn't end the block around it
            found = _end_of(tag).search(page, at)
            at = found.end() if found else end
            continue
        if block and not last().dropped:
            flush()
        ends = _CLOSES.get(tag, frozenset()) | (_PARAGRAPH if block else frozenset())
        if any(opened[name] for name in ends):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in _SCOPE:
                    break
        if tag in _VOID or attrs.rstrip().endswith("/"):
            continue
        if tag in _RAW:
            found = _end_of(tag).search(page, at)
            at = found.end() if found else end
            continue
        f = last()
        dropped = f.dropped or _label(tag, attrs, bool(f.part))
        own = f.container
        if tag in _CONTAINER:
            containers += 1
            own = containers
        path = paths.setdefault((f.path, tag), len(paths) + 1) if block else f.path
        stack.append(Frame(tag, path, own, dropped, f.part or (own if tag in ("article", "main") else 0)))
        opened[tag] += 1
    if last().dropped:
        close(0)
    flush()
    return out


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}\b[^>]*>?", re.I)


def kept_blocks(blocks: list[Block]) -> np.ndarray:
    """Which blocks their tag paths' ratios, smoothed along the page and fused by container, keep."""
    _, path = np.unique([b.path for b in blocks], return_inverse=True)
    size = np.array([len(b.text) for b in blocks], dtype=float)
    stops = np.array([sum(map(b.text.count, _STOPS)) for b in blocks], dtype=float)
    nodes = np.bincount(path)
    ratio = (np.bincount(path, size) / nodes * (1 + np.bincount(path, stops) / nodes))[path]
    wide = np.concatenate([ratio[:1], ratio, ratio[-1:]])
    smooth = (wide[:-2] + 2 * wide[1:-1] + wide[2:]) / 4
    part = np.array([b.part for b in blocks])
    _, own = np.unique([b.container for b in blocks], return_inverse=True)
    _, box = np.unique([b.part or b.container for b in blocks], return_inverse=True)
    fused = np.bincount(box, smooth * size)
    keep = fused[box] * np.where(part > 0, _BONUS, 1) >= fused.std()
    mean = np.bincount(own, smooth * size) / np.bincount(own, size)
    for p in np.unique(part[part > 0]):
        inside = part == p
        keep[inside] &= mean[own[inside]] * _BONUS >= mean[np.unique(own[inside])].std()
    return keep


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, k in zip(blocks, kept_blocks(blocks), strict=True) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """The pages with text (the main text) and n_chars."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(main_text, na_action=None)

    kept = pages.drop("text", "n_chars")
    return kept.withColumn("text", run(F.coalesce(F.col("html").cast("string"), F.lit("")))).withColumn("n_chars", F.length("text").cast("long"))


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
