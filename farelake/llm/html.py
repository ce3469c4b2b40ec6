"""Main text of web pages: structure first, repeated runs of a host for the rest.

A page is read as a stream of blocks. Structure settles most of them: what lies in
menus, headers, footers, sidebars, forms, scripts and the like is no text, and
neither is anything whose class, id or role says so; where a page marks its article
(``article``, or without one ``main`` or that role), exactly the rest of it is the text.
An article is kept whole even if other pages hold the same one.

Names say so as whole words of a class or id: ``sidebar``, ``site-nav`` or ``adSlot``, but not
``has-sidebar``, ``no-sidebar`` or ``comments-closed``, which tell how a page looks. They never
send away the page itself or a heading, and inside an article ids are places to link to and only
classes of sections count. A form that holds the article is a wrapper. Where names or forms would
leave nothing of an article that a page marks, they are not believed about what holds it.

Pages that mark no article leave blocks open. For these the token streams of all
pages of a host are compared (:mod:`farelake.llm.runs`; a token is the digest of a
block): runs of blocks with ``LEAST_WORDS`` words or more that occur on pages of the
host with ``LEAST_CONTENTS`` different contents or more are boilerplate, open blocks
covered by one are removed, and the runs that are left are the text. The content of a
page is its article, or else its open blocks; copies of a page are one content however
many ids they have, and a passage that only two contents share stays.

Null and empty pages have an empty text. Broken markup is read as browsers do:
missing end tags are implied, stray ones ignored, a comment or script without an end
reaches to the end of the page. A null url is a host of its own. Rows of the same id
and html are one page read twice. Pages of any length are read whole.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from numpy.typing import NDArray
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import KEY, key_of, materialize
from farelake.llm.runs import all_runs, in_class_of_contents, tight_runs

LEAST_WORDS = 5
#: Two contents can't tell what a host says everywhere from a passage that one took over.
LEAST_CONTENTS = 3
#: Most pages with open blocks to remove that are sent to every task; more are joined.
BROADCAST_PAGES = 20_000

# Names of elements and words that tell what an element is for.
SKIPPED = set("script style title textarea noscript template iframe object svg math".split())
CHROME = set("nav footer aside button select dialog menu head".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
TELLS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment "
    "comments disqus reply replies discussion related recommended share sharing social widget "
    "pagination pager login search".split()
)
#: Beside a tell, these make a name that tells how a page looks, not what an element is for.
STATES = set(
    "has have with without no not is hide hides show shows open opened closed enabled disabled "
    "allowed none off on free active inactive".split()
)
#: Elements whose classes count inside an article, and those whose ids do.
SECTIONS = set("div section ul ol dl table figure span p header".split())
PARTS = set("div ul ol".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 html body".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
IMPLIED_END = {"li": {"ul", "ol", "menu"}, "p": set(), "td": {"table"}, "th": {"table"}}
IMPLIED_END |= {"tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?![\w-])""",
    re.I,
)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAME_PARTS = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Zones of a page. What is DOUBTED by its name is away unless that leaves no article, and
#: what is WRAPPED in a form unless it is an article.
ARTICLE, MAIN, OPEN, AWAY, DOUBTED, WRAPPED = 3, 2, 1, 0, -1, -2


def _tells(value: str) -> bool:
    """Whether a class or id has a word that says what its element is for."""
    for word in value.split():
        parts = [part for part in _NAME_PARTS.split(_HUMP.sub(" ", word).lower()) if part]
        if not TELLS.isdisjoint(parts) and STATES.isdisjoint(parts):
            return True
    return False


def _purpose(name: str, attributes: str, in_article: bool) -> int:
    """What an element makes of its content; OPEN is as its parent."""
    if name == "form":
        return WRAPPED
    if name in CHROME or name == "header" and not in_article:
        return AWAY
    found = {"article": ARTICLE, "main": MAIN}.get(name, OPEN)
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                inner = SECTIONS if key == "class" else PARTS
                named = name in inner if in_article else name not in HEADINGS
                if named and _tells(value):
                    return AWAY if in_article else DOUBTED
                continue
            value = value.lower()
            if key == "role":
                if value in ROLES:
                    return AWAY
                found = max(found, MAIN) if value == "main" else found
            elif key == "style":
                if _HIDDEN.search(value):
                    return AWAY
            elif value in ("", "true", "hidden"):
                return AWAY
    return found


def blocks_of(html: str | None) -> list[tuple[str, int]]:
    """Text and zone of each block of a page, in order; blocks without text are left out."""
    blocks, doubted = _blocks_of(html or "", believe=True)
    if doubted and best_zone(blocks) < MAIN:
        blocks, _ = _blocks_of(html or "", believe=False)
    return blocks


def _blocks_of(html: str, believe: bool) -> tuple[list[tuple[str, int]], bool]:
    """The blocks, and whether a name sent an article away.

    Unless names are believed, an article inside what they send away is one all the same.
    """
    doubted = False
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, and the zone inside each
    zone, at = OPEN, 0

    def end_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append((text, zone))

    while True:
        tag = _TAG.search(html, at)
        if (end := tag.start() if tag else len(html)) > at:
            text = html[at:end]
            pieces.append(unescape(text) if "&" in text else text)
        if tag is None:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS or open_at is not None and stack[open_at][1] != zone:
                end_block()
            if open_at is not None:
                del stack[open_at:]
                zone = stack[-1][1] if stack else OPEN
            continue
        if name in SKIPPED:
            if not tag[3].endswith("/"):
                close = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.I).search(html, at)
                at = close.end() if close else len(html)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCKS:
            end_block()
            implied = "p" if name not in IMPLIED_END else name
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in (implied, "p"):
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS:
                    break
            zone = stack[-1][1] if stack else OPEN
        if name in VOID or tag[3].endswith("/"):
            continue
        purpose = _purpose(name, tag[3], zone >= MAIN)
        if zone <= AWAY:
            inside = zone
            if purpose == AWAY or purpose == DOUBTED and zone == WRAPPED:
                inside = purpose
            elif purpose >= MAIN and zone == DOUBTED:
                doubted = True
                inside = zone if believe else purpose
            elif purpose >= MAIN and zone == WRAPPED:
                inside = purpose
        else:
            inside = purpose if purpose <= AWAY else max(zone, purpose)
        if inside != zone and name not in BLOCKS:
            end_block()
        stack.append((name, inside))
        zone = inside
    end_block()
    return [(text, max(zone, AWAY)) for text, zone in out], doubted


def host_of(url: str | None) -> str:
    """Host of a url in lower case; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def best_zone(blocks: list[tuple[str, int]]) -> int:
    """The zone the main text is in: the article, else what is marked as main, else open."""
    return max((zone for _, zone in blocks), default=AWAY)


def _settled(blocks: list[tuple[str, int]]) -> bool:
    """Whether structure leaves no block open: the page marks its main text, or has none."""
    return best_zone(blocks) != OPEN


def _runs_of(row: dict) -> tuple[NDArray, NDArray, NDArray, int]:
    every = blocks_of(row["html"])
    blocks = [b for b in every if b[1] < MAIN]
    if not blocks:
        return np.empty(0, int), np.empty(0, int), np.empty((0, 2), np.uint64), 0
    best = best_zone(every)
    content = xxhash.xxh3_64_intdigest("\n".join(t for t, zone in every if zone == best))
    host = host_of(row["url"]).encode()
    digests = b"".join(xxhash.xxh3_128_digest(host + b" " + b[0].encode()) for b in blocks)
    weights = np.array([len(text.split()) for text, _ in blocks])
    tokens = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return *tight_runs(tokens, weights, LEAST_WORDS), content - (1 << 63)


def repeated_blocks(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``runs`` (starts and ends in turn, over blocks outside articles) that pages of the
    host with other contents have too, for pages that structure doesn't settle."""
    runs = all_runs(pages, _runs_of, ["url", "html"], content=True)
    rows = materialize(spark, runs, "page-runs")
    found = in_class_of_contents(spark, rows, LEAST_CONTENTS).groupBy(*KEY)
    return found.agg(F.flatten(F.collect_list(F.array("start", "end"))).alias("runs"))


def _is_open(htmls: pd.Series) -> pd.Series:
    return htmls.map(lambda html: not _settled(blocks_of(html))).astype(bool)


def _texts(htmls: pd.Series, runs: pd.Series) -> pd.Series:
    def text(html: str | None, flat: NDArray | None) -> str:
        blocks = blocks_of(html)
        best = best_zone(blocks)
        if best >= MAIN:
            return " ".join(text for text, zone in blocks if zone == best)
        covered: set[int] = set()
        if flat is not None:
            for start, end in zip(flat[::2], flat[1::2]):
                covered.update(range(start, end))
        kept = (text for i, (text, zone) in enumerate(blocks) if zone == OPEN and i not in covered)
        return " ".join(kept)

    return pd.Series([text(h, r) for h, r in zip(htmls, runs)], dtype=object)


def main_text(
    spark: SparkSession,
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars`` (code points)."""
    rows = pages.select(
        *key_of(id_col, html_col),
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    is_open, text = F.pandas_udf(_is_open, "boolean"), F.pandas_udf(_texts, "string")
    repeated = repeated_blocks(spark, rows)
    open_pages = rows.where(is_open("html")).select(*KEY).distinct()
    needed = materialize(spark, repeated.join(open_pages, KEY), "page-boilerplate")
    if needed.count() <= BROADCAST_PAGES:
        needed = F.broadcast(needed)
    made = rows.join(needed, KEY, "left")
    made = made.select("page_id", "url", text("html", "runs").alias("text"))
    return made.select("*", F.char_length("text").cast("bigint").alias("n_chars"))
