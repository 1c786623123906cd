"""Main text of web pages, by structure and by what repeats across the pages of a host.

A page is cut into blocks. Blocks of an ``article`` or ``main`` element are content, blocks of
menus, headers, footers, forms, adverts and the like are not. All others are undecided: the
token streams of a host's pages outside content make one suffix array, in which the suffixes
that share their first tokens are neighbours. Its intervals are formed by an aggregation over
all suffixes, cut to the length that counts as long: an interval from enough distinct pages
is boilerplate, and what it covers goes from undecided blocks; their unique runs stay. A
hot host is spread over the cluster by its suffixes, as no task has to see a whole host.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import written

RUN_TOKENS = 8
MIN_PAGES = 3

# Elements by role.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
CONTENT = {"article", "main"}
CHROME = {
    "aside", "button", "dialog", "fieldset", "footer", "form", "head", "header", "menu", "nav",
    "select",
}
CHROME_ROLES = {
    "alert", "banner", "complementary", "contentinfo", "dialog", "menu", "menubar",
    "navigation", "search",
}
CHROME_NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "header", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination",
    "popup", "promo", "promoted", "related", "reply", "replies", "share", "sharing", "sidebar",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
OUTSIDE, INSIDE, UNDECIDED = 0, 1, 2
# Outside too, but a wrapper that has a chrome word for a name of its own lets ``main`` come
# back, and one that only has it inside a longer name, or is a form, also ``article``.
NAMED, LOOSE = 3, 4

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
# One attribute after the other, so that nothing inside a value is taken for one.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def page_blocks(text: str | None) -> list[tuple[int, str]]:
    """(zone, text) of each block of a page, in page order."""
    source = text or ""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    zone, at = UNDECIDED, 0

    def close_block():
        if held:
            said = " ".join(html.unescape("".join(held)).split())
            if said:
                out.append((OUTSIDE if zone in (NAMED, LOOSE) else zone, said))
            held.clear()

    while at < len(source):
        found = _TAG.search(source, at)
        if found is None:
            held.append(source[at:])
            break
        held.append(source[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        name, ending = name.lower(), bool(found[1] or found[4])
        if name == "br":
            held.append(" ")
        if name in BLOCK:
            close_block()
        if ending:
            zone = _closed(stack, name)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name in VOID:
            continue
        if name in BLOCK:
            zone = _implied_end(stack, name)
        inner = _zone_of(name, found[3] or found[6] or "", zone)
        if inner != zone:
            close_block()
        zone = inner
        if not (found[3] or found[6] or "").endswith("/"):
            stack.append((name, zone))
        else:
            zone = stack[-1][1] if stack else UNDECIDED
    close_block()
    return out


def _closed(stack: list[tuple[str, int]], name: str) -> int:
    """Drops the elements that an end tag closes; the zone after it."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            break
    return stack[-1][1] if stack else UNDECIDED


def _implied_end(stack: list[tuple[str, int]], name: str) -> int:
    """Ends a paragraph, or an item of the same kind, that a new block ends by rule."""
    for i in range(len(stack) - 1, -1, -1):
        over = stack[i][0]
        if over == "p" or (over == name and name in ("li", "dt", "dd", "option", "tr", "td", "th")):
            del stack[i:]
            break
        if over in BLOCK:
            break
    return stack[-1][1] if stack else UNDECIDED


def _zone_of(name: str, attributes: str, around: int) -> int:
    if around == OUTSIDE:
        return OUTSIDE
    wrapper = around
    if name == "form" and around != INSIDE:
        wrapper = _narrower(around, LOOSE)
    elif name in CHROME and not (name == "header" and around == INSIDE):
        return OUTSIDE
    role = ""
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key == "role":
                role = value
            elif key in ("class", "id") and CHROME_NAMES & set(re.split(r"[\s_-]+", value)):
                if name not in ("html", "body", *CONTENT):
                    if around == INSIDE:
                        return OUTSIDE
                    wrapper = _narrower(wrapper, _named(value))
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                return OUTSIDE
    if role in CHROME_ROLES:
        return OUTSIDE
    kinds = {name, role} & CONTENT
    if wrapper == NAMED:
        return INSIDE if "main" in kinds else NAMED
    return INSIDE if kinds else wrapper


def _narrower(around: int, zone: int) -> int:
    return NAMED if NAMED in (around, zone) else zone


def _named(value: str) -> int:
    """NAMED if one of the names consists of chrome words alone, else LOOSE."""
    names = [set(re.split(r"[_-]+", n)) - {""} for n in value.split()]
    return NAMED if any(n and n <= CHROME_NAMES for n in names) else LOOSE


def extract_pages(
    pages: DataFrame, run_tokens: int = RUN_TOKENS, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages``.

    Character references are decoded, white space inside a block is one space, blocks are
    joined by one line end in page order. Runs of ``run_tokens`` tokens or more that occur on
    ``min_pages`` pages of a host or more count as boilerplate outside content. Null and
    empty pages give an empty text; a null url is a host of its own; repeated rows are pages
    of their own. Other columns are not read; an empty table gives no rows.
    """
    named = pages.select("page_id", "url", "html")
    types = {f.name: f.dataType.simpleString() for f in named.schema}
    schema = (
        f"page_id {types['page_id']}, url {types['url']}, host string, "
        "blocks array<struct<zone:int,text:string>>"
    )
    parsed = named.mapInPandas(_parse, schema).withColumn("row", F.monotonically_increasing_id())
    # Every text is written once here; zstandard makes it smaller than the default would.
    parsed = written(parsed, "page-blocks", compression="zstd")
    marks = written(host_marks(parsed, run_tokens, min_pages), "page-marks")
    undecided = F.exists("blocks", lambda b: b["zone"] == UNDECIDED)
    content = F.transform(F.filter("blocks", lambda b: b["zone"] == INSIDE), lambda b: b["text"])
    plain = parsed.where(~undecided).select("page_id", "url", F.array_join(content, "\n").alias("text"))
    open_pages = parsed.where(undecided).join(marks, "row", "left")
    judged = open_pages.select("page_id", "url", "blocks", "starts").mapInPandas(
        lambda frames: _unique_runs(frames, run_tokens),
        f"page_id {types['page_id']}, url {types['url']}, text string",
    )
    return plain.unionByName(judged).withColumn("n_chars", F.length("text").cast("long"))


def host_marks(parsed: DataFrame, run_tokens: int = RUN_TOKENS, min_pages: int = MIN_PAGES) -> DataFrame:
    """(row, starts): where runs of a page's stream begin that the host's other pages share.

    The streams of all pages count, whatever structure says of their blocks; a page without
    such runs has no row. A suffix goes by a hash of its host and first tokens, so suffixes
    are dealt by their leading tokens and a hot host is spread.
    """
    outside = F.filter("blocks", lambda b: b["zone"] != INSIDE)
    # The stream of a page: the words of its blocks, a line end after each block.
    stream = F.flatten(F.transform(outside, lambda b: F.split(F.concat(b["text"], F.lit(" \n")), " ")))
    streams = parsed.select("host", "row", stream.alias("tokens"))
    keys = F.when(
        F.size("tokens") >= run_tokens,
        F.transform(
            F.sequence(F.lit(0), F.size("tokens") - run_tokens),
            lambda i: F.unhex(
                F.md5(F.concat_ws(" ", "host", F.slice("tokens", i + 1, run_tokens)).cast("binary"))
            ),
        ),
    )
    suffixes = streams.select("row", keys.alias("keys"))
    once = suffixes.select(F.explode(F.array_distinct("keys")).alias("key"))
    shared = once.groupBy("key").agg(F.count(F.lit(1)).alias("n_pages"))
    shared = written(shared.where(F.col("n_pages") >= min_pages), "page-runs")
    placed = suffixes.select("row", F.posexplode("keys").alias("start", "key"))
    hits = placed.join(shared.select(F.col("key").alias("of")), F.col("key") == F.col("of"), "left_semi")
    return hits.groupBy("row").agg(F.collect_list("start").alias("starts"))


def _parse(frames):
    for frame in frames:
        yield pd.DataFrame(
            {
                "page_id": frame["page_id"],
                "url": frame["url"],
                "host": [_host(u) for u in frame["url"]],
                "blocks": [
                    [{"zone": z, "text": t} for z, t in page_blocks(h)] for h in frame["html"]
                ],
            }
        )


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _unique_runs(frames, run_tokens):
    for frame in frames:
        texts = []
        for blocks, starts in zip(frame["blocks"], frame["starts"]):
            covered: set[int] = set()
            for s in [] if starts is None else starts:
                covered.update(range(s, s + run_tokens))
            at, said = 0, []
            for block in blocks:
                if block["zone"] == INSIDE:
                    said.append(block["text"])
                    continue
                words = block["text"].split(" ")
                if block["zone"] == UNDECIDED:
                    kept = " ".join(w for i, w in enumerate(words) if at + i not in covered)
                    if kept:
                        said.append(kept)
                at += len(words) + 1
            texts.append("\n".join(said))
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})
