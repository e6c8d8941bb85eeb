"""Main text of raw web pages by line-block distribution.

Markup is stripped into lines: every block element and line break ends a line, inline elements don't.
Elements that are never part of an article (scripts, styles, menus, page headers and footers, sidebars,
forms, notices, adverts, reader comments; by element, role, class or id) leave one empty line. A line's
weight is its text outside links and nothing if it is mostly links; in an article or main element it weighs
``ARTICLE_BONUS`` times as much. Weights are summed over windows of ``WINDOW`` lines, which end where such an element
begins or ends; where the sums rise from zero there is a surge, where they fall back to zero a dive.
Text between a surge and its dive is kept, whole and in page order, if its highest sum reaches
``SURGE`` (or the page's highest sum, if that is less), inside and outside of such elements.

Each page is handled by itself in one task, in time linear in its length for ordinary markup; nothing is
exchanged between tasks.

Defined results: a null or empty page, or one without such text, gives an empty string; unclosed
elements end where their parent does, an unclosed comment or script at the page's end; repeated rows
are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
ARTICLE_BONUS = 2

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+)>|<[/!?][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+(?:>|\Z)|<|[^<]++""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Fixed element names, by what they do to the text.
RAW = frozenset("script style title textarea template noscript xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("nav footer aside form menu dialog button select option datalist svg canvas object audio video head".split())
ARTICLE = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Words of class and id names that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation navi footer cookie cookies consent gdpr notice notification"
    " popup modal overlay share sharing social related recommended newsletter subscribe subscription paywall breadcrumb breadcrumbs comment comments disqus replies respond pagination pager"
    " widget widgets toolbar masthead topbar login signin signup search".split()
)
#: Words of class and id names that mark containers of the article, whatever else they say.
CONTAINERS = frozenset("content main article body wrapper wrap container layout page post entry story text".split())
#: Words that make a class name a state of a container: no-sidebar, page-with-menu.
STATES = frozenset("no has with without".split())
#: Words of marks that name a building block as well.
BLOCKS = frozenset("widget widgets".split())
#: A header of these belongs to the article.
TITLED = frozenset("article post entry story content body text".split())
COMMENTS = frozenset("comment comments disqus replies respond".split())


def _dropped(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element's text is not part of an article."""
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if not attrs.strip() or name in ("html", "body", *ARTICLE):
        return False
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "") or found.get("role") in ROLES:
        return True
    names = [re.findall(r"[a-z]+", x) for x in (found.get("class", "") + " " + found.get("id", "")).split()]
    words = {word for name_ in names for word in name_}
    if words & COMMENTS:
        return True
    for name_ in names:  # a name says by its last word what it is: main-nav, page-footer
        if name_ and not STATES & set(name_) and (name_[-1] in MARKS - BLOCKS or name_[-1] == "header" and not in_article and not TITLED & set(name_)):
            return True
    return bool(words & MARKS) and not words & CONTAINERS


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """Lines ``(text, weight, in an article element)`` of a page; dropped elements are empty lines."""
    out: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    plain = linked = 0
    open_: list[tuple[str, bool, bool]] = []  # name, dropped, article
    links = dropping = articles = 0

    def end_line() -> None:
        nonlocal plain, linked
        text = " ".join("".join(parts).split())
        if text or not out or out[-1][0]:
            out.append((text, plain if plain >= linked else 0, articles > 0))
        parts.clear()
        plain = linked = 0

    def pop(to: int) -> None:
        nonlocal dropping, articles
        while len(open_) > to:
            name, dropped, article = open_.pop()
            if name not in INLINE:
                end_line()
            dropping -= dropped
            articles -= article

    at, size = 0, len(html)
    while at < size:
        m = TOKEN.match(html, at)
        at = m.end()
        name = m["name"]
        if name is None:
            token = m[0]
            if not dropping and (token[0] != "<" or token == "<"):
                text = unescape(token)
                parts.append(text)
                n = len(text.strip())
                if links:
                    linked += n
                else:
                    plain += n
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == name:
                        if open_[k][1]:
                            pop(k)
                        break
                    if open_[k][0] not in INLINE:
                        break
            else:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == name:
                        pop(k)
                        break
                    if open_[k][0] in ARTICLE and name in ("p", "li", "b"):
                        break
                end_line()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            if name == "title":
                end_line()
            continue
        if name in VOID:
            if name in ("br", "hr"):
                end_line()
            continue
        if name == "a":
            links += 1
        if name not in INLINE:
            # a new block ends an open paragraph, an item the item before it
            for k in range(len(open_) - 1, max(-1, len(open_) - 4), -1):
                if open_[k][0] == "p" or open_[k][0] == name and name in ("li", "dt", "dd", "tr", "td", "th"):
                    pop(k)
                    break
                if open_[k][0] not in INLINE:
                    break
            end_line()
        if m["attrs"].rstrip().endswith("/") and name not in INLINE:
            continue
        dropped = not dropping and _dropped(name, m["attrs"], articles > 0)
        if name not in INLINE or dropped:
            if dropped and name in INLINE:
                parts.append(" ")
            article = name in ARTICLE and not dropping
            open_.append((name, bool(dropped), article))
            dropping += bool(dropped)
            articles += article
    end_line()
    return out


def extract(html: str | None) -> str:
    """The main text of one page: its blocks joined by line feeds."""
    lines = lines_of(html) if html else []
    weight = [w * (ARTICLE_BONUS if article else 1) for _, w, article in lines]
    same = lambda a, b: lines[a][2] == lines[b][2]
    sums, ends = [0] * len(lines), len(lines)
    for at in range(len(lines) - 1, -1, -1):
        if at + 1 < ends and not same(at, at + 1):
            ends = at + 1
        sums[at] = sum(weight[at : min(at + WINDOW, ends)])
    least = min(SURGE, max(sums, default=0))
    kept: list[str] = []
    at = 0
    while at < len(lines):
        if not sums[at]:
            at += 1
            continue
        dive = at
        while dive < len(lines) and sums[dive] and same(at, dive):
            dive += 1
        if max(sums[at:dive]) >= least:
            kept += [text for text, _, _ in lines[at:dive] if text]
        at = dive
    return "\n".join(kept)


def extract_pages(pages: DataFrame, html_col: str = "html", to: str = "main_text") -> DataFrame:
    """``pages`` with the main text of column ``html_col`` as column ``to``."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pages_.map(extract).astype(object)

    return pages.withColumn(to, run(F.col(html_col).cast("string")))


def digest(pages: DataFrame) -> DataFrame:
    return extract_pages(pages.select("page_id", "url", "html"), to="html").select("page_id", "url", F.col("html").alias("text"), F.length("html").cast("long").alias("n_chars"))
