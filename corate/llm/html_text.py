"""Main text of web pages by line-block distribution.

A page is cut into lines at its block elements; markup, scripts, styles and
comments go, and so do elements that by their name, role or class are not
article text (menus, footers, adverts, forms, reader comments ...).  Over the
lines the distribution of text is summed in sliding windows, with link texts
counted as nothing.  Text starts where the sum surges and ends where it dives to
zero; the lines in between are kept.
Where a page marks its article (``article``, ``main``) the mark is a weight: windows do not reach over its borders, a line
inside counts ``surge`` signs more than it has, so the least text there surges, and lines outside have
to reach ``OUTSIDE`` times as much.  A teaser in a mark thus does not hide a long text beside it.

Reading a page takes time in proportion to its length, also where nothing in it is ever closed.

Pages are independent of each other, so rows stay where they are: no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import fresh, with_columns_last

# Element names of HTML, and words that sites use for classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
DROPPED = frozenset(
    "nav footer aside form head script style noscript template iframe object svg canvas math audio video select "
    "textarea button fieldset dialog menu title applet map datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments commentlist "
    "disqus replies respond footer masthead toolbar pagination pager widget copyright disclaimer skip".split()
)
# Containers whose class never makes them something else than the page itself.
NEVER = frozenset("html body article main".split())
ARTICLE = frozenset("article main".split())
# Names that also describe the layout of a wrapper ("with-sidebar"): an article in it is still one.
LAYOUT = frozenset("sidebar menu nav navbar masthead banner footer toolbar widget share sharing social skip copyright overlay".split())

# How much more than inside text outside of a mark must surge; and signs that an ASCII word counts at most.
OUTSIDE = 3
LONGEST_WORD = 40

_OPEN = re.compile(r"<!--|<!\[CDATA\[|<(script|style|textarea|title|noscript|iframe|template)\b", re.I)
# A quoted value may hold a ">"; a quote that opens no value, or is never closed, is a sign like others.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>|<[/!?][^>]*+>""")
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_TOKEN = re.compile(r"[a-z0-9]+")


def without_raw(page: str) -> str:
    """The page without comments, CDATA sections and elements whose content is no markup; what is never closed takes the rest.

    A CDATA section or a tag that is never closed is left as it is, and looked for only once.
    """
    parts, at, look = [], 0, 0
    sections = tags = True
    while (found := _OPEN.search(page, look)) is not None:
        begin, name = found.start(), found[1]
        if name is not None:
            close = page.find(">", found.end()) if tags else -1
            if close < 0:
                tags, look = False, found.end()
                continue
            end = re.compile(rf"</{name}\s*>", re.I).search(page, close + 1)
            stop = end.end() if end else len(page)
        elif page.startswith("<!--", begin):
            close = page.find("-->", begin + 4)
            stop = close + 3 if close >= 0 else len(page)
        else:
            close = page.find("]]>", found.end()) if sections else -1
            if close < 0:
                sections, look = False, found.end()
                continue
            stop = close + 3
        parts.append(page[at:begin])
        at = look = stop
    return "".join(parts) + page[at:]


# What an element is: text, a wrapper whose name says otherwise but that may hold an article, or no article text at all.
TEXT, WRAPPER, BOILERPLATE = 0, 1, 2


def _boilerplate(name: str, attributes: str, in_article: bool) -> int:
    if name in DROPPED or (name == "header" and not in_article):
        return BOILERPLATE
    if name in NEVER and "comment" not in attributes.lower() or not attributes:
        return TEXT
    wrapper = False
    for key, value in _ATTR.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            words = set(_TOKEN.findall(_CAMEL.sub(" ", value).lower()))
            if words & NAMES - LAYOUT:
                return BOILERPLATE
            wrapper = wrapper or bool(words & NAMES)
        elif key == "role" and value.lower() in ROLES:
            return BOILERPLATE
        elif key == "aria-hidden" and value.lower() == "true":
            return BOILERPLATE
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return BOILERPLATE
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        return BOILERPLATE
    return WRAPPER if wrapper else TEXT


def _weight(text: str) -> int:
    """The signs of a text; of a long run of ASCII signs only the first count."""
    return sum(min(len(w), LONGEST_WORD) if w.isascii() else len(w) for w in text.split(" ")) + text.count(" ")


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """The lines of a page: text, its length without links, whether it is inside an article."""
    page = without_raw(page)
    lines: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, int, bool]] = []  # name, what it is, article
    depth: Counter[str] = Counter()  # open elements by name
    parts: list[str] = []
    linked = 0
    in_link = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, max(0, _weight(text) - linked), bool(stack) and stack[-1][2]))
        parts.clear()
        linked = 0

    def pop() -> str:
        name = stack.pop()[0]
        depth[name] -= 1
        return name

    def read(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1][1]):
            parts.append(text)
            if in_link:
                linked += _weight(text.strip())

    at, last = 0, page.rfind(">")
    while True:
        start = page.find("<", at)
        if start < 0 or start > last:
            read(page[at:])
            break
        found = _TAG.match(page, start)
        if found is None:  # a bare sign, part of the text
            read(page[at : start + 1])
            at = start + 1
            continue
        read(page[at:start])
        at = found.end()
        if not found[2]:
            continue
        name, closing = found[2].lower(), bool(found[1])
        if name == "br":
            read(" ")
        elif name == "a":
            in_link = not closing and "href" in found[3].lower()
        if name in INLINE and not (name == "span" and not closing and _boilerplate(name, found[3], False)):
            if name == "span" and closing and stack and stack[-1][0] == "span":
                pop()
            continue
        if name != "span":
            in_link = False  # a link that is never closed ends with its block
        if closing:
            if depth[name]:
                flush()
                while pop() != name:
                    pass
            elif not (stack and stack[-1][1]):
                flush()
            continue
        inside, article = stack[-1][1:] if stack else (TEXT, False)
        if not inside and name != "span":
            flush()
        if stack and stack[-1][0] == "p" and name != "span":  # a block element ends an open paragraph
            pop()
            inside, article = stack[-1][1:] if stack else (TEXT, False)
        if name in VOID or found[3].rstrip().endswith("/"):
            continue
        own = _boilerplate(name, found[3], article)
        what = own if inside == WRAPPER and name in ARTICLE else max(inside, own)
        stack.append((name, what, what == TEXT and (article or name in ARTICLE)))
        depth[name] += 1
    if not (stack and stack[-1][1]):
        flush()
    return lines


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The main text: blocks in page order, joined by an empty line."""
    if not page:
        return ""
    lines = page_lines(page)
    # Stretches of lines inside and outside of marks; without any mark the page is one stretch.
    marked = any(inside for _, _, inside in lines)
    stretches = [list(g) for _, g in groupby(lines, key=lambda x: x[2])]
    kept: list[str] = []
    best = max((s for g in stretches for s in _sums([x[1] for x in g], window)), default=0)
    for stretch in stretches:
        inside = stretch[0][2]
        sizes = [surge + len(text) if inside else size for text, size, _ in stretch]
        least = surge if inside else OUTSIDE * surge if marked else min(surge, best)
        kept += _surges([x[0] for x in stretch], sizes, window, least)
    return "\n\n".join(kept)


def _sums(sizes: list[int], window: int) -> list[int]:
    return [sum(sizes[i : i + window]) for i in range(len(sizes))]


def _surges(texts: list[str], sizes: list[int], window: int, surge: int) -> list[str]:
    """The texts from each line on whose window surges to the one where it dives to zero."""
    sums = _sums(sizes, window)
    kept: list[str] = []
    at = 0
    while at < len(sizes):
        if sizes[at] == 0:
            at += 1
            continue
        dive = at
        while dive < len(sizes) and sums[dive] > 0:
            dive += 1
        if max(sums[at:dive]) >= surge:
            kept += texts[at:dive]
        at = dive
    return kept


def extract_main_text(df: DataFrame, html_col: str = "html", window: int = 3, surge: int = 80) -> DataFrame:
    """``df`` with text and n_chars (its code points) in the place of ``html_col``.

    Null or empty html, and pages without text, give an empty text.  Character
    references are decoded; white space inside a block becomes one space.  Text
    is never cut.  Input columns named text or n_chars are replaced; an empty
    table gives an empty result.
    """

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: main_text(page if isinstance(page, str) else None, window, surge))

    name = fresh("_text", df)
    read = df.withColumn(name, extract(F.col(html_col)))
    result = with_columns_last(read, {"text": F.col(name), "n_chars": F.char_length(name).cast("long")})
    return result.drop(name, html_col)
