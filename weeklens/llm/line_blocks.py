"""Main text of web pages by the line-block distribution.

Markup is stripped to lines, one per block element; scripts, styles, menus,
page headers and footers, sidebars, notices, adverts, forms and reader comments
go with it. Over the rest, the text lengths of ``window`` following lines are
summed. Text surges where the sum exceeds ``surge`` and dives where it falls to
``dive`` or below; the lines between a surge and the next dive are main text.
Lines that consist of links count as empty. The few short lines that lead up to
a surge belong to it. Elements a page marks as articles bound the search: where
there are any, text is looked for inside them only, one by one, and surges there
at its first character, so that short lines stay; those in menus or sidebars do
not count.

A class or id that is a notice word, or made of such words alone, marks notices.
One that merely holds such a word ("with-sidebar", "header-fixed") may be the
wrapper of the page, and so may a form: these go unless they hold most of the
page's text.
"""

from __future__ import annotations

import html as htmllib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column

WINDOW = 3
SURGE = 80
DIVE = 0

# Elements and words of class and id attributes.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select option head title".split())
OUT = frozenset("nav footer aside form button menu dialog fieldset label input".split())
MARKED = frozenset(["article", "main"])
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = frozenset(("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
                   "navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget "
                   "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
                   "subscription signup login share sharing social related recommended comment comments disqus "
                   "respond replies pagination pager").split())
READERS = frozenset("comment comments disqus respond replies".split())  # their text may outgrow the page's own
MODIFIERS = frozenset("has have with without no".split())
INLINE_NOISE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


KEPT, PERHAPS, NOISY = 0, 1, 2


def _is_hidden(attributes: str) -> bool:
    for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if hidden or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _names(attributes: str):
    """Class and id names, each as its parts."""
    for name, a, b, c, _ in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in (a or b or c).split():
                yield token, [p.lower() for p in _NAME_PART.findall(token)]


def _noise(attributes: str) -> int:
    if _is_hidden(attributes):
        return NOISY
    for name, a, b, c, _ in _ATTRIBUTE.findall(attributes):
        if name.lower() == "role" and (a or b or c) in (
                "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
            return NOISY
    found = KEPT
    for token, parts in _names(attributes):
        held = [p in NOISE for p in parts]
        if any(held):
            if token.lower() in NOISE or all(held) or (READERS & set(parts) and parts[0] not in MODIFIERS):
                return NOISY
            found = PERHAPS
    return found


def _is_inline_noise(attributes: str) -> bool:
    # an inline element's class says little, but for adverts and buttons
    return _is_hidden(attributes) or any(token.lower() in INLINE_NOISE for token, _ in _names(attributes))


def page_lines(html: str) -> list[tuple[str, int, int]]:
    """(text, length outside links, number of the marked article element or 0) per line of the page."""
    lines: list[tuple[str, int, int, tuple]] = []
    text: list[str] = []
    linked: list[str] = []
    # element, drops its text, article number, and the nearest wrapper and form that go unless they hold most of the page
    stack: list[tuple[str, bool, int, tuple]] = []
    around: list[int] = [0]  # per wrapper or form (0: none) the next one of its kind around it
    skip, article, doubts, articles, links = False, 0, (0, 0), 0, 0

    def close_line():
        if text:
            whole = " ".join(htmllib.unescape("".join(text)).split())
            if whole:
                in_links = len(" ".join(htmllib.unescape("".join(linked)).split()))
                lines.append((whole, len(whole) - in_links, article, doubts))
            text.clear()
            linked.clear()

    def cut(i):
        nonlocal skip, article, doubts
        del stack[i:]
        skip, article, doubts = stack[-1][1:] if stack else (False, 0, (0, 0))

    at, n = 0, len(html)
    while at < n:
        open_ = html.find("<", at)
        if open_ < 0:
            open_ = n
        if open_ > at and not skip:
            text.append(html[at:open_])
            if links:
                linked.append(html[at:open_])
        if open_ >= n:
            break
        m = _TOKEN.match(html, open_)
        if m is None:
            if not skip:
                text.append("<")
            at = open_ + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if name in RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                # its content is no markup up to its own end tag
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else (n if name in ("script", "style") else at)
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name in INLINE:
            within = stack and stack[-1][0] in INLINE  # only those that drop their text, and what they hold, are listed
            if closing and within:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] not in INLINE:
                        break
                    if stack[i][0] == name:
                        cut(i)
                        break
            elif not closing and name not in VOID and (within or (m[3] and not skip and _is_inline_noise(m[3]))):
                skip = True
                stack.append((name, skip, article, doubts))
            continue
        close_line()
        links = 0
        if name in VOID or name in ("html", "body"):
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
                if name in ("p", "li") and stack[i][0] not in INLINE and stack[i][0] != "p":
                    break  # its end was implied before
            continue
        # a block ends an open paragraph, an item the one before it
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == "p" or (name == "li" and stack[i][0] == "li"):
                cut(i)
                break
            if stack[i][0] not in INLINE and not (name == "li" and stack[i][0] not in ("ul", "ol", "menu", *MARKED)):
                break
        noise = _noise(m[3]) if m[3] else KEPT
        perhaps = noise == PERHAPS or name == "form"
        if name in MARKED:
            # what a page marks as its article is one, unless it stands in a menu, footer or sidebar
            hidden = any(s[0] in OUT and s[0] != "form" for s in stack) or noise != KEPT
            articles += 1
            skip, article = bool(hidden), (0 if hidden else (article or articles))
            doubts = (0, doubts[1])
        elif (name in OUT and name != "form") or (name == "header" and not article) or noise == NOISY:
            skip = True
        elif perhaps and not skip:
            around.append(doubts[name == "form"])
            doubts = (doubts[0], len(around) - 1) if name == "form" else (len(around) - 1, doubts[1])
        stack.append((name, skip, article, doubts))
    close_line()
    sizes = [0] * len(around)
    for _, own, _, held in lines:
        for d in held:
            sizes[d] += own
    for d in range(len(around) - 1, 0, -1):
        sizes[around[d]] += sizes[d]
    whole = sum(own for _, own, _, _ in lines)
    gone = [False] * len(around)
    for d in range(1, len(around)):
        gone[d] = gone[around[d]] or sizes[d] * 2 <= whole
    return [(t, own, number) for t, own, number, held in lines if not (gone[held[0]] or gone[held[1]])]


def text_lines(sizes: list[int], window: int = WINDOW, surge: int = SURGE, dive: int = DIVE, bounded: bool = False) -> list[bool]:
    """Which lines are text, by their sizes (0: a line of links).

    A block is the sum over a line and the ``window`` - 1 after it. Text surges at a line of text whose block
    exceeds ``surge`` and dives at the first one after it whose block is ``dive`` or less. Up to ``window`` - 1
    lines before a surge are its run-up (a title and its kin are too short to surge by themselves): as far as
    they are text. In a ``bounded`` search, inside an element that holds text only, lines of links between text
    stay and so do those in a run-up."""
    n = len(sizes)
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    block = [total[min(n, i + window)] - total[i] for i in range(n)]
    keep, inside = [False] * n, False
    for i in range(n):
        if not inside and sizes[i] and block[i] > surge:
            inside = True
            for j in range(i - 1, max(-1, i - window), -1):
                if keep[j] or not (sizes[j] or bounded):
                    break
                keep[j] = True
        if inside and block[i] <= dive:
            inside = False
        keep[i] = inside and (bounded or sizes[i] > 0)
    return keep


def main_text(html: str, window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> str:
    """Kept lines joined by one space."""
    lines = page_lines(html)
    sizes = [own if own * 2 >= len(text) else 0 for text, own, _ in lines]
    if not any(a for _, _, a in lines):
        keep = text_lines(sizes, window, surge, dive)
    else:
        # marked elements bound the search, each by itself; text there surges at its first character
        keep, at = [False] * len(lines), {}
        for i, (_, _, a) in enumerate(lines):
            if a:
                at.setdefault(a, []).append(i)
        for held in at.values():
            whole = sum(len(lines[i][0]) for i in held)
            # one that consists of links holds no text
            some = [sizes[i] if 2 * sum(lines[k][1] for k in held) >= whole else 0 for i in held]
            for i, k in zip(held, text_lines(some, window, 0, dive, bounded=True)):
                keep[i] = k
    return " ".join(text for (text, _, _), k in zip(lines, keep) if k)


def _task(window: int, surge: int, dive: int):
    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), window, surge, dive) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A null html is empty; a page without main text gives an empty text. Null or repeated ids and null urls
    are passed on. An empty table gives an empty result. There is no shuffle: pages are read and worked on
    one by one where they lie.
    """
    rows = pages.select(column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
                        F.coalesce(column(pages, "html", "string"), F.lit("")).alias("html"))
    return rows.mapInArrow(_task(window, surge, dive), "page_id long, url string, text string, n_chars long")
