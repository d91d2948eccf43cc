"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one per block of the page. Lines of elements that never belong to the
article (navigation, headers, footers, forms, adverts, comments and the like) count as text of length
0. Over sliding windows of ``WINDOW`` lines the lengths are summed; a surge is the first window that
rises above ``RISE`` times the page's mean window, the matching dive is where windows fall to zero. Text
between a surge and its dive is kept. Every page goes this way. Elements that mark an article are
evidence in the lengths: one that holds most of the page's text lengthens its lines and shortens the
others, so that short paragraphs at its edges stay.

Cases: null and empty html give an empty text; pages are read whole; unclosed and stray tags are
tolerated, and so are markup in attributes, comments and scripts; equal pages give equal results; an
empty table gives an empty result; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

WINDOW = 3
#: A window is a surge from this share of the mean over the windows that hold text.
RISE = 0.3

#: Elements whose content is no text at all.
_SILENT = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "head", "title", "textarea", "select", "button")
#: Elements that are never the article.
_APART = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "figcaption", "label"))
#: The same by class, id or role.
_APART_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar|"
    r"footer|header|masthead|comments?|disqus|replies|respond|cookies?|consent|gdpr|notices?|alerts?|popup|modal|"
    r"newsletter|subscribe|subscription|share|social|related|recommend\w*|search\w*|login|signup|toolbar|widget|"
    r"contentinfo|navigation|complementary|dialog)(?:$|[\s_-])",
    re.I,
)
_BLOCKS = frozenset(
    ("address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt",
     "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section",
     "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
) | _APART
_VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
#: Opening one of these closes an open one of the same set, within the nearest block that holds it.
_SELF_CLOSING = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(" + "|".join(_SILENT) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.I | re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACE = re.compile(r"\s+")


def lines(page: str) -> list[tuple[str, bool, int]]:
    """(text, apart, marked element it lies in or -1) of each block line, in page order."""
    out: list[tuple[str, bool, int]] = []
    held: list[str] = []
    open_: list[tuple[str, bool, int]] = []  # element, apart, marked element
    marks = 0

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append((text, any(a for _, a, _ in open_), next((m for _, _, m in open_ if m >= 0), -1)))

    at = 0
    for m in _TOKEN.finditer(page):
        held.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in _BLOCKS:
            flush()
        if m[2]:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if depth is not None:
                del open_[depth:]
            continue
        if name in _VOID or m[4].rstrip().endswith("/") and name not in _BLOCKS:
            continue
        if name in _SELF_CLOSING and open_ and open_[-1][0] == name:
            open_.pop()
        names = " ".join(a or b or c for a, b, c in _NAMED.findall(m[4]))
        apart = name in _APART or bool(names and _APART_NAMES.search(names)) or bool(_HIDDEN.search(m[4]))
        if name in ("html", "body", "main", "article"):
            apart = False
        marked = name in ("article", "main") or "articlebody" in m[4].lower()
        open_.append((name, apart, marks if marked else -1))
        marks += marked
    held.append(page[at:])
    flush()
    return out


def _window_sums(lengths: np.ndarray, window: int) -> np.ndarray:
    padded = np.append(lengths, np.zeros(window - 1, dtype=lengths.dtype))
    return np.convolve(padded, np.ones(window, dtype=lengths.dtype), "valid")


def surges(lengths: np.ndarray, window: int = WINDOW, rise: float = RISE, mean: float | None = None) -> np.ndarray:
    """Which lines lie between a surge point and its dive point.

    ``mean``: the page's mean window, if it is not that of ``lengths``.
    """
    keep = np.zeros(len(lengths), dtype=bool)
    if not lengths.any():
        return keep
    sums = _window_sums(lengths, window)
    limit = rise * (sums[sums > 0].mean() if mean is None else mean)
    inside = False
    for i, total in enumerate(sums):
        if not inside and total >= limit and lengths[i] > 0:
            inside = True
        elif inside and total == 0:
            inside = False
        keep[i] = inside
    return keep & (lengths > 0)


def weighted_lengths(found: list[tuple[str, bool, int]], window: int = WINDOW) -> tuple[np.ndarray, float]:
    """Line lengths with the page's marks as evidence, and the mean window of the lengths without.

    A mark counts as far as its element holds the page's text. Lines of the element with the most text
    are at least its share of the mean window long, and as much of other lines' length is taken off, so
    a mark on a teaser changes little and the element of the whole article shows in its shortest lines.
    """
    plain = np.array([0 if apart else len(text) for text, apart, _ in found], dtype=np.int64)
    if not plain.any():
        return plain, 0.0
    sums = _window_sums(plain, window)
    mean = float(sums[sums > 0].mean())
    mark = np.array([m for _, _, m in found], dtype=np.int64)
    if not (plain[mark >= 0] > 0).any():
        return plain, mean
    held = np.bincount(mark[mark >= 0], weights=plain[mark >= 0])
    best = int(held.argmax())
    share = held[best] / plain.sum()
    if share <= 0.5:
        return plain, mean
    inside = np.maximum(plain, math.ceil(share * mean))
    outside = np.maximum(0, plain - int(share * mean))
    return np.where(plain == 0, 0, np.where(mark == best, inside, outside)), mean


def main_text(page: str) -> str:
    found = lines(page)
    lengths, mean = weighted_lengths(found)
    keep = surges(lengths, mean=mean)
    return "\n".join(text for (text, _, _), k in zip(found, keep, strict=True) if k)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def make(htmls: list[str]) -> dict[str, list]:
        texts = [main_text(h) for h in htmls]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_texts(pages.select("page_id", "url", "html"), "text string, n_chars long", make, "html")
