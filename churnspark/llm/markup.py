"""The text lines of an HTML page, each with the region it stands in.

A line is the text between two borders of block elements: character references decoded, runs of
white space turned into one space, trimmed; empty ones are left out. Elements that are not shown
give no lines; elements that are no main text by their name or by a word of their class, id or
role are the page's frame. End tags may be missing, as far as HTML lets them be.
"""

from __future__ import annotations

import html
import re

# Names of HTML elements, and words by which pages name their regions.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
_RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
_HIDDEN = _RAW | frozenset("audio canvas datalist head map math object svg template video".split())
_FRAMING = frozenset("aside button dialog footer form menu nav search select".split())
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"},
}
_LISTS = frozenset("ul ol dl menu table div section article main body".split())
_REGIONS = frozenset(
    "ad ads advert advertisement advertisements adverts advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted "
    "related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Of these, what holds articles of its own that are not the page's.
_CLOSED = frozenset("ad ads advert advertisement advertisements adverts advertising comment comments disqus respond related".split())
# These stand for the page's own only outside an article.
_OUTER = frozenset("header footer masthead".split())
_ROLES = frozenset("banner complementary contentinfo dialog form navigation search alert".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![A-Za-z]))[^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_HIDING = re.compile(r"(?:^|[\s\"'/])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true)", re.IGNORECASE)
_MAIN_ROLE = re.compile(r"(?:^|[\s\"'/])role\s*=\s*[\"']?main\b", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")

FRAME, OUTSIDE, MAIN, ARTICLE = range(-1, 3)
# A frame that an article inside it leaves again: wrappers are named after parts that they also hold.
_WRAPPER = FRAME - 1


def _framing(name: str, attributes: str, inside: int) -> int | None:
    """``FRAME`` if an element and all it holds is no main text, ``_WRAPPER`` if articles in it may be, else None."""
    if name in _FRAMING or (name == "header" and inside != ARTICLE):
        return FRAME
    if not attributes or name in ("html", "body"):
        return None
    found = None
    for key, value in _NAMED.findall(attributes):
        value = value.lower().strip("\"'")
        words = set(_WORD.findall(value))
        if key.lower() == "role":
            if words & _ROLES:
                return FRAME
        elif name in ("main", "article"):
            # Only by whole names: "ad-free" is no advert.
            if _REGIONS & set(value.split()):
                return FRAME
        elif words & _CLOSED:
            return FRAME
        elif words & _REGIONS or (inside != ARTICLE and words & _OUTER):
            found = _WRAPPER
    return found


class _Reader:
    """Collects (line, region) while tags and text of a page go by."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int]] = []
        self.text: list[str] = []
        self.open: list[str] = []
        self.hidden = 0  # depth of the outermost open element that is not shown, 0 for none
        self.regions: list[int] = [OUTSIDE]

    def end_line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            self.text = []
            if line:
                self.lines.append((line, max(self.regions[-1], FRAME)))

    def add(self, text: str) -> None:
        if text and not self.hidden:
            self.text.append(html.unescape(text) if "&" in text else text)

    def _close_to(self, depth: int) -> None:
        """Close all elements from this depth on."""
        if any(name in _BLOCK for name in self.open[depth:]):
            self.end_line()
        del self.open[depth:], self.regions[depth + 1 :]
        if self.hidden > depth:
            self.hidden = 0

    def start(self, name: str, attributes: str) -> None:
        if name in _BLOCK:
            self._close_implied(name)
            self.end_line()
        elif name == "br":
            self.add(" ")
        if name in _VOID:
            return
        inside = self.regions[-1]
        self.open.append(name)
        if not self.hidden and (name in _HIDDEN or _HIDING.search(attributes)):
            self.hidden = len(self.open)
        frame = FRAME if inside == FRAME else _framing(name, attributes, inside)
        if frame is not None:
            inside = frame
        elif name == "article":
            inside = ARTICLE
        elif name == "main" or _MAIN_ROLE.search(attributes):
            inside = max(inside, MAIN)
        self.regions.append(inside)

    def _close_implied(self, name: str) -> None:
        closes = _ENDS.get(name, frozenset())
        at = len(self.open) - 1
        while at >= 0:
            here = self.open[at]
            if here == "p" or here in closes:
                self._close_to(at)
            elif here in _BLOCK and (not closes or here in _LISTS or here in _ENDS):
                break
            at -= 1

    def end(self, name: str) -> None:
        if name == "p" and "p" not in self.open:
            self.end_line()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at] == name:
                self._close_to(at)
                return
            # An inline end tag does not reach over a block's border.
            if name not in _BLOCK and self.open[at] in _BLOCK:
                return


def page_lines(page: str) -> list[tuple[str, int]]:
    """(line, region) in page order; regions: ``ARTICLE``, ``MAIN``, ``OUTSIDE`` of both, or ``FRAME``."""
    reader = _Reader()
    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if not found:
            reader.add(page[at:])
            break
        reader.add(page[at : found.start()])
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            reader.end(name)
            continue
        reader.start(name, attributes)
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = close.end() if close else size
            reader.end(name)
    reader.end_line()
    return reader.lines
