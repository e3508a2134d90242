"""A small tree of the block elements of an HTML page."""

from __future__ import annotations

import re
from html import unescape

# Fixed values of HTML: elements that are blocks (all others, unknown ones too, stand inside a line), those without
# content, those whose content is no text of the page (raw, or shown only in place of media), those of them that last
# to the end of the page without an end tag, and what an opening tag closes.
BLOCK = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup legend li listing main menu "
                  "nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noframes xmp template svg select "
                "audio canvas video".split())
CODE = frozenset(("script", "style"))
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table body article section div nav aside main header footer form".split())

_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"""
                  r"""([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
# The last slash belongs to the value in <svg a=b/>.
_OPEN_VALUE = re.compile(r"""=\s*[^\s"']*/\Z""")
_TOKEN = re.compile(r"[a-z]+")
_NAMED = ("class", "id", "role", "itemprop")


class Page:
    """Block elements in page order (``tag, parent, depth, tokens``), and runs of text with their element."""

    def __init__(self, html: str):
        self.tag, self.parent, self.depth, self.tokens = ["html"], [-1], [0], [()]
        self.kept: list[bool] = [False]
        self.chars, self.link_chars, self.words = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        # Open elements, and for each tag (and for all scopes) the places of its open elements in that stack.
        self._stack, self._places, self._scopes = [0], {}, [0]
        self._run, self._links = [], 0
        self._read(html)
        self._flush()

    def _open(self, tag: str, attributes: str) -> None:
        self._flush()
        if tag not in ("body", "head"):
            self._close("p")
        for over in CLOSES.get(tag, ()):
            places = self._places.get(over)
            if places and places[-1] > self._scopes[-1]:
                self._close(over)
        named = _ATTRIBUTE.findall(attributes) if "=" in attributes else ()
        tokens = tuple(t for name, value in named if name.lower() in _NAMED for t in _TOKEN.findall(value.lower()))
        self.kept.append(any(name == "data-keep" for name, _ in named))
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.depth.append(len(self._stack))
        self.tokens.append(tokens)
        for counts in (self.chars, self.link_chars, self.words):
            counts.append(0)
        self._places.setdefault(tag, []).append(len(self._stack))
        if tag in SCOPES:
            self._scopes.append(len(self._stack))
        self._stack.append(len(self.tag) - 1)

    def _close(self, tag: str) -> None:
        """Close the innermost open element of that tag, if any, and all inside it; each element is closed once."""
        if not self._places.get(tag):
            return
        self._flush()
        for at in range(len(self._stack) - 1, self._places[tag][-1] - 1, -1):
            closed = self.tag[self._stack.pop()]
            self._places[closed].pop()
            if closed in SCOPES:
                self._scopes.pop()

    def _flush(self) -> None:
        if self._run:
            words = "".join(self._run).split()
            if words:
                text, own = " ".join(words), self._stack[-1]
                self.blocks.append((own, text))
                self.chars[own] += len(text)
                self.words[own] += len(words)
            self._run = []

    def _read(self, html: str) -> None:
        at, search, size = 0, _TAG.search, len(html)
        endless = set()  # raw elements without a further end tag: not sought again
        while at < size:
            found = search(html, at)
            stop = found.start() if found else size
            if stop > at:
                text = html[at:stop]
                text = unescape(text) if "&" in text else text
                self._run.append(text)
                if self._links:
                    self.link_chars[self._stack[-1]] += len(text)
            if not found:
                return
            at, (end, tag, attributes) = found.end(), found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if end:
                if tag == "a":
                    self._links = 0
                elif tag in BLOCK:
                    self._flush()
                    self._close(tag)
                elif tag == "br":
                    self._flush()
            elif tag in RAW:
                if tag in endless or tag == "svg" and attributes.endswith("/") and not _OPEN_VALUE.search(attributes):
                    continue
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(html, at)
                if close:
                    at = close.end()
                elif tag in CODE:
                    return
                else:
                    endless.add(tag)
            elif tag == "a":
                self._links = 1
            elif tag in ("br", "hr"):
                self._flush()
            elif tag in BLOCK and tag not in VOID:
                self._open(tag, attributes)
