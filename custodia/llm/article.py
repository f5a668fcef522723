"""Main text of HTML pages by tree scoring.

A page becomes a tree of elements and a list of text blocks. Each block gives
points for its length and its commas to the elements around it, all of them to
the nearest, half to the next, ever less further up; an element's points are
discounted by the share of its text that is in links. The container with most
points and those siblings that look like text are kept, less what is no article
by its element, role, class or id: menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments.

Blocks are joined in page order by a blank line, white space inside a block is
one space, character references are decoded, nothing else is dropped or cut.
Null or empty pages, and pages without text, give the empty text. Rows with
repeated ids give one row each; a null url stays null.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from custodia.llm import kernels as K
from custodia.llm.common import pick

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html head caption tbody td tfoot th thead tr option optgroup legend summary".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}

# What is no article, by element, role, and words of class or id.
NOT_TEXT = frozenset("nav footer aside form button select input dialog menu head object embed audio video canvas map".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners billboard breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent copyright dialog disclaimer disqus feedback footer foot form gdpr legal login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies reply respond "
    "share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)
HEADERS = frozenset(["header", "head"])
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*+)(?:>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]*+)))?""")
LAYOUT = re.compile(r"(?:has|with|without|no|is)[-_]", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Elements (tag, parent, dropped or not) and blocks (element, text, characters in links) of one page."""

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.soft = [""], [-1], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.parts: list[tuple[str, bool]] = []
        self.stack = [0]
        self.links = 0
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"), decode=False)
                continue
            name = m[2].lower()
            if m[1]:
                self._close(name)
                continue
            self._open(name, m[3])
            if name in RAW and not m[3].rstrip().endswith("/"):
                until = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                self._close(name)
                at = until.end() if until else end
        self._flush()

    def _text(self, text: str, decode: bool = True) -> None:
        if not self._dropped():
            self.parts.append((references.unescape(text) if decode and "&" in text else text, self.links > 0))

    def _dropped(self) -> bool:
        return self.drop[self.stack[-1]]

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(p for p, _ in self.parts).split())
            if text:
                self.blocks.append((self._block(), text, sum(len(p) for p, link in self.parts if link)))
            self.parts = []

    def _block(self) -> int:
        return next((n for n in reversed(self.stack) if self.tag[n] in BLOCK), 0)

    def _open(self, name: str, attributes: str) -> None:
        if name in ("br", "wbr"):
            self.parts.append((" " if name == "br" else "", False))
            return
        if name in BLOCK:
            self._flush()
            self.links = 0
            if name in CLOSES_P:
                self._close_upto({"p"}, {"td", "th", "button", "caption", "table"})
            if name in ENDS:
                self._close_upto(*ENDS[name])
        if name in VOID:
            return
        if name == "a":
            self.links = 1
        out, soft = self._junk(name, attributes)
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.drop.append(out or self._dropped())
        self.soft.append(soft)
        self.stack.append(len(self.tag) - 1)
        if attributes.endswith("/") and name not in BLOCK:
            self._close(name)

    def _close_upto(self, names: set[str], within: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[k]]
            if tag in names:
                del self.stack[k:]
                return
            if tag in within:
                return

    def _close(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
            self.links = 0
        if name == "a":
            self.links = 0
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[k]]
            if tag == name:
                del self.stack[k:]
                return
            if name not in BLOCK and tag in BLOCK:
                return

    def _junk(self, name: str, attributes: str) -> tuple[bool, bool]:
        """Whether an element is no article at all, or only by its class or id."""
        if name in RAW or name in NOT_TEXT:
            return True, False
        inside = any(self.tag[n] in ("article", "main") for n in self.stack)
        if name == "header" and not inside:
            return True, False
        if not attributes.strip(" /"):
            return False, False
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or HIDDEN.search(found.get("style", "")):
            return True, False
        if name in ("html", "body", "article", "main") and found.get("role", "").lower() not in NOT_ROLES and name != "article":
            return False, False
        if found.get("role", "").lower() in NOT_ROLES:
            return True, False
        names = [x for key in ("class", "id") for x in found.get(key, "").split() if not LAYOUT.match(x)]
        words = {w.lower() for x in names for w in NAME_WORD.findall(x)}
        return False, bool(words & NOT_NAMES) or (bool(words & HEADERS) and not inside)

    def text(self) -> str:
        blocks = self._kept()
        return "\n\n".join(text for _, text, _ in blocks)

    def _kept(self) -> list[tuple[int, str, int]]:
        size = self._sums([(n, len(t)) for n, t, _ in self.blocks])
        whole = size[0]
        holds = [False] * len(self.tag)
        for n, tag in enumerate(self.tag):
            if tag in ("article", "main", "h1") and not self.soft[n]:
                up = self.parent[n]
                while up >= 0:
                    holds[up] = True
                    up = self.parent[up]
        # a class or id does not speak against what holds the article, the title or nearly all text
        out = list(self.drop)
        for n in range(1, len(self.tag)):
            soft = self.soft[n] and not holds[n] and (self.tag[n] == "article" or size[n] <= 0.8 * whole)
            out[n] = out[n] or out[self.parent[n]] or soft
        blocks = [b for b in self.blocks if not out[b[0]]]
        if not blocks:
            return []
        score, length, linked = [0.0] * len(self.tag), self._sums([(n, len(t)) for n, t, _ in blocks]), self._sums([(n, k) for n, _, k in blocks])
        for n, text, link in blocks:
            points = (1 + text.count(",") + text.count("，") + min(len(text) / 100, 3.0)) * (1 - min(1.0, link / len(text)))
            # an element that is a paragraph itself passes its points on
            up, share = (self.parent[n] if self.tag[n] not in ("div", "section", "article", "main", "body", "") else n), 1.0
            depth = 0
            while up >= 0:
                score[up] += points * share
                depth += 1
                up, share = self.parent[up], 0.5 if depth == 1 else 1 / (3 * depth)
        value = [s * (1 - min(1.0, linked[n] / length[n])) if length[n] else 0.0 for n, s in enumerate(score)]
        best = max(range(len(value)), key=lambda n: value[n])
        up = best
        while up > 0 and self.tag[up] not in ("article", "body", "html"):
            up = self.parent[up]
        if up > 0 and self.tag[up] == "article":
            best = up
        top = {best}
        around = self.parent[best]
        if around >= 0:
            own: dict[int, int] = {}
            for n, text, _ in blocks:
                while n > 0 and self.parent[n] != around:
                    n = self.parent[n]
                if n > 0 and n != best:
                    own[n] = own.get(n, 0) + 1
            for n in own:
                density = linked[n] / length[n]
                heading = self.tag[n] in ("h1", "h2", "hgroup", "header") and n < best
                paragraph = self.tag[n] == "p" and density < 0.25 and (length[n] > 80 or self.tag[best] == "p")
                if heading or paragraph or (value[n] >= max(10.0, 0.2 * value[best]) and density < 0.5):
                    top.add(n)
        inside = [False] * len(self.tag)
        for n in range(len(self.tag)):
            inside[n] = n in top or (self.parent[n] >= 0 and inside[self.parent[n]])
        return [b for b in blocks if inside[b[0]]]

    def _sums(self, values: list[tuple[int, int]]) -> list[int]:
        """Sums over each element with all that it holds."""
        out = [0] * len(self.tag)
        for n, v in values:
            out[n] += v
        for n in range(len(self.tag) - 1, 0, -1):
            out[self.parent[n]] += out[n]
        return out


def main_text(source: str | None) -> str:
    """The article of one page."""
    return Page(source).text() if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (its code points)."""
    pages = pick(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in K.slices(batches, 2):
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
