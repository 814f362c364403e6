"""Main text of web pages by composite text density.

Every block element gets its link-adjusted characters per tag. The element whose children's densities
add up to the most is the content; the least density on the way from the body to it is the threshold
that other parts must reach to belong to it.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe xmp noembed noframes title canvas annotation annotation-xml metadata desc".split())
BLOCKS = set(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary header footer nav aside form fieldset center hgroup".split()
)
NOISE_TAGS = set("nav footer aside form menu dialog button select option datalist head".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead notice notices cookie cookies consent gdpr newsletter subscribe signup popup "
    "modal comment comments disqus reply replies respond related share sharing social widget toolbar pagination login "
    "search form header topbar".split()
)
_HOLDERS = set("article main body html".split())
#: Starting one of these ends an open element of the others.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th", "thead", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"},
}
#: An implied end does not reach past these.
_SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")


def _is_noise(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NOISE_TAGS or (tag == "header" and not in_article):
        return True
    if "=" not in attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        for word in value.strip("\"'").lower().split():
            if name.lower() == "role":
                if word in NOISE_ROLES:
                    return True
                continue
            if in_article and word.endswith("header"):
                continue
            if word in NOISE_NAMES:
                return tag not in ("html", "body", "main")
            parts = _NAME_PARTS.split(word)
            if tag not in _HOLDERS and parts[0] not in ("has", "no", "with", "without", "is", "not"):
                if parts[0] in NOISE_NAMES or parts[-1] in NOISE_NAMES:
                    return True
    return False


class _Page:
    """Elements in page order (parents first) with their counts, and the text between them."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.noise, self.by_name = ["#page"], [0], [False], [False]
        self.own_chars, self.own_links, self.own_link_tags = [0], [0], [0]
        self.runs: list[tuple[int, str | None]] = []  # None: a block ends here
        self.open = [0]
        self.articles = self.links = 0
        at, lower = 0, None
        for token in _TOKEN.finditer(source):
            if token.start() < at:
                continue
            self._text(source[at : token.start()])
            at = token.end()
            tag = token[2] or token[5]
            if not tag:
                continue
            tag = tag.lower()
            if token[1] or token[4]:
                self._end(tag)
                continue
            attributes = token[3] or token[6] or ""
            if tag in RAW:
                if not attributes.endswith("/") or tag in ("script", "style"):
                    lower = lower if lower is not None else source.lower()
                    end = lower.find(f"</{tag}", at) if len(lower) == len(source) else -1
                    if len(lower) != len(source):  # a letter whose lower case is longer: search the page itself
                        found = re.compile(f"</{tag}", re.I).search(source, at)
                        end = found.start() if found else -1
                    at = len(source) if end < 0 else end
                continue
            self._start(tag, attributes)
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if text:
            node = self.open[-1]
            text = entities.unescape(text) if "&" in text else text
            if not self.noise[node]:
                n = len("".join(text.split()))
                self.own_chars[node] += n
                if self.links:
                    self.own_links[node] += n
            self.runs.append((node, text))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and tag in self.tags:
            return
        if tag == "body":
            self._end("head")
        if tag in BLOCKS:
            self.runs.append((self.open[-1], None))
            self._close({"p"}, {"table", "button", "li", "td", "th", "blockquote", "div", "section", "article"} - {tag} | {"#page"})
        if tag in _CLOSES:
            self._close(_CLOSES[tag], _SCOPES.get(tag, set()) | {"#page"})
        if tag in VOID:
            if tag in ("br", "hr"):
                self.runs.append((self.open[-1], None))
            self._count(self.open[-1], tag)
            return
        parent = self.open[-1]
        if tag in ("article", "main") and self.by_name[parent]:
            self._reveal(parent)
        own = _is_noise(tag, attributes, self.articles > 0)
        self.tags.append(tag)
        self.parents.append(parent)
        self.by_name.append(self.by_name[parent] or (own and tag not in NOISE_TAGS))
        self.noise.append(self.noise[parent] or own)
        self.own_chars.append(0)
        self.own_links.append(0)
        self.own_link_tags.append(0)
        self.open.append(len(self.tags) - 1)
        self._count(parent, tag)
        self.articles += tag in ("article", "main")
        self.links += tag == "a"

    def _count(self, node: int, tag: str) -> None:
        if tag == "a" and not self.noise[node]:
            self.own_link_tags[node] += 1

    def _reveal(self, node: int) -> None:
        """An element is no noise by its name if the article is inside it."""
        for i in self.open:
            if self.by_name[i] and not any(self.tags[j] in NOISE_TAGS for j in self.open):
                self.noise[i] = self.by_name[i] = False

    def _close(self, tags: set[str], scope: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[depth]]
            if name in tags:
                self._pop(depth)
                return
            if name in scope:
                return

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[depth]]
            if name == tag:
                self._pop(depth)
                return
            if tag not in BLOCKS and name in BLOCKS:
                return  # a stray inline end tag does not end a block
        if tag in ("p", "br"):
            self.runs.append((self.open[-1], None))

    def _pop(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.articles -= self.tags[node] in ("article", "main")
            self.links -= self.tags[node] == "a"
            if self.tags[node] in BLOCKS:
                self.runs.append((node, None))
        del self.open[depth:]

    def content(self) -> list[bool]:
        """Which elements belong to the main text."""
        n = len(self.tags)
        chars, links, link_tags, inner = self.own_chars[:], self.own_links[:], self.own_link_tags[:], [0] * n
        for i in range(n - 1, 0, -1):
            if not self.noise[i]:
                p = self.parents[i]
                chars[p] += chars[i]
                links[p] += links[i]
                link_tags[p] += link_tags[i]
                inner[p] += inner[i] + 1
        body = next((i for i in range(n) if self.tags[i] == "body"), 0)
        ratio = links[body] / max(1, chars[body])
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            if self.noise[i] or (self.tags[i] not in BLOCKS and i):
                continue
            c, lc, t = chars[i], links[i], max(1, inner[i])
            if c:
                base = max(math.e, math.log(c / max(1, c - lc) * lc + ratio * c + math.e))
                gain = math.log(max(1.0, c / max(1, lc) * t / max(1, link_tags[i]))) / math.log(base)
                density[i] = c / t * gain
            holder = self.parents[i]
            while holder and self.tags[holder] not in BLOCKS:
                holder = self.parents[holder]
            if i:
                sums[holder] += density[i]
        best = list(range(n))  # the element of the largest sum in each subtree; the outermost of equals
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if not self.noise[i] and sums[best[i]] > sums[best[p]]:
                best[p] = best[i]
        top = best[body]
        threshold, node = density[top], top
        while node != body and node:
            node = self.parents[node]
            if self.tags[node] in BLOCKS:
                threshold = min(threshold, density[node])
        holder = top
        while holder and self.tags[holder] not in ("article", "main"):
            holder = self.parents[holder]
        within = [False] * n
        within[holder or top] = True
        for i in range(n):
            if i and within[self.parents[i]]:
                within[i] = True
            elif not holder and density[i] >= threshold > 0 and not self.noise[i] and self.tags[i] in BLOCKS and i != body and i:
                within[best[i]] = True
        return [within[i] and not self.noise[i] for i in range(n)]

    def text(self) -> str:
        wanted = self.content()
        blocks: list[str] = []
        parts: list[str] = []
        for node, text in [*self.runs, (0, None)]:
            if text is None:
                if parts and (block := " ".join("".join(parts).split())):
                    blocks.append(block)
                parts = []
            elif wanted[node]:
                parts.append(text)
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    """The main text of one page; empty for null, empty or textless pages."""
    return _Page(source).text() if source else ""


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(``page_id``, ``url``, ``text``) of every page.

    A null or empty page has an empty text, never null. Repeated rows are extracted each; an empty
    table gives an empty one. Other columns are ignored.
    """

    @F.pandas_udf("string")
    def extracted(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s) for s in sources], dtype=object)

    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), extracted(F.col(html)).alias("text"))
