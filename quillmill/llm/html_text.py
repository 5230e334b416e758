"""Main text of web pages by composite text density.

Method (Sun, Song and Liao, DOM based content extraction via text density): the page becomes a tree of elements, and
every node gets a composite text density, its characters per tag adjusted for links::

    CTD = C / T * log_B(C / LC * T / LT),   B = ln(C / (C - LC) * LC + LCb / Cb * C + e^2)

with C characters, T tags, LC and LT those inside links, b for the whole page, and 1 for what would be 0 below a fraction
bar. (e^2 stands where the paper has e, so that the logarithm's base does not fall to 1 on pages without links.) A node's
density sum adds up the densities of its children and of its own text. The node with the largest sum is the content; if
one box within it carries nearly all of its sum, that box is. Other subtrees come with it if they are as dense as the
least dense node on its path to the body and as dense as half of its text, and their sum is a fair share of its own.
Boxes at its edges that are much less dense, or links in the main, go: footers, side boxes, lists of links.

What the tree says about meaning helps density where there is any. A single ``article`` (or ``main``) with a heading or
some of the largest sum is the content; of several, the one that holds the node with the largest sum, and others as
dense. An ``article`` within an ``article`` is a comment on it. If the largest sum lies beside the page's ``h1``, the
text under the ``h1`` is the content, if it has some of that sum; so is what comes before a list of like records, each
led by a short line, as reader comments are. An ``h1`` right before the content belongs to it.

Inline elements (b, span, br ...) are part of their parent's text, not nodes. Menus, headers, footers, asides, forms,
scripts, styles and hidden elements are left out by element and role. Classes and ids name boilerplate too: the words of
``NAMED`` at the end of a name leave an element out, unless what is left has hardly any density; other words leave out
only what is also much less dense than the content's text. A header within an article belongs to it.

Blocks are what lies between the tags of block elements: character references are decoded, white space (by Unicode)
becomes one space, blocks are joined by a line feed in page order. Nothing is cut or capped.

Cases: a null or empty page, or one without text, gives an empty text. Markup that is cut off, nested wrongly or lacks
end tags is read as browsers do in the main: what is open at the end is closed, a stray end tag is ignored, ``<`` that
begins no tag is text. Pages of any length and depth are read whole, without recursion. Repeated rows are read row by
row. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of HTML elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template svg math".split())
LEFT_OUT = frozenset(
    "head script style textarea title noscript xmp iframe noembed noframes template svg math nav footer aside form button select input menu dialog object canvas audio video".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words that name boilerplate at the end of a class or id, whatever its density.
NAMED = frozenset(
    """ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer login masthead menu modal nav navbar navigation newsletter pagination popup promo related respond sidebar signup
    sponsor sponsored subscribe toolbar""".split()
)
#: Words that do if the element is also much less dense than the content.
DOUBTFUL = frozenset("alert banner copyright header notice notices search share sharing social teaser widget".split())
#: Elements that lay out others; elements of lists; how a footer's notice begins or ends.
BOXES = frozenset("div section center table tbody thead tfoot tr td th main article".split())
LISTS = frozenset("ul ol dl menu".split())
NOTICE = re.compile(r"\W*(?:©|\(c\)|copyright\b)|.*\ball rights reserved\W*$", re.IGNORECASE | re.DOTALL)
#: Shares of a density sum: nearly all, a fair share, some of it; and how dense, beside text, what is much less dense is.
NEARLY_ALL, FAIR, SOME, MUCH_LESS = 0.75, 0.25, 0.1, 0.25

#: Start tags that end an open element of the given kind, and where the search for it stops.
ENDED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
ENDS: dict[str, set[str]] = {}
for _open, _starts in ENDED_BY.items():
    for _start in _starts:
        ENDS.setdefault(_start, set()).add(_open)
FENCE = {"p": frozenset("button td th table body".split()), "li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
TABLE = frozenset(["table"])

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WORDS = re.compile(r"[a-z0-9]+")


#: Words before the last of a class or id that turn its meaning round.
TURNED = frozenset("has no non with without".split())


OUT, BY_NAME, IN_DOUBT = 3, 2, 1


def _hint(attributes: str, in_article: bool = False) -> int:
    """OUT by role or ``hidden``; BY_NAME or IN_DOUBT by class or id; 0: no sign of boilerplate."""
    found = 0
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes):
        return OUT
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in LEFT_OUT_ROLES:
            return OUT
        if name in ("class", "id"):
            for token in value.split():
                parts = _WORDS.findall(token)
                if not parts or (in_article and parts[-1] == "header") or (len(parts) > 1 and parts[-2] in TURNED):
                    continue
                if parts[-1] in NAMED or (parts[-1] in DOUBTFUL and not NAMED.isdisjoint(parts)):
                    found = BY_NAME
                elif parts[-1] in DOUBTFUL or parts[0] in NAMED or parts[0] in DOUBTFUL:
                    found = max(found, IN_DOUBT)
    return found


def ctd(c: int, t: int, lc: int, lt: int, share: float) -> float:
    """The composite text density of c characters in t tags, lc and lt of them links; ``share``: the page's link characters."""
    if not c:
        return 0.0
    t = max(t, 1)
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e**2)
    return c / t * max(0.0, math.log(c / max(lc, 1) * t / max(lt, 1))) / math.log(base)


class _Densities:
    """Characters, densities and sums of a page's nodes without those that are ``out``."""

    def __init__(self, page: _Page, out: list[bool]):
        n, parent = len(page.tag), page.parent
        chars, links, link_tags = ([0 if o else x for o, x in zip(out, v, strict=True)] for v in (page.chars, page.link_chars, page.link_tags))
        own = list(zip(chars, links, link_tags, strict=True))
        share = sum(page.link_chars) / max(sum(page.chars), 1)  # the whole page's, menus included
        tags = [0] * n
        for k in range(n - 1, 0, -1):
            if not out[k]:
                p = parent[k]
                chars[p] += chars[k]
                links[p] += links[k]
                link_tags[p] += link_tags[k]
                tags[p] += tags[k] + 1
        self.page, self.out, self.chars, self.links = page, out, chars, links
        self.own = [x[0] for x in own]
        self.density = [ctd(chars[k], tags[k] + link_tags[k], links[k], link_tags[k], share) for k in range(n)]
        self.total = [ctd(c, lt, lc, lt, share) for c, lc, lt in own]
        # of a subtree's text, the mean density of a block, by its characters
        self.block = [t * c for t, (c, _, _) in zip(self.total, own, strict=True)]
        self.end = list(range(1, n + 1))
        for k in range(n - 1, 0, -1):
            self.total[parent[k]] += self.density[k]
            self.block[parent[k]] += self.block[k]
            self.end[parent[k]] = max(self.end[parent[k]], self.end[k])
        self.block = [b / max(c, 1) for b, c in zip(self.block, chars, strict=True)]
        self.top = list(range(n))  # of a subtree, the node with the largest sum, the outermost of equal ones
        for k in range(n - 1, 0, -1):
            p = parent[k]
            if not out[k] and self.total[self.top[k]] >= self.total[self.top[p]] and (self.total[self.top[k]] > self.total[self.top[p]] or self.top[p] != p):
                self.top[p] = self.top[k]
        self.children: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            if chars[k] and not out[k]:
                self.children[parent[k]].append(k)

    def holds(self, a: int, k: int) -> bool:
        return a <= k < self.end[a]

    def sum(self, k: int) -> float:
        return self.total[self.top[k]]

    def narrowed(self, k: int) -> int:
        """``k``, or the box within it that carries nearly all of its sum."""
        while True:
            inner = next((c for c in self.children[k] if self.page.tag[c] in BOXES and self.sum(c) >= NEARLY_ALL * self.total[k] > 0), None)
            if inner is None:
                return k
            k = self.top[inner]

    def records(self, k: int) -> bool:
        """Whether the children are three or more boxes of one shape, each with a short line and something else."""
        kids, tag = self.children[k], self.page.tag
        if len(kids) < 3 or len({tag[c] for c in kids}) > 1 or not (tag[kids[0]] in BOXES or tag[kids[0]] == "li"):
            return False
        shapes = {(self.own[c] > 0, tuple(tag[g] for g in self.children[c])) for c in kids}
        if len(shapes) > 1:
            return False
        led, parts = shapes.pop()
        if led + len(parts) < 2 or (not led and parts[0][0] == "h"):
            return False
        return all((self.own[c] if led else self.chars[self.children[c][0]]) <= 60 for c in kids)


class _Page:
    """The tree of one page: per node its tag, parent, sign of boilerplate, characters, tags, link characters and link tags."""

    def __init__(self, html: str):
        self.tag, self.parent, self.sign = ["#root"], [-1], [0]
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        self.text: list[tuple[int, int, str]] = []  # node, block, raw text
        self.body = 0
        self._read(html)

    def _node(self, tag: str, parent: int, sign: int) -> int:
        for values, x in ((self.tag, tag), (self.parent, parent), (self.sign, sign), (self.chars, 0), (self.tags, 0), (self.link_chars, 0), (self.link_tags, 0)):
            values.append(x)
        return len(self.tag) - 1

    def _read(self, html: str) -> None:
        stack, block, links, at = [0], 0, 0, 0
        open_: Counter[str] = Counter()  # how many elements of each name are open, so that none is looked for in vain

        def close(k: int) -> None:
            for n in stack[k:]:
                open_[self.tag[n]] -= 1
            del stack[k:]

        text, size = self.text, len(html)
        last = html.rfind(">") + 1  # no tag ends after this
        hidden_inline = 0  # depth of inline elements that are boilerplate, each an own node on the stack
        while at < size:
            if at >= last:
                comment = html.find("<!--", at)
                self._text(stack[-1], block, html[at : comment if comment >= 0 else size], links)
                break
            m = _TAG.search(html, at)
            end = m.start() if m else size
            if end > at:
                self._text(stack[-1], block, html[at:end], links)
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, attributes, closing = name.lower(), m[3] or m[6] or "", bool(m[1] or m[4])
            if closing:
                if name == "a":
                    links = 0
                if name in INLINE:
                    if hidden_inline and self.tag[stack[-1]] == name:
                        close(len(stack) - 1)
                        hidden_inline -= 1
                    continue
                block += 1
                for k in range(len(stack) - 1, 0, -1) if open_[name] else ():
                    tag = self.tag[stack[k]]
                    if tag == name:
                        close(k)
                        break
                    if tag in ("td", "th", "table") and name not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table", "body", "html"):
                        break
                continue
            if name in INLINE:
                if name == "br":
                    text.append((stack[-1], block, " "))
                elif name == "a":
                    links = 1
                    self.link_tags[stack[-1]] += 1
                if name not in VOID and attributes and (sign := _hint(attributes)) >= BY_NAME and not attributes.endswith("/"):
                    stack.append(self._node(name, stack[-1], sign))
                    open_[name] += 1
                    hidden_inline += 1
                continue
            block += 1
            for kind in ENDS.get(name, ()):
                fence = FENCE.get(kind, TABLE)
                for k in range(len(stack) - 1, 0, -1) if open_[kind] else ():
                    tag = self.tag[stack[k]]
                    if tag == kind:
                        close(k)
                        break
                    if tag in fence:
                        break
            if name in ("html", "body") and open_[name]:
                continue
            if name == "body":
                close(2 if len(stack) > 1 and self.tag[stack[1]] == "html" else 1)
            sign = OUT if name in LEFT_OUT else 0
            if name == "header" or (attributes and not sign and name not in ("html", "body", "main")):
                in_article = open_["article"] + open_["main"] > 0
                sign = OUT if name == "header" and not in_article else _hint(attributes, in_article)
                if name == "article" and sign < OUT:  # what is an article is no share button, but it may be a comment or an advert
                    sign = sign if sign == BY_NAME else 0
            node = self._node(name, stack[-1], sign)
            if name == "body" and not self.body:
                self.body = node
            if name in RAW and not attributes.endswith("/"):
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
                at = stop.end() if stop else size
            elif name not in VOID and not (attributes.endswith("/") and name in ("path", "rect")):
                stack.append(node)
                open_[name] += 1

    def _text(self, node: int, block: int, raw: str, links: int) -> None:
        self.text.append((node, block, raw))
        n = len(raw) if raw[:1] > " " and raw[-1:] > " " else len(raw.strip())
        self.chars[node] += n
        if links:
            self.link_chars[node] += n

    def _below(self, marked) -> list[bool]:
        """For each node whether it, or what it lies in, is marked."""
        out = [False] * len(self.tag)
        for k in range(1, len(out)):
            out[k] = out[self.parent[k]] or marked(k)
        return out

    def _path(self, k: int) -> list[int]:
        """``k`` and what it lies in, up to the body."""
        path = [k]
        while k > self.body:
            k = self.parent[k]
            path.append(k)
        return path

    def _content(self, d: _Densities) -> tuple[int, bool, int]:
        """(the node with the content, whether an element says so, the node with the largest sum)."""
        tag, body = self.tag, self.body
        best = d.top[body]
        for kind in ("article", "main"):
            outer = [k for k in range(1, len(tag)) if tag[k] == kind and d.chars[k] and not d.out[k] and not any(tag[p] == kind for p in self._path(k)[1:])]
            holder = next((k for k in outer if d.holds(k, best)), None)
            if len(outer) == 1:
                k = outer[0]
                if any(tag[h] in ("h1", "h2") and d.chars[h] for h in range(k, d.end[k])) or d.sum(k) >= SOME * d.total[best]:
                    return k, True, best
            elif holder is not None:
                return holder, True, best
        best = d.narrowed(best)
        if d.records(best):
            before = [k for k in range(body, best) if d.end[k] <= best and not d.out[k] and not d.records(k)]
            other = max(before, key=lambda k: d.total[k], default=None)
            if other is not None and d.total[other] >= SOME * d.total[best]:
                return d.narrowed(other), False, best
        title = next((k for k in range(body, len(tag)) if tag[k] == "h1" and d.chars[k] and not d.out[k]), None)
        if title is not None and not d.holds(best, title):
            for k in self._path(title)[:-1]:
                p = self.parent[k]
                after = [c for c in d.children[p] if c > k]
                if d.holds(p, best):
                    return next((d.narrowed(d.top[c]) for c in after if d.sum(c) >= SOME * d.total[best]), best), False, best
                if sum(d.density[c] for c in after) >= SOME * d.total[best]:
                    return p, False, best
        return best, False, best

    def _edges(self, d: _Densities, chosen: int, by_element: bool) -> set[int]:
        """Children at either edge that are no content: links in the main and, in plain boxes, what is much less dense."""
        texts = {}
        if not by_element:
            for node, _, raw in self.text:
                texts.setdefault(node, []).append(raw)

        def loose(c: int, last: bool) -> bool:
            if self.tag[c] in BOXES or self.tag[c] in LISTS:
                if 2 * d.links[c] >= d.chars[c]:
                    return True
            if by_element:
                return False
            if self.tag[c] in BOXES and d.block[c] < d.block[chosen] / 2:
                return True
            notice = last and NOTICE.match(" ".join(unescape("".join(x)) for k in range(c, d.end[c]) for x in [texts.get(k, ())]).strip())
            return bool(notice) or (last and self.tag[c] in ("h1", "h2", "h3", "h4", "h5", "h6"))

        kids, out = list(d.children[chosen]), set()
        while len(kids) > 1 and loose(kids[-1], True):
            out.add(kids.pop())
        while len(kids) > 1 and loose(kids[0], False):
            out.add(kids.pop(0))
        return out

    def content(self) -> str:
        n, parent, body, tag = len(self.tag), self.parent, self.body, self.tag
        d = _Densities(self, self._below(lambda k: self.sign[k] >= BY_NAME))
        if any(s == BY_NAME for s in self.sign):
            bare = _Densities(self, self._below(lambda k: self.sign[k] == OUT))
            if d.sum(body) < SOME * bare.sum(body) and not any(tag[k] == "article" and d.chars[k] for k in range(n)):
                d = bare  # the names cannot be right
        if not d.chars[body]:
            return ""
        chosen, by_element, best = self._content(d)
        path = self._path(chosen)
        gone = self._edges(d, chosen, by_element)
        taken = [False] * n
        taken[chosen] = True
        title = next((k for k in range(chosen - 1, body, -1) if tag[k] == "h1" and d.chars[k] and not d.out[k]), None)
        if title is not None and parent[title] in path and not any(tag[k] == "h1" for k in range(chosen, d.end[chosen])):
            taken[title] = True
        # others that are as dense: articles beside an article; beside a plain box anything, unless the box has the h1
        alone = by_element or any(tag[k] == "h1" for k in range(chosen, d.end[chosen]))
        least = min(d.density[k] for k in path)
        for k in range(body, n):
            if d.out[k] or not d.chars[k] or d.holds(k, chosen) or d.holds(chosen, k) or (best != chosen and d.holds(best, k)):
                continue
            if (not alone or tag[k] == "article") and d.density[k] >= least and d.block[k] >= d.block[chosen] / 2:
                if d.sum(k) >= FAIR * d.sum(chosen) and not d.records(k):
                    taken[k if tag[k] == "article" else d.top[k]] = True
        inner = {k for k in range(1, n) if tag[k] == "article" and any(tag[p] == "article" for p in self._path(k)[1:])}
        for k in [k for k in range(1, n) if tag[k] == "article" and k not in inner]:
            nested = [c for c in inner if d.holds(k, c) and parent[c] not in inner]
            if d.chars[k] > sum(d.chars[c] for c in nested):  # comments on it; else it only holds them together
                gone.update(nested)
        doubtful = (k for k in range(1, n) if self.sign[k] == IN_DOUBT and k not in path and d.block[k] < MUCH_LESS * d.block[chosen])
        gone.update(doubtful)
        for k in range(1, n):
            taken[k] = (taken[k] or taken[parent[k]]) and not d.out[k] and k not in gone
        blocks, now, parts = [], -1, []
        for node, block, raw in self.text:
            if taken[node] and not d.out[node]:
                if block != now:
                    blocks.append(parts)
                    now, parts = block, []
                parts.append(unescape(raw) if "&" in raw else raw)
        blocks.append(parts)
        lines = (" ".join("".join(p).split()) for p in blocks if p)
        return "\n".join(line for line in lines if line)


def main_text(html: str | None) -> str:
    return _Page(html).content() if html else ""


def _extracted(batches):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
        # a lone surrogate, from a numeric reference, has no UTF-8 form
        texts = [t if t.isascii() else t.encode("utf-8", "replace").decode("utf-8") for t in texts]
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` (other than text and n_chars), the main text and its length in code points."""
    narrow = pages.select(*keep, F.col(html_col).alias("_qm_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(_extracted, f"{fields}, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
