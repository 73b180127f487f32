"""Main text of web pages by consensus of the pages of a host."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.llm.text import per_row
from yearling.sources.staging import staged

# Element names of HTML, and words that sites use in classes and ids.

INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math merror mfrac mi mn mo mover mpadded mroot mrow ms msqrt mstyle msub msubsup msup mtext "
    "munder munderover semantics svg g path circle ellipse line polygon polyline rect tspan "
    "use".split()
)
VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = {"script", "style", "noscript", "textarea", "title", "iframe", "template"}
SKIPPED = RAW | set(
    "head nav footer aside form button select option menu dialog object audio video canvas "
    "map annotation annotation-xml mphantom defs desc metadata symbol".split()
)
CONTAINERS = {"article", "main", "section", "div", "td", "body"}
#: Elements whose start ends an open paragraph.
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table "
    "ul".split()
)
#: Elements that end an open one of the listed kind, looked for up to the given parents.
ENDS_ITEM = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
ROLES = set("navigation banner contentinfo complementary search dialog alert form menu".split())
AROUND = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login register sidebar sidebars aside nav navbar navigation "
    "menu breadcrumb breadcrumbs pager pagination footer header masthead topbar toolbar comment "
    "comments respond disqus reply replies share sharing social related recommended "
    "recommendations trending widget widgets search form".split()
)
#: Words that, joined to one of the above, still name matter around the text.
HOLDERS = set(
    "area articles bar block body bottom box button buttons col column container content global "
    "group heading icon icons in inline inner item items left link links list main message mobile "
    "outer page panel posts primary reader right row secondary section site slot stories text "
    "thread title top unit user wrap wrapper".split()
)
INSIDE = set("article content entry main post story text body".split())

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
_NO_LETTERS = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")


class Page:
    """Elements of a page in page order, and its text in order with the element it is in.

    End tags may be missing or misplaced, as browsers allow: paragraphs and items end
    where the next one starts, and an end tag without its start counts for nothing.
    """

    def __init__(self, html: str):
        self.tags: list[str] = ["#"]
        self.parents: list[int] = [-1]
        self.paths: list[str] = [""]
        self.skip: list[bool] = [False]
        #: 0 for classes that say nothing, 1 for a word in a longer name, 2 for a whole name.
        self.by_class: list[int] = [0]
        self.linked: list[bool] = [False]
        #: Element and text; no text stands for the edge of a block.
        self.events: list[tuple[int, str | None]] = []
        self._read(html)
        self._settle()

    def _read(self, html: str) -> None:
        open_, at = [0], 0
        events = self.events
        while True:
            found = _TAG.search(html, at)
            if found is None:
                break
            if found.start() > at:
                events.append((open_[-1], html[at : found.start()]))
            at = found.end()
            close, name, rest = found.group(1, 2, 3)
            if name is None:
                close, name, rest = found.group(4, 5, 6)
            if name is None:
                continue
            name = name.lower()
            if close:
                self._end(open_, name)
                continue
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
                continue
            if name == "br":
                events.append((open_[-1], " "))
                continue
            self._start(open_, name, rest)
            if name in VOID or rest.endswith("/") and name not in CONTAINERS:
                open_.pop()
        if at < len(html):
            events.append((open_[-1], html[at:]))

    def _start(self, open_: list[int], name: str, rest: str) -> None:
        tags = self.tags
        if name in ENDS_PARAGRAPH:
            self._close(open_, {"p"}, CONTAINERS | {"li", "blockquote", "table"})
        elif name in ENDS_ITEM:
            self._close(open_, *ENDS_ITEM[name])
        parent, number = open_[-1], len(tags)
        classes, skip, by_class = "", name in SKIPPED, 0
        if rest and name not in INLINE:
            classes, by_class, hidden = self._attributes(name, rest)
            skip = skip or hidden
        if name == "header":
            by_class = 2
        tags.append(name)
        self.parents.append(parent)
        step = name + classes
        self.paths.append(
            self.paths[parent] if name in ("html", *INLINE) else f"{self.paths[parent]}>{step}"
        )
        self.skip.append(skip)
        self.by_class.append(by_class)
        self.linked.append(name == "a" or self.linked[parent])
        open_.append(number)
        if name not in INLINE:
            self.events.append((number, None))

    def _end(self, open_: list[int], name: str) -> None:
        tags, inline = self.tags, name in INLINE
        for i in range(len(open_) - 1, 0, -1):
            tag = tags[open_[i]]
            if tag == name:
                if not inline:
                    self.events.append((open_[i], None))
                del open_[i:]
                return
            if inline and tag not in INLINE:
                return
            # A stray end of a paragraph or item does not end what holds it.
            if tag in CONTAINERS and name in ("p", "li", "dt", "dd"):
                return

    def _close(self, open_: list[int], kinds: set[str], until: set[str]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            tag = self.tags[open_[i]]
            if tag in kinds:
                del open_[i:]
                return
            if tag in until:
                return

    @staticmethod
    def _attributes(name: str, rest: str) -> tuple[str, int, bool]:
        """The generalised class, how much it speaks for matter around the text, and
        whether the element is hidden or has a role of that kind."""
        classes, words, whole, hidden = "", set(), False, False
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                for one in value.split():
                    parts = set(_NO_LETTERS.split(one)) - {""}
                    words |= parts
                    whole |= bool(parts & AROUND) and parts <= AROUND | HOLDERS
                if key == "class":
                    kinds = sorted({_DIGITS.sub("#", c) for c in value.split()})
                    classes = "".join(f".{c}" for c in kinds)
            elif key == "role":
                hidden |= value in ROLES
            elif key == "style":
                hidden |= "display:none" in value.replace(" ", "")
            elif key == "aria-hidden":
                hidden |= value == "true"
            else:
                hidden = True
        around = words & AROUND
        if around == {"header"} and words & INSIDE:
            around = set()
        if name in ("body", "article", "main", "html"):
            around = set()
        by_class = 0 if not around else 2 if whole else 1
        return classes, by_class, hidden and name not in ("html", "body")

    def _settle(self) -> None:
        """Skipped are elements around the text, and all in them. One that holds an
        article is a frame, not matter around the text; a header inside an article
        that has a heading is its title. A word in a longer class name says nothing of
        an element inside an article, nor of one with most of the page's text."""
        n = len(self.tags)
        holds, heads, within = [False] * n, [False] * n, [False] * n
        sizes = self._sizes() if 1 in self.by_class else None
        for i in range(n - 1, 0, -1):
            parent, tag = self.parents[i], self.tags[i]
            holds[parent] = holds[parent] or holds[i] or tag in ("article", "main")
            heads[parent] = heads[parent] or heads[i] or tag in ("h1", "h2")
        for i in range(1, n):
            parent = self.parents[i]
            within[i] = within[parent] or self.tags[parent] in ("article", "main")
            title = self.tags[i] == "header" and within[i] and heads[i]
            around = self.by_class[i]
            if around == 1:
                around = 0 if within[i] or 2 * sizes[i] > sizes[0] else 1
            if around and not holds[i] and not title:
                self.skip[i] = True
            self.skip[i] = self.skip[i] or self.skip[parent]
        self.within = within

    def _sizes(self) -> list[int]:
        """Text without links in each element that is not around the text by its tag or
        a whole class name."""
        n = len(self.tags)
        sizes, out = [0] * n, [False] * n
        for i in range(1, n):
            out[i] = out[self.parents[i]] or self.skip[i] or self.by_class[i] == 2
        for i, text in self.events:
            if text and not self.linked[i] and not out[i]:
                sizes[i] += len("".join(text.split()))
        for i in range(n - 1, 0, -1):
            sizes[self.parents[i]] += sizes[i]
        return sizes

    def scores(self) -> dict[int, float]:
        """How much each container looks like the article: its text without links, by the
        share this has of all text in it. An article or main element, or a class that
        says so, counts more; of equal ones the innermost is best."""
        n = len(self.tags)
        own, every = [0] * n, [0] * n
        for i, text in self.events:
            if text:
                size = len("".join(text.split()))
                every[i] += size
                if not self.skip[i] and not self.linked[i]:
                    own[i] += size
        for i in range(n - 1, 0, -1):
            own[self.parents[i]] += own[i]
            every[self.parents[i]] += every[i]
        found = {}
        for i in range(1, n):
            tag = self.tags[i]
            if tag not in CONTAINERS or self.skip[i] or not own[i]:
                continue
            score = own[i] * own[i] / every[i]
            if tag in ("article", "main"):
                score *= 1.5
            elif tag != "body" and INSIDE & set(_NO_LETTERS.split(self.paths[i].rpartition(">")[2])):
                score *= 1.25
            found[i] = score
        return found

    def best(self, scores: dict[int, float]) -> int:
        return max(scores, key=lambda i: (scores[i], i)) if scores else -1

    def text(self, path: str) -> str:
        """The text of all elements with this path."""
        return self._collect([i for i, p in enumerate(self.paths) if p == path])

    def _collect(self, roots: list[int]) -> str:
        inside = [False] * len(self.tags)
        for i in roots:
            inside[i] = not self.skip[i]
        for i in range(1, len(inside)):
            inside[i] = (inside[i] or inside[self.parents[i]]) and not self.skip[i]
        for i in self._link_lists(inside):
            inside[i] = False
            for j in range(i + 1, len(inside)):
                if not inside[self.parents[j]] and self.parents[j] >= i:
                    inside[j] = False
        parts = []
        for i, text in self.events:
            if text is None:
                parts.append(" ")
            elif inside[i]:
                parts.append(unescape(text))
        return " ".join("".join(parts).split())

    def _link_lists(self, inside: list[bool]) -> list[int]:
        """Lists of three or more links and nothing else: menus, but for those inside an
        article, which belong to it."""
        lists = {
            i
            for i, t in enumerate(self.tags)
            if t in ("ul", "ol") and inside[i] and not self.within[i]
        }
        if not lists:
            return []
        links: Counter[int] = Counter()
        plain: Counter[int] = Counter()
        owner = [-1] * len(self.tags)
        for i in range(1, len(self.tags)):
            owner[i] = i if i in lists else owner[self.parents[i]]
            if self.tags[i] == "a" and owner[i] >= 0:
                links[owner[i]] += 1
        for i, text in self.events:
            if text and owner[i] >= 0 and not self.linked[i]:
                plain[owner[i]] += len(text.strip())
        return sorted(i for i in lists if links[i] >= 3 and not plain[i])


def _key(present: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(present)) - (1 << 63)


def _parsed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pages with a key of the paths they have, and their votes for each path.

    A page has one vote for its best container and parts for those that come near.
    """
    for page_id, url, html, host in rows:
        page = Page(html or "")
        scores = page.scores()
        most = max(scores.values(), default=0.0)
        shares: dict[str, float] = dict.fromkeys(page.paths, 0.0)
        for i, score in scores.items():
            if 2 * score >= most:
                path = page.paths[i]
                shares[path] = max(shares[path], score / most)
        present = sorted(shares)
        votes = [(path, shares[path], int(shares[path] == 1.0)) for path in present]
        yield page_id, url, html, host, _key(present), votes


def _extract(rows: Iterator[tuple]) -> Iterator[tuple]:
    for page_id, url, html, paths in rows:
        page = Page(html or "")
        text = ""
        present = set(page.paths)
        for path in paths or ():
            if path in present:
                text = page.text(path)
                if text:
                    break
        else:
            best = page.best(page.scores())
            if best > 0:
                text = page.text(page.paths[best])
        if not text and not page.scores():
            text = page._collect([0])
        yield page_id, url, text, len(text)


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """The main text of every page: `page_id`, `url`, `text`, `n_chars` (code points).

    Every page's containers are scored, and the pages of a host vote on the paths of
    tags and classes (digits generalised). A page's text is that of the elements on the
    host's path with most votes that the page has, else of its own best container, else
    of all that is not around the text. Left out are scripts, styles, forms, menus,
    headers, footers, sidebars, notices, adverts and reader comments, by element, role,
    class or id. Character references are decoded; white space becomes one space inside
    a block and between blocks.

    A class or id counts when a whole name is made of words for such matter; a word in a
    longer name counts only outside of articles and not for most of a page's text. Lists
    of nothing but links are menus, but for those inside an article. Formulas and the
    words of drawings are text.

    Null and empty pages give an empty text; pages without a host form one. Repeated
    rows each give a row; other columns are not read; of containers with equal scores the
    innermost, then the later one is the page's best, of paths with equal votes the first
    by name wins. A page is read whole, however long, twice: for its votes and for its
    text. Votes are summed within each task and by Spark, so a host with many pages weighs no more than others; every path that
    some page voted first is joined with the pages' own paths.
    """
    host = F.coalesce(F.regexp_extract(url_col, r"^\s*[a-zA-Z][\w+.-]*://([^/?#]*)", 1), F.lit(""))
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
        F.lower(host).alias("host"),
    )
    parsed = staged(
        per_row(
            source,
            "page_id bigint, url string, html string, host string, key bigint, "
            "votes array<struct<path: string, share: double, first: bigint>>",
            _parsed,
            step=64,
        ),
        "parsed",
    )
    # What pages of one shape say is summed up before the shuffles; html is not read here.
    shapes = parsed.select("host", "key", F.explode("votes").alias("v")).select(
        "host", "key", "v.*"
    )
    votes = shapes.groupBy("host", "path").agg(
        F.sum("first").alias("first"), F.round(F.sum("share"), 6).alias("share")
    )
    present = shapes.select("host", "key", "path").distinct()
    # First by pages whose best container it is, then by votes in all.
    chosen = staged(
        present.join(votes.where("first > 0"), ["host", "path"])
        .groupBy("host", "key")
        .agg(F.sort_array(F.collect_list(F.expr("struct(-first, -share, path)"))).alias("ranked"))
        .select("host", "key", F.col("ranked.path").alias("paths")),
        "paths",
    )
    pages_of = parsed.select("page_id", "url", "html", "host", "key")
    joined = pages_of.join(chosen, ["host", "key"], "left").select(
        "page_id", "url", "html", "paths"
    )
    return per_row(
        joined, "page_id bigint, url string, text string, n_chars bigint", _extract, step=64
    )
