"""Main text of web pages, by the paths that the pages of a host agree on.

Each page scores its containers and votes for one, named by its generalised path: tags with their first class, without
digits, from the root. Votes are counted by host, and each page is read again with the paths that won at its host. A page too short or
too odd to tell its article from the rest is so read like its neighbours.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, saved, whole_text
from tallymill.scratch import remove

#: Share of a host's votes that a path needs to win.
WINNING_SHARE = 0.1
#: A host with more than this share of all pages has its paths sent to every task; there are at most 1 / share of them.
HOT_SHARE = 1 / 20_000
#: Share of a container's score that a container inside needs, to be the closer frame of the article.
CLOSER = 0.75
#: How much more the score of an article or main element weighs.
MEANT = 4

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?![^\s\"'/])", re.IGNORECASE)
_LAST_TEXT = re.compile(r"[^<]*(?:<(?![a-zA-Z!/?])[^<]*)*+")
_NO_STEP = re.compile(r"[\d/]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements of HTML by the way they take part in text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article blockquote body center details div html main section table tbody td tr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog footer form head iframe input math menu nav noembed noframes noscript object"
    " option script select style svg template textarea title video xmp".split()
)
_CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
}
_STOPS = frozenset("article aside body div footer form header main nav section table ul ol dl".split())

# Words in class, id and role that name what is not the article.
_ASIDE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial alert banner breadcrumb breadcrumbs comment commentlist"
    " comments complementary consent contentinfo cookie cookies dialog disqus footer footnav gdpr login masthead menu menubar"
    " modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popover popup promo"
    " promotion promotions reader recommendation recommendations recommended related replies reply respond search share sharing"
    " sidebar signup skip social sponsor sponsored sponsors subscribe subscription taboola toolbar topbar widget widgets".split()
)
_NOT_SO = frozenset("has no with without".split())


@functools.lru_cache(maxsize=20_000)
def _marks(name: str, attributes: str) -> tuple[str, bool, bool]:
    """The element's step in a path, whether it is left out by its name or marks, and whether it is a page header."""
    marks = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        marks.setdefault(key.lower(), " ".join(filter(None, values)))
    first = _NO_STEP.sub("", next(iter(marks.get("class", "").split()), ""))
    step = name if name in ("html", "body") or not first else f"{name}.{first}"
    words = {w.lower() for key in ("class", "id", "role") if key in marks for w in _WORDS.findall(marks[key])}
    header = name == "header" or "header" in words
    if name in ("html", "body", "main") or words & _NOT_SO:
        return step, name in _LEFT_OUT, name == "header"
    return step, name in _LEFT_OUT or "hidden" in marks or bool(words & _ASIDE), header


@dataclass
class _Container:
    parent: int
    step: str
    meant: bool
    score: float = 0.0
    heading: bool = False
    inner: list[int] = field(default_factory=list)


@dataclass
class _Open:
    name: str
    container: int
    out: bool
    link: bool


class Page:
    """The blocks of text of one page, each with the container that it lies in."""

    def __init__(self, html: str) -> None:
        self.containers = [_Container(-1, "", False)]
        self.blocks: list[tuple[int, str]] = []
        self._open = [_Open("", 0, False, False)]
        self._names: Counter[str] = Counter()
        self._parts: list[str] = []
        self._linked = 0
        self._block = ""
        self._read(html)
        for i in range(len(self.containers) - 1, 0, -1):
            own, parent = self.containers[i], self.containers[self.containers[i].parent]
            parent.score += own.score
            parent.inner.append(i)

    def _read(self, html: str) -> None:
        at, end = 0, html.rfind(">") + 1
        while at < len(html):
            tag = _TAG.search(html, at, end)
            if tag is None:
                self._text(_LAST_TEXT.match(html, at).group())
                break
            self._text(html[at : tag.start()])
            at = tag.end()
            closing, name, attributes = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
            if not name:
                if tag.group().startswith("<!--") and not tag.group().endswith("-->"):
                    break
                continue
            name = name.lower()
            if closing:
                self._close(name)
                continue
            self._start(name, attributes)
            if name in _RAW:
                past = _raw_end(name).search(html, at)
                at = past.end() if past else len(html)
                self._close(name)
        self._flush()

    def _text(self, raw: str) -> None:
        top = self._open[-1]
        if not raw or top.out:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if top.link:
            self._linked += len(text)

    def _flush(self) -> None:
        """End the block."""
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                where = self._open[-1].container
                self.blocks.append((where, text))
                plain = max(0, len(text) - 2 * self._linked)
                container = self.containers[where]
                container.score += plain * (0.5 if self._block in _HEADINGS or self._block == "li" else 1)
                if self._block == "h1":
                    container.heading = True
            self._parts = []
        self._linked = 0

    def _start(self, name: str, attributes: str) -> None:
        if name in _VOID:
            if name == "hr":
                self._flush()
            elif name == "br" and self._parts:
                self._parts.append(" ")
            return
        if name in _BLOCKS:
            self._flush()
            if self._names["p"]:
                self._close_within("p", _STOPS)
            for other in _CLOSED_BY.get(name, ()):
                if self._names[other]:
                    self._close_within(other, _STOPS)
            self._block = name
        step, out, header = _marks(name, attributes)
        top = self._open[-1]
        container = top.container
        if header and not (self._names["article"] or self._names["main"]):
            out = out or name not in ("article", "main", *_HEADINGS)
        out = out or top.out
        if name in _CONTAINERS and not out:
            self.containers.append(_Container(container, step, name in ("article", "main")))
            container = len(self.containers) - 1
        self._open.append(_Open(name, container, out, top.link or name == "a"))
        self._names[name] += 1

    def _close(self, name: str) -> None:
        if name in ("p", "br") and not self._names[name]:
            self._flush()
        if not self._names[name]:
            return
        if name in _BLOCKS:
            self._flush()
            while self._pop() != name:
                pass
            self._block = ""
        else:
            self._close_within(name, _BLOCKS)

    def _close_within(self, name: str, stops: frozenset[str]) -> None:
        """Close the innermost element of this name, unless one of ``stops`` is open within it."""
        for i in range(len(self._open) - 1, 0, -1):
            found = self._open[i].name
            if found == name:
                while len(self._open) > i:
                    self._pop()
                return
            if found in stops:
                return

    def _pop(self) -> str:
        name = self._open.pop().name
        self._names[name] -= 1
        return name

    def best(self) -> int:
        """The container that frames the article: inward as long as one container inside holds most of the score.

        A main heading is not left behind.
        """
        at = 0
        while True:
            here = self.containers[at]
            if here.heading:
                return at
            weigh = [(self.containers[i].score * (MEANT if self.containers[i].meant else 1), -i) for i in here.inner]
            weight, inside = max(weigh, default=(0, 0))
            own = here.score - sum(self.containers[i].score for i in here.inner)
            if weight <= 0 or weight < CLOSER * (own + sum(w for w, _ in weigh)):
                return at
            at = -inside

    def path(self, container: int) -> str:
        steps = []
        while container > 0:
            steps.append(self.containers[container].step)
            container = self.containers[container].parent
        return "/".join(reversed(steps))

    def text_at(self, path: str) -> str:
        """The blocks inside all containers of this path, in page order."""
        steps = path.split("/") if path else []
        # How many steps lead to each container; all of them at a match and inside it.
        led = [0] + [-1] * (len(self.containers) - 1)
        for i in range(1, len(self.containers)):
            before = led[self.containers[i].parent]
            if before == len(steps):
                led[i] = before
            elif before >= 0 and steps[before] == self.containers[i].step:
                led[i] = before + 1
        return "\n".join(text for where, text in self.blocks if led[where] == len(steps))


@functools.cache
def _raw_end(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE)


def vote(html: str) -> tuple[str, float]:
    """The path that a page is for, and the score of its container."""
    page = Page(html)
    best = page.best()
    return page.path(best), float(page.containers[best].score)


def extract(html: str, paths: list[str]) -> str:
    """The main text by the first of ``paths`` that the page has text at, or else by its own best container."""
    page = Page(html)
    for path in paths:
        text = page.text_at(path)
        if text:
            return text
    return page.text_at(page.path(page.best()))


def _host(url: str) -> Column:
    found = F.regexp_extract(F.lower(F.col(url).cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def host_paths(pages: DataFrame, url: str = "url", html: str = "html", kept: list[str] | None = None) -> DataFrame:
    """``host, pages, paths``: the paths that win at each host, most votes first, joined by spaces.

    Pages without a host vote for nothing. Votes are counted before the shuffle, so a host of any size costs a row for
    each of its paths and tasks. The counts are written, and their path is added to ``kept``.
    """
    rows = pages.select(_host(url).alias("host"), whole_text(html).alias("html")).filter("host IS NOT NULL")
    votes = by_row(rows, lambda page: [vote(page)], "path string, score double")
    counted = votes.filter("score > 0").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    counted = saved(counted, "votes", kept)
    ranked = F.sort_array(F.collect_list(F.struct(-F.col("votes"), -F.round("score"), F.col("path"))))
    by_host = counted.groupBy("host").agg(F.sum("votes").alias("pages"))
    winning = counted.join(by_host, "host").filter(F.col("votes") >= WINNING_SHARE * F.col("pages"))
    return winning.groupBy("host", "pages").agg(F.concat_ws(" ", F.transform(ranked, lambda x: F.translate(x["path"], " ", ""))).alias("paths"))


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    The text is that of the article: without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
    comments of readers and markup. An article's own header stays. Character references are decoded, white space inside a
    block (a line break element counts as such) becomes one space, and blocks follow in page order, joined by a line feed.

    Pages are independent but for the paths of their host: the first winning path that has text on the page decides, else
    the page's own best container; so also without a host. A null page is empty, and a page without text gives an
    empty text. Repeated and null ids are reported as they come. An empty table gives an empty result. Other columns are
    not read. The paths of hosts with very many pages go to all tasks, as there can be few of them; those of others are
    joined by host.
    """
    spark = pages.sparkSession
    kept: list[str] = []
    agreed = saved(host_paths(pages, url, html, kept), "host-paths", kept)
    total = agreed.agg(F.sum("pages")).first()[0] or 0
    is_hot = F.col("pages") > total * HOT_SHARE
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), _host(url).alias("host"), whole_text(html).alias("html"))
    hot = agreed.filter(is_hot).select("host", "paths")
    placed = rows.join(F.broadcast(hot), "host", "left")
    cold = agreed.filter(~is_hot).select("host", F.col("paths").alias("own"))
    if not cold.isEmpty():
        rest = placed.filter("paths IS NULL").join(cold, "host", "left").withColumn("paths", F.col("own"))
        placed = placed.filter("paths IS NOT NULL").unionByName(rest.drop("own"))
    asked = placed.select("page_id", "url", F.concat(F.coalesce("paths", F.lit("")), F.lit("\n"), F.col("html")).alias("html"))

    def read(asked: str) -> list[tuple]:
        paths, page = asked.split("\n", 1)
        return [(extract(page, paths.split()),)]

    texts = by_row(asked, read, "text string").withColumn("n_chars", F.char_length("text").cast("bigint"))
    result = saved(texts, "main-texts")
    for path in kept:
        remove(spark, path)
    return result
