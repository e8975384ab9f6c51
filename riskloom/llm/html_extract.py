"""Main text of web pages by consensus paths of their hosts.

1. Tasks score the containers of each page: text outside menus and the like counts for the container
   that holds it, half for the next one outwards, a quarter for the one after, and a twentieth less
   with every further step. The best container is widened to the article or main around it, or else outwards as long as what
   comes in is text rather than links. The page votes for the path of the result: tags with classes
   and ids from the root on, digits made alike.
2. Spark counts votes by host and path. Paths with at least MIN_SHARE of a host's votes win; so a
   host has ten at most, whatever its size.
3. Every page is read again with the winning paths of its host, most votes first: the first one that
   the page has, with text, is its article. A page that has none takes its own best container.

A name like ``sidebar`` or ``comments`` marks what isn't article text only as the last word of a class (not
``sidebar-right`` or ``comments-open``), and no element does that holds the title and most of the page's text;
a form is part of the page if it holds an article, a title or most of the text.

Parsing is a small helper for one page at a time, tolerant of tags that are never closed. Its time and
memory are proportional to the page, whatever its tags: paths are built for voted containers only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.scratch import save_scratch

MIN_SHARE = 0.1

# Elements and names of HTML, and words that sites use for what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = "script|style|noscript|template|textarea|title|svg|iframe|object|select|math|video|audio|canvas"
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body center div main section td".split())
NOISE_TAGS = frozenset("aside button dialog footer head menu nav".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup "
    "promo promoted promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription teaser toolbar widget widgets".split()
)
ARTICLE_WORDS = frozenset("article body content entry main post story text".split())
#: After one of the words above these say no more than "part of a page": comment-list, share-buttons.
PART_WORDS = frozenset(
    "area areas articles bar block body box button buttons card cards col column container content frame group heading holder icons inner item "
    "items label layer link links list outer overlay panel posts region row section slot stories strip title unit wrap wrapper zone".split()
)
SOUND, DOUBTFUL, NOISE = range(3)
#: An element ends the open elements of its list, up to the nearest element of the second list.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ()),
}

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(?P<unread>{UNREAD})\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=unread)\s*>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    # tags with a stray quote, and one that the end of the page cuts, are markup all the same
    r"""|(?P<stray></?[a-zA-Z][^<>]*(?:>|\Z)|</?\Z)|(?P<text>[^<]+|<)""",
    re.S | re.I,
)
#: The same for a tag without an end.
_STRAY = re.compile(r"(?P<tag>(?!))?(?:(?P<stray></?[a-zA-Z][^<>]*(?:>|\Z)|</?\Z)|(?P<text>[^<]+|<))", re.S)
MANY = 32
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMED = re.compile(r"class|id|role|hidden|style", re.I)


@lru_cache(1 << 14)
def _element(tag: str, attrs: str) -> tuple[str, bool]:
    """(part of a path, whether the element's names say that it isn't article text)."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if _NAMED.search(attrs) else {}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    path = tag + "".join(f".{x}" for x in sorted({re.sub(r"\d+", "0", x.lower()) for x in found.get("class", "").split()}))
    if found.get("id"):
        path += "#" + re.sub(r"\d+", "0", found["id"].lower())
    path = path.replace("/", "|")
    if tag in ("html", "body", "article", "main"):
        return path, SOUND
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    if hidden or role in NOISE_ROLES or tag in NOISE_TAGS:
        return path, NOISE
    if tag == "form" or role == "form" or any(map(_names_noise, names.split())):
        return path, DOUBTFUL
    return path, SOUND


def _names_noise(name: str) -> bool:
    """Whether a class or id says that its element isn't article text."""
    words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
    kept = [x for k, x in enumerate(words) if not (k and words[k - 1] in ("with", "has", "no", "without"))]
    while len(kept) > 1 and kept[-1] in PART_WORDS and kept[-1] not in NOISE_WORDS:
        kept.pop()
    if not kept or len(kept) < len(words) and kept == words[: len(kept)] and kept[-1] in ("has", "with", "no", "without"):
        return False
    return kept[-1] in NOISE_WORDS or kept[-1] == "header" and ARTICLE_WORDS.isdisjoint(words)


def _tokens(html: str) -> Iterator[re.Match]:
    """Texts and tags of a page in time proportional to it.

    A tag that has no end costs a look at all that follows. After MANY such looks the ends of all tags are
    found from behind first, and tags without one aren't tried any more.
    """
    at, failures, ends = 0, 0, None
    while at < len(html):
        pattern = _TOKEN if ends is None or html[at] != "<" or ends(at) else _STRAY
        m = pattern.match(html, at)
        at = m.end()
        if pattern is _TOKEN and (m["stray"] is not None or m["text"] == "<"):
            failures += 1
            if failures == MANY:
                ends = _tag_ends(html)
        yield m


def _tag_ends(html: str):
    """Whether the tag that begins at a place has an end: a > outside quotes, for <! and <? any >."""
    marks = [(m.start(), m[0]) for m in re.finditer("[>\"']", html)]
    places = [p for p, _ in marks]
    ended, after = [False] * (len(marks) + 1), {'"': len(marks), "'": len(marks)}
    for k in range(len(marks) - 1, -1, -1):
        kind = marks[k][1]
        if kind == ">":
            ended[k] = True
        else:
            ended[k] = after[kind] < len(marks) and ended[after[kind] + 1]
            after[kind] = k
    last = html.rfind(">")
    return lambda at: at < last and (html[at + 1] in "!?" or ended[bisect_left(places, at)])


class PageText:
    """Containers and text blocks of one page."""

    def __init__(self, html: str):
        self.parts, self.parents, self.tags, self.hashes = [""], [-1], [""], [0]  # container 0 is the page
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._found: list[tuple[int, str, int, int]] = []  # the same, and the doubtful region
        self._regions: list[list] = [[-1, True, 0, 0]]  # parent, is a form, plain text, holds 1 an article, 2 a title
        self._open: list[tuple[str, int, bool, int, bool]] = []  # tag, container, not article text, region, in an article
        self._text: list[str] = []
        self._links = 0
        for m in _tokens(html):
            if m["text"] is not None:
                self._add(m["text"])
            elif m["tag"] is not None:
                tag = m["tag"].lower()
                (self._end if m["end"] else self._begin)(tag, m["attrs"])
        self._flush()
        self._judge()

    def _judge(self) -> None:
        """Drop the blocks of doubtful regions, but for those that hold the article."""
        for _, text, links, region in self._found:
            self._regions[region][2] += len(text) - links
        for parent, _, plain, holds in reversed(self._regions[1:]):  # a region comes after the one around it
            self._regions[parent][2] += plain
            self._regions[parent][3] = max(self._regions[parent][3], holds)
        sound, whole = [True], self._regions[0][2]
        for parent, form, plain, holds in self._regions[1:]:
            most = 2 * plain > whole
            sound.append(sound[parent] and (most or holds > 0 if form else most and holds > 1))
        self.blocks = [(container, text, links) for container, text, links, region in self._found if sound[region]]

    def path(self, container: int) -> str:
        parts = []
        while container > 0:
            parts.append(self.parts[container])
            container = self.parents[container]
        return "".join(f"/{x}" for x in reversed(parts))

    def _state(self) -> tuple[int, bool, int, bool]:
        return self._open[-1][1:] if self._open else (0, False, 0, False)

    def _add(self, text: str) -> None:
        if not self._state()[1]:
            text = unescape(text) if "&" in text else text
            self._text.append(text)
            if any(x[0] == "a" for x in self._open[-4:]):
                self._links += len(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                container, _, region, _ = self._state()
                self._found.append((container, text, min(self._links, len(text)), region))
            self._text, self._links = [], 0

    def _cut(self, at: int) -> None:
        if any(x[0] in BLOCK for x in self._open[at:]):
            self._flush()
        del self._open[at:]

    def _last(self, tags: tuple[str, ...], within: tuple[str, ...] | frozenset[str]) -> int:
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] in tags:
                return k
            if self._open[k][0] in within:
                return -1
        return -1

    def _begin(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self._text.append(" ")
            return
        if tag in BLOCK:
            self._flush()
            at = self._last(("p",), CONTAINER) if tag not in CLOSES else self._last(*CLOSES[tag])
            if tag == "body":
                at = self._last(("head",), ())
            if at >= 0:
                self._cut(at)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
            return
        container, noise, region, inside = self._state()
        if not noise:
            part, kind = _element(tag, attrs)
            noise = kind == NOISE or tag == "header" and not inside
            if kind == DOUBTFUL and not noise:
                self._regions.append([region, tag == "form", 0, 0])
                region = len(self._regions) - 1
            if tag in ("h1", "main", "article"):
                self._regions[region][3] = max(self._regions[region][3], 1 if tag == "article" else 2)
            if not noise and tag in CONTAINER:
                self.parts.append(part)
                self.parents.append(container)
                self.tags.append(tag)
                self.hashes.append(hash((self.hashes[container], part)))
                container = len(self.parts) - 1
        self._open.append((tag, container, noise, region, inside or tag in ("article", "main")))

    def _end(self, tag: str, _: str) -> None:
        at = self._last((tag,), () if tag in BLOCK else BLOCK)
        if at >= 0:
            self._cut(at)
        elif tag == "p":
            self._flush()

    def scores(self) -> list[float]:
        """Text that isn't links, by container: whole in its own, less in those around it, at any depth."""
        own, below, deep = ([0.0] * len(self.parts) for _ in range(3))
        for container, text, links in self.blocks:
            own[container] += len(text) - links
        for k in range(len(own) - 1, 0, -1):  # a container comes after the one around it
            below[self.parents[k]] += own[k]
            deep[self.parents[k]] += 0.25 * below[k] + 0.95 * deep[k]
        out = [x + 0.5 * y + z for x, y, z in zip(own, below, deep, strict=True)]
        for k, part in enumerate(self.parts):
            last = re.split(r"[.#-]", part)
            out[k] *= 1.5 if not ARTICLE_WORDS.isdisjoint(x for x in last if x != "body" or len(last) > 1) else 1.0
        return out

    def best(self) -> int:
        """The container with the highest score, the outermost of equal ones, widened to the whole article."""
        scores = self.scores()
        return self._widened(max(range(len(scores)), key=lambda k: (scores[k], -k)))

    def _widened(self, best: int) -> int:
        """The nearest article or main around a container, or the outermost one that adds more text than links.

        From an article it goes on to an article or main around that if that adds more text than links.
        """
        plain, links = [0] * len(self.parts), [0] * len(self.parts)
        for container, text, linked in self.blocks:
            plain[container] += len(text) - linked
            links[container] += linked
        for k in range(len(self.parts) - 1, 0, -1):
            plain[self.parents[k]] += plain[k]
            links[self.parents[k]] += links[k]
        around = [best]
        while self.parents[around[-1]] >= 0:
            around.append(self.parents[around[-1]])
        marked = [k for k in around if self.tags[k] in ("article", "main")]
        for k in marked or around:
            if k == (marked or around)[0] or plain[k] - plain[best] > links[k] - links[best]:
                best = k
        return best

    def text_of(self, chosen: set[int]) -> str:
        """The blocks inside the chosen containers, in page order."""
        inside = [False] * len(self.parts)
        for k, parent in enumerate(self.parents):
            inside[k] = k in chosen or parent >= 0 and inside[parent]
        return "\n".join(text for container, text, _ in self.blocks if inside[container])

    def article(self, winners: list[str]) -> str:
        """The text under the first winning path that the page has, or under its own best container."""
        for path in winners:
            wanted = 0
            for part in path.split("/")[1:]:
                wanted = hash((wanted, part))
            text = self.text_of({k for k, x in enumerate(self.hashes) if x == wanted and self.path(k) == path})
            if text:
                return text
        return self.text_of({self.best()})


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for html in batch.column("html"):
            page = PageText(html.as_py() or "")
            paths.append(page.path(page.best()) if page.blocks else None)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [PageText(html.as_py() or "").article(paths.as_py() or []) for html, paths in zip(batch.column("html"), batch.column("paths"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def winning_paths(pages: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """(host, paths): the paths with at least ``share`` of the votes of a host, most votes first."""
    votes = pages.select("host", "html").mapInArrow(_vote, "host string, path string").where("path IS NOT NULL")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("votes"))
    votes = save_scratch(votes, "votes")
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    most = votes.join(total, "host").where(F.col("votes") >= share * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("minus"), "path")))
    return most.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def extract_articles(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page.

    ``pages`` has page_id, url and html; other columns are ignored. A null or empty html, and a page
    without article text, has the text ''. Pages with a null url, or one without a host, vote
    together. Repeated rows vote once each. White space inside a block is one space, blocks are
    joined by a line break, character references are decoded.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    pages = pages.select(F.col("page_id").cast("bigint"), "url", "html", host.alias("host"))
    # written first, so that the join knows how large the winners are
    winners = save_scratch(winning_paths(pages), "paths")
    rows = pages.join(winners, "host", "left").select("page_id", "url", "html", "paths")
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string")
