"""Main text of web pages by consensus on each host's container paths.

Each page scores its containers: the share of the page's paragraph text that an element holds,
times the share of that text in all text it holds.  The best container casts its score as a
vote for its generalised path (tags with their classes, without numbers and positions).  Spark
sums the votes per host; each page is then extracted again with its host's winning paths, in
the order of their votes, and only by its own best container if it has none of them.

Navigation, page headers, footers, asides, forms, adverts, notices, comments and the like are
never part of a container's text, whether named by tag, role, class or id.  A name counts if it
consists of furniture words and neutral ones ("site-nav", not "search-term" or "has-sidebar");
inline elements and headings are never cut by a name.  Comments, adverts and consent notices go
whatever they hold.  Other named elements, and forms, are judged by what they hold: one around an article,
a main element or a first-level heading is a wrapper and stays, and so are the outermost ones of a page
that would have no text without them.  How much text an element holds plays no part in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, written

WINNING_SHARE = 0.25  # of the best path's votes, which a further path of a host needs
TEXT_ROWS = 512

# Element names of the HTML standard by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas "
                "select noembed noframes xmp audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split())
SKIPPED = frozenset("head nav footer aside button fieldset menu dialog".split())
WRAPPED = frozenset("article main h1".split())  # an element around one of them is a wrapper
SWALLOWING = frozenset("script style textarea title".split())  # of RAW: without an end they take the rest
CLOSED_BY_BLOCK = "p"
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
               "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt td th figcaption".split())

# Words in class, id or role names that mark page furniture.
FURNITURE = frozenset("""
ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo
promotion nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager
sidebar aside rail widget widgets
header masthead topbar footer colophon copyright
cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay
comment comments respond disqus reply replies
share sharing social related recommended newsletter subscribe signup login search form
contentinfo complementary skip
""".split())

# Those of them that no article is inside of.
ALWAYS = frozenset("""
ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored
cookie cookies consent gdpr comment comments respond disqus reply replies
""".split())
COMMENTS = frozenset("comment comments respond disqus reply replies".split())

# Words that say nothing beside a furniture word; words that make a header the
# article's own; words after which a name tells what an element has or lacks.
NEUTRAL = frozenset("""
site page main global primary secondary top bottom left right upper lower first last sticky fixed mobile
desktop area bar block box button buttons col column container content group icon icons inner outer item
items js link links list panel row section slot the unit widget wrap wrapper zone post posts entry article
user users reader readers text message info
""".split())
OWN_HEADER = frozenset("article content entry main page post section story".split())
DESCRIBING = frozenset("has no not with without hide hides show shows hidden".split())
UNCUT = INLINE | frozenset("h1 h2 h3 h4 h5 h6 html body article main".split())
# Elements whose id is mostly the anchor of a passage.
ANCHORED = (PARAGRAPH | {"section"}) - {"td", "th"}
SOFT, HARD = 1, 2  # kinds of furniture: cut unless it is a wrapper; cut in any case

_TAG = re.compile(r"""<(?:!--(?P<note>.*?(?:-->|\Z))|(?P<kind>[/!?]?)(?P<name>[a-zA-Z][^\s/>]*+)"""
                  r"""(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?P<end>>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_NUMBER = re.compile(r"\d+")
_SPLIT = re.compile(r"[\s_\-:.]+|(?<=[a-z])(?=[A-Z])")


def _furniture(name: str, inside: bool) -> int:
    """The kind of page furniture that a class, id or role names, or 0; ``inside`` an article or not."""
    words = [w.lower() for w in _SPLIT.split(_NUMBER.sub("", name)) if w]
    for i, word in enumerate(words):
        if word in DESCRIBING:
            words = words[:i]
            break
    if inside or OWN_HEADER.intersection(words):
        words = [w for w in words if w != "header"]
    if not FURNITURE.intersection(words) or not all(w in FURNITURE or w in NEUTRAL for w in words):
        return 0
    return HARD if ALWAYS.intersection(words) else SOFT


def _anchored(name: str) -> int:
    """The same for a section's id, which mostly names a passage: only comments count."""
    words = {w.lower() for w in _SPLIT.split(_NUMBER.sub("", name)) if w}
    return HARD if words & COMMENTS and words <= COMMENTS | NEUTRAL else 0


def _names(tag: str, rest: str, inside: bool) -> tuple[str, int, bool]:
    """Generalised classes of a tag, the furniture that its class, id or role names, if it's hidden."""
    classes, furniture, hidden = [], 0, False
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "class":
            classes += [_NUMBER.sub("", c) for c in value.split()]
        if name in ("class", "role") or (name == "id" and tag not in ANCHORED):
            furniture = max([furniture, *(_furniture(v, inside) for v in value.split())])
        elif name == "id" and tag == "section":
            furniture = max(furniture, _anchored(value))
        hidden = (hidden or name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true")
                  or (name == "style" and bool(_NO_DISPLAY.search(value))))
    label = "".join(f".{c}" for c in sorted(set(classes)) if c)
    return label, 0 if tag in UNCUT else furniture, hidden


class Page:
    """Elements (parent, path) and blocks (element, text, linked characters, in a paragraph)."""

    def __init__(self, html: str):
        self.parents: list[int] = [-1]
        self.paths: list[str] = [""]
        self.blocks: list[tuple[int, str, int, bool]] = []
        self._stack: list[tuple[str, int, bool]] = [("", 0, False)]  # name, element, skipped
        self._named: dict[int, int] = {}  # elements that a name calls furniture, and its kind
        self._wrappers: set[int] = set()  # elements around an article
        self._text: list[str] = []
        self._linked = 0
        self._links = 0
        self._read(html)

    def _flush(self) -> None:
        text = " ".join(unescape("".join(self._text)).split())
        if text:
            paragraph = any(name in PARAGRAPH for name, _, _ in self._stack)
            element = next(e for name, e, _ in reversed(self._stack) if name not in INLINE)
            self.blocks.append((element, text, self._linked, paragraph))
        self._text, self._linked = [], 0

    def _pop_to(self, depth: int) -> None:
        if any(name not in INLINE for name, _, _ in self._stack[depth:]):
            self._flush()
        self._links -= sum(name == "a" for name, _, _ in self._stack[depth:])
        del self._stack[depth:]

    def _open(self, name: str, rest: str) -> None:
        stack = self._stack
        if name not in INLINE:
            if name in SAME_CLOSES:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in SAME_CLOSES[name]:
                        break
                    if stack[depth][0] == name:
                        self._pop_to(depth)
                        break
            for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[depth][0] == CLOSED_BY_BLOCK:
                    self._pop_to(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
            self._flush()
        _, parent, skipped = stack[-1]
        inside = bool(rest or name == "header") and any(n in ("article", "main") for n, _, _ in stack)
        label, furniture, hidden = _names(name, rest, inside) if rest else ("", 0, False)
        skipped = skipped or hidden or name in SKIPPED or (name == "header" and not inside)
        element = parent
        if name not in INLINE:
            element = len(self.parents)
            self.parents.append(parent)
            self.paths.append(f"{self.paths[parent]}/{name}{label}")
            if furniture or name == "form":
                self._named[element] = furniture or SOFT
            if name in WRAPPED and not skipped:
                while parent and parent not in self._wrappers:
                    self._wrappers.add(parent)
                    parent = self.parents[parent]
        stack.append((name, element, skipped))
        self._links += name == "a"

    def _close(self, name: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] == name:
                self._pop_to(depth)
                return
            if name in INLINE and self._stack[depth][0] not in INLINE:
                return  # a stray end of an inline tag doesn't close the block around it

    def _add(self, text: str) -> None:
        if not self._stack[-1][2] and text:
            self._text.append(text)
            if self._links > 0:
                self._linked += len(text.strip())

    def _read(self, html: str) -> None:
        at, size, unclosed = 0, len(html), set()
        while at < size:
            m = _TAG.search(html, at)
            if not m:
                self._add(html[at:])
                break
            self._add(html[at: m.start()])
            at = m.end()
            if m["name"] is None or m["kind"] in ("!", "?"):
                continue
            if not m["end"]:
                break  # the page ends inside a tag
            name, rest = m["name"].lower(), m["rest"]
            if m["kind"] == "/":
                self._close(name)
            elif name in RAW:
                if rest.endswith("/") and name in ("svg", "math"):
                    continue
                end = None if name in unclosed else re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                if end or name in SWALLOWING:
                    at = end.end() if end else size
                else:
                    unclosed.add(name)  # the tag alone is dropped; no need to look for its end again
            elif name in VOID:
                if name == "hr":
                    self._flush()
                else:
                    self._add(" ")
            else:
                self._open(name, rest)
        self._pop_to(1)
        self._flush()
        self._cut()

    def _cut(self) -> None:
        """Drop the blocks of furniture elements that aren't wrappers."""
        if not self._named:
            return
        cut = {e for e, kind in self._named.items() if kind == HARD or e not in self._wrappers}
        while True:
            gone, outermost = [False] * len(self.parents), []
            for e in range(1, len(gone)):  # parents come before their children
                above = gone[self.parents[e]]
                gone[e] = above or e in cut
                if gone[e] and not above and self._named[e] == SOFT:
                    outermost.append(e)
            left = [b for b in self.blocks if not gone[b[0]]]
            if not outermost or any(paragraph and linked < len(text) for _, text, linked, paragraph in left):
                break
            # No text without them: what stands outermost is around the page, not part of it.
            holding = self._holding(cut)
            around = [e for e in outermost if holding[e]]
            if not around:
                break
            cut.difference_update(around)
        self.blocks = left

    def _holding(self, cut: set[int]) -> list[bool]:
        """Of every element, whether there is unlinked text in it outside of comments and adverts."""
        hard = [False] * len(self.parents)
        for e in range(1, len(hard)):
            hard[e] = hard[self.parents[e]] or (e in cut and self._named[e] == HARD)
        holds = [False] * len(self.parents)
        for element, text, linked, _ in self.blocks:
            holds[element] = holds[element] or (linked < len(text) and not hard[element])
        for e in range(len(holds) - 1, 0, -1):
            holds[self.parents[e]] = holds[self.parents[e]] or holds[e]
        return holds

    def best(self) -> tuple[str, float]:
        """Path and score of the best container; the deepest of equals.  No text: ("", 0)."""
        good, every = [0.0] * len(self.parents), [0] * len(self.parents)
        for element, text, linked, paragraph in self.blocks:
            weight = max(len(text) - linked, 0) * (1.0 if paragraph else 0.25)
            e = element
            while e >= 0:
                good[e] += weight
                every[e] += len(text)
                e = self.parents[e]
        if not good[0]:
            return "", 0.0
        score = [g * g / (good[0] * n) if n else 0.0 for g, n in zip(good, every)]
        top = max(score)
        winner = max((e for e, s in enumerate(score) if s >= top - 1e-9),
                     key=lambda e: (self._container(e), self.paths[e].count("/"), -e))
        while not self._container(winner):
            winner = self.parents[winner]
        return self.paths[winner], score[winner]

    def _container(self, element: int) -> bool:
        name = self.paths[element].rpartition("/")[2].partition(".")[0]
        return name not in PARAGRAPH

    def text(self, path: str) -> str:
        """The blocks within the elements at ``path``, one a line."""
        inside = [p == path for p in self.paths]
        for e in range(1, len(inside)):
            inside[e] = inside[e] or inside[self.parents[e]]
        return "\n".join(t for e, t, _, _ in self.blocks if inside[e])


def extract(html: str, paths: list[str]) -> str:
    """Text of the first of ``paths`` that the page has; else of its own best container."""
    page = Page(html)
    for path in paths:
        if text := page.text(path):
            return text
    return page.text(page.best()[0])


def _htmls(batch: pa.RecordBatch, column: str) -> list[str]:
    return [h or "" for h in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "html"):
        best = [Page(h).best() for h in _htmls(batch, "html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p for p, _ in best], pa.string()),
             pa.array([s for _, s in best], pa.float64())], names=["host", "path", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "html"):
        paths = batch.column(3).to_pylist()
        texts = [extract(h, p or []) for h, p in zip(_htmls(batch, "html"), paths)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"])


def host_of(url):
    """Host of a URL without user and port, in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(
        url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): each host's winning container paths, most votes first."""
    votes = (pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
             .mapInArrow(_vote, "host string, path string, score double").where("score > 0")
             .groupBy("host", "path").agg(F.sum("score").alias("votes")))
    votes = written(votes, "votes", batch_rows=TEXT_ROWS)
    top = votes.groupBy("host").agg(F.max("votes").alias("most"))
    return (votes.join(top, "host").where(F.col("votes") >= F.col("most") * WINNING_SHARE)
            .groupBy("host")
            .agg(F.sort_array(F.collect_list(F.struct((-F.round("votes", 6)).alias("v"), "path")))
                 ["path"].alias("paths")))


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by a line feed in page order.  Null or empty html, and pages without article text,
    give an empty text.  Of containers with equal scores the deepest votes, of those the first on the page;
    of a host's paths with equal votes the first by name.  Rows without url vote together.  Repeated rows are extracted each;
    other columns are ignored."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    paths = written(host_paths(pages), "paths").withColumnRenamed("host", "h")
    kind = pages.schema["page_id"].dataType.simpleString()
    found = (rows.join(paths, host_of(F.col("url")) == F.col("h"), "left")
             .select("page_id", "url", "html", "paths")
             .mapInArrow(_extract, f"page_id {kind}, url string, text string"))
    return written(found, "extracted", batch_rows=TEXT_ROWS).withColumn(
        "n_chars", F.length("text").cast("long"))
