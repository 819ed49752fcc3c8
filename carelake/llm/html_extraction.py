"""Main text of web pages by tag-path ratios.

A page is cut into blocks: the text between two borders of block-level
elements. Each block has a tag path, the labels (tag, classes and id without
digits) from the root down to its innermost block-level element; inline markup belongs to its
block. Per page:

1. Blocks in boilerplate zones (navigation, page headers and footers, asides, forms, adverts,
   notices, reader comments, hidden elements; by tag, role, class and id) are put aside.
2. Text length, punctuation and link text are summed per tag path. A path's text
   ratio is its unlinked text per block, its punctuation ratio its punctuation per block.
3. Each block takes its path's ratios; both sequences are smoothed over neighbouring blocks with a
   Gaussian and fused into one score, ``text * (1 + punctuation)``.
4. A path whose mean score reaches ``LAMBDA`` standard deviations of the page's
   scores is a content path, and its blocks are content.
5. The article is completed: the container that holds most of the content (``article`` or ``main``
   elements where the page has them) also gives its other blocks, such as headings
   and short paragraphs, but for lists of links.

Spark deals out the pages; a page is worked on by itself, so nothing is
shuffled and a task holds one block of pages.

The text: character references are decoded, white space (as ``str.split`` sees it) inside
a block becomes one space, blocks are trimmed, empty ones go, and the rest are joined by
``\\n`` in page order. ``<br>`` is white space, a table row is one block.

Defined cases: null, empty and tag-only pages have an empty text and no paths; a page without
markup is one block; unclosed tags, comments and scripts end with the page or where HTML
implies it; pages of any length are read whole; repeated rows are extracted alike; an empty table
gives an empty table; other columns pass through, and a column with the name
of an output column is replaced.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import read_table, ship, text_blocks

#: Standard deviations of the page's scores that a content path reaches.
LAMBDA = 0.8
#: Gaussian weights of a block and its neighbours on either side.
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
#: Share of the content that a container has to hold to be gone into.
SHARE = 0.7
#: Link text from which on a block counts as a link.
LINKED = 0.6
#: Blocks of a list of links.
LINK_LIST = 3

# Elements of HTML by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt
    ruby s samp small span strike strong sub sup td th time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split())
CONTAINERS = frozenset("html body div section article main center form table tbody tr td".split())
#: What a start tag closes, and the elements beyond which it doesn't look.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
           "option": (("option",), ("select",)), "tr": (("tr",), ("table",)),
           "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
#: A block's place: in a form, in boilerplate.
FORM, ZONE = 1, 2
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# What marks boilerplate.
ZONE_TAGS = frozenset("""head nav footer aside button select fieldset noscript template dialog svg math object
    audio video canvas menu search""".split())
ZONE_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    status toolbar""".split())
#: A class or id with one of these words, unless a qualifier stands beside it.
ZONE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot breadcrumb breadcrumbs
    comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus flyout footer gdpr
    masthead menu modal nav navbar navigation navi newsletter outbrain overlay pager pagination paywall popup promo
    promotion recommended related replies reply respond responses share sharing signup skip social sponsor sponsored
    sponsors subscribe subscription taboola toolbar topbar tracking""".split())
#: The same, where no class of the element is made of content words.
SIDE_WORDS = frozenset("alert banner notice notices notification sidebar side widget widgets".split())
#: The same, where no article is around them either.
HEAD_WORDS = frozenset("header login search teaser teasers".split())
QUALIFIERS = frozenset("closed enabled has layout main no open page with without".split())
CONTENT_WORDS = frozenset("article body content entry main post story".split())

#: Quoted values are bounded, so that an unclosed quote costs no more than that.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>|"""
                    r"""<(/?)([a-zA-Z][^\s<>/]*)((?:[^<>"']|"[^"]{0,4096}"|'[^']{0,4096}')*+)>|"""
                    r"""<(/?)([a-zA-Z][^\s<>/]*)([^<>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?=[\s=/>]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                        re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_PUNCTUATION = re.compile(r"""[.,;:!?…。、，；：！？«»„“”"()]""")


def _label(tag: str, attributes: str) -> tuple[str, int, str, bool]:
    """An element's label in tag paths, how strongly its classes and id mark it as boilerplate (3: always,
    2: as SIDE_WORDS do, 1: as HEAD_WORDS do), its role, and whether it is hidden."""
    if not attributes or attributes.isspace():
        return tag, 0, "", False
    mark, names, role, hidden, content = 0, [], "", False, False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            names.append(re.sub(r"\d+", "", value))
            for token in value.split():
                words = {w.lower() for w in _WORD.findall(token)}
                content = content or bool(words) and words <= CONTENT_WORDS
                if not words & QUALIFIERS:
                    mark = max(mark, 3 if words & ZONE_WORDS else 2 if words & SIDE_WORDS else
                               1 if words & HEAD_WORDS and not words & CONTENT_WORDS else 0)
        elif name == "role":
            role = value.lower()
        elif name == "style":
            hidden = hidden or bool(_HIDDEN.search(value))
        else:
            hidden = hidden or name == "hidden" or value.lower() == "true"
    return ".".join([tag, *names]), 0 if content and mark < 3 else mark, role, hidden


class _Element:
    __slots__ = ("tag", "path", "zone", "link", "article", "number", "block")

    def __init__(self, tag, path, zone, link, article, number, block=None):
        self.tag, self.path, self.zone, self.link = tag, path, zone, link
        self.article, self.number = article, number
        self.block = self if block is None else block


class Page:
    """A page's blocks and the tree of its elements."""

    def __init__(self, html: str):
        self.parent: list[int] = [-1]          # of each element
        self.tags: list[str] = ["#page"]
        self.paths: dict[tuple[int, str], int] = {}
        self.path_of: list[tuple[int, str]] = [(-1, "")]
        #: block: [pieces, path, element, place (0, FORM or ZONE), length of link text, in an article, tag]
        self.blocks: list[list] = []
        self._stack = [_Element("#page", 0, 0, False, False, 0)]
        self._count: dict[str, int] = {}       # open elements by tag
        self._open = True                      # the next text begins a block
        self._read(html)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            if found is None:
                self._text(html[at:])
                return
            if found.start() > at:
                self._text(html[at:found.start()])
            at = found.end()
            slash, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if name is None:
                if found.group().startswith("<![CDATA["):
                    self._text(found.group()[9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            name = name.lower()
            if slash:
                self._end(name)
            elif name in RAW:
                close = _RAW_END[name].search(html, at)
                if close is None:
                    return
                stop = html.find(">", close.end())
                at = end if stop < 0 else stop + 1
            else:
                self._start(name, attributes)

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        if self._open:
            if not raw or raw.isspace():
                return
            block = top.block
            self.blocks.append([[], block.path, block.number, top.zone, 0, block.article, block.tag])
            self._open = False
        text = unescape(raw) if "&" in raw else raw
        last = self.blocks[-1]
        if top.zone > last[3]:                 # an inline zone in content
            return
        if top.zone < last[3]:                 # content after an inline zone
            last[3], last[0], last[4] = top.zone, [], 0
        last[0].append(text)
        if top.link:
            last[4] += len(text.strip())

    def _pop(self, k: int) -> None:
        for e in self._stack[k:]:
            self._count[e.tag] -= 1
        del self._stack[k:]

    def _pop_to(self, names, beyond) -> None:
        if not any(self._count.get(t) for t in names):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag in names:
                self._pop(k)
                self._open = True
                return
            if self._stack[k].tag in beyond:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and self._count.get("p"):
            for k in range(len(self._stack) - 1, 0, -1):
                if self._stack[k].tag == "p":
                    self._pop(k)
                    break
                if self._stack[k].tag not in INLINE or self._stack[k].tag in ("td", "th"):
                    break
        elif tag in IMPLIED:
            self._pop_to(*IMPLIED[tag])
        if tag not in INLINE:
            self._open = True
        elif tag in ("br", "td", "th", "img") and not self._open:
            self.blocks[-1][0].append(" ")
        if tag in VOID:
            return
        top = self._stack[-1]
        label, mark, role, hidden = _label(tag, attributes)
        whole = tag in ("article", "main") or role in ("main", "article")
        article = top.article or whole
        zone = FORM if tag == "form" else 0
        if tag not in ("html", "body") and (
                hidden or role in ZONE_ROLES or tag in ZONE_TAGS or mark >= 2 or
                (mark == 1 or tag == "header") and not article):
            zone = ZONE
        # A form may go around the whole page: an article in it is none of its fields.
        zone = max(zone, 0 if whole and top.zone == FORM else top.zone)
        key = (top.path, label)
        path = top.path if tag in INLINE and tag not in ("td", "th") else self.paths.setdefault(key, len(self.path_of))
        if path == len(self.path_of):
            self.path_of.append(key)
        number = len(self.parent)
        self.parent.append(top.number)
        self.tags.append(tag)
        self._count[tag] = self._count.get(tag, 0) + 1
        self._stack.append(_Element(tag, path, zone, top.link or tag == "a", article, number,
                                    top.block if tag in INLINE else None))

    def _end(self, tag: str) -> None:
        if tag == "p" or tag not in INLINE:
            self._open = True
        if not self._count.get(tag):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag == tag:
                self._pop(k)
                return
            if tag in INLINE and self._stack[k].tag in ("td", "th", "table") and tag not in ("td", "th"):
                return

    def path_name(self, path: int) -> str:
        names = []
        while path > 0:
            path, label = self.path_of[path]
            names.append(label)
        return "/".join(reversed(names))


def path_scores(paths: np.ndarray, text: np.ndarray, marks: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The fused score of each block, from the ratios of its path and of its neighbours'."""
    _, place = np.unique(paths, return_inverse=True)
    n = np.bincount(place)
    ratio = np.bincount(place, np.maximum(text - linked, 0)) / n
    punctuation = np.bincount(place, marks) / n
    middle = len(KERNEL) // 2

    def smooth(x):
        return np.convolve(x, KERNEL)[middle:middle + len(x)]

    weight = smooth(np.ones(len(paths)))
    return smooth(ratio[place]) / weight * (1 + smooth(punctuation[place]) / weight)


def content_blocks(page: Page) -> tuple[list[int], set[int]]:
    """Which blocks are content, and the content paths."""
    least = min((b[3] for b in page.blocks), default=ZONE)   # a form where the page has nothing else
    rows = [k for k, b in enumerate(page.blocks) if b[3] == least < ZONE]
    if not rows:
        return [], set()
    texts = ["".join(page.blocks[k][0]) for k in rows]
    paths = np.array([page.blocks[k][1] for k in rows])
    length = np.array([len("".join(t.split())) for t in texts], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts], float)
    linked = np.minimum(np.array([page.blocks[k][4] for k in rows], float), length)
    scores = path_scores(paths, length, marks, linked)
    mean = np.bincount(paths, scores) / np.maximum(np.bincount(paths), 1)
    content = mean[paths] >= LAMBDA * scores.std()
    share = linked / np.maximum(length, 1)
    content &= share <= LINKED
    if not content.any():
        content = scores >= scores.max()
    # Links one after the other in one path are a list of links.
    same = np.concatenate([[0], np.cumsum((np.diff(paths) != 0) | ((share[1:] > LINKED) != (share[:-1] > LINKED)))])
    link_list = (share > LINKED) & (np.bincount(same)[same] >= LINK_LIST)
    # Content of an element and of what it holds: children have higher numbers than their parents.
    mass = np.zeros(len(page.parent))
    np.add.at(mass, [page.blocks[k][2] for k in rows], length * content)
    for e in range(len(mass) - 1, 0, -1):
        mass[page.parent[e]] += mass[e]
    inside = np.array([page.blocks[k][5] for k in rows])
    if (content & inside).any():
        keep = inside & ~link_list
    else:
        children: dict[int, list[int]] = {}
        for e in range(1, len(mass)):
            children.setdefault(page.parent[e], []).append(e)
        root = 0
        while True:
            best = max((e for e in children.get(root, ()) if page.tags[e] in CONTAINERS), key=mass.__getitem__,
                       default=None)
            if best is None or mass[best] < SHARE * mass[root]:
                break
            root = best
        within = [False] * len(mass)
        within[root] = True
        for e in range(root + 1, len(mass)):
            within[e] = within[page.parent[e]]
        keep = content.copy()
        below = np.array([within[page.blocks[k][2]] for k in rows])
        tag = [page.blocks[k][6] for k in rows]
        chosen = np.flatnonzero(content)
        for i in np.flatnonzero(~content & (share <= LINKED)):
            after = chosen[np.searchsorted(chosen, i):]
            heads = tag[i] in HEADINGS and len(after) and after[0] - i <= 3
            # Headings over the content, and what its container has between content blocks.
            keep[i] = heads or below[i] and len(after) and chosen[0] < i
    return [k for k, kept in zip(rows, keep, strict=True) if kept], set(paths[content & keep].tolist())


def main_text(html: str) -> tuple[str, list[str]]:
    """The page's main text and its content paths in page order."""
    page = Page(html)
    kept, paths = content_blocks(page)
    texts = [" ".join("".join(page.blocks[k][0]).split()) for k in kept]
    names = dict.fromkeys(page.path_name(page.blocks[k][1]) for k in kept if page.blocks[k][1] in paths)
    return "\n".join(t for t in texts if t), list(names)


def extract(pages: DataFrame, html: str = "html", text: str = "text", paths: str = "content_paths") -> DataFrame:
    """``pages`` with the main text of each, its ``n_chars`` and its content paths."""
    from pyspark.sql.pandas.types import to_arrow_schema
    added = [T.StructField(text, T.StringType(), False), T.StructField("n_chars", T.LongType(), False),
             T.StructField(paths, T.ArrayType(T.StringType(), False), False)]
    names = {f.name for f in added}
    schema = T.StructType([f for f in pages.schema.fields if f.name not in names] + added)
    target = to_arrow_schema(schema)
    source = "__html"
    while source in pages.columns:
        source += "_"
    ship(pages.sparkSession)

    def run(batches):
        for batch, sources in text_blocks(batches, source):
            found = [main_text(h) for h in sources]
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {
                text: pa.array([f[0] for f in found], pa.string()),
                "n_chars": pa.array([len(f[0]) for f in found], pa.int64()),
                paths: pa.array([f[1] for f in found], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in target], schema=target)

    return pages.withColumn(source, F.col(f"`{html}`").cast("string")).mapInArrow(run, schema)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
