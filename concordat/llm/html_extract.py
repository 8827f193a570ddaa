"""Main text of HTML pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Elements that start and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never shown or is no running text.
SILENT = frozenset("annotation annotation-xml audio button canvas datalist embed head iframe input noscript object option script select style svg template textarea title video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element that a start tag of the same group closes.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Elements that stand in a head; the end tag of a head may be left out, and any other element closes it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
#: Elements of a head whose own content, blocks too, does not close it.
HIDDEN_IN_HEAD = ("noscript", "template")
#: Evidence for content (positive) and boilerplate (negative) that an element gives to all below it.
TAG_EVIDENCE = {
    "article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "address": -3.0,
    "fieldset": -5.0, "header": -5.0,
}
#: Words of names that mark boilerplate, at any length of its text.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright"
    " disqus footer gdpr header masthead menu nav navbar navigation newsletter notice notices pager pagination promo related recommended sidebar"
    " signup sponsor sponsored subscribe topbar".split()
)
#: Words that often do, but that prose in them outweighs: they have other meanings, too.
DOUBTFUL_NAMES = frozenset(
    "alert banner byline disclaimer foot legal login metadata modal overlay popup promotion rail replies reply respond search share sharing side"
    " social tags toolbar widget".split()
)
CONTENT_NAMES = frozenset("article body content entry hentry main post story text".split())
#: Words of form and place that leave the meaning to the word before them ("comment-list", "sidebar-left").
FORM_NAMES = frozenset(
    "area bar block body bottom box button buttons center column container content count form group heading holder icons image inner item items left"
    " link links list module outer panel posts right row section slot text thread title top unit wrap wrapper".split()
)
#: Words before which a name tells a state of the page, not what an element is ("has-sidebar").
STATE_NAMES = frozenset("has hide is no show with without".split())
#: Form controls; an element that cannot stand in one closes it where its end tag is missing.
CONTROLS = frozenset("button datalist option select textarea".split())
NOT_IN_CONTROLS = frozenset("article aside blockquote fieldset footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split())
#: Smoothness: neighbours in page order, and blocks that follow each other below one element.
ADJACENT, SIBLING = 0.6, 1.0


def name_evidence(names: str, article: bool = False) -> float:
    """Evidence of an element's class, id and role for content.

    Names are taken whole: one word, or a compound that the word before words of form ("comment-list")
    or the last word ("site-footer") decides.  On an article itself only what is surely no article
    counts: its other names are often those of its subjects.
    """
    least, content = 0.0, False
    for name in names.split():
        words = [w.rstrip("0123456789") for w in re.split(r"[-_:./]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower())]
        words = [w for w in words if w]
        if not words or words[0] in STATE_NAMES:
            continue
        head = words[0] if all(w in FORM_NAMES or w in DOUBTFUL_NAMES for w in words[1:]) else "" if article else words[-1]
        titled = head == "header" and not CONTENT_NAMES.isdisjoint(words)
        if head in BOILERPLATE_NAMES and not titled:
            least = -9.0
        elif head in DOUBTFUL_NAMES and not article:
            # The last word of a compound such as "side-by-side" or "market-share" says nothing.
            least = min(least, -5.0 if head == words[0] else 0.0)
        content = content or words[-1] in CONTENT_NAMES
    return least or 2.0 * content


class Block:
    __slots__ = ("parts", "linked", "evidence", "parent", "heading", "inside")

    def __init__(self, evidence: float, parent: int, heading: bool, inside: bool):
        self.parts: list[str] = []
        self.linked = 0
        self.evidence, self.parent, self.heading, self.inside = evidence, parent, heading, inside


class Blocks(HTMLParser):
    """Blocks of a page in order, each with its text and the evidence of the elements around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.block: Block | None = None
        # Open elements: tag, number, evidence so far, inside an article or main element.
        self.stack: list[tuple[str, int, float, bool]] = [("", 0, 0.0, False)]
        self.open: dict[str, int] = {}
        self.number = self.silent = self.links = 0

    def _end_head(self, tag: str = "") -> None:
        """Close an open head, and what is open in it, before ``tag`` or text that cannot stand there."""
        if tag in IN_HEAD or tag != "body" and any(self.open.get(x) for x in HIDDEN_IN_HEAD):
            return
        if tag in BLOCKS or self.stack[-1][0] == "head":
            self._close("head")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open.get("head"):
            self._end_head(tag)
        if tag == "br":
            self.handle_data(" ")
        if tag in NOT_IN_CONTROLS and self.silent:
            for other in CONTROLS:
                self._close(other)
        if tag in BLOCKS:
            self.block = None
            for other in CLOSES.get(tag, ()):
                if self.stack[-1][0] == other or other == "p" and self.open.get("p") and self._paragraph_open():
                    self._close(other)
        if tag in VOID:
            return
        self.number += 1
        _, _, evidence, inside = self.stack[-1]
        own = TAG_EVIDENCE.get(tag, 0.0)
        if inside and tag in ("header", "article", "main"):
            own = 0.0
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        if any(k in ("hidden", "aria-hidden") and v != "false" for k, v in attrs):
            own -= 5.0
        if names and tag not in ("html", "body"):
            own += name_evidence(names, tag in ("article", "main"))
        if tag == "main":
            evidence = max(evidence, 0.0)
        inside = inside or tag in ("article", "main") and own > 0
        self.stack.append((tag, self.number, evidence + own, inside))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    def set_cdata_mode(self, elem: str, **kwargs) -> None:
        """Only scripts and styles hide markup; newer parsers would read an open text area to the end of the page."""
        if elem in self.CDATA_CONTENT_ELEMENTS:
            super().set_cdata_mode(elem, **kwargs)

    def _paragraph_open(self) -> bool:
        """Whether a paragraph is open below the innermost other block."""
        for tag, *_ in reversed(self.stack):
            if tag in BLOCKS:
                return tag == "p"
        return False

    def _close(self, tag: str) -> None:
        while self.open.get(tag):
            last = self.stack.pop()[0]
            self.open[last] -= 1
            self.silent -= last in SILENT
            self.links -= last == "a"
            if last == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block = None
        self._close(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and tag not in SILENT:
            self._close(tag)
        elif tag in SILENT and tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.stack[-1][0] == "head" and not data.isspace():
            self._end_head()
        if self.silent:
            return
        if self.block is None:
            if data.isspace():
                return
            tag, number, evidence, inside = next(x for x in reversed(self.stack) if x[0] in BLOCKS or not x[0])
            parent = self.stack[-2][1] if len(self.stack) > 1 and self.stack[-1][1] == number else number
            self.block = Block(self.stack[-1][2], parent, tag in ("h1", "h2", "h3", "h4", "h5", "h6"), inside)
            self.blocks.append(self.block)
        self.block.parts.append(data)
        if self.links:
            self.block.linked += len(data)


def _costs(blocks: list[Block], texts: list[str]) -> list[float]:
    """The classifier: evidence for content (positive) or boilerplate (negative) of each block."""
    marked = any(b.inside for b in blocks)
    found = []
    for block, text in zip(blocks, texts, strict=True):
        words = text.count(" ") + 1
        links = min(1.0, block.linked / max(1, len(text)))
        score = block.evidence + min(3.0, words / 10) - 4.0 * links
        score += 0.5 * (text[-1:] in ".!?:;…\"'") + 1.0 * block.heading - 0.5
        if marked and not block.inside:
            score -= 4.0
        found.append(score)
    return found


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least total cost: what a label costs a block, and each edge between unlike labels.

    A positive score is the capacity from the source, a negative one that to the sink.  A block
    whose capacity exceeds its edges' is decided at once; a maximum flow (by blocking flows in
    level graphs) decides the others, and what the source still reaches is content.
    """
    n = len(scores)
    weight = [0.0] * n
    for a, b, w in edges:
        weight[a] += w
        weight[b] += w
    label: list[bool | None] = [s > 0 if abs(s) > w else None for s, w in zip(scores, weight, strict=True)]
    if None not in label:
        return label
    number = {i: k for k, i in enumerate(i for i in range(n) if label[i] is None)}
    source, sink = len(number), len(number) + 1
    terminal = {i: [max(0.0, scores[i]), max(0.0, -scores[i])] for i in number}
    to, room, out = [], [], [[] for _ in range(len(number) + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for a, b, w in edges:
        if label[a] is None and label[b] is None:
            add(number[a], number[b], w, w)
        elif label[a] is None:
            terminal[a][not label[b]] += w
        elif label[b] is None:
            terminal[b][not label[a]] += w
    for i, (content, other) in terminal.items():
        if content:
            add(source, number[i], content, 0.0)
        if other:
            add(number[i], sink, other, 0.0)
    tiny = 1e-9
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        at = [0] * len(out)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if room[e] <= tiny)
                x = to[path[first] ^ 1]
                del path[first:]
            elif at[x] < len(out[x]):
                e = out[x][at[x]]
                if room[e] > tiny and level[to[e]] == level[x] + 1:
                    path.append(e)
                    x = to[e]
                else:
                    at[x] += 1
            elif path:
                x = to[path.pop() ^ 1]
                at[x] += 1
            else:
                break
    for i, k in number.items():
        label[i] = level[k] >= 0
    return label


def main_text(html: str | None) -> str:
    """Main text of one page: its content blocks in page order, one on each line."""
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    pairs = [(b, t) for b in parser.blocks if (t := " ".join("".join(b.parts).split()))]
    blocks, texts = [b for b, _ in pairs], [t for _, t in pairs]
    edges = [(i, i + 1, ADJACENT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if block.parent in last:
            edges.append((last[block.parent], i, SIBLING))
        last[block.parent] = i
    labels = min_cut(_costs(blocks, texts), edges)
    return "\n".join(t for t, content in zip(texts, labels, strict=True) if content)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add ``text``, the main text of each page, to ``pages``.

    Blocks are runs of text between block-level tags, with character references decoded and white
    space turned into single blanks.  A classifier gives each block a cost for either label: the
    elements and names around it, its length, links and punctuation.  Costs are terminal capacities,
    page order and common parents are smoothness edges, and a minimum cut labels the blocks.

    Null and empty pages have an empty text, and so has a page without content.  Pages of any
    length are read whole; every page is a row.  All columns are kept; one that is already called
    ``text`` is replaced.
    """
    kind = T.StructType([f for f in pages.schema.fields if f.name != text] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(x) for x in batch.column(html).to_pylist()], pa.string())
            kept = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [found], kept + [text])

    return pages.mapInArrow(run, kind)
