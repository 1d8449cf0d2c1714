"""Main text of web pages: text-to-tag ratios, Gaussian smoothing, threshold clusters.

The standard library's parser feeds events to a line builder: every block-level tag ends a line, and
each line knows its text, its number of tags, its share of link text and the containers it stands in.
Lines inside boilerplate (by element, role, hidden state, or a class or id that names one) are marked.
A name counts in full when all of it says boilerplate ("comments", "ad-box"); inside article and main
elements only such names of containers count.  Elsewhere, a name of which only a part says so ("post-menu")
does not mark an element that holds most of the prose.  Headings and anchors of sections are never marked by name.

The text-to-tag ratio of the lines in page order is smoothed with a Gaussian; lines at or above the
threshold (the standard deviation of the smoothed ratios) seed clusters.  Seeds inside article or main
elements choose these and the articles beside them.  With a seed outside of such elements the clusters are
containers (sections, divisions, cells): ratios are smoothed inside each, and containers that stay below the
threshold and have no heading (link rows, footers without a telling tag) go.  All unmarked lines of what is kept
are returned in page order, so short paragraphs stay; runs of pure link lines outside articles do not.

Defined cases: a null, empty or markup-only page has the empty text; unclosed tags are closed by their
containers, an unclosed comment or tag at the end goes; nesting of any depth and pages of any length take
time in proportion to their length; a vetoed element that is never closed ends where an article or main element begins;
repeated pages are read row by row; other columns pass through, one named like the result is replaced.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, whole_text

# HTML elements by their role here.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section "
                    "summary table tbody tfoot thead tr ul").split())
BOILERPLATE = frozenset(("nav footer aside form script style noscript template iframe object svg canvas button select textarea "
                         "dialog menu head title label datalist audio video map").split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
                   "gdpr notice notices notification alert nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside "
                   "footer foot header masthead topbar comment comments reply replies disqus discussion respond share sharing social related "
                   "recommended recommendations newsletter subscribe subscription signup login search popup modal overlay widget "
                   "widgets pagination pager toolbar skip copyright teaser teasers outbrain taboola paywall").split())
#: Of a whole page or article, only these names make it boilerplate.
ARTICLE_NAMES = frozenset("ad ads advert advertisement sponsored promo comment comments reply related teaser recommended".split())
#: Names with no other use, and words that may stand beside one.
PLAIN_NAMES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo gdpr consent navbar navigation nav breadcrumb "
                         "breadcrumbs sidebar footer masthead topbar comment comments reply replies disqus share sharing related recommended "
                         "newsletter subscribe signup popup modal pagination pager copyright teaser teasers outbrain taboola paywall").split())
BESIDE = frozenset(("area section list box block body container wrapper wrap inner form left right top bottom slot unit banner bar button buttons "
                    "link links icons item items card group row column col panel posts post articles article stories widget node").split())
CONTAINERS = frozenset("article main div section aside ul ol li dl table nav header footer details center dir".split())
NEGATED = ("no", "not", "has", "with", "without", "is", "hide")
REGION = frozenset("article main section div td body blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SILENT = frozenset(("script", "style"))
RADIUS = 2
SIGMA = 1.0
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_TAG_START = re.compile(r"<[A-Za-z/!?]")
_KERNEL = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


def _plain(name: str, names: frozenset) -> bool:
    """Whether a whole class or id says boilerplate: one of the names, with nothing but layout words beside it."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    return not names.isdisjoint(parts) and all(p in names or p in BESIDE or p.isdigit() for p in parts)


def _partly(name: str) -> bool:
    """Whether a part of a class or id says boilerplate; parts after a negation do not."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    end = next((i for i, p in enumerate(parts) if p in NEGATED), len(parts))
    return not NAMES.isdisjoint(parts[:end])


def _named(tag: str, attrs: list, inside: bool = False) -> int:
    """What role, state, class and id of an element say: 2 boilerplate, 1 boilerplate unless it holds most of the prose, 0 neither."""
    if tag in ("html", "body"):
        return 0
    found = 0
    for key, value in attrs:
        value = value or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 2
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return 2
        if key == "role" and value.lower() in ROLES:
            return 2
        if key not in ("class", "id") or tag in HEADINGS or key == "id" and (tag not in CONTAINERS or inside and tag == "section"):
            continue
        for name in value.split():
            if tag in ("article", "main"):
                found = 2 if _plain(name, ARTICLE_NAMES) else found
            elif inside:
                found = 2 if tag in CONTAINERS and _plain(name, PLAIN_NAMES) else found
            elif _plain(name, PLAIN_NAMES if tag in CONTAINERS else NAMES):
                found = 2
            elif tag in CONTAINERS and (tag, key) != ("section", "id") and _partly(name):
                found = max(found, 1)
    return found


class LineBuilder(HTMLParser):
    """Parser events to lines (text, tags, link characters, node): a node is a block element with its parent, so a line costs the
    same however deep it stands.  Node 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.mark, self.home = [""], [-1], [0], [0]  # by node; home: outermost article or main, 0 without
        self.stack = [0]  # open nodes
        self.open = {}  # tag to the places of its open nodes in the stack
        self.marked = 0  # open nodes with a mark
        self.links = 0
        self.lines = []
        self.pieces, self.tags, self.link_chars = [], 0, 0

    def end_line(self):
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append((text, self.tags, self.link_chars, self.stack[-1]))
            self.tags = 0
        self.pieces, self.link_chars = [], 0

    def close_to(self, depth: int):
        """Close the open nodes from this place of the stack on."""
        self.end_line()
        for node in self.stack[depth:]:
            self.open[self.tag[node]].pop()
            self.marked -= self.mark[node] > 0
        del self.stack[depth:]
        self.links = 0

    def place(self, *tags) -> int:
        """Place of the innermost open node with one of these tags, 0 without."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.pieces.append(" ")
        elif tag == "a":
            self.links = 1
        elif tag in ("td", "th"):
            self.pieces.append(" ")
        inside = bool(self.home[self.stack[-1]])
        named = _named(tag, attrs, inside)
        marks = 2 if tag in BOILERPLATE or tag == "header" and not inside else named
        if tag in VOID:
            if tag == "hr":
                self.end_line()
            return
        if tag not in BLOCKS and not marks:
            return
        if tag in BLOCKS:
            if tag in ("article", "main") and not named:
                self.leave_unclosed()
            self.imply_ends(tag)
        if not (tag in SILENT and self.mark[self.stack[-1]] == 0):  # a script inside a paragraph does not end its line
            self.end_line()
        self.push(tag, marks)

    def push(self, tag: str, marks: int):
        above, node = self.stack[-1], len(self.tag)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        self.marked += marks > 0
        self.tag.append(tag)
        self.parent.append(above)
        self.mark.append(marks)
        self.home.append(self.home[above] or (node if tag in ("article", "main") else 0))

    def leave_unclosed(self):
        """An article begins: boilerplate of the page that is still open was never closed."""
        if not self.marked:
            return
        for depth, node in enumerate(self.stack):
            if self.mark[node] and self.tag[node] in ("nav", "header", "head", "title", "form", "p", "span", "ul"):
                self.close_to(depth)
                return

    def imply_ends(self, tag: str):
        """A new block ends an open paragraph; a list item, row or option ends its predecessor."""
        if tag in ("li", "tr"):  # looks through other blocks, up to the list or table
            at = self.place("p", tag, "ul", "ol", "table", "tbody", "thead", "tfoot", "menu")
            if at and self.tag[self.stack[at]] in ("p", tag):
                self.close_to(at)
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.tag[self.stack[depth]]
            if open_tag == "p" or open_tag in HEADINGS and tag in HEADINGS or open_tag == tag and tag in ("dt", "dd", "option") \
                    or open_tag == "head" and tag == "body":
                self.close_to(depth)
                return
            if open_tag in BLOCKS:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = 0
        elif tag in ("td", "th"):
            self.pieces.append(" ")
        at = self.place(tag)
        # a stray end tag does not close its container
        if at and (tag in ("body", "html", "main", "article") or at > self.place("article", "main", "body")):
            if tag in SILENT and at == len(self.stack) - 1:
                self.drop_silent()
            else:
                self.close_to(at)
        elif tag in BLOCKS:
            self.end_line()

    def drop_silent(self):
        """The end of a script or style: its node goes, the line around it goes on."""
        node = self.stack.pop()
        self.open[self.tag[node]].pop()
        self.marked -= self.mark[node] > 0

    def handle_data(self, data):
        if self.tag[self.stack[-1]] in SILENT:
            return
        self.pieces.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def _whole_tags(html: str) -> tuple[str, str]:
    """(markup up to the last tag's end, text behind it).  A comment or tag that is never closed is not looked for again
    and again from every '<' in it: the comment goes, and so does the tag with what follows."""
    comment = html.find("<!--", html.rfind("-->") + 1)
    html = html if comment < 0 else html[:comment]
    end = html.rfind(">") + 1
    tail = html[end:]
    cut = _TAG_START.search(tail)
    return html[:end], tail[:cut.start()] if cut else tail


def lines_of(html: str) -> tuple[list, LineBuilder]:
    """The lines of a page (text, tags, link characters, node, marked), and the parser with its nodes."""
    parser = LineBuilder()
    markup, tail = _whole_tags(html)
    parser.feed(markup)
    parser.close()
    parser.handle_data(unescape(tail))
    parser.close_to(1)
    hard, soft = [False], [0]  # by node: inside a node marked 2; nearest node marked 1, itself included
    for node in range(1, len(parser.tag)):
        up = parser.parent[node]
        hard.append(hard[up] or parser.mark[node] == 2)
        soft.append(node if parser.mark[node] == 1 else soft[up])
    prose, total = [0] * len(parser.tag), 0  # characters outside links, of each node marked 1 and of the page
    for text, _, link_chars, node in parser.lines:
        if not hard[node]:
            chars = max(0, len(text) - link_chars)
            total += chars
            prose[soft[node]] += chars
    for node in range(len(parser.tag) - 1, 0, -1):  # inner nodes first
        if parser.mark[node] == 1:
            prose[soft[parser.parent[node]]] += prose[node]
    spared = [True]  # by node: every node marked 1 around it holds most of the prose
    for node in range(1, len(parser.tag)):
        spared.append(spared[parser.parent[node]] and (parser.mark[node] != 1 or 2 * prose[node] > total))
    return [(text, tags, links, node, hard[node] or not spared[node]) for text, tags, links, node in parser.lines], parser


def smoothed_ratios(lines: list, group: list | None = None) -> np.ndarray:
    """Text-to-tag ratio of each line, smoothed over its neighbours (of the same group; the outermost line stands for what
    lies beyond); marked lines weigh nothing."""
    raw = np.array([0.0 if line[4] else len(line[0]) / max(1, line[1]) for line in lines])
    group = np.zeros(len(raw), np.int64) if group is None else np.asarray(group)
    order = np.argsort(group, kind="stable")
    group = group[order]
    first, last = np.searchsorted(group, group, "left"), np.searchsorted(group, group, "right") - 1
    near = np.arange(len(raw))[:, None] + np.arange(-RADIUS, RADIUS + 1)
    smooth = np.empty(len(raw))
    smooth[order] = raw[order][np.clip(near, first[:, None], last[:, None])] @ _KERNEL
    return smooth


def _menu_lines(lines: list, home: list) -> set:
    """Numbers of lines outside articles in runs of three or more that are link text only."""
    out, run = set(), []
    for i, (text, _, link_chars, node, _) in enumerate([*lines, ("", 0, -1, 0, False)]):
        if link_chars >= 0 and link_chars >= 0.9 * len(text) and not home[node]:
            run.append(i)
        else:
            out.update(run if len(run) >= 3 else ())
            run = []
    return out


def _clusters(lines: list, free: list, page: LineBuilder) -> list:
    """The free lines of the containers that hold content.  Ratios are smoothed inside each container; one with a line at or
    above the threshold, the smaller of the standard deviation and the median of all smoothed ratios, or with a
    heading, is content with all its lines, and so are containers inside it; others (link rows, footers) are not."""
    container = [0]  # by node: the nearest container, itself included
    for node in range(1, len(page.tag)):
        container.append(node if page.tag[node] in REGION else container[page.parent[node]])
    held = [container[lines[i][3]] for i in free]
    ratio = smoothed_ratios([lines[i] for i in free], held)
    threshold = min(ratio.std(), float(np.median(ratio)))
    seeded = {c for c, r in zip(held, ratio) if r >= threshold}
    content = seeded | {c for c, i in zip(held, free) if page.tag[lines[i][3]] in HEADINGS}
    within = [False]  # by node: below a container with a seed; the page itself does not count
    for node in range(1, len(page.tag)):
        up = page.parent[node]
        within.append(within[up] or up in seeded and page.tag[up] not in ("", "body"))
    return [i for i in free if container[lines[i][3]] in content or within[container[lines[i][3]]]]


def blocks_of(html: str) -> list:
    """The content blocks of a page in page order."""
    lines, page = lines_of(html)
    home = page.home
    menus = _menu_lines(lines, home)
    lines = [(*line[:4], line[4] or i in menus) for i, line in enumerate(lines)]
    free = [i for i, line in enumerate(lines) if not line[4]]
    if not free:
        return []
    ratio = smoothed_ratios(lines)
    least = ratio.std()
    seeds = [i for i in free if ratio[i] >= least] or [max(free, key=lambda i: ratio[i])]
    homes = {home[lines[i][3]] for i in seeds}
    if 0 in homes:  # content outside of articles: its containers, and all articles
        kept = {*_clusters(lines, free, page), *(i for i in free if home[lines[i][3]])}
    else:  # the articles with seeds, and those beside them
        beside = {page.parent[h] for h in homes}
        kept = {i for i in free if home[lines[i][3]] in homes or home[lines[i][3]] and page.parent[home[lines[i][3]]] in beside}
    return [lines[i][0] for i in sorted(kept)]


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """All columns plus ``out``: the main text, blocks joined by an empty line."""
    whole = fresh(pages, "__whole")
    df = pages.withColumn(whole, whole_text(html_col))
    df = df.drop(out) if out in df.columns else df
    at = df.columns.index(whole)

    def run(frames):
        for batch in frames:
            text = pa.array(["\n\n".join(blocks_of(h)) for h in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out])

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(out, T.StringType())])
    return df.mapInArrow(run, schema).drop(whole)
