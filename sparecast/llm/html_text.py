"""Main text of web pages by tree scoring.

The page becomes a tree (unclosed and stray tags are put right as browsers do
in the common cases).  Elements that never hold article text are left out:
menus, headers, footers, sidebars, forms, scripts, styles, hidden elements, and
elements whose class, id or role has a notice, advert, comment section or the
like as its main part.  A named element stays when it holds an article element
or, but for comments and what stands beside an article element, more than half
of the page's points.  A page without an article element that names leave with
hardly any text is read once more without them.

Each block of text of some length earns points for its length and its commas,
less its share of links, and passes them to the containers around it, in whole to the nearest (and to every
article), then a half, a third and so on; lists, tables and quotes pass them
on.  A container's points are discounted by its link density.  The best
container is kept, with those of its siblings that have a fifth of its points or
are long texts with few links, the headings right before them, and what stands
between them but for links.

Character references are decoded, white space inside a block becomes one
space, and blocks are joined in page order by one space.  Nothing else is cut.

Defined results: a null, empty or markup-only page has an empty text; a page
without any block of some length gives the text of its best container all the
same (an article, else the body); repeated rows each get their result; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch

LEAST_BLOCK = 25  # characters of a block that earns points
POINT_CHARS, MOST_LENGTH_POINTS = 100, 3.0
SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 0.2, 80, 0.25

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_COMMA = re.compile("[,،、，]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
LEFT_OUT = frozenset(("script style textarea title xmp iframe noembed noframes noscript template head nav header footer aside"
                      " button select option datalist menu dialog svg math canvas audio video object map applet").split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
                    " strike strong sub sup time tt u var wbr").split())
#: Words in a class, id or role that mark what isn't article text.
UNWANTED = frozenset(("ad ads advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment comments"
                      " consent contentinfo cookie cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation"
                      " newsletter notice notices notification pager pagination paywall popup promo promotion related recommended replies"
                      " reply respond search share sharing shoutbox sidebar sidebars signup skyscraper social sponsor sponsored subscribe"
                      " subscription toolbar tooltip complementary dialog alert alertdialog form menubar").split())
STARTS_UNWANTED = tuple("advert breadcrumb commentlist commentform commentsection cookie newsletter sidebar sponsor".split())
KEPT_WHOLE = frozenset("html body main".split())  # never left out for their names
ARTICLE_UNWANTED = frozenset("ad ads advert comment comments promo related reply replies respond sponsored".split())
#: Comments may be longer than the article; other named elements are left out only while they are the smaller part.
COMMENTS = frozenset("comment comments commentlist commentform commentsection disqus replies reply respond response".split())
#: Words after (or before) the main part of a name: 'sidebar-right', 'comment-list', 'main-menu'.
MODIFIERS = frozenset(("left right top bottom upper lower middle center first last inner outer primary secondary main wide small large sticky"
                       " fixed mobile desktop global site page wrap wrapper container holder box block area region zone section group row"
                       " col column cell panel pane card tile unit slot frame layer overlay backdrop body text title heading head label list"
                       " items item entry link links post posts article articles story stories news content contents button buttons btn icon"
                       " icons bar strip widget widgets tool tools tray drawer toggle field input policy message msg count counts meta info"
                       " thread tree id no n").split())
#: Names that wrap content beside something: 'content-sidebar-wrap'; and states: 'has-comments'.
WRAPS = frozenset("wrap wrapper container holder layout grid".split())
HOLDS_CONTENT = frozenset("content article entry story main page post text body".split())
STATES = frozenset("has have with without no not is show hide hides on off".split())
#: An id of these elements is an anchor, and these words may come from a title.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 section p li dt dd a span b strong em".split())
TITLE_WORDS = frozenset(("ad alert alertdialog banner banners comment consent cookie cookies dialog form header menu menus navigation notice"
                         " notices notification promo promotion recommended related replies reply respond search share sharing social"
                         " sponsor sponsored subscription advertising advertisement newsletter footer").split())
NAMED_SHARE = 0.5  # of the page's points: a named element with more is no sidebar
MOST_LEVELS = 64  # of containers that a block's points climb
WRAPPING_FORM = "a form"
NAMED_PENALTY = 0.3  # on the points of a named element that stays for its share
LEAST_TEXT, DROPPED_TO_TEXT = 140, 3  # less text than that, beside this many times as much left out for names
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
                      " h4 h5 h6 header hr main menu nav ol p pre section table ul").split())
#: A start tag closes an open element of these names, up to the nearest of the bounds.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "table tr"), "th": ("td th", "table tr"), "thead": ("thead tbody tfoot tr td th", "table"),
          "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table"), "option": ("option", "select")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CELLS = frozenset("td th".split())
#: Elements that structure a text: their points belong to the container around them.
PASS_ON = HEADINGS | frozenset(("p pre ul ol dl li dt dd table caption thead tbody tfoot tr blockquote figure figcaption address summary"
                                " details").split())
CELL_BLOCKS = PASS_ON - frozenset(["p", "table"]) - HEADINGS
COLUMN_CHARS = 400  # of a cell's own text: a column of a page laid out as a table
SCOPES = frozenset("html body article aside main section nav header footer table td th div form ul ol dl blockquote".split())
#: An open paragraph outside of these isn't closed by what they hold.
BOUNDS = SCOPES | LEFT_OUT
FOREIGN = frozenset(("svg", "math"))  # their elements may end with their start tag


class Node:
    __slots__ = ("tag", "parent", "start", "end", "children", "points", "chars", "links", "own", "commas", "inline", "out", "named", "first",
                 "last", "penalty", "block", "linked")

    def __init__(self, tag: str, parent: Node | None, start: int, out: bool = False) -> None:
        self.tag, self.parent, self.start, self.end = tag, parent, start, start
        self.children: list[Node] = []
        self.points = 0.0
        self.chars = self.links = 0  # of the whole element, without white space runs
        self.own = self.commas = 0  # of the text whose nearest block this is
        self.inline = tag in INLINE
        self.out = out  # left out, or inside an element that is
        self.named = ""  # the word of its name that marks what isn't article text
        self.first = self.last = 0  # places of its descendants in the page's list of nodes
        self.penalty = 1.0
        self.block: Node = parent.block if self.inline and parent is not None else self  # the nearest that isn't inline
        self.linked: bool = tag == "a" or parent is not None and parent.linked

    def passes_on(self) -> bool:
        """Whether points go on in full: a text block, list, table, quote, or a cell that isn't laid out as a page's column."""
        if self.tag in CELLS:
            return self.own < COLUMN_CHARS and all(n.inline or n.tag in CELL_BLOCKS for n in self.children)
        return self.tag in PASS_ON

    def earned(self) -> float:
        if self.own < LEAST_BLOCK:
            return 0.0
        return (1 + self.commas + min(self.own / POINT_CHARS, MOST_LENGTH_POINTS)) * (1 - self.links / self.chars)


def _attributes(rest: str) -> dict[str, str]:
    """The attributes of a tag; of one name the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), "".join(values))
    return out


def _hidden(attributes: dict[str, str]) -> bool:
    """A ``hidden`` attribute, ``aria-hidden`` of true, or a last ``display`` declaration of none."""
    if attributes.get("hidden", "until-found").strip().lower() != "until-found":
        return True
    if attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    display = ""
    for declaration in html.unescape(attributes.get("style", "")).split(";"):
        name, _, value = declaration.partition(":")
        if name.strip().lower() == "display":
            display = value.lower().replace("!important", "").strip()
    return display == "none"


def _unwanted_name(name: str, words: frozenset[str], starts: tuple[str, ...]) -> str:
    """The main part of a class, id or role, if it is one of ``words``, else nothing."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not STATES.isdisjoint(parts) or not WRAPS.isdisjoint(parts) and not HOLDS_CONTENT.isdisjoint(parts):
        return ""
    while parts and (parts[-1].isdigit() or parts[-1] in MODIFIERS):
        parts.pop()
    return parts[-1] if parts and (parts[-1] in words or parts[-1].startswith(starts)) else ""


def _named(tag: str, attributes: dict[str, str]) -> str:
    """The word that marks the element as none of the article's, if there is one."""
    if tag in KEPT_WHOLE:
        return ""
    words, starts = (ARTICLE_UNWANTED, ("\n",)) if tag == "article" else (UNWANTED, STARTS_UNWANTED)
    for key in ("class", "role", "id"):
        for name in attributes.get(key, "").split():
            word = _unwanted_name(name, words, starts)
            if word and not (key == "id" and tag in ANCHORED and word in TITLE_WORDS):
                return word
    return ""


class Page:
    """The tree of a page: elements with the range of text pieces they hold."""

    def __init__(self, source: str, names: bool = True) -> None:
        self.names = names
        self.pieces: list[str] = []
        self.texts: list[tuple[Node, int, int]] = []  # element, characters, commas
        self.named: list[Node] = []
        self.left_out_chars = 0  # for names
        self.open_tags: Counter[str] = Counter()
        self.root = Node("html", None, 0)
        self.nodes = [self.root]
        self.stack = [self.root]
        at = 0
        while at < len(source):
            cut = source.find("<", at)
            if cut < 0:
                self._text(source[at:])
                break
            if cut > at:
                self._text(source[at:cut])
            m = _TAG.match(source, cut)
            if m is None:
                self._text("<")
                at = cut + 1
                continue
            at = m.end()
            name = m.group("name") or m.group("name2")
            if not name:
                continue
            tag = name.lower()
            if m.group("end") or m.group("end2"):
                self._close(tag)
                continue
            rest = m.group("rest") or m.group("rest2") or ""
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = closing.end() if closing else len(source)
                continue
            self._open(tag, rest)
        while self.stack:
            self._pop()
        self._count()
        if self.named:
            self._leave_out()
            self._count()

    def _text(self, raw: str) -> None:
        if self.stack[-1].out:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        chars = len(text) if not text.isspace() else 0
        if not chars:
            return
        self.texts.append((self.stack[-1], chars, len(_COMMA.findall(text))))

    def _count(self) -> None:
        """Characters, links and commas of all elements, of the text that isn't left out."""
        for n in self.nodes:
            n.chars = n.links = n.own = n.commas = 0
        for n, chars, commas in self.texts:
            if n.out:
                continue
            n.block.own += chars
            n.block.commas += commas
            n.chars += chars
            if n.linked:
                n.links += chars
        for n in reversed(self.nodes):  # children come after their parents
            if n.parent is not None:
                n.parent.chars += n.chars
                n.parent.links += n.links

    def marked(self) -> list[Node]:
        """The article and main elements with text."""
        return [n for n in self.nodes if n.tag in ("article", "main") and not n.named and not n.out and n.chars]

    def _leave_out(self) -> None:
        """Leave out the named elements that hold no article and, but for comments, a small share of the page's points.

        Beside an article element the share doesn't count.
        """
        earned = [0.0]
        for n in self.nodes:
            earned.append(earned[-1] + (0.0 if n.inline else n.earned()))
        total = lambda n: earned[n.last] - earned[n.first - 1]
        outside, end = earned[-1], 0
        for n in self.named:
            if n.first > end:
                outside, end = outside - total(n), n.last
        marked = self.marked()
        firsts, lasts = [x.first for x in marked], list(accumulate((x.last for x in marked), max))
        for n in self.named:
            if n.out:
                continue
            before, behind = bisect_left(firsts, n.first), bisect_right(firsts, n.first)
            if behind < len(firsts) and firsts[behind] <= n.last:
                continue
            beside = marked and not (before and lasts[before - 1] >= n.first)
            large = n.chars >= LEAST_TEXT and total(n) > NAMED_SHARE * (total(n) + outside)
            if large and not beside and n.named not in COMMENTS:
                n.penalty = NAMED_PENALTY if n.named != WRAPPING_FORM else 1.0
                continue
            self.left_out_chars += n.chars if n.named != WRAPPING_FORM else 0
            for x in (n, *self.nodes[n.first : n.last]):
                x.out = True
            self.pieces[n.start : n.end] = [""] * (n.end - n.start)

    def _open(self, tag: str, rest: str) -> None:
        if tag == "html" or tag == "body" and any(n.tag == "body" for n in self.stack):
            return
        if tag in CLOSES_P:
            self._end(("p",), BOUNDS)
        if tag in CLOSES:
            names, bounds = CLOSES[tag]
            self._end(tuple(names.split()), LEFT_OUT.union(bounds.split()))
        out = self.stack[-1].out
        if tag not in INLINE and not out:
            self.pieces.append(" ")
        if tag in VOID:
            return
        ends = rest.rstrip().endswith("/")
        if ends and (tag in FOREIGN or out and any(n.tag in FOREIGN for n in self.stack)):
            return
        named = ""
        if not out:
            attributes = _attributes(rest) if rest and tag not in LEFT_OUT else {}
            out = tag in LEFT_OUT or tag not in KEPT_WHOLE and _hidden(attributes)
            named = _named(tag, attributes) if self.names and not out else ""
            if tag == "form" and not out:  # a search or login form goes, one around the page or its article stays
                named = named if named in COMMENTS else WRAPPING_FORM
            if ends and tag not in LEFT_OUT and (out or named):
                return
        node = Node(tag, self.stack[-1], len(self.pieces), out)
        self.stack.append(node)
        self.open_tags[tag] += 1
        if not out:
            node.parent.children.append(node)
            self.nodes.append(node)
            node.first = len(self.nodes)
            if named:
                node.named = named
                self.named.append(node)

    def _end(self, names: tuple[str, ...], bounds: frozenset[str]) -> None:
        """Close the innermost open element of these names, unless a bound comes first."""
        if not any(self.open_tags[name] for name in names):
            return None
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in names:
                while len(self.stack) > i:
                    self._pop()
                return self._end(names, bounds) if len(names) > 1 else None
            if self.stack[i].tag in bounds:
                return None
        return None

    def _close(self, tag: str) -> None:
        if tag not in INLINE and not self.stack[-1].out:
            self.pieces.append(" ")
        if not self.open_tags[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in INLINE and not self.stack[i].inline or tag not in SCOPES and self.stack[i].tag in LEFT_OUT:
                return

    def _pop(self) -> None:
        node = self.stack.pop()
        self.open_tags[node.tag] -= 1
        node.end, node.last = len(self.pieces), len(self.nodes)

    def score(self) -> None:
        """Every block's points go to the containers around it, divided by their level; above ``MOST_LEVELS`` nothing is left."""
        holder: dict[Node, Node | None] = {}  # the nearest that keeps points, itself included
        weight: dict[Node, float] = {}
        for n in self.nodes:  # parents come before their children
            above = holder[n.parent] if n.parent is not None else None
            holder[n] = above if n.inline or n.passes_on() else n
            weight[n] = n.penalty * (weight[n.parent] if n.parent is not None else 1.0)
            n.points = 0.0
        for block in self.nodes:
            earned = 0.0 if block.inline or block.out else block.earned() * weight[block]
            around, level = holder[block], 1
            while earned and around is not None and level <= MOST_LEVELS:
                around.points += earned if around.tag == "article" else earned / level
                level += 1
                around = holder[around.parent] if around.parent is not None else None

    def worth(self, node: Node) -> float:
        return node.points * (1 - node.links / node.chars) if node.chars else 0.0

    def main(self) -> list[Node]:
        """The best container and the siblings that stay, in page order."""
        self.score()
        holders = [n for n in self.nodes if not n.inline and not n.out and n.chars]
        best = max(holders, key=self.worth, default=None)
        if best is None:
            return []
        if self.worth(best) <= 0:
            return [next((n for n in holders if n.tag in ("article", "main")), next((n for n in holders if n.tag == "body"), self.root))]
        if best.parent is None:
            return [best]
        least = SIBLING_SHARE * self.worth(best)

        def few_links(n: Node) -> bool:
            return n.links < SIBLING_LINKS * n.chars

        beside = [n for n in best.parent.children if not n.out and n.chars]
        stays = [n is best or not n.inline and (self.worth(n) >= least or few_links(n) and n.chars > SIBLING_CHARS) for n in beside]
        for i in range(len(beside) - 2, -1, -1):  # headings go with what they head
            stays[i] = stays[i] or stays[i + 1] and beside[i].tag in HEADINGS
        first, last = stays.index(True), len(stays) - 1 - stays[::-1].index(True)
        return [n for i, n in enumerate(beside) if stays[i] or first < i < last and (n.inline or few_links(n))]

    def text(self) -> str:
        """The text of the kept elements, and what stands between them outside of other elements."""
        kept = self.main()
        if not kept:
            return ""
        held = set(kept)
        out, at = [], kept[0].start
        for n in kept[0].parent.children if kept[0].parent else ():
            if n.start >= kept[0].start and n.end <= kept[-1].end and n not in held:
                out += self.pieces[at : n.start]
                out.append("" if n.inline else " ")
                at = n.end
        return " ".join("".join([*out, *self.pieces[at : kept[-1].end]]).split())


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    text = page.text()
    if not page.marked() and len(text) < LEAST_TEXT and page.left_out_chars > DROPPED_TO_TEXT * len(text):
        return Page(source, names=False).text()
    return text


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` for every row of ``pages``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            [id_col, url_col, "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{c}`") for c in (id_col, url_col, html_col)])
    schema = T.StructType([rows.schema[0], rows.schema[1], *T.StructType.fromDDL("text string, n_chars long")])
    return per_batch(rows, run, schema)
