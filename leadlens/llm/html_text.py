"""Main text of web pages by tree scoring.

Paragraphs earn points for length and commas; the points pass to their ancestors and are discounted by the share of text
in links; the best container and its siblings that look like content are kept.  A page is one row's work: a forgiving
tag reader builds the tree (missing end tags are implied), scoring and output walk it once each.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import text_of, tidied

# HTML's element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, with the pattern of their end tag; without one, the first four take the rest of the page, the others nothing.
RAW = {t: re.compile(f"</{t}(?=[\\s/>]|$)", re.I | re.A) for t in "script style textarea title xmp iframe noembed noframes noscript".split()}
TO_END = set("script style textarea title".split())
#: Elements with markup that is not shown in the text, and those of them that are left alone where they have no end tag.
HIDDEN = set("svg object canvas select template annotation annotation-xml".split())
LOOSE = {t: re.compile(rf"<(/?){t}(?=[\s/>])", re.I | re.A) for t in "object canvas select template".split()}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: HTML start tags that end an open svg or math, and elements of these that hold HTML.
BREAKS = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()) | BLOCK
HOLDS_HTML = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: Implied ends don't reach out of these.
SCOPE = set("svg math object canvas select template foreignobject".split())
#: A start tag of the key ends an open element of these, up to the nearest of BOUNDS.
ENDS_P = BLOCK - set("body html legend li dd dt td th tr tbody thead tfoot caption".split())
IMPLIED = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
IMPLIED |= {k: {"tr", "td", "th", "tbody", "thead", "tfoot"} for k in ("tbody", "thead", "tfoot")}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}

#: Elements that never hold the article, by name; roles and words of class or id speak against an element, but its share of the page's points decides.
OUT = set("nav header footer aside menu head button input search label".split()) | set(RAW) | HIDDEN
#: Elements that can also wrap a whole page: they, and the roles, speak against an element as words do.
WRAPS = set("form fieldset dialog".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist note status".split())
OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising adbox adblock banner sponsor sponsored promo promotion sidebar aside menu nav navbar navigation breadcrumb breadcrumbs"
    " header masthead footer comment comments respond reply replies disqus discussion reactions cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations trending popular widget toolbar pagination pager skip skiplink"
    " copyright legal disclaimer byline tagcloud tags rating".split()
)
#: Names of readers' comments, which can be longer than the article, and what such names have besides.
COMMENTS = set("comment comments respond reply replies disqus".split())
COMMENT_PARTS = COMMENTS | set("area list section thread threads wrap wrapper container box".split())
NO_TAG = re.compile("<[!?/]")
TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|$)", re.S)
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "kids", "out", "doubt", "text", "links", "commas", "score", "held", "span")

    def __init__(self, tag, parent, out, doubt=None):
        self.tag, self.parent, self.out, self.doubt, self.kids = tag, parent, out, doubt, []
        self.text = self.links = self.commas = self.span = 0
        self.score = self.held = 0.0


def _doubts(names: list[str]):
    """What the words of class and id say against an element: (words, whole, comments) or None.  ``whole``: one name has no other word
    (``sidebar``, not ``has-sidebar``); ``comments``: one is a name of readers' comments."""
    found, whole, comments = set(), False, False
    for name in names:
        words = WORDS.findall(CAMEL.sub(" ", name).lower())
        hit = OUT_WORDS.intersection(words)
        found |= hit
        whole |= bool(hit) and OUT_WORDS.issuperset(words)
        comments |= not COMMENTS.isdisjoint(words) and COMMENT_PARTS.issuperset(words)
    return (found, whole, comments) if found else None


def _unwanted(tag: str, attrs: str, inside: bool):
    """Whether an element is no part of an article, or what its names say against it (see ``_doubts``).  ``inside``: a header in an
    article holds its title, so its name alone doesn't exclude it."""
    if tag in OUT and not (tag == "header" and inside):
        return True
    against = {tag} if tag in WRAPS else set()
    if not attrs or tag in ("html", "body", "main"):
        return (against, False, False) if against else False
    names: list[str] = []
    for m in ATTR.finditer(attrs):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower().strip() in OUT_ROLES:
            against.add(f"role {value.lower().strip()}")
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            names += value.split()
    words, whole, comments = _doubts(names) or (set(), False, False)
    return (against | words, whole, comments) if against or words else False


def _unended(page: str, tag: str) -> set[int]:
    """Places of the start tags of an element that have no end tag."""
    opened: list[int] = []
    for m in LOOSE[tag].finditer(page):
        if not m[1]:
            opened.append(m.start())
        elif opened:
            opened.pop()
    return set(opened)


def parse(page: str) -> Node:
    """Tree of elements and strings (raw, with character references)."""
    root = node = Node("#root", None, False)
    at, n = 0, len(page)
    articles = 0
    foreign = choice = None  # the last opened svg or math; an open select without an end tag
    final = page.rfind(">")  # what follows is no tag, however many open there
    endless: set[str] = set()  # raw elements that end nowhere in the rest
    unended: dict[str, set[int]] = {}
    opened: set[str] = set()
    while at < n:
        if at > final:
            cut = NO_TAG.search(page, at)  # an open comment or the like, which takes the rest
            node.kids.append(page[at : cut.start() if cut else n])
            break
        m = TAG.search(page, at)
        if not m:
            node.kids.append(page[at:])
            break
        if m.start() > at:
            node.kids.append(page[at : m.start()])
        at = m.end()
        end, tag, attrs = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)  # the latter with an odd quote
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag not in opened:  # many of these must not each search a deep tree
                continue
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                while node is not up:
                    articles -= node.tag in ("article", "main")
                    node = node.parent
                articles -= node.tag in ("article", "main")
                node = node.parent
            continue
        if choice is not None and tag not in ("option", "optgroup"):
            up = node
            while up is not None and up is not choice:
                up = up.parent
            node, choice = up.parent if up is not None else node, None
        inside = False  # directly in svg or math
        if foreign is not None:
            up = node
            while up is not None and up.tag not in ("svg", "math") and up.tag not in HOLDS_HTML:
                up = up.parent
            if up is None:
                foreign = None
            elif up.tag in ("svg", "math"):
                inside = tag not in BREAKS
                node = node if inside else up.parent
        if tag in RAW and not inside:
            end = None if tag in endless else RAW[tag].search(page, at)
            if end is not None:
                close = page.find(">", end.end())
                at = n if close < 0 else close + 1
            elif tag in TO_END:
                break  # nothing after it is shown
            else:
                endless.add(tag)
            continue
        if tag in LOOSE:
            if tag not in unended:
                unended[tag] = _unended(page, tag)
            if m.start() in unended[tag] and tag != "select":
                continue
        if tag in ENDS_P:
            up = node
            while up is not root and up.tag != "p" and up.tag not in BLOCK and up.tag not in SCOPE:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in IMPLIED:
            up, stop = node, BOUNDS.get(tag, set())
            last = None
            while up is not root and up.tag not in stop and up.tag not in SCOPE:
                if up.tag in IMPLIED[tag]:
                    last = up
                up = up.parent
            if last is not None:
                node = last.parent
        verdict = node.out or _unwanted(tag, attrs, articles > 0)
        child = Node(tag, node, verdict is True, None if verdict is True else verdict or None)
        node.kids.append(child)
        if tag not in VOID and not (attrs.endswith("/") and tag not in BLOCK):
            node = child
            opened.add(tag)
            articles += tag in ("article", "main")
            if tag in ("svg", "math"):
                foreign = child
            elif tag == "select" and m.start() in unended[tag]:
                choice = child
    return root


def _measure(root: Node) -> list[Node]:
    """Lengths of text, of text in links, and commas of every wanted element; returns the elements, parents first."""
    order, stack = [], [(root, False)]
    while stack:
        node, link = stack.pop()
        order.append(node)
        node.text = node.links = node.commas = 0
        node.score, node.held, node.span = 0.0, 0.0, 1
        link = link or node.tag == "a"
        for k in node.kids:
            if isinstance(k, str):
                size = len(k) - k.count(" ") if not k.isspace() else 0
                node.text += size
                node.links += size if link else 0
                node.commas += k.count(",") + k.count("，") + k.count("、")
            elif not k.out:
                stack.append((k, link))
    for node in reversed(order):
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.links += node.links
            node.parent.commas += node.commas
    return order


def _density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def _points(node: Node) -> float:
    """Points of an element's own paragraph: 0 if it is none."""
    own = node.tag in ("p", "pre", "blockquote", "td", "li") or node.tag in ("div", "section", "article", "body", "main", "#root") and any(isinstance(k, str) and k.strip() for k in node.kids)
    if not own or node.text < 20:
        return 0.0
    direct = node.tag in ("p", "pre", "td", "li", "blockquote")
    size = node.text if direct else sum(len(k) for k in node.kids if isinstance(k, str))
    commas = node.commas if direct else sum(k.count(",") for k in node.kids if isinstance(k, str))
    return (1 + commas + min(size / 100, 3)) * (1 - _density(node))


def _settle(root: Node) -> list[Node]:
    """Excludes elements whose names speak against them, unless most of the page's points are theirs, alone or together with the
    others of the same word in longer names (``elementor-widget-container``); returns the excluded ones.

    Readers' comments can outweigh an article, so elements named for them alone stay out where an article or a title is elsewhere; so
    do other elements of a whole name beside an article element with text.
    """
    order = _measure(root)
    doubted = [k for k, node in enumerate(order) if node.doubt]
    if not doubted:
        return []
    for node in reversed(order):
        node.held += _points(node)
        if node.parent is not None:
            node.parent.held += node.held
            node.parent.span += node.span
    most = root.held / 2

    def beside(k: int) -> bool:
        """Whether the element at place k leaves an article, or readers' comments a title, elsewhere."""
        lo, hi = k, k + order[k].span
        if any(x.tag in ("h1", "main") for x in order[lo:hi]):
            return False
        if not order[k].doubt[2]:
            return any(x.tag in ("article", "main") and x.text and (j + x.span <= lo or j >= hi) for j, x in enumerate(order))
        return any(x.tag == "h1" and x.text or x.tag in ("article", "main") and x.held > (order[k].held if j < lo and j + x.span >= hi else 0) for j, x in enumerate(order) if not lo <= j < hi)

    # an article element of such a name is another one's if it doesn't hold most of the points, or if its name is that of comments
    left = [k for k in doubted if order[k].held <= most or (order[k].doubt[1] and order[k].tag != "article" or order[k].doubt[2]) and beside(k)]
    held: dict[str, float] = {}
    ends: dict[str, int] = {}
    for k in left:
        words, whole, comments = order[k].doubt
        for w in () if whole or comments else words:
            if k >= ends.get(w, 0):  # not in another one of this word
                held[w] = held.get(w, 0.0) + order[k].held
                ends[w] = k + order[k].span
    common = {w for w, points in held.items() if points > most}
    gone = [order[k] for k in left if order[k].doubt[1] or order[k].doubt[2] or not order[k].doubt[0] <= common]
    for node in gone:
        node.out = True
    return gone


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings that go with it, in page order."""
    gone = _settle(root)
    nodes = _best_nodes(root)
    if nodes is None and gone:  # nothing scores: once more without the words, but not for what lies beside an article of a few words
        short = any(n.tag in ("article", "main") and n.text for n in _measure(root))
        for node in gone:
            if node.doubt[2]:  # readers' comments never come back
                continue
            up = node
            while short and up is not None and up.tag not in ("article", "main"):
                up = up.parent
            node.out = up is None
        nodes = _best_nodes(root)
    return nodes or [n for n in _measure(root) if n.tag == "body"][:1] or [root]


def _best_nodes(root: Node) -> list[Node] | None:
    """As ``main_nodes``, of what isn't excluded; None if nothing scores."""
    order = _measure(root)
    for node in order:
        points = _points(node)
        if not points:
            continue
        up, share = node.parent if node.tag in ("p", "pre", "td", "li", "blockquote") else node, 1.0
        while up is not None and share > 0.1:
            up.score += points * share
            up, share = up.parent, share / 2
    best, top = None, 0.0
    for node in order:
        if node.tag in ("tr", "tbody", "thead", "ul", "ol", "dl", "p", "#root", "html") and best is not None and node.tag != "#root":
            continue
        bonus = 1.25 if node.tag in ("article", "main") else 1.0
        value = node.score * (1 - _density(node)) * bonus
        if value > top:
            best, top = node, value
    if best is None:
        return None
    while best.parent is not None and best.tag in ("p", "li", "td", "th", "tr", "tbody", "thead", "ul", "ol", "dl", "table", "blockquote", "b", "i", "em", "strong", "span"):
        best = best.parent
    around, up = None, best
    while up is not None:
        if up.tag == "article" or up.tag == "main" and around is None:
            around = up  # the outermost article, or else the main element
        up = up.parent
    best = around or best  # short sections and the title count as much as the longest section
    if best.parent is None:
        return [best]
    level = max(10.0, top * 0.2)
    holds = set()  # elements with a paragraph, by id()
    for node in reversed(order):
        if node.tag in ("p", "pre", "blockquote") and node.text or id(node) in holds:
            holds.update((id(node), id(node.parent)))
    kept = []
    for k in best.parent.kids:
        if isinstance(k, str) or k.out:
            continue
        paragraph = k.tag == "p" and (k.text > 80 and _density(k) < 0.25 or 0 < k.text and k.links == 0 and k.commas + k.text // 40 > 0)
        section = best.tag != "main" and k.tag != "p" and id(k) in holds and _density(k) < 0.25
        if k is best or k.score * (1 - _density(k)) >= level and k.tag not in ("a",) or paragraph or section or k.tag in ("h1", "h2") and k.text and best.tag not in ("body", "article", "main"):
            kept.append(k)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    """Text of each block: references decoded, white space as one blank, trimmed, none empty."""
    out: list[str] = []
    line: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif not x.out:
                if x.tag == "br":
                    line.append(" ")
                elif x.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(x.kids))
        flush()
    return out


def main_text(page: str) -> str:
    """Main text of one page: its blocks joined by two line ends.  Pages without wanted text give the empty text."""
    return "\n\n".join(blocks(main_nodes(parse(page)))) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The whole page is read; a null or empty page, or one without main text, has the empty text.  Ids and URLs may be null or
    repeated and are passed on; repeated rows give equal rows; an empty table gives no row; other columns are ignored.
    """
    kinds = {f.name: f.dataType for f in pages.schema}
    schema = T.StructType([T.StructField("page_id", kinds[id_col]), T.StructField("url", kinds[url_col]), T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield pa.record_batch([part.column(0), part.column(1), pa.array([main_text(p) for p in part.column(2).to_pylist()], pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html")).mapInArrow(tidied(run), schema)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
