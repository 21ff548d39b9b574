"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph gives points for its length and commas to its
ancestors, fewer the further up; a container's points are discounted by the share of
its text that is link text. The best container, widened to the article element around
it, is kept with those siblings that read like it. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are known by element, role,
class and id, and never count; a class or id must name the part as a whole ("sidebar",
"post-comments"; not "has-sidebar" or "related-work"), and no such name takes away what
holds the main element or most of the page's text. The time is in proportion to the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabulon.llm.common import table

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
                  "section summary table tbody td tfoot th thead tr ul caption title".split())
DROPPED = frozenset("script style noscript template iframe object embed svg math canvas audio video head title nav "
                    "footer aside form button select textarea input label fieldset dialog menu header".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                  "toolbar status".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article main h1 h2 h3 h4 h5 h6 body html".split())
#: Words in a class or id that mark what does not belong to the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertisment banner breadcrumb breadcrumbs combx comment "
    "comments commentlist commentarea consent cookie cookies disclaimer discussion disqus foot footer footnav gdpr header "
    "masthead menu menus modal nav navbar navigation navi newsletter notice notices notification pager pagination paywall "
    "popup popover promo promoted promotion recommended related replies reply respond respondlist rss share sharing "
    "shoutbox sidebar sidebars signup skyscraper social sponsor sponsored subscribe subscription tags toolbar tooltip "
    "topbar widget widgets login alert".split())
#: Words that may stand beside them in a name.
FILLER = frozenset("site page post posts article articles entry box block area section list container wrapper wrap inner "
                   "outer top bottom left right global primary secondary slot unit bar panel item items links buttons form "
                   "count content story stories message popular more".split())
#: Of these, a name is never overruled by how much text the part holds.
COMMENTS = frozenset("comment comments commentlist commentarea discussion disqus reply replies respond respondlist".split())
#: Ancestors that a paragraph passes points to.
LEVELS = 10
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS_P = BLOCK - {"br", "body", "html", "head", "title", "option"}
#: An opening tag ends the outermost open element of these kinds within the given scope.
_KINDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
          "p": ({"p"}, {"td", "th", "table", "button", "body"})}
_CLOSES = {"li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}
_MARKS = {tag for ends, scope in _KINDS.values() for tag in ends | scope}


class Node:
    """An element. ``drop``: HARD where it never counts, SOFT where its name says so.
    ``inside``: in an article or main element; ``open``: for every kind of ``_KINDS``, the
    element that an opening tag of that kind would end."""

    __slots__ = ("tag", "parent", "items", "drop", "score", "chars", "linked", "inside", "open")

    def __init__(self, tag: str, parent: "Node | None", drop: int = 0):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.items: list[Node | str] = []
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.open: dict[str, Node] = parent.open if parent is not None else {}
        if tag in _MARKS:
            self.open = {k: x for k, x in self.open.items() if tag not in _KINDS[k][1]}
            for kind, (ends, _) in _KINDS.items():
                if tag in ends:
                    self.open.setdefault(kind, self)


HARD, SOFT = 2, 1


def _boilerplate(value: str, inside: bool) -> tuple[bool, bool]:
    """Whether one of the names in a class or id is that of a part which is none of the
    article's, and whether of reader comments."""
    found = False
    for name in value.split():
        words = {w.lower() for w in _NAME.findall(name)}
        named = words & BOILERPLATE
        if named and words <= BOILERPLATE | FILLER and not (inside and named == {"header"}):
            found = True
            if named & COMMENTS:
                return True, True
    return found, False


def _unwanted(tag: str, attrs: str, inside_article: bool) -> int:
    if tag in ("html", "body"):
        return 0
    if tag in DROPPED and not (tag == "header" and inside_article):
        return HARD
    soft = 0
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), unescape(a or b or c)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return HARD
        if name == "role" and value.lower() in ROLES or name == "style" and _HIDDEN.search(value):
            return HARD
        if name in ("class", "id"):
            named, comments = _boilerplate(value, inside_article)
            if comments and tag != "main":
                return HARD
            if named and tag not in ("article", "main"):
                soft = SOFT
    return soft


def parse(html: str) -> Node:
    """The page's tree: elements with text and elements inside; unknown ends are ignored,
    missing ends are supplied."""
    root = node = Node("#root", None)
    count: dict[str, int] = {}  # open elements by tag
    at, n = 0, len(html)
    lowered = None

    def close(top: Node) -> Node:
        """Leave the open elements up to ``top``; its parent is open then."""
        here = node
        while here is not top.parent:
            count[here.tag] -= 1
            here = here.parent
        return here

    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            node.items.append(unescape(html[at:]))
            break
        if m.start() > at:
            node.items.append(unescape(html[at:m.start()]))
        at = m.end()
        if m["cdata"] is not None:
            node.items.append(m["cdata"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if count.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = close(up)
            elif tag == "p":
                node.items.append(Node("p", node))
            continue
        if tag in _ENDS_P and "p" in node.open:
            node = close(node.open["p"])
        if tag in _CLOSES and _CLOSES[tag] in node.open:
            node = close(node.open[_CLOSES[tag]])
        new = Node(tag, node, _unwanted(tag, m["attrs"] or "", node.inside or node.tag in ("article", "main")))
        node.items.append(new)
        if tag in RAW:
            lowered = lowered or html.lower()
            end = lowered.find(f"</{tag}", at) if len(lowered) == n else html.find(f"</{tag}", at)
            end = n if end < 0 else end
            new.items.append(unescape(html[at:end]) if tag in ("title", "textarea") else "")
            shut = html.find(">", end)
            at = n if shut < 0 else shut + 1
        elif tag not in VOID and not (m["attrs"] or "").endswith("/") or tag in ("p", "div", "article"):
            count[tag] = count.get(tag, 0) + 1
            node = new
    return root


def overrule_names(root: Node) -> None:
    """Keep what only its name would drop where it holds the main element, or, on a page
    without an article or main element elsewhere, over half of the text outside links."""
    order, todo, elsewhere = [], [(root, False)], False
    while todo:
        node, named = todo.pop()
        if node.drop == HARD:
            continue
        order.append(node)
        named = named or node.drop == SOFT
        elsewhere = elsewhere or not named and node.tag in ("article", "main")
        todo += [(x, named) for x in node.items if isinstance(x, Node)]
    text, main = {}, set()
    for node in reversed(order):  # children first
        text[id(node)] = 0 if node.tag == "a" else sum(
            len(x.strip()) if isinstance(x, str) else text.get(id(x), 0) for x in node.items)
        if node.tag == "main" or any(id(x) in main for x in node.items if isinstance(x, Node)):
            main.add(id(node))
    for node in order:
        if node.drop == SOFT and (id(node) in main or not elsewhere and 2 * text[id(node)] > text[id(root)]):
            node.drop = 0


def _nodes(root: Node) -> list[Node]:
    """All kept elements, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.drop]
    return out


def _paragraph(node: Node) -> str:
    """Text of an element without the blocks inside it."""
    out, todo = [], list(reversed(node.items))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append(" ")
        elif not x.drop and x.tag not in BLOCK:
            todo += reversed(x.items)
    return " ".join("".join(out).split())


def score(root: Node) -> Node | None:
    """Give all containers their points; returns the best one, the first of equals."""
    nodes = _nodes(root)
    for node in reversed(nodes):  # children first
        for x in node.items:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            elif not x.drop:
                node.chars += x.chars
                node.linked += x.chars if x.tag == "a" else x.linked
    for node in nodes:
        if node.tag not in PARAGRAPHS or node.tag == "#root":
            continue
        text = _paragraph(node)
        if not text:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        if node.tag in ("p", "pre", "blockquote", "td", "li", "dd") or node.tag[0] == "h" and node.tag != "html":
            up, share = node.parent, 1.0
        else:
            up, share = node, 1.0  # text that lies in a container directly
        for level in range(1, LEVELS + 1):
            if up is None or up.tag == "#root":
                break
            up.score += points * share
            share = 0.5 if level == 1 else 1 / (3 * level)
            up = up.parent
    best, most = None, 0.0
    for node in nodes:
        if node.chars and node.tag not in ("#root", "a", "p", "tr"):
            node.score *= 1 - node.linked / node.chars
            if node.score > most:
                best, most = node, node.score
    return best


def _text(*items: Node | str) -> str:
    out: list[str] = []
    todo: list[Node | str] = list(reversed(items))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append(" ")
        elif not x.drop:
            if x.tag in BLOCK:
                out.append(" ")
                todo.append(" ")
            todo += reversed(x.items)
    return " ".join("".join(out).split())


def _around(best: Node) -> list[Node | str]:
    """The best container with what stands beside it and reads like it: blocks, and runs of
    text and inline elements, of which under a quarter is link text; blocks with more
    links by a fifth of the best score."""
    out: list[Node | str] = []
    for alone, part in groupby(best.parent.items, lambda x: id(x) if x is best or isinstance(x, Node) and x.tag in BLOCK else 0):
        part = list(part)
        chars = sum(len("".join(x.split())) if isinstance(x, str) else x.chars for x in part)
        linked = sum(x.chars if x.tag == "a" else x.linked for x in part if isinstance(x, Node))
        keep = part[0] is best or linked < 0.25 * chars or alone and chars and part[0].score >= 0.2 * best.score
        out += part if keep else [" "]
    return out


def main_text(html: str | None) -> str:
    """The main text of a page; empty where nothing scores."""
    root = parse(html or "")
    overrule_names(root)
    best = score(root)
    if best is None:
        return _text(root)
    up = best
    while up is not None:  # an article element is kept as a whole
        if up.tag == "article":
            best = up
        up = up.parent
    if best.parent is None:
        return _text(best)
    if best.tag != "article" or best.parent.tag == "main":
        return _text(*_around(best))
    # what lies around an article is not part of it, but for articles that score like it
    return " ".join(filter(None, (_text(x) for x in best.parent.items if x is best or isinstance(x, Node) and not x.drop
                                  and x.tag == "article" and x.chars and x.score >= 0.2 * best.score)))


def extract_main(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """One row per page: the ``keep`` columns, text (empty if none) and n_chars, its code
    points. NULL html counts as empty; rows are independent, so repeated rows repeat; a
    ``keep`` column named like a result is replaced by it."""
    keep = [c for c in keep if c not in ("text", "n_chars")]
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("__html"))
    schema = StructType([src.schema[c] for c in keep] + [StructField("text", StringType()),
                                                         StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keep)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column(k).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*keep, "text", "n_chars"])

    return src.mapInArrow(run, schema)


def op10_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(table(spark, sf_dir, "pages"))
