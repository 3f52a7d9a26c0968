"""HTML main text by a tree-structured graphical model.

The block elements of a page are the nodes of a tree. Each node is content, boilerplate or
a frame around either; a node factor weighs what its tag, names and text look like, and an
edge factor how often a child is one of the three under its parent. Messages go up from the
leaves to the root and down again (sum-product), which gives the exact marginals of every
node; the text of nodes whose likeliest state is content is the main text.

The factors are trained on labelled pages: a bounded sample of pages with a landmark
(``article`` or ``main``) labels its own nodes, those inside the landmark content, those
around it frames and those beside it boilerplate, as is what is boilerplate wherever it
stands (navigation, asides, forms, comment sections and the like). What the pages show is
averaged with what fixed lists of names let expect, so that pages without a landmark, and a model
without a sample, are decided as well; no single look weighs more than ``MOST`` nats.

Scripts, styles, templates and what the head may hold never are text; the head ends at the
first element that can't stand in it, also without an end tag. References are decoded, white
space within a block becomes one blank, blocks are joined by a line break in page order. A
null or empty page, and one without content, has empty text. Unclosed elements end where
the standard ends them or with the page; a tag that the page's end cuts off is dropped.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm import rows

SAMPLE = 1000
SAMPLE_CHARS = 100_000
PSEUDO = 20.0
MOST = 10.0

FRAME, CONTENT, BOILERPLATE = range(3)

# Element names of the standard by role, and names that sites give blocks.
RAW = ("script", "style", "template", "noscript", "textarea", "title", "select", "svg", "iframe")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul button caption label legend".split()
)
LANDMARKS = frozenset(("article", "main"))
BOILERPLATE_TAGS = frozenset("nav aside header footer form menu dialog button fieldset label legend search".split())
CONTENT_TAGS = frozenset("article main p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments reply replies disqus "
    "respond cookie cookies consent gdpr notice notification alert popup modal overlay subscribe subscription newsletter "
    "signup login share sharing social related recommended recommendations widget pagination pager search form copyright "
    "legal disclaimer tags toc teaser skip".split()
)
# Longer names are also recognised where they begin a word.
BEGINNINGS = tuple(sorted(w for w in BOILERPLATE_NAMES if len(w) > 5))
FRAME_TAGS = frozenset("html body div section".split())
CONTENT_NAMES = frozenset("article content post entry story main body text maincontent articlebody postbody".split())
# An open element of the first kind ends where one of the second begins.
ENDS_AT = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
    "p": BLOCKS - {"button", "label", "caption", "legend"},
}
KEEPS_OPEN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}

# The rest of a tag up to its end: a quote only opens a value behind an equals sign. Each character is read
# once; a tag without an end takes the rest of the page.
_INSIDE = r"(?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)"
    # An svg element can be empty; a slash at the end of an unquoted value is the value's.
    r"|<svg(?=[\s/])(?:[^>=/]|/(?!>)|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))*+/>"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>]){_INSIDE}>.*?(?:</(?P=raw)(?=[\s/>]){_INSIDE}>|\Z)"
    rf"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>{_INSIDE})>"
    rf"|</?[a-zA-Z]{_INSIDE}(?:=.*)?\Z|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "parent", "order", "runs", "linked", "chars")

    def __init__(self, tag: str, names: tuple[str, ...], parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.runs: list[tuple[int, str]] = []
        self.chars = self.linked = 0


def name_words(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = [a or b or c for a, b, c in _NAMES.findall(attributes)]
    return tuple(w for f in found for w in _WORD.findall(f.lower()))


def parse(html: str) -> list[Node]:
    """Block elements in page order; the first is the root. Text runs carry their order."""
    nodes = [Node("#root", (), -1)]
    open_blocks, links, order, at = [0], 0, 0, 0

    def text(piece: str) -> None:
        nonlocal order
        if not piece:
            return
        node = nodes[open_blocks[-1]]
        if not piece.isspace():
            node.chars += len(piece)
            node.linked += len(piece) if links else 0
        node.runs.append((order, piece))
        order += 1

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            text(references.unescape(html[at:m.start()]))
        at = m.end()
        if m["data"]:
            text(m["data"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag == "a":
            links = 0 if m["end"] else 1
        if tag not in BLOCKS:
            if tag in VOID and tag in ("br", "hr", "img", "input"):
                text(" ")
            continue
        if m["end"]:
            for k in range(len(open_blocks) - 1, 0, -1):
                if nodes[open_blocks[k]].tag == tag:
                    del open_blocks[k:]
                    links = 0
                    break
            continue
        for k in range(len(open_blocks) - 1, 0, -1):
            inside = nodes[open_blocks[k]].tag
            if tag in ENDS_AT.get(inside, ()):
                del open_blocks[k:]
                break
            if inside in KEEPS_OPEN.get(tag, ()) or inside not in ("p", "li", "dt", "dd", "td", "th", "tr"):
                break
        nodes.append(Node(tag, name_words(m["attributes"]), open_blocks[-1]))
        open_blocks.append(len(nodes) - 1)
    if at < len(html):
        text(references.unescape(html[at:]))
    return nodes


def names_boilerplate(word: str) -> bool:
    return word in BOILERPLATE_NAMES or word.startswith(BEGINNINGS)


def looks(node: Node) -> list[str]:
    """What a node looks like, as the names of its factor's terms."""
    share = node.linked / node.chars if node.chars else 0
    size = "none" if not node.chars else "short" if node.chars < 25 else "medium" if node.chars < 120 else "long"
    found = [f"size:{size}"]
    if node.chars:
        found.append(f"links:{'no' if share < 0.2 else 'some' if share < 0.6 else 'many'}")
    # A name says more than the tag: comments are often articles of their own.
    if any(map(names_boilerplate, node.names)):
        found.append("named:boilerplate")
    else:
        found.append(f"tag:{node.tag}")
        if not CONTENT_NAMES.isdisjoint(node.names):
            found.append("named:content")
    return found


def is_boilerplate(node: Node) -> bool:
    return node.tag in BOILERPLATE_TAGS or any(map(names_boilerplate, node.names))


def labelled(nodes: list[Node]) -> list[int] | None:
    """States of the nodes of a page with a landmark; None without one."""
    states = []
    landmarks = False
    for node in nodes:
        above = states[node.parent] if node.parent >= 0 else FRAME
        if above == BOILERPLATE or is_boilerplate(node):
            states.append(BOILERPLATE)
        elif above == CONTENT or node.tag in LANDMARKS:
            landmarks = True
            states.append(CONTENT)
        else:
            states.append(FRAME)
    # What holds no landmark isn't a frame.
    holds = [state == CONTENT for state in states]
    for i in range(len(nodes) - 1, 0, -1):
        if holds[i]:
            holds[nodes[i].parent] = True
    return [s if s != FRAME or h else BOILERPLATE for s, h in zip(states, holds)] if landmarks else None


class Model:
    """Factors: of each look for every state, and of the child's state under the parent's."""

    def __init__(self, term: dict[str, tuple[float, ...]], edge: tuple[tuple[float, ...], ...]):
        self.term, self.edge = term, edge

    def _own(self, node: Node) -> list[float]:
        f = c = b = 0.0
        for look in looks(node):
            term = self.term.get(look)
            if term:
                f, c, b = f + term[0], c + term[1], b + term[2]
        top = max(f, c, b)
        return [math.exp(f - top), math.exp(c - top), math.exp(b - top)]

    def marginals(self, nodes: list[Node]) -> list[list[float]]:
        """Probabilities of the states of every node, by messages up and down the tree."""
        below = [self._own(n) for n in nodes]
        below[0] = [1.0, 0.2 if nodes[0].chars else 1e-6, 1e-6]
        sent: list[list[float]] = [[]] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            x, y, z = below[i]
            message = [e[0] * x + e[1] * y + e[2] * z for e in self.edge]
            top = sum(message)
            sent[i] = message = [v / top for v in message]
            up = below[nodes[i].parent]
            up[0], up[1], up[2] = up[0] * message[0], up[1] * message[1], up[2] * message[2]
            top = up[0] + up[1] + up[2]
            up[0], up[1], up[2] = up[0] / top + 1e-30, up[1] / top + 1e-30, up[2] / top + 1e-30
        total = sum(below[0])
        whole = [[v / total for v in below[0]]]
        e = self.edge
        for i in range(1, len(nodes)):
            parent, message, own = whole[nodes[i].parent], sent[i], below[i]
            x, y, z = parent[0] / message[0], parent[1] / message[1], parent[2] / message[2]
            here = [own[k] * (e[0][k] * x + e[1][k] * y + e[2][k] * z) for k in range(3)]
            total = here[0] + here[1] + here[2]
            whole.append([here[0] / total + 1e-30, here[1] / total + 1e-30, here[2] / total + 1e-30])
        return whole

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        nodes = parse(html)
        likely = self.marginals(nodes)
        blocks = []
        for node, p in zip(nodes, likely):
            if node.chars and p[CONTENT] > p[FRAME] and p[CONTENT] > p[BOILERPLATE]:
                run, last = [], None
                for order, piece in node.runs:
                    # Text before and after an inner block are blocks of their own.
                    if last is not None and order != last + 1:
                        blocks.append((run[0][0], "".join(x for _, x in run)))
                        run = []
                    run.append((order, piece))
                    last = order
                blocks.append((run[0][0], "".join(x for _, x in run)))
        lines = (_SPACE.sub(" ", text).strip() for _, text in sorted(blocks))
        return "\n".join(line for line in lines if line)


# What is expected without labelled pages: a share of each look in the states frame, content
# and boilerplate, by the lists, and the child's state under each parent's.
EXPECTED_EDGES = ((0.25, 0.20, 0.55), (1e-6, 0.93, 0.07), (1e-6, 1e-3, 0.999))
EXPECTED_LOOKS = (
    *((tag, (0.005, 0.001, 0.994)) for tag in sorted(BOILERPLATE_TAGS)),
    *((tag, (0.05, 0.70, 0.25)) for tag in sorted(CONTENT_TAGS - LANDMARKS - {"h1"})),
    ("h1", (0.03, 0.87, 0.10)),
    *((tag, (5e-4, 0.999, 5e-4)) for tag in sorted(LANDMARKS)),
    *((tag, (0.9998, 1e-4, 1e-4)) for tag in ("html", "body")),
)


def expected() -> dict[str, tuple[float, ...]]:
    looks_ = {f"tag:{tag}": share for tag, share in EXPECTED_LOOKS}
    return looks_ | {
        "named:boilerplate": (5e-4, 5e-4, 0.999), "named:content": (0.10, 0.85, 0.05), "size:long": (0.05, 0.80, 0.15),
        "size:medium": (0.10, 0.50, 0.40), "size:short": (0.10, 0.42, 0.48), "links:many": (0.05, 0.20, 0.75),
        "links:some": (0.10, 0.40, 0.50), "links:no": (0.15, 0.50, 0.35), "size:none": (0.50, 0.30, 0.20),
    }


def fit(pages: list[str]) -> Model:
    """Shares of states by look and by parent over the labelled pages, halfway to what is expected.

    Every page counts once for each look and state, so that long pages don't outweigh others.
    Nodes that the lists name as boilerplate, and what they hold, teach nothing of tags and names.
    """
    seen: dict[str, list[float]] = {}
    edges = [[0.0] * 3 for _ in range(3)]
    pages_of = [1.0] * 3
    for html in pages:
        nodes = parse(html)
        states = labelled(nodes)
        if states is None:
            continue
        named: list[bool] = []
        for node in nodes:
            named.append(is_boilerplate(node) or node.parent >= 0 and named[node.parent])
        once = {(look, states[i]) for i in range(1, len(nodes)) for look in looks(nodes[i])
                if not named[i] or look.startswith(("size:", "links:"))}
        for look, state in once:
            seen.setdefault(look, [0.0] * 3)[state] += 1
        for state in set(states[1:]):
            pages_of[state] += 1
        for node, state in zip(nodes[1:], states[1:]):
            edges[states[node.parent]][state] += 1
    term = {}
    prior = expected()
    for look in prior.keys() | seen.keys():
        share = prior.get(look, (1 / 3, 1 / 3, 1 / 3))
        if look in seen:
            rates = [(seen[look][k] + share[k]) / pages_of[k] for k in range(3)]
            # Sizes differ more between sites than tags and names do.
            weight = 0.25 if look.startswith(("size:", "links:")) else 0.5
            share = [weight * rate / sum(rates) + (1 - weight) * e for rate, e in zip(rates, share)]
        term[look] = tuple(max(math.log(v / max(share)), -MOST) for v in share)
    edge = []
    for counts, share in zip(edges, EXPECTED_EDGES):
        total = sum(counts) + PSEUDO
        edge.append(tuple((n + PSEUDO * e) / total / 2 + e / 2 for n, e in zip(counts, share)))
    return Model(term, tuple(edge))


def train(pages: DataFrame, html: str = "html", page_id: str = "page_id", sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` pages of at most ``SAMPLE_CHARS`` characters, by the hash of their ids."""
    found = (
        pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{html}`").alias("html"))
        .where(F.length("html").between(1, SAMPLE_CHARS))
    )
    ids = found.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = (
        found.join(F.broadcast(ids), found["id"].eqNullSafe(ids["id"]), "left_semi").groupBy("id").agg(F.min("html").alias("html"))
    )
    return fit([r["html"] for r in chosen.orderBy("id").collect()])


def extractor(spark: SparkSession, model: Model):
    """Column function: the main text of a page."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            yield pa.array([shared.value.extract(h) for h in batch.to_pylist()], pa.string())

    return extract


def extract_column(pages: DataFrame, model: Model, html: str = "html") -> Column:
    return extractor(pages.sparkSession, model)(F.col(f"`{html}`"))
