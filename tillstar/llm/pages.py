"""Main text of web pages by a minimum cut over their blocks."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXT, annotate, column, pieces, remote

#: Elements that begin and end blocks; all others run on in the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir "
    "div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input keygen link meta param source track "
    "wbr".split()
)
#: Elements whose content is not text of the page; it goes up to their end tag, whatever it holds.
RAW = frozenset(
    "script style title textarea xmp iframe noembed noframes noscript template svg math object "
    "audio video canvas datalist".split()
)
#: An element that starts closes an open one of these kinds, unless one of the second list is
#: nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
#: Elements inside each other that are told apart; deeper ones count as their parents, as in browsers.
DEEPEST = 512
#: Inside these a paragraph that is open outside of them stays open.
SCOPES = frozenset("td th caption table button".split())

#: Elements and roles that hold no article, and those that do.
OUTSIDE = frozenset("nav footer aside form menu dialog search select button fieldset legend".split())
INSIDE = frozenset("article main".split())
ROLES_OUTSIDE = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog "
    "alertdialog alert tablist".split()
)
#: Words of class and id that tell boilerplate and content.
WORDS_OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs footer masthead topbar related recommended recommendations recirculation widget "
    "toolbar pagination pager copyright disclaimer skip hidden paywall taboola outbrain".split()
)
WORDS_COMMENTS = frozenset(
    "comment comments commentlist disqus reply replies respond discussion".split()
)
WORDS_INSIDE = frozenset("article content entry post story main body text".split())

#: An element whose class or id tells boilerplate is believed unless it holds this share of the
#: page's text, as the wrapper of a whole page may be named for its side bar.
BELIEVED = 2 / 3

#: Log-odds of content that the element around a block adds, in its nearest sense: fixed by the
#: meaning of the elements, not learned.
MARKED = {"outside": -6.0, "named outside": -6.0, "inside": 6.0, "named inside": 1.0, "": 0.0}
#: The most that its own text may tell for or against a block, so that what is marked stays.
MOST_TOLD = 3.0
#: Weights of the features of a block's own text where a corpus has no marked blocks to learn from:
#: a constant, log of the words, share of them in links, sentence ends per word, heading, words of
#: the block in proportion to the page's longest, a short block on rights.
DEFAULT = (-0.8, 0.6, -4.0, 2.0, 0.8, 1.0, -4.0)
#: Pages and blocks of a page that the weights are learned from; longer pages are left out whole.
SAMPLE_PAGES, SAMPLE_BLOCKS = 1000, 400

#: Cost of a border between two blocks that follow each other, and of one between a block, or an
#: element, and the element around it.
BORDER, NEST = 0.6, 0.4

_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]+)""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RIGHTS = re.compile(r"\u00a9|\(c\)|copyright|all rights reserved", re.I)
_SENTENCE = re.compile(r"[.!?。！？؟।](?=\s|$|[\"')\]”’»])")


def tokens(html: str):
    """(kind, value, attributes) of a page: text, start and end tags, in time in proportion to
    its length whatever it holds."""
    at, size = 0, len(html)
    unended: set[str] = set()
    quotes = True  # until a tag's quotes turn out to be unbalanced up to the end of the page
    while at < size:
        open_at = html.find("<", at)
        if open_at < 0:
            yield "text", html[at:], ""
            return
        if open_at > at:
            yield "text", html[at:open_at], ""
        following = html[open_at + 1 : open_at + 2]
        if following == "!":
            if html.startswith("<!--", open_at):
                end = html.find("-->", open_at + 4)
                # an empty comment may end at once
                for short in (">", "->"):
                    if html.startswith(short, open_at + 4):
                        end = open_at + 4 + len(short) - 3
                at = size if end < 0 else end + 3
            else:
                end = html.find(">", open_at)
                at = size if end < 0 else end + 1
            continue
        closing = following == "/"
        name = _NAME.match(html, open_at + 1 + closing)
        if name is None:
            if closing or following == "?":  # what browsers take for a comment
                end = html.find(">", open_at)
                at = size if end < 0 else end + 1
            else:
                yield "text", "<", ""
                at = open_at + 1
            continue
        rest = _REST.match(html, name.end()) if quotes else None
        if rest is None:
            quotes = False
            end = html.find(">", name.end())
            end = size if end < 0 else end + 1
        else:
            end = rest.end()
        kind = name.group().lower()
        if closing:
            yield "end", kind, ""
        else:
            yield "start", kind, html[name.end() : end - 1]
        at = end
        if (
            not closing and kind in RAW and kind not in unended
            and not html.startswith("/>", end - 2)
        ):
            over = re.compile(rf"</{kind}(?=[\s/>])", re.I).search(html, at)
            if over is not None:
                at = over.start()
            elif kind in ("script", "style"):
                at = size
            else:  # rather some text too much than the rest of the page lost
                unended.add(kind)


class Node:
    """An element with blocks: the one around it, and what its name, class and id tell."""

    __slots__ = ("up", "kind", "sense", "named", "article", "size", "number")

    def __init__(self, up, kind, sense="", named=""):
        self.up, self.kind, self.sense, self.named = up, kind, sense, named
        self.article = kind in INSIDE or up is not None and up.article
        self.size, self.number = 0, -1


def told(kind: str, attributes: str, up: Node) -> tuple[str, str]:
    """What an element tells of its content: by its kind or role, and by its class or id."""
    sense = named = ""
    if kind in OUTSIDE:
        sense = "outside"
    elif kind in INSIDE:
        sense = "inside"
    elif kind == "header" and not up.article:  # of the page; that of an article belongs to it
        sense = "outside"
    if "=" in attributes and kind not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name == "role":
                role = value.strip("\"'").lower()
                if role in ROLES_OUTSIDE:
                    sense = "outside"
                elif role in ("main", "article"):
                    sense = "inside"
            elif name in ("class", "id"):
                words = set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
                if words & WORDS_COMMENTS:
                    sense = "outside"
                elif words & WORDS_OUTSIDE:
                    named = "named outside"
                elif words & WORDS_INSIDE and not named:
                    named = "named inside"
    elif re.search(r"\bhidden\b", attributes) and kind not in ("html", "body"):
        named = "named outside"
    return sense, named


class Block:
    """A run of text between two borders of blocks."""

    __slots__ = ("text", "node", "words", "linked", "heading")

    def __init__(self, text, node, linked, heading):
        self.text, self.node, self.heading = text, node, heading
        self.words, self.linked = text.count(" ") + 1, linked


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page in its order, scripts, styles and markup left out, character
    references decoded, white space turned into single spaces."""
    root = Node(None, "")
    stack, open_kinds, found = [root], Counter(), []
    parts: list[str] = []
    linked = 0  # words of the block inside links
    link = 0  # depth of the element that holds the open link

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                top = stack[-1]
                block = Block(text, top, linked, any(top.kind == f"h{i}" for i in range(1, 7)))
                found.append(block)
        linked = 0

    def pop():
        nonlocal link
        open_kinds[stack.pop().kind] -= 1
        if link > len(stack):
            link = 0

    for kind, value, attributes in tokens(html or ""):
        if kind == "text":
            text = unescape(value) if "&" in value else value
            parts.append(text)
            if link:
                linked += len(text.split())
        elif value == "br":
            parts.append(" ")
        elif value == "a":
            link = len(stack) if kind == "start" else 0
        elif value not in BLOCKS:
            if value in ("img", "input", "iframe", "video", "audio"):
                parts.append(" ")
        elif kind == "start":
            flush()
            if open_kinds["p"] and value not in ("button", "option", "optgroup", "legend"):
                depth = len(stack) - 1
                while depth and stack[depth].kind not in SCOPES and stack[depth].kind != "p":
                    depth -= 1
                if stack[depth].kind == "p":
                    while len(stack) > depth:
                        pop()
            if value in CLOSES:
                own, limits = CLOSES[value]
                if any(open_kinds[k] for k in own):
                    depth = len(stack) - 1
                    while depth and stack[depth].kind not in own and stack[depth].kind not in limits:
                        depth -= 1
                    if stack[depth].kind in own:
                        while len(stack) > depth:
                            pop()
            if len(stack) < DEEPEST and value not in VOID and value not in ("html", "head", "body"):
                stack.append(Node(stack[-1], value, *told(value, attributes, stack[-1])))
                open_kinds[value] += 1
        else:
            flush()
            if open_kinds[value]:
                while stack[-1].kind != value:
                    pop()
                pop()
    flush()
    return found


def marks(found: list[Block]) -> list[str]:
    """What the elements around each block tell of it, "" where they tell nothing."""
    total = 0
    for block in found:
        node = block.node
        while node is not None:
            node.size += block.words
            node = node.up
        total += block.words
    known: dict[int, str] = {}

    def mark(node):
        # from the outermost element inwards: boilerplate holds for all inside, content until
        # something nearer tells boilerplate
        chain = []
        while node is not None and id(node) not in known:
            chain.append(node)
            node = node.up
        sense = known[id(node)] if node is not None else ""
        for node in reversed(chain):
            believed = node.named != "named outside" or node.size < BELIEVED * total
            if sense not in ("outside", "named outside") or node.sense == "inside":
                if node.sense == "outside":
                    sense = "outside"
                elif node.sense == "inside":
                    # an article in a list of advertised ones is one of them
                    sense = sense if sense == "outside" or sense == "named outside" else "inside"
                elif node.named == "named outside" and believed:
                    sense = "named outside"
                elif node.named == "named inside" and sense == "":
                    sense = "named inside"
            known[id(node)] = sense
        return sense

    return [known[id(b.node)] if id(b.node) in known else mark(b.node) for b in found]


def features(found: list[Block]) -> np.ndarray:
    """What the text of each block tells, in the order of DEFAULT."""
    longest = max((b.words for b in found), default=1)
    rows = [
        (
            1.0, np.log(b.words), min(1.0, b.linked / b.words),
            min(1.0, 8 * len(_SENTENCE.findall(b.text)) / b.words), float(b.heading),
            b.words / longest, float(b.words < 40 and _RIGHTS.search(b.text) is not None),
        )
        for b in found
    ]
    return np.array(rows, float).reshape(len(rows), len(DEFAULT))


def kept_side(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes a minimum cut leaves with the content.

    A node with positive log-odds pays them if it is cut off from the content, one with negative
    ones if it isn't, and every edge between the two sides pays its weight. The cut is that of a
    maximum flow: shortest augmenting paths level by level. Nodes that tie go with the boilerplate.
    """
    count = len(odds)
    scale = 1 << 16  # whole numbers, so that equal costs tie
    excess = [int(round(x * scale)) for x in odds]
    heads: list[list[int]] = [[] for _ in range(count)]
    to, room = [], []
    for a, b, weight in edges:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to += (b, a)
        room += (int(round(weight * scale)),) * 2

    while True:
        level = [-1] * count
        queue = [v for v in range(count) if excess[v] > 0]
        for v in queue:
            level[v] = 0
        sinks = False
        for v in queue:  # grows while it is read
            if excess[v] < 0:
                sinks = True
                continue
            step = level[v] + 1
            for e in heads[v]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = step
                    queue.append(to[e])
        if not sinks:
            return [x >= 0 for x in level]
        place = [0] * count
        for source in [v for v in queue if excess[v] > 0]:
            path: list[int] = []
            v = source
            while excess[source] > 0:
                if excess[v] < 0:
                    flow = min(excess[source], -excess[v], *(room[e] for e in path))
                    excess[source] -= flow
                    excess[v] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, v = [], source
                    continue
                edge = -1
                while place[v] < len(heads[v]):
                    e = heads[v][place[v]]
                    if room[e] and level[to[e]] == level[v] + 1:
                        edge = e
                        break
                    place[v] += 1
                if edge >= 0:
                    path.append(edge)
                    v = to[edge]
                elif path:
                    edge = path.pop()
                    v = to[edge ^ 1]
                    place[v] += 1
                else:
                    break


def content(html: str | None, weights=DEFAULT) -> list[Block]:
    """The blocks of a page that the minimum cut takes for content.

    The classifier's log-odds of a block, of its own text and of the elements around it, are
    capacities to the terminals. Blocks that follow each other are joined by an edge, the cheaper
    to cut the more elements lie between them, and every block and element to the element around
    it, if it holds several; so are the elements up to the page itself.
    """
    found = blocks(html)
    if not found:
        return []
    told_of = marks(found)
    odds = (features(found) @ np.asarray(weights)).clip(-MOST_TOLD, MOST_TOLD)
    odds = list(odds + np.array([MARKED[m] for m in told_of]))

    # numbers for the elements that hold blocks, the innermost that hold all of them the last
    children = Counter()
    seen = set()
    for block in found:
        node = block.node
        children[id(node)] += 1
        while node.up is not None and id(node) not in seen:
            seen.add(id(node))
            children[id(node.up)] += 1
            node = node.up
    edges: list[tuple[int, int, float]] = []

    def hub(node):
        """The nearest element with several children, as a node of the graph."""
        while node is not None and children[id(node)] < 2:
            node = node.up
        path = []
        while node is not None and node.number < 0:
            node.number = len(odds)
            odds.append(0.0)
            path.append(node)
            node = node.up
            while node is not None and children[id(node)] < 2:
                node = node.up
        chain = path if node is None else [*path, node]
        edges.extend((a.number, b.number, NEST) for a, b in zip(chain, chain[1:], strict=False))
        return chain[0].number if chain else -1

    for at, block in enumerate(found):
        number = hub(block.node)
        if number >= 0:
            edges.append((at, number, NEST))
        if at:
            edges.append((at - 1, at, BORDER / (1 + apart(found[at - 1].node, block.node))))
    kept = kept_side(np.array(odds), edges)
    return [b for b, keep in zip(found, kept, strict=False) if keep]


def apart(a: Node, b: Node) -> int:
    """Elements between two blocks' own ones and the innermost that holds both, at most 8."""
    own = []
    node = a
    while node is not None and len(own) < 8:
        own.append(node)
        node = node.up
    steps, node = 0, b
    while node is not None and steps < 8:
        for k, above in enumerate(own):
            if above is node:
                return max(0, k - 1) + max(0, steps - 1)
        node, steps = node.up, steps + 1
    return 8


def extracted(texts, weights):
    made = ["\n".join(b.text for b in content(t, weights)) for t in texts]
    return [pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())]


def _examples(batches, most):
    """Features of the blocks that elements mark as content or boilerplate, one row a page."""
    for batch in batches:
        for piece in pieces(batch, TEXT):
            rows, labels, values = [], [], []
            for row, html in enumerate(piece.column(TEXT).to_pylist()):
                found = blocks(html)
                if not 0 < len(found) <= most:
                    continue
                told_of = marks(found)
                known = [k for k, m in enumerate(told_of) if m in ("inside", "outside")]
                if known:
                    rows.append(row)
                    labels.append([told_of[k] == "inside" for k in known])
                    values.append(features(found)[known].ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("hash").take(pa.array(rows, pa.int64())),
                    pa.array(labels, pa.list_(pa.bool_())),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                ["hash", "labels", "features"],
            )


def fit(
    df: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES,
    sample_blocks: int = SAMPLE_BLOCKS,
) -> tuple[float, ...]:
    """Weights of the block features, learned from blocks that elements mark.

    Blocks inside `article` and `main` are content, those in `nav`, `footer` and their like
    boilerplate; what is learned tells the blocks that nothing marks. The sample is the
    `sample_pages` distinct pages of the smallest hashes, those of more than `sample_blocks` blocks
    left out whole. Logistic regression, drawn to DEFAULT, which stands where one kind is missing.
    """
    source = df.select(column(html).cast("string").alias(TEXT)).select(
        F.xxhash64(TEXT).alias("hash"), TEXT
    )
    chosen = source.select("hash").distinct().orderBy("hash").limit(sample_pages)
    examples = (
        source.join(F.broadcast(chosen), "hash")  # at most 8 bytes a sampled page
        .mapInArrow(
            remote(_examples, sample_blocks),
            "hash long, labels array<boolean>, features array<double>",
        )
        .dropDuplicates(["hash"])
        .orderBy("hash")
        .select("labels", "features")
        .toArrow()
    )
    if not examples.num_rows:
        return DEFAULT
    labels = np.array(sum(examples["labels"].to_pylist(), []), float)
    rows = np.array(sum(examples["features"].to_pylist(), []), float).reshape(len(labels), -1)
    if not 0 < labels.sum() < len(labels):
        return DEFAULT
    # both kinds weigh the same, however many blocks each has
    share = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    start, pull = np.array(DEFAULT), 0.02
    weights = start.copy()
    for _ in range(30):  # Newton's method
        chance = 1 / (1 + np.exp(-(rows @ weights).clip(-30, 30)))
        slope = rows.T @ (share * (chance - labels)) + pull * (weights - start)
        curve = (rows * (share * chance * (1 - chance))[:, None]).T @ rows
        weights = weights - np.linalg.solve(curve + pull * np.eye(len(start)), slope)
    return tuple(float(x) for x in weights.round(6))


def main_text(
    df: DataFrame, html: str = "html", keep: list[str] | None = None, weights=None
) -> DataFrame:
    """Add text (of the blocks that are content, in page order, joined by one line break) and
    n_chars (its code points) to every page; `weights` as `fit` gives them (default: learned here).

    A null or empty page, and one without content, has the empty text. Pages of any length and
    nesting, with unclosed or stray tags, are read as browsers read them as far as blocks go.
    Repeated rows are read each alone; an empty table stays empty. Input columns named like a new
    one give way to it.
    """
    weights = fit(df, html) if weights is None else tuple(weights)
    return annotate(df, html, keep, "text string, n_chars long", extracted, weights)
